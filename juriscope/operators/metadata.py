"""Metadata of acts: number, object, date, signatories, source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriscope.functions.fuzzy import contains_target, fuzzy_match, gram_hits, is_garbage, let
from juriscope.functions.text import after_first, contains, french_date, from_first_digit, repair_date, single_line, starts_with, strip_accents, strip_accents_column, trimmed, trimmed_column
from juriscope.operators.lines import between_first, held, joined
from juriscope.rules import FRENCH_LAW, Rules


def starts_object(c, rules: Rules = FRENCH_LAW):
    out = F.lit(False)
    for s in rules.object_starts:
        out = out | starts_with(c, s)
    return out


def law_numbers(header: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """doc_id and law_number: from the line that begins with LOI to the object, from its first digit."""
    found = between_first(header, starts_with(F.col("line"), "LOI"), starts_object(F.col("line"), rules))
    return found.groupBy("doc_id").agg(from_first_digit(single_line(joined(["doc_id"]))).alias("law_number"))


def law_objects(header: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """doc_id and law_object: from the object's first line to the assembly's."""
    stop = F.lit(False)
    for t in rules.assembly:
        stop = stop | contains(F.col("line"), t)
    return between_first(header, starts_object(F.col("line"), rules), stop).groupBy("doc_id").agg(single_line(joined(["doc_id"])).alias("law_object"))


def law_dates(numbers: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """doc_id and the date that follows "DU" in the number, misread parts repaired; null if it is none."""
    year = F.col("year") if "year" in numbers.columns else F.lit(None).cast("string")
    return numbers.select("doc_id", french_date(let(after_first(F.col("law_number"), "DU"), lambda c: repair_date(c, year, rules)), rules).alias("law_date"))


def signature_lines(footer: DataFrame) -> DataFrame:
    """Lines between the closing formula, in the city that the document names, and the distribution list."""
    line = trimmed(F.col("line"))
    elsewhere = F.max(contains(F.col("line"), "PORTO-NOVO")).over(Window.partitionBy("doc_id"))
    told = footer.withColumn("elsewhere", elsewhere).withColumn("line", line).where(F.col("line") != "")
    here = F.when(F.col("elsewhere"), contains_target(F.col("line"), "Porto-Novo", 2)).otherwise(contains_target(F.col("line"), "Cotonou", 2))
    on = contains(F.col("line"), "Fait à") & here
    off = contains(F.col("line"), "AMPLIATIONS") | contains(F.col("line"), "JOURNAL OFFICIEL")
    told = told.withColumn("on", on).withColumn("inside", F.coalesce(held(F.when(F.col("on"), True).when(off, False)), F.lit(False)))
    return told.where(F.col("inside") & ~F.col("on")).drop("on", "inside", "elsewhere")


def grams(c: Column, n: int = 3) -> Column:
    """The n-grams of a text by place, repeats included; none of a shorter one."""
    return F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substr(c, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def indexed_grams(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """key and gram: the trigrams by which texts (text) must be met so that no key (key) with three trigrams in a text is missed.

    Of a key's places, those whose trigram no text has can match nothing.  If three
    of the others match, at most two of them are the two most frequent ones, so a
    key is found without these.  A key of under three places is found only as a
    whole, by its rarest trigram, if texts have all of them.
    """
    often = texts.select(F.explode(F.array_distinct(grams(F.col("text")))).alias("gram")).groupBy("gram").agg(F.count("*").alias("often"))
    places = keys.select("key", F.posexplode(grams(F.col("key"))).alias("place", "gram")).join(often, "gram")
    by_key = Window.partitionBy("key")
    ranked = places.withColumn("rank", F.row_number().over(by_key.orderBy("often", "place"))).withColumn("there", F.count("*").over(by_key))
    enough = (F.col("there") >= 3) | (F.col("there") == F.length("key") - 2)
    return ranked.where(enough & (F.col("rank") <= F.greatest(F.col("there") - 2, F.lit(1)))).select("key", "gram").distinct()


def candidates(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Pairs (text, key) of distinct texts and keys that may match: a rare trigram in common, or a key of one or two letters that the text holds."""
    met = texts.select("text", F.explode(F.array_distinct(grams(F.col("text")))).alias("gram")).join(indexed_grams(texts, keys), "gram")
    pieces = F.array_distinct(F.concat(grams(F.col("text"), 1), grams(F.col("text"), 2)))
    short = keys.where(F.length("key").between(1, 2)).select("key", F.col("key").alias("gram"))
    held = texts.select("text", F.explode(pieces).alias("gram")).join(short, "gram")
    return met.select("text", "key").unionByName(held.select("text", "key")).distinct()


def signatories(lines: DataFrame, register: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """Each line's first match in the register (priority, name, role), then each document's distinct ones in order.

    With ``rules.compat`` the first row with three common trigrams wins; without
    it the one with the most.  Lines and names meet by the names' rarer trigrams,
    so the register may be of any size.
    """
    lines = lines.withColumn("bare", trimmed_column(F.col("line")))
    left = lines.where(~is_garbage(F.col("bare")) & (F.col("bare") != "")).select("doc_id", "line_no", F.upper(F.col("line")).alias("text"))
    # a step a column, so that each is computed once
    for step in (strip_accents_column, trimmed_column, F.lower):
        left = left.withColumn("text", step(F.col("text")))
    right = register.select("priority", "name", "role", F.lower(trimmed(strip_accents(F.upper(F.col("name"))))).alias("key"))
    met = candidates(left.select("text").distinct(), right.select("key").distinct())
    met = met.where(fuzzy_match(F.col("text"), F.col("key"), F.greatest(F.length("text"), F.length("key")), 3, 3)).join(right, "key")
    rank = F.struct("priority", "name", "role") if rules.compat else F.struct((-gram_hits(F.col("text"), F.col("key"), 3)).alias("less"), "priority", "name", "role")
    best = met.groupBy("text").agg(F.min(rank).alias("best"))
    named = left.join(best, "text")
    return named.groupBy("doc_id", F.col("best.name").alias("name"), F.col("best.role").alias("role")).agg(F.min("line_no").alias("line_no"))
