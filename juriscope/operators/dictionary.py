"""Repair of misread words against a dictionary, by equi-joins over the distinct words.

A dictionary is a table of (priority, word); of several words that fit, the one
of least priority is taken, of equals the first by code point.  Words at edit distance 1 and of equal length share
a pattern with one letter masked, so they meet in a hash join on that pattern;
a pattern's group is bounded by the alphabet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from juriscope.functions.text import strip_accents
from juriscope.rules import FRENCH_LAW, Rules

#: The rules in the order in which they are tried.
RULES = ("capital i", "glued", "protected", "frequent", "split", "accent", "shape", "distance")


def folded(word: Column) -> Column:
    """Lower case, with the ligature written out."""
    return F.replace(F.lower(word), F.lit("œ"), F.lit("oe"))


def is_upper(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\p{Lu}"), F.lit(False))


def repairable(word: Column) -> Column:
    """Two letters or more, all of them letters, the first in lower case."""
    return F.coalesce(word.rlike(r"^\p{L}{2,}$") & ~is_upper(word), F.lit(False))


def masked(word: Column) -> Column:
    """The word with each of its letters masked in turn."""
    at = F.when(F.length(word) > 0, F.sequence(F.lit(1), F.length(word))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(i.alias("at"), F.concat(F.substr(word, F.lit(1), i - 1), F.lit("\u0001"), F.substr(word, i + 1)).alias("pattern")))


def same_shape(read: Column, meant: Column, rules: Rules = FRENCH_LAW) -> Column:
    """Letters that OCR takes for one another: l for i, two descenders, two ascenders."""
    both = lambda letters: F.contains(F.lit(letters), read) & F.contains(F.lit(letters), meant)
    return ((read == "l") & (meant == "i")) | both(rules.descenders) | both(rules.ascenders)


def repaired_words(words: DataFrame, dictionary: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """word, rule and fixed for each distinct word that a rule changes.

    Cases: null words, words that are not repairable and words that the
    dictionary has are left out; a null or blank dictionary word counts as absent.
    """
    entries = dictionary.where(F.trim("word") != "").groupBy("word").agg(F.min("priority").alias("priority"))
    known = entries.select(F.lower("word").alias("known")).distinct()
    asked = words.select("word").where(repairable(F.col("word"))).distinct().withColumn("low", folded(F.col("word")))
    asked = asked.join(known, F.col("low") == F.col("known"), "left_anti")

    def found(df: DataFrame, rule: str, order: Column, fixed: Column) -> DataFrame:
        return df.select("word", F.struct(F.lit(RULES.index(rule)).alias("rule"), order.cast("long").alias("order"), fixed.alias("fixed")).alias("hit"))

    rows = entries.withColumnRenamed("word", "entry")
    capital = asked.where(F.startswith("word", F.lit("l"))).withColumn("entry", F.concat(F.lit("I"), F.substring("word", 2, 1 << 30))).join(rows, "entry")
    endings = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(e).alias("end")) for i, e in enumerate(("à", "au", "aux"))])
    glued = asked.where(F.length("low") > 2).select("word", "low", F.explode(endings).alias("e")).where(F.endswith("low", F.col("e.end")))
    glued = glued.withColumn("known", F.substr(F.col("low"), F.lit(1), F.length("low") - F.length("e.end"))).join(known, "known")
    protected = asked.where(F.col("low").rlike("(ois|oise|oises)$"))
    common = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in enumerate(rules.frequent_words)])
    frequent = asked.select("word", "low", F.explode(common).alias("c")).where((F.length("c.w") == F.length("low")) & (F.levenshtein("low", "c.w") == 1))
    n = F.length("low")
    cuts = asked.where(n >= 4).select("word", n.alias("n"), "low", F.explode(F.sequence(F.lit(2), n - 2)).alias("i"))
    cuts = cuts.select("word", (F.col("i") * 10 + F.col("n") - F.col("i")).alias("score"), F.substr("low", F.lit(1), F.col("i")).alias("a"), F.substr("low", F.col("i") + 1).alias("b"))
    for part in ("a", "b"):
        fine = (F.length(part) >= 3) | F.col(part).isin(*rules.short_words)
        cuts = cuts.where(fine).join(known, F.col(part) == F.col("known"), "left_semi")
    plain = rows.withColumn("low", F.replace(strip_accents(F.col("entry")), F.lit("ç"), F.lit("c"))).where(F.length("low") == F.length("entry"))
    accent = asked.join(plain, "low")
    near = asked.select("word", "low", F.inline(masked(F.col("low")))).join(rows.select("entry", "priority", F.inline(masked(F.col("entry")))), ["at", "pattern"]).where(F.col("low") != F.col("entry"))
    letter = lambda c: F.substr(c, F.col("at"), F.lit(1))
    alike = same_shape(letter(F.col("low")), letter(F.col("entry")), rules)
    hits = reduce(
        DataFrame.unionByName,
        (
            found(capital, "capital i", F.col("priority"), F.col("entry")),
            found(glued, "glued", F.col("e.i"), F.concat_ws(" ", "known", "e.end")),
            found(protected, "protected", F.lit(0), F.col("word")),
            found(frequent, "frequent", F.col("c.i"), F.col("c.w")),
            found(cuts, "split", -F.col("score"), F.concat_ws(" ", "a", "b")),
            found(accent, "accent", F.col("priority"), F.col("entry")),
            near.select("word", F.struct(F.when(alike, RULES.index("shape")).otherwise(RULES.index("distance")).alias("rule"), F.col("priority").cast("long").alias("order"), F.col("entry").alias("fixed")).alias("hit")),
        ),
    )
    best = hits.groupBy("word").agg(F.min("hit").alias("hit"))
    name = F.element_at(F.array(*map(F.lit, RULES)), F.col("hit.rule") + 1)
    return best.select("word", name.alias("rule"), F.col("hit.fixed").alias("fixed")).where(F.col("fixed") != F.col("word"))


def between_names(words: Column, i: Column) -> Column:
    """Whether the words on both sides have an initial capital."""
    return is_upper(F.get(words, i - 1)) & is_upper(F.get(words, i + 1))


def repaired_lines(lines: DataFrame, dictionary: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """doc_id, line_no and line with each word repaired, except between two names.

    Only words that change are shuffled back to their lines.  Cases: a null line
    stays null; blanks at a line's end go.
    """
    split = lines.select("doc_id", "line_no", F.split(F.regexp_replace("line", " +$", ""), " ").alias("words"))
    placed = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"), between_names(F.col("words"), i).alias("kept")))
    each = split.select("doc_id", "line_no", F.inline(placed)).where(~F.col("kept") & repairable(F.col("word")))
    changed = each.join(repaired_words(each.select("word"), dictionary, rules), "word")
    new = changed.groupBy("doc_id", "line_no").agg(F.map_from_entries(F.collect_set(F.struct("at", "fixed"))).alias("new"))
    put = F.transform("words", lambda w, i: F.coalesce(F.try_element_at(F.col("new"), i), w))
    return split.join(new, ["doc_id", "line_no"], "left").select("doc_id", "line_no", F.array_join(F.when(F.col("new").isNull(), F.col("words")).otherwise(put), " ").alias("line"))
