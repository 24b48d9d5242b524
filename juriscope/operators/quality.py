"""Quality rules over structured acts, and words that no lexicon knows."""

from __future__ import annotations

from string import ascii_letters

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriscope.functions.text import letters_only
from juriscope.sources.shared import shared_path

#: Words that are sent to all tasks, at most.
MISSING = 500_000
#: What stands between words.  Letters are listed one by one, which Java's regex looks up in one table; ranges it tries one after the other at each character.
WORDS = f"[^{ascii_letters}àâéèêëîïôûùçœ'-]+"


def lexicon(lines: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct normalised words of three letters or more."""
    words = F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), r"\s+")).alias("w")
    return lines.select(words).select(letters_only(F.col("w")).alias("word")).where(F.length("word") > 2).distinct()


def unknown_words(texts: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MISSING) -> DataFrame:
    """id and how many words of four letters or more the lexicon lacks, repeats counted; 0 included.  Ids are distinct.

    Each distinct word of the corpus is normalised and looked up once.  The words
    that the lexicon lacks are written and counted; up to ``most`` are sent to all
    tasks, so occurrences are counted where they stand; more of them meet the
    occurrences by a shuffle.  A text without words keeps its row by an empty one.
    """
    spark = texts.sparkSession
    each = texts.select(id_col, F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), WORDS)).alias("w"))
    words = each.select("w").distinct().select("w", letters_only(F.col("w")).alias("word")).where(F.length("word") >= 4)
    path = shared_path(spark, "missing-words")
    words.join(known.select("word").distinct(), "word", "left_anti").select("w", F.lit(True).alias("missing")).write.parquet(path)
    missing = spark.read.parquet(path)
    if missing.count() <= most:
        told = each.join(F.broadcast(missing), "w", "left").withColumn("count", F.lit(1))
    else:
        told = each.groupBy(id_col, "w").count().join(missing, "w", "left")
    return told.groupBy(id_col).agg(F.sum(F.when(F.col("missing"), F.col("count")).otherwise(0)).cast("long").alias("n_unknown"))


def structure_errors(laws: DataFrame) -> DataFrame:
    """A row for each broken rule of (doc_id, law_number, n_articles)."""
    checks = F.array(
        F.when(F.col("law_number").isNull(), F.lit("Structure: lawNumber manquant")),
        F.when(F.coalesce("n_articles", F.lit(0)) < 2, F.lit("Structure: < 2 articles")),
    )
    return laws.select("doc_id", F.explode(F.array_compact(checks)).alias("error"))


def act_errors(laws: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, place and error of acts (doc_id, metadata, articles): broken structure first (place 0), then each article's words that the lexicon lacks.

    A blank article, like any with an empty lexicon, has none.
    """
    counted = laws.select("doc_id", F.col("metadata.lawNumber").alias("law_number"), F.size("articles").alias("n_articles"))
    broken = structure_errors(counted).select("doc_id", F.lit(0).alias("place"), "error")
    each = laws.select("doc_id", F.posexplode("articles").alias("pos", "a")).select(F.struct("doc_id", (F.col("pos") + 1).alias("place")).alias("id"), F.col("a.content").alias("text"))
    unknown = unknown_words(each, known, "id").where("n_unknown > 0").select("id.doc_id", "id.place", F.format_string("LEXIQUE: %d mots inconnus dans l'article %d", "n_unknown", "id.place").alias("error"))
    any_known = known.limit(1).select(F.lit(True).alias("any"))
    return broken.unionByName(unknown.join(F.broadcast(any_known)).drop("any"))


def stamped(laws: DataFrame, source: str, by: str) -> DataFrame:
    """Acts with the file that they come from, who extracted them and when, in their metadata."""
    m = F.col("metadata")
    return laws.withColumn("metadata", m.withField("source_pdf", F.col(source)).withField("extracted_by", F.lit(by)).withField("extracted_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")))


def gate(laws: DataFrame) -> DataFrame:
    """Each act with whether it passes: a number that is not blank and two articles."""
    return laws.withColumn("passes", F.coalesce(F.trim("law_number") != "", F.lit(False)) & (F.coalesce("n_articles", F.lit(0)) >= 2))


def accepted_and_rejected(laws: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Acts that pass the gate, and the others with the first rule that they break; one bad act stops no other."""
    told = gate(laws)
    why = F.when(F.coalesce(F.trim("law_number") == "", F.lit(True)), "lawNumber manquant").otherwise("Moins de 2 articles")
    return told.where("passes").drop("passes"), told.where(~F.col("passes")).drop("passes").withColumn("reason", why)
