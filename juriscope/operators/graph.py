"""Laws and articles as a graph of node and edge tables, kept up by keyed merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, key: str, *order) -> DataFrame:
    """One row for each key: the first in order; rows are combined before the shuffle."""
    columns = [c for c in df.columns if c != key]
    rows = df.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("__row"))
    return rows.select(*[F.col(key) if c == key else F.col(f"__row.{c}") for c in df.columns])


def last_by(df: DataFrame, key: str, *order) -> DataFrame:
    """One row for each key: the last in order."""
    columns = [c for c in df.columns if c != key]
    rows = df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("__row"))
    return rows.select(*[F.col(key) if c == key else F.col(f"__row.{c}") for c in df.columns])


def priority_union(preferred: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """All preferred rows, and of the others those whose key they lack.  A null key is one's own."""
    return preferred.unionByName(other.join(preferred.select(key).distinct(), key, "left_anti"))


def law_nodes(laws: DataFrame) -> DataFrame:
    """One node for each law number; the first document wins."""
    one = first_by(laws, "law_number", "doc_id")
    return one.select(F.col("law_number").alias("id"), F.col("law_object").alias("title"), F.col("law_date").alias("promulgated"), F.lit("En vigueur").alias("status"))


def article_nodes(articles: DataFrame, *also: str) -> DataFrame:
    """One node for each (law, index), with what other columns are named; the last article of an index wins."""
    key = F.concat("law_number", F.lit("_ART_"), "index")
    one = last_by(articles.withColumn("id", key), "id", "article_no")
    return one.select("id", F.concat(F.lit("Article "), "index").alias("label"), "law_number", "content", F.to_json(F.struct("law_number", "index")).alias("metadata"), *also)


def edges(nodes: DataFrame, laws: DataFrame) -> DataFrame:
    """Article to law, where the law exists."""
    return nodes.select(F.col("id").alias("src"), F.col("law_number").alias("dst")).join(laws.select(F.col("id").alias("dst")), "dst").select("src", "dst").distinct()


def upsert(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """New rows, and old rows that they do not replace."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def replace_children(old: DataFrame, new: DataFrame, parent: str = "law_number") -> DataFrame:
    """New children, and old ones of parents that have no new children."""
    return new.unionByName(old.join(new.select(parent).distinct(), parent, "left_anti"))


def duplicates(df: DataFrame, key: str = "id") -> DataFrame:
    """Keys that stand in several rows: empty if the constraint holds."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
