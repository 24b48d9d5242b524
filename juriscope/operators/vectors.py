"""Vectors of articles: chunk means, cosine search, joins with articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from juriscope.functions.fuzzy import let
from juriscope.functions.text import chunks, is_blank


def mean_vector(rows: DataFrame, by: str, vector_col: str) -> DataFrame:
    """Element-wise mean of a group's vectors, computed by position with partial aggregates."""
    spread = rows.select(by, F.posexplode(vector_col).alias("pos", "x"))
    means = spread.groupBy(by, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"]).alias("vector"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null for a zero vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def cosine_top_k(rows: DataFrame, query: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows nearest to the one row of ``query`` by angle, ties to the smaller id."""
    q = query.select(F.col(vector_col).alias("q")).limit(1)
    return rows.join(F.broadcast(q)).select(id_col, cosine(F.col(vector_col), F.col("q")).alias("score")).orderBy(F.desc_nulls_last("score"), id_col).limit(k)


def hashed_embedding(text: Column, dims: int = 64) -> Column:
    """A deterministic stand-in for a model: signed word counts by hash, in unit length; zero without words."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    slots = F.transform(words, lambda w: F.struct(F.pmod(F.xxhash64(w), F.lit(dims)).cast("int").alias("i"), F.when(F.pmod(F.xxhash64(w, F.lit(1)), F.lit(2)) == 0, 1.0).otherwise(-1.0).alias("s")))
    zero = F.array_repeat(F.lit(0.0), dims)

    def add(acc: Column, x: Column) -> Column:
        return F.transform(acc, lambda y, i: F.when(i == x["i"], y + x["s"]).otherwise(y))

    def unit(raw: Column) -> Column:
        length = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda s, x: s + x * x))
        return let(length, lambda n: F.transform(raw, lambda x: F.when(n > 0, x / n).otherwise(x)))

    return let(F.aggregate(slots, zero, add), unit)


def embed_texts(rows: DataFrame, embed=hashed_embedding, most: int = 512) -> DataFrame:
    """key and the mean of the vectors of the text's chunks, of rows (key, content).

    ``embed`` is a Column function, or an adapter: a function from frames of (key,
    chunk) to frames of (key, vector) that runs a model in ``mapInPandas``; or a
    store of vectors, which has ``vectors_of``.
    """
    if hasattr(embed, "vectors_of"):
        return embed.vectors_of(rows, most)
    pieces = rows.select("key", F.explode(F.when(F.length("content") <= most, F.array("content")).otherwise(chunks(F.col("content"), most))).alias("chunk"))
    if getattr(embed, "adapter", False):
        kind = rows.schema["key"].dataType.simpleString()
        return mean_vector(pieces.mapInPandas(embed, f"key {kind}, vector array<double>").withColumnRenamed("vector", "v"), "key", "v")
    return mean_vector(pieces.select("key", embed(F.col("chunk")).alias("v")), "key", "v")


def adapter(f):
    """Mark a function over frames as an embedding adapter."""
    f.adapter = True
    return f


def embed_articles(articles: DataFrame, embed=hashed_embedding, most: int = 512) -> DataFrame:
    """doc_id, article_no and the mean of the chunks' vectors; blank articles are left out."""
    rows = articles.where(~is_blank(F.col("content"))).select(F.struct("doc_id", "article_no").alias("key"), "content")
    return embed_texts(rows, embed, most).select("key.*", "vector")


def with_vectors(articles: DataFrame, vectors: DataFrame, on: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """Articles with their first vector, and the articles that have none."""
    columns = [c for c in vectors.columns if c not in (*on, order)]
    first = vectors.groupBy(*on).agg(F.min_by(F.struct(*columns), order).alias("__first")).select(*on, "__first.*")
    return articles.join(first, on), articles.join(first, on, "left_anti")
