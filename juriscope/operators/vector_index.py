"""An index of vectors by angle: random hyperplanes, several tables of buckets, and a sketch.

Each table cuts space by a few hyperplanes; the sides on which a vector lies are
its bucket there.  Vectors at a small angle share a bucket in some table.  A
query looks into its own bucket of each table and those beyond the planes that
it lies nearest to.  What shares a bucket is an equi-join; of it the rows whose
sketches (sides of many more planes) differ least are scored exactly.

The index holds each distinct vector once, by digest, and is only ever added to:
articles that come, change or go need no index rows rewritten, as the current
articles say which digests count.  Two tables are kept:

``vectors``: digest, vector.
``postings``: slot (table), bucket, digest, sketch; a row for each table.

A plane's components are 1 or -1 by a digest of the plane and the place, so any
session makes the same planes, and so can SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from juriscope.operators.vectors import cosine
from juriscope.sources.shared import shared_path, table_or_none

#: Parts into which a group of rows is dealt before its first rows are taken.
DEALT = 32
#: Parts into which the postings of a bucket are dealt by digest.
PARTS = 8


@dataclass(frozen=True)
class Planes:
    """``tables`` tables of ``bits`` planes, and ``words`` words of 64 planes for the sketch."""

    dims: int = 64
    tables: int = 24
    bits: int = 6
    words: int = 8

    def signs(self):
        """The planes as columns of a matrix: first those of the tables, then those of the sketch."""
        import numpy as np

        rows = [[hashlib.md5(f"{p}:{i}".encode()).hexdigest()[0] < "8" for p in range(self.tables * self.bits + 64 * self.words)] for i in range(self.dims)]
        return np.where(np.array(rows), 1.0, -1.0)


def digest(vector: Column) -> Column:
    return F.md5(F.array_join(F.transform(vector, lambda x: x.cast("string")), ","))


def usable(rows: DataFrame, vector_col: str, dims: int) -> DataFrame:
    """Rows with ``vector`` (doubles) in place of the vector column; those of another length, not finite or all zero are left out."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size(vector_col) == dims) & finite & F.exists(vector, lambda x: x != 0)).withColumn("vector", vector)


def signed(rows: DataFrame, key: str, planes: Planes, probes: int = 1) -> DataFrame:
    """key, buckets (of each table: its own, then those beyond the ``probes`` - 1 nearest planes) and sketch of rows (key, vector)."""
    signs = planes.signs()
    at = planes.tables * planes.bits

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        weight = 1 << np.arange(planes.bits)
        for f in frames:
            if not len(f):
                continue
            side = np.stack(f["vector"].to_list()) @ signs
            table = side[:, :at].reshape(len(f), planes.tables, planes.bits)
            own = (table > 0) @ weight
            order = np.argsort(np.abs(table), axis=2, kind="stable")[:, :, : probes - 1]
            buckets = np.concatenate([own[:, :, None], own[:, :, None] ^ (1 << order)], axis=2)
            words = np.packbits(side[:, at:] > 0, axis=1, bitorder="little").view("<i8")
            yield pd.DataFrame({key: f[key], "buckets": buckets.tolist(), "sketch": words.tolist()})

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "vector").mapInPandas(work, f"{key} {kind}, buckets array<array<int>>, sketch array<bigint>")


def settings(spark: SparkSession, path: str, planes: Planes) -> None:
    """The index's planes are written once; others than those are an error."""
    kept = table_or_none(spark, f"{path}/planes")
    if kept is None:
        spark.createDataFrame([asdict(planes)], "dims int, tables int, bits int, words int").coalesce(1).write.parquet(f"{path}/planes")
    elif kept.first().asDict() != asdict(planes):
        raise ValueError(f"the index at {path} has other planes")


def extend(spark: SparkSession, path: str, rows: DataFrame, planes: Planes, vector_col: str = "embedding") -> int:
    """Add the vectors of rows that the index lacks; how many there were.

    Each distinct vector is signed once.  Postings are written first, so a run
    that dies half way leaves postings without a vector, which no search meets, and
    the next run adds them again; equal postings count once.
    """
    settings(spark, path, planes)
    found = usable(rows, vector_col, planes.dims).select(digest(F.col("vector")).alias("digest"), "vector").groupBy("digest").agg(F.first("vector").alias("vector"))
    known = table_or_none(spark, f"{path}/vectors")
    new = found if known is None else found.join(known.select("digest"), "digest", "left_anti")
    # written apart, so that the postings and the vectors are of the same rows whatever is read anew
    batch = shared_path(spark, "new-vectors")
    new.write.parquet(batch)
    new = spark.read.parquet(batch)
    each = signed(new, "digest", planes).select("digest", "sketch", F.posexplode("buckets").alias("slot", "b"))
    each.select("slot", F.get("b", F.lit(0)).alias("bucket"), "digest", "sketch").write.mode("append").parquet(f"{path}/postings")
    new.write.mode("append").parquet(f"{path}/vectors")
    return new.count()


def apart(a: Column, b: Column, words: int) -> Column:
    """In how many places two sketches differ."""
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(words)), F.lit(0))


def first_rows(rows: DataFrame, by: str, order: Column, n: int, deal: Column) -> DataFrame:
    """The first n rows of each group, and those equal to the n-th; large groups are dealt over tasks, and each sends on its own first n."""
    dealt = rows.withColumn("__deal", F.pmod(F.xxhash64(deal), F.lit(DEALT)))
    some = dealt.withColumn("__rn", F.rank().over(Window.partitionBy(by, "__deal").orderBy(order))).where(F.col("__rn") <= n)
    return some.withColumn("__rn", F.rank().over(Window.partitionBy(by).orderBy(order))).where(F.col("__rn") <= n).drop("__deal", "__rn")


def candidates(spark: SparkSession, path: str, queries: DataFrame, live: DataFrame, planes: Planes, probes: int, refine: int) -> DataFrame:
    """query_id and digest: of the live digests that share a bucket with a query the ``refine`` whose sketches are least apart, and those equal to the last.

    Pairs that share a bucket are only counted, by how far apart they are, where
    they meet; then those are sent on that lie within the bound that the counts give.
    """
    own = signed(queries, "query_id", planes, probes)
    asked = own.select("query_id", F.col("sketch").alias("own"), F.posexplode("buckets").alias("slot", "b")).select("query_id", "own", "slot", F.explode("b").alias("bucket"))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    posted = spark.read.parquet(f"{path}/postings").join(live.select("digest"), "digest", "left_semi")
    # buckets are dealt by digest; equal postings count once
    posted = posted.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(PARTS)).cast("int"))
    posted = posted.repartition("slot", "bucket", "part").dropDuplicates(["slot", "bucket", "part", "digest"])
    met = lambda asked: posted.join(asked, ["slot", "bucket", "part"]).withColumn("apart", apart(F.col("sketch"), F.col("own"), planes.words))
    # in one table a pair stands once, so the refine-th of any table is no nearer than the refine-th of all
    so_far = F.sum("count").over(Window.partitionBy("query_id", "slot").orderBy("apart"))
    told = met(asked).groupBy("query_id", "slot", "apart").count().withColumn("n", so_far).where(F.col("n") >= refine)
    bound = told.groupBy("query_id").agg(F.min("apart").alias("bound"))
    near = met(asked.join(bound, "query_id", "left")).where(F.col("bound").isNull() | (F.col("apart") <= F.col("bound"))).select("query_id", "digest", "apart").distinct()
    return first_rows(near, "query_id", F.col("apart"), refine, F.col("digest")).select("query_id", "digest")


def nearest_by_index(spark: SparkSession, path: str, queries: DataFrame, articles: DataFrame, k: int, planes: Planes, probes: int = 3, refine: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), id and score: the k articles nearest by angle to each of many queries (query_id, vector), as far as the index finds them.

    ``articles``: the current ones, all of whose vectors are in the index.  Scores
    are exact cosines; ties go to the smaller id.  ``refine`` (default 16 k)
    distinct vectors a query are scored.  Articles with equal vectors are found
    together; of one vector only the k least ids can be among the nearest.
    A query without a usable vector has no rows.
    """
    held = usable(articles, vector_col, planes.dims).select(F.col(id_col), digest(F.col("vector")).alias("digest"))
    live = held.select("digest").distinct()
    asked = usable(queries, "vector", planes.dims).select("query_id", "vector")
    found = candidates(spark, path, asked, live, planes, probes, refine or 16 * k)
    stored = spark.read.parquet(f"{path}/vectors").dropDuplicates(["digest"]).withColumnRenamed("vector", "__v")
    scored = found.join(stored, "digest").join(asked, "query_id").select("query_id", "digest", cosine(F.col("__v"), F.col("vector")).alias("score"))
    wanted = held.join(scored.select("digest").distinct(), "digest", "left_semi")
    members = first_rows(wanted, "digest", F.col(id_col), k, F.col(id_col))
    every = scored.join(members, "digest").select("query_id", id_col, "score")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
