"""The law graph as tables in buckets, merged by rewriting only the buckets that a merge touches.

A row lies in the bucket of its law, so a law with its articles and edges is in
one bucket of each table.  A merge writes the touched buckets anew under a
version of its own, and then adds one file to the manifest that says where each
of them now lies.  That file is the switch: until it is there readers see the
old buckets, so a merge that dies leaves the old graph whole.  Buckets that a
merge does not touch keep their files.  One merge runs at a time.

    manifest/           table, bucket, version, path (null: the bucket is empty)
    laws|articles|edges/version=N/bucket=B/
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from juriscope.operators import graph
from juriscope.sources.shared import table_or_none

#: Tables of the graph: the column that names a row's law, and the key.
TABLES = {"laws": ("id", "id"), "articles": ("law_number", "id"), "edges": ("dst", "src")}
MANIFEST = "table string, bucket int, version long, path string"
#: Buckets of a new graph, and parts of a bucket, which a large law is dealt over.
BUCKETS, PARTS = 64, 4


@dataclass
class Counts:
    """What a merge did: rows that it made, rows that gave way to those of the same law, and buckets written."""

    created: dict[str, int]
    replaced: dict[str, int]
    buckets: int


def bucket_of(law: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(law), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, folder: str) -> dict[str, dict[int, str | None]]:
    """Where each bucket of each table lies: a row for each bucket, of which there is a fixed number."""
    rows = table_or_none(spark, f"{folder}/manifest", MANIFEST)
    if rows is None:
        return {}
    last = rows.groupBy("table", "bucket").agg(F.max_by("path", "version").alias("path"), F.max("version").alias("version"))
    # max_by passes over null paths, which say that a bucket became empty
    last = last.withColumnRenamed("path", "__path").join(rows, ["table", "bucket", "version"]).select("table", "bucket", "path")
    found: dict[str, dict[int, str | None]] = {}
    for r in last.collect():
        found.setdefault(r["table"], {})[r["bucket"]] = r["path"]
    return found


def read_graph(spark: SparkSession, folder: str, name: str, only: list[int] | None = None) -> DataFrame | None:
    """A table of the graph, or some buckets of it; None if nothing is there."""
    places = manifest(spark, folder).get(name, {})
    paths = sorted(p for b, p in places.items() if p and (only is None or b in only))
    return spark.read.parquet(*[f"{folder}/{p}" for p in paths]) if paths else None


def buckets_in(spark: SparkSession, folder: str, default: int = BUCKETS) -> int:
    """The number of buckets that a graph was made with."""
    kept = table_or_none(spark, f"{folder}/settings")
    if kept is not None:
        return kept.first()["buckets"]
    spark.createDataFrame([(default,)], "buckets int").coalesce(1).write.parquet(f"{folder}/settings")
    return default


def switched(spark: SparkSession, folder: str, rows: list[tuple[str, int, int, str | None]]) -> None:
    """One file more in the manifest, which is there whole or not at all."""
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")


def observed(spark: SparkSession, told: Observation, path: str) -> dict:
    """What was observed of a write; a write that Spark found to be of no rows tells nothing, and leaves no files."""
    try:
        return told.get
    except Py4JJavaError:
        if table_or_none(spark, path) is not None:
            raise
        return {"new": 0, "kept": 0, "full": []}


def merge(spark: SparkSession, folder: str, tables: dict[str, DataFrame], buckets: int = BUCKETS, reload: bool = False) -> Counts:
    """Merge laws, articles and edges into a graph: a given law takes the place of the one of its id, with all its articles and edges.

    With ``reload`` all that was there gives way.  Counts come from the writes themselves.  A key that would stand twice is an
    error, and the graph stays as it was.  Columns must be those of the graph.
    """
    n, version = buckets_in(spark, folder, buckets), time.time_ns()
    given = tables["laws"].select(F.col("id").alias("__law")).distinct()
    kept = manifest(spark, folder)
    touched = list(range(n)) if reload else sorted(r["b"] for r in given.select(bucket_of(F.col("__law"), n).alias("b")).distinct().collect())  # as many as there are buckets, at most
    counts, switch = Counts({}, {}, 0), []
    for name, (law, key) in TABLES.items():
        after = Observation()
        new = tables[name].withColumn("__new", F.lit(True))
        old = read_graph(spark, folder, name, touched)
        if old is not None and not reload:
            # a law of an untouched bucket is not read; in a touched one those given give way
            new = new.unionByName(old.join(given, old[law] == given["__law"], "left_anti").withColumn("__new", F.lit(False)))
        told = new.withColumn("bucket", bucket_of(F.col(law), n)).observe(after, F.count_if("__new").alias("new"), F.count_if(~F.col("__new")).alias("kept"), F.collect_set("bucket").alias("full"))
        path = f"{name}/version={version}"
        dealt = told.drop("__new").repartition("bucket", F.pmod(F.xxhash64(key), F.lit(PARTS)))
        dealt.write.partitionBy("bucket").parquet(f"{folder}/{path}")
        got = observed(spark, after, f"{folder}/{path}")
        counts.created[name] = got["new"]
        counts.replaced[name] = (0 if old is None else old.count()) - got["kept"]  # a count by the files' footers
        switch += [(name, b, version, f"{path}/bucket={b}" if b in got["full"] else None) for b in sorted({*touched, *got["full"]}) if b in got["full"] or b in kept.get(name, {})]
        if got["full"] and name != "edges":
            twice = graph.duplicates(spark.read.parquet(f"{folder}/{path}"), key).limit(1).collect()
            if twice:
                raise ValueError(f"{name}: {twice[0][key]} stands more than once")
    counts.buckets = len({b for _, b, _, _ in switch})
    if switch:
        switched(spark, folder, switch)
    return counts


def cleared(spark: SparkSession, folder: str) -> int:
    """Empty a graph by one switch; how many nodes it had."""
    n = sum(t.count() for t in (read_graph(spark, folder, x) for x in ("laws", "articles")) if t is not None)
    rows = [(name, b, time.time_ns(), None) for name, places in manifest(spark, folder).items() for b in places]
    if rows:
        switched(spark, folder, rows)
    return n
