"""Vectors of chunks by what the chunks say: a model sees each distinct chunk once, over all runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriscope.functions.text import chunks
from juriscope.operators import vectors
from juriscope.sources.shared import counted, shared_path, table_or_none

STORE = "digest string, vector array<double>"


class VectorStore:
    """A table of (digest, vector) of one model's chunks, which runs add to and never rewrite."""

    def __init__(self, path: str, embed=vectors.hashed_embedding):
        self.path, self.embed, self.embedded = path, embed, 0

    def vectors_of(self, rows: DataFrame, most: int = 512) -> DataFrame:
        """key and the mean of its chunks' vectors, of rows (key, content); a chunk that stands twice counts twice.

        Chunks whose digest the store lacks are embedded, each once, and added.  A
        chunk that the model gives no vector is asked for again next time, and
        counts for nothing.
        """
        spark = rows.sparkSession
        # cut once, as the pieces are both looked up and joined
        cut = shared_path(spark, "pieces")
        content = F.coalesce("content", F.lit(""))
        rows.select("key", F.explode(F.when(F.length(content) <= most, F.array(content)).otherwise(chunks(content, most))).alias("chunk")).withColumn("digest", F.sha2("chunk", 256)).write.parquet(cut)
        pieces = spark.read.parquet(cut)
        distinct = pieces.groupBy("digest").agg(F.first("chunk").alias("chunk"))
        known = table_or_none(spark, self.path, STORE)
        new = distinct if known is None else distinct.join(known.select("digest"), "digest", "left_anti")
        if getattr(self.embed, "adapter", False):
            made = new.withColumnRenamed("digest", "key").mapInPandas(self.embed, "key string, vector array<double>").withColumnRenamed("key", "digest")
        else:
            made = new.select("digest", self.embed(F.col("chunk")).alias("vector"))
        self.embedded += counted(made.where(F.size("vector") > 0), lambda df: df.write.mode("append").parquet(self.path))
        store = spark.read.schema(STORE).parquet(self.path).dropDuplicates(["digest"])
        return vectors.mean_vector(pieces.select("key", "digest").join(store, "digest").select("key", F.col("vector").alias("v")), "key", "v")
