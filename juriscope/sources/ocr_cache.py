"""Texts that OCR read, kept by file name and content, so a file that did not change is never read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriscope.sources.adapters import Adapter, read_pages
from juriscope.sources.shared import shared_path, table_or_none

CACHE = "file string, digest string, page int, text string, at timestamp"


def pages_through_cache(files: DataFrame, ocr: Adapter, path: str) -> DataFrame:
    """file, page and text of files (file, content): from the cache, else by ``ocr``, whose results are added to it.

    A file counts as known if its name and the digest of its content are.  Of
    several readings the newest counts, all its pages together.  A file of which
    every page is blank is not kept, so it is read again next time; it has its
    blank pages all the same.
    """
    spark = files.sparkSession
    named = files.withColumn("digest", F.sha2("content", 256))
    kept = table_or_none(spark, path, CACHE)
    new = named if kept is None else named.join(kept.select("file", "digest").distinct(), ["file", "digest"], "left_anti")
    read = read_pages(new, ocr).join(new.select("file", "digest"), "file").withColumn("at", F.current_timestamp())
    # written before any is kept, so each file is read once in a run
    fresh_path = shared_path(spark, "ocr")
    read.select("file", "digest", "page", F.coalesce("text", F.lit("")).alias("text"), "at").write.parquet(fresh_path)
    now = spark.read.schema(CACHE).parquet(fresh_path)
    inked = now.groupBy("file", "digest").agg(F.max(F.trim("text") != "").alias("inked")).where("inked").drop("inked")
    now.join(inked, ["file", "digest"], "left_semi").write.mode("append").parquet(path)
    every = spark.read.schema(CACHE).parquet(path).join(named.select("file", "digest"), ["file", "digest"], "left_semi")
    blank = now.join(inked, ["file", "digest"], "left_anti")
    return newest(every).unionByName(blank).select("file", "page", "text")


def newest(pages: DataFrame) -> DataFrame:
    """The pages of the last reading of each file."""
    last = pages.groupBy("file", "digest").agg(F.max("at").alias("at"))
    return pages.join(last, ["file", "digest", "at"], "left_semi")
