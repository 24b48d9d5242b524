"""Writers: acts as JSON, errors, caches."""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriscope.sources.shared import counted


def write_laws(laws: DataFrame, path: str, pretty: bool = False) -> None:
    """Acts as JSON, one a line, or indented text records."""
    if pretty:
        laws.select(F.to_json(F.struct(*laws.columns), {"pretty": "true"}).alias("value")).write.mode("overwrite").text(path, lineSep="\n\n")
    else:
        laws.write.mode("overwrite").json(path)


def write_law_files(laws: DataFrame, folder: str) -> int:
    """One indented JSON file an act (file, metadata, articles), named as ``file`` says; how many were written.

    The tasks write the files, each under another name first, so one that is
    repeated replaces its own.  The folder must be one that all tasks see, by its
    path; on an object store use ``write_laws``.
    """
    rows = laws.select("file", F.to_json(F.struct("metadata", "articles"), {"pretty": "true"}).alias("json"))

    def write(frames):
        os.makedirs(folder, exist_ok=True)
        for f in frames:
            for name, text in zip(f["file"], f["json"], strict=True):
                part = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
                with open(part, "w", encoding="utf-8") as out:
                    out.write(text)
                os.replace(part, os.path.join(folder, name))
            yield pd.DataFrame({"n": [len(f)]})

    return int(rows.mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"])


def append_errors(errors: DataFrame, path: str) -> int:
    """Errors with the time at which they were told; how many there are."""
    return counted(errors.withColumn("ts", F.current_timestamp()), lambda df: df.write.mode("append").parquet(path))


def write_vectors(vectors: DataFrame, path: str, by: str = "file", parts: int = 64) -> None:
    """Vectors in a bounded number of folders by the hash of a key; what was there is replaced."""
    part = F.pmod(F.xxhash64(by), F.lit(parts)).cast("int")
    vectors.withColumn("part", part).repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)
