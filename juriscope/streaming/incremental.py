"""Only new inputs: as a batch against what exists, or as a file stream that remembers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_only(inputs: DataFrame, existing: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Inputs that have no output yet; all of them if forced."""
    return inputs if force else inputs.join(existing.select(key).distinct(), key, "left_anti")


def process_new_files(spark: SparkSession, folder: str, output: str, checkpoint: str, step: Callable[[DataFrame], DataFrame], suffix: str = "txt"):
    """Every text file once, over any number of runs; the checkpoint remembers which were read.

    A batch is written to a folder of its own number, so a batch that is tried again replaces what it left.
    """
    stream = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", f"*.{suffix}").load(folder).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    write = lambda df, batch: step(df).write.mode("overwrite").parquet(f"{output}/batch={batch}")
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
