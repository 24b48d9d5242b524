"""Tables that one step writes and a later one reads, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names; without one, in a temporary folder, on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = getattr(shared_path, "made", None) or tempfile.mkdtemp(prefix="juriscope-")
        shared_path.made = folder
    return f"{folder.rstrip('/')}/juriscope/{name}-{uuid.uuid4().hex}"


def table_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A Parquet table, or None if nothing was written there yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException:
        return None


def counted(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """How many rows a write wrote, told by the write itself; a plan that Spark finds to be empty tells nothing."""
    told = Observation()
    write(rows.observe(told, F.count("*").alias("n")))
    try:
        return told.get["n"]
    except Py4JJavaError:
        return 0
