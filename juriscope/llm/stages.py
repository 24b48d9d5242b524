"""Written stages: tables in the folder that ``spark.checkpoint.dir`` names.

A stage is a Parquet table that every executor can read again after another
executor is lost, and that cuts the lineage of what follows.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Rows and bytes of an Arrow batch, at most; a longer row stands alone, whole.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 400, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; without one, a temporary folder, on a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = getattr(shared_folder, "made", None)
    if made is None:
        made = shared_folder.made = tempfile.mkdtemp(prefix="juriscope-")
    return made


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_folder(spark)}/juriscope/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``df`` with ``place``, its row number from 0, and the sums of the rows before it, in an order over all rows.

    Rows are dealt by range and written, so a task orders one range; the sums of
    the ranges, a row for each, carry from one to the next.
    """
    ranges = staged(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), name)
    one = {"place": F.lit(1).cast("long"), **sums}
    totals = ranges.groupBy("__range").agg(*[F.sum(c).alias(f"__{n}") for n, c in one.items()])
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    totals = totals.select("__range", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in one])
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    told = ranges.join(F.broadcast(totals), "__range")
    return told.select(*df.columns, *[(F.col(f"__{n}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(n) for n, c in one.items()])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table as a DataFrame, by Spark's reader only."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """How many tasks can be expected to run at once; shuffle partitions if that is more."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shipped(spark: SparkSession) -> None:
    """Python workers get this package from the driver through Spark, so executors need no copy of it."""
    context = spark.sparkContext
    if getattr(context, "_juriscope_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    to = Path(tempfile.mkdtemp(prefix="juriscope-")) / "juriscope.zip"
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, Path(package.name) / f.relative_to(package))
    context.addPyFile(str(to))
    context._juriscope_shipped = True


def trimmed() -> None:
    """Give memory that a task no longer uses back to the system; its worker may wait for long."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


#: Results after which a task gives freed memory back.
TRIM = 8
#: What this worker keeps between tasks of one kind; a task of another kind empties it.
KEPT: dict = {}


def kept() -> dict:
    return KEPT


def remembering(work: Callable) -> Callable:
    """Mark work that uses what earlier tasks left in KEPT."""
    work.remembers = True
    return work


def arrow_map(df: DataFrame, work: Callable, schema) -> DataFrame:
    """``df.mapInArrow``, with this package on the workers.

    Batches are bounded by rows and bytes, since rows are whole texts here.  The
    session's settings are narrowed where they allow more, as Spark reads them
    when a query runs; narrower ones stay.
    """
    spark = df.sparkSession
    shipped(spark)
    for key, most in BATCHES.items():
        set_to = int(spark.conf.get(key).rstrip("b"))
        if set_to > most or set_to <= 0:
            spark.conf.set(key, str(most))

    remembers = getattr(work, "remembers", False)

    def lean(batches):
        if not remembers:
            kept().clear()
        try:
            for n, batch in enumerate(work(batches), 1):
                yield batch
                if not n % TRIM:
                    trimmed()
        finally:
            trimmed()

    return df.mapInArrow(lean, schema)
