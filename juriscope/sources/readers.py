"""Readers: scanned acts, OCR text, act and vector JSON, dictionaries, registers, corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from juriscope.functions.text import strip_accents, trimmed

LAW_SCHEMA = (
    "metadata struct<lawNumber:string,lawObject:string,lawDate:string,source:string,signatories:array<struct<name:string,role:string>>,"
    "source_pdf:string,extracted_by:string,extracted_at:string>, articles array<struct<index:string,content:string>>, _corrupt string"
)
VECTOR_SCHEMA = "file string, timestamp string, articles array<struct<index:string,vector:array<double>>>, metadata_vectors struct<lawNumber_vector:array<double>,lawObject_vector:array<double>>"


def scan_files(spark: SparkSession, folder: str, suffix: str = "pdf", name: str | None = None) -> DataFrame:
    """file, path and content of a folder's files, or of the one named."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").load(folder).select(F.col("_metadata.file_name").alias("file"), "path", "content")
    return df.where(F.col("file") == name) if name else df


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """file and whole text of a folder's text files."""
    return spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt").select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def read_laws(spark: SparkSession, *folders: str) -> DataFrame:
    """Acts as JSON, one a file; what cannot be read is kept in _corrupt.  Spark's readers pass over files of no bytes."""
    whole = spark.read.text(list(folders), wholetext=True, pathGlobFilter="*.json").select(F.col("_metadata.file_name").alias("file"), "value")
    read = whole.withColumn("law", F.from_json("value", LAW_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}))
    empty = F.coalesce(F.trim("value"), F.lit("")) == ""
    return read.select("law.metadata", "law.articles", F.when(empty, F.coalesce("value", F.lit(""))).otherwise(F.col("law._corrupt")).alias("_corrupt"), "file")


def good_and_rejected(laws: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Acts (file, metadata, articles) that ``read_laws`` could read, and the files that hold none, with the reason."""
    why = F.when(F.col("_corrupt").isNotNull(), "JSON illisible").when(F.col("metadata").isNull() & F.col("articles").isNull(), "ni metadata ni articles")
    told = laws.withColumn("reason", why)
    return told.where("reason is null").select("file", "metadata", "articles"), told.where("reason is not null").select("file", "reason")


def read_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Vector files; a time in milliseconds and one in ISO 8601 both become a timestamp."""
    df = spark.read.schema(VECTOR_SCHEMA).option("multiLine", True).json(folder, pathGlobFilter="*.json")
    at = F.coalesce(F.timestamp_millis(F.col("timestamp").try_cast("long")), F.try_to_timestamp("timestamp"))
    return df.withColumn("timestamp", at)


def read_vector_table(spark: SparkSession, path: str) -> DataFrame:
    """Vectors that ``write_vectors`` wrote."""
    return spark.read.parquet(path).drop("part")


def read_words(spark: SparkSession, path: str, sep: str = r"\s+") -> DataFrame:
    """Distinct words of the files that a path or glob names, with their file."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.explode(F.split("value", sep)).alias("word")).where(F.trim("word") != "").distinct().orderBy("file", "word")


def _pairs(spark: SparkSession, path: str, sep: str, kept) -> DataFrame:
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("at", "value"))
    lines = whole.where(kept(F.col("value")))
    parts = F.split("value", sep, 2)
    return lines.select("file", "at", F.get(parts, F.lit(0)).alias("key"), trimmed(F.get(parts, F.lit(1))).alias("value"))


def _first_place_last_value(rows: DataFrame, by: str) -> DataFrame:
    order = F.struct("file", "at")
    found = rows.groupBy(by).agg(F.min(order).alias("first"), F.max_by("key", order).alias("key"), F.max_by("value", order).alias("value"))
    return found.withColumn("priority", F.row_number().over(Window.orderBy("first"))).drop("first")  # a dimension table


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """priority, name, role of a ``name;roles`` file; # begins a comment; of equal names the first place and the last value stay."""
    rows = _pairs(spark, path, ";", lambda v: ~F.startswith(F.trim(v), F.lit("#")) & F.contains(v, F.lit(";"))).withColumn("key", trimmed(F.col("key"))).withColumn("plain", strip_accents(F.upper("key")))
    return _first_place_last_value(rows, "plain").select("priority", F.col("key").alias("name"), F.col("value").alias("role"))


def read_corrections(spark: SparkSession, folder: str) -> tuple[tuple[str, str], ...]:
    """Corrections of the ``wrong,right`` files of a folder by name, in order; a rule set takes them."""
    rows = _first_place_last_value(_pairs(spark, folder, ",", lambda v: F.contains(v, F.lit(","))).withColumn("same", F.col("key")), "same")
    return tuple((r["key"], r["value"]) for r in rows.orderBy("priority").collect())


def read_template(spark: SparkSession, path: str) -> str:
    """A template without its comment lines."""
    rows = spark.read.text(path, wholetext=True).first()
    return "\n".join(x for x in (rows["value"] if rows else "").split("\n") if not x.strip().startswith("#")).strip()


def read_properties(spark: SparkSession, path: str) -> "Properties":
    """Settings of a ``key=value`` file; # and ! begin comments."""
    rows = spark.read.text(path).where(F.col("value").rlike(r"^\s*[^#!\s]")).select(F.trim(F.regexp_extract("value", r"^([^=:]*)", 1)).alias("key"), F.trim(F.regexp_extract("value", r"^[^=:]*[=:]?(.*)$", 1)).alias("value"))
    return Properties({r["key"]: r["value"] for r in rows.collect()})  # a file of settings


class Properties(dict):
    """Settings by key; a key that is missing without a default is an error."""

    def setting(self, key: str, default: str | None = None) -> str:
        if key in self:
            return self[key]
        if default is None:
            raise KeyError(f"no setting {key!r}")
        return default
