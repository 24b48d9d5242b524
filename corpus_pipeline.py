"""A training corpus from ``documents``: toxicity, near duplicates, secrets, mixture, token ids.

Each stage takes (spark, docs, sf_dir); ``run`` writes each one's result to the
shared folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from juriscope.llm import bpe, mixing, neardup, secrets, toxicity
from juriscope.llm.stages import read_table, staged


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic.

    Cases: null and empty texts are scored by the bias alone; repeated rows stay or
    go together; without confirmed toxic texts all stay.  Columns stay as they are,
    whatever their names.
    """
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, to="__toxicity").where(F.col("__toxicity") < toxicity.CUT).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one of least id.

    Cases: texts without words and rows without an id are no duplicates; of rows
    with one id the one that is least as JSON stays.
    """
    return neardup.one_of_each(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; n_chars follows.

    Cases: null texts stay null; repeated rows each get their marks; other columns
    stay as they are, whatever their names.
    """
    return secrets.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it; a fraction counts as a whole from one half on.

    Cases: documents without words, null texts among them, take nothing of the mix
    and stay once; rows without an id or a source are mixed like others; rows with
    one id and size are taken as often as the one of them that is taken most.
    """
    taken = staged(mixing.mix(docs).groupBy("doc_id", "size").agg(F.max("taken").alias("taken")), "taken")
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(1).cast("int")
    plan = taken.select(F.col("doc_id").alias("__doc_id"), F.col("size").alias("__size"), times.alias("__times")).where(F.col("__times") > 0)
    sized = docs.withColumn("__words", mixing.words(F.col("text")))
    joined = sized.join(plan, sized["doc_id"].eqNullSafe(plan["__doc_id"]) & (F.col("__words") == F.col("__size")))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (little-endian unsigned 32-bit integers), and whether they decode to its text.

    Cases: null texts have no ids and decode to the empty text; columns named
    n_tokens, ids or round_trip give way to the results; the text goes.
    """
    path = bpe.public_path("byte_bpe_50k.json")
    out = bpe.encode_decode(docs.withColumn("__sha256", F.sha2(F.coalesce("text", F.lit("")), 256)), path, to="__decoded")
    return out.withColumn("round_trip", F.sha2("__decoded", 256) == F.col("__sha256")).drop("__decoded", "__sha256")


STAGES = [("toxicity", toxicity_stage), ("near-dedup", dedup_stage), ("secrets", secrets_stage), ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: Toxicity is a trained model, and near duplicates and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
