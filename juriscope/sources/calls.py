"""Calls of a language model that survive failures.

Inputs are asked in waves.  A wave is one job whose answers join the cache when
it ends, so what was answered before a run died is never asked again.  Within a
wave a call that fails is tried again, then row by row; a row that fails for
good is told with its error and keeps no other back.  When more rows failed than
the budget allows, no further wave is asked.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriscope.sources.adapters import Adapter, token_usage
from juriscope.sources.shared import counted, shared_path, table_or_none
from juriscope.streaming.incremental import new_only

CACHE = "file string, answer string, at timestamp"
FAILED = "file string, error string, at timestamp"


@dataclass
class Told:
    """What a run of calls did; tokens are those that the answers tell of."""

    answered: int = 0
    failed: int = 0
    unasked: int = 0
    prompt_tokens: int = 0
    completion_tokens: int = 0
    total_tokens: int = 0


def guarded(ask: Adapter, retries: int, batch: int, pause: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``ask`` over frames of at most ``batch`` rows, each row with its answer or its error."""

    def tried(part: pd.DataFrame, times: int) -> tuple[dict, str]:
        error = ""
        for n in range(times):
            try:
                frames = list(ask(iter([part])))
            except Exception as e:  # whatever a model's client raises is this row's error, not the job's
                error = f"{type(e).__name__}: {e}"
                if n + 1 < times:
                    time.sleep(pause * 2**n)
                continue
            return {f: a for x in frames for f, a in zip(x["file"], x["answer"], strict=True)}, ""
        return {}, error

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for first in range(0, len(f), batch):
                part = f.iloc[first : first + batch].reset_index(drop=True)
                got, error = tried(part, 1 if len(part) > 1 else retries + 1)
                errors = {}
                if error and len(part) > 1:
                    for i in range(len(part)):
                        row = part.iloc[i : i + 1].reset_index(drop=True)
                        one, why = tried(row, retries + 1)
                        got |= one
                        errors[row["file"][0]] = why
                elif error:
                    errors[part["file"][0]] = error
                answers = [got.get(x) for x in part["file"]]
                blank = [a is None or not str(a).strip() for a in answers]
                yield pd.DataFrame({"file": part["file"], "answer": [None if b else a for a, b in zip(answers, blank, strict=True)], "error": [(errors.get(x) or "no answer") if b else None for x, b in zip(part["file"], blank, strict=True)]})

    return work


def ask_all(inputs: DataFrame, ask: Adapter, cache: str, force: bool = False, retries: int = 2, budget: int | None = None, wave: int = 1000, batch: int = 16, pause: float = 0.1) -> tuple[DataFrame, DataFrame, Told]:
    """(file, answer) of each input (file, text) that has one, (file, error) of those that failed in this run, and counters.

    ``ask`` turns frames of file and text into frames of file and answer.  Answers
    come from the cache, a Parquet folder that all executors share, else are asked
    for and added to it; of several to a file the last one counts.  With ``force``
    every input is asked anew.  A blank answer is a failure.  Failures of all runs
    are kept beside the cache.  Of inputs of one file one is asked.
    """
    spark = inputs.sparkSession
    one = inputs.groupBy("file").agg(F.min("text").alias("text"))
    known = table_or_none(spark, cache, CACHE)
    asked = one if known is None else new_only(one, known, "file", force)
    path = shared_path(spark, "calls")
    asked.write.parquet(path)
    asked = spark.read.parquet(path)
    n, told = asked.count(), Told()
    waves = -(-n // wave)
    if waves > 1:  # a wave reads its own inputs alone
        asked.withColumn("wave", F.pmod(F.xxhash64("file"), F.lit(waves))).repartition("wave").write.partitionBy("wave").parquet(f"{path}.waves")
        asked = spark.read.schema("file string, text string, wave bigint").parquet(f"{path}.waves")
    failures = spark.createDataFrame([], FAILED)
    for i in range(waves):
        part = asked.where(F.col("wave") == i) if waves > 1 else asked
        done = shared_path(spark, "answers")
        part.select("file", "text").mapInPandas(guarded(ask, retries, batch, pause), "file string, answer string, error string").withColumn("at", F.current_timestamp()).write.parquet(done)
        rows = spark.read.parquet(done)
        told.answered += counted(rows.where("error is null").select("file", "answer", "at"), lambda df: df.write.mode("append").parquet(cache))
        bad = rows.where("error is not null").select("file", "error", "at")
        told.failed += counted(bad, lambda df: df.write.mode("append").parquet(f"{cache}.failed"))
        failures = failures.unionByName(bad)
        used = token_usage(rows.where("error is null")).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")]).first()
        for c in used.asDict():
            setattr(told, c, getattr(told, c) + used[c])
        if budget is not None and told.failed > budget:
            break
    told.unasked = n - told.answered - told.failed
    kept = table_or_none(spark, cache, CACHE)
    if kept is None:
        kept = spark.createDataFrame([], CACHE)
    last = kept.groupBy("file").agg(F.max_by("answer", F.struct("at", "answer")).alias("answer"))
    return last.join(one.select("file"), "file", "left_semi"), failures.select("file", "error"), told
