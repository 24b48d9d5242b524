"""Where models plug in: OCR, language model, grammar, embedding.

Each adapter is a function from an iterator of pandas frames to another, run by
``mapInPandas``; the defaults are deterministic and need no model or network.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Adapter = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def plain_text(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reads the bytes of a file as UTF-8 text; the stand-in for OCR."""
    for f in frames:
        yield pd.DataFrame({"file": f["file"], "page": 1, "text": [bytes(x).decode("utf-8", "replace") for x in f["content"]]})


def read_pages(files: DataFrame, ocr: Adapter = plain_text) -> DataFrame:
    return files.select("file", "content").mapInPandas(ocr, "file string, page int, text string")


def with_native_text(pages: DataFrame, files: DataFrame, native: Adapter) -> DataFrame:
    """Pages (file, page, text) with the text that the file itself holds in place of blank ones; only files with a blank page are opened for it."""
    blank = pages.where(F.coalesce(F.trim("text"), F.lit("")) == "").select("file").distinct()
    own = read_pages(files.join(blank, "file", "left_semi"), native).withColumnRenamed("text", "native")
    return pages.join(own, ["file", "page"], "left").select("file", "page", F.coalesce(first_text("text", "native"), F.lit("")).alias("text"))


def first_text(*candidates: str):
    """The first candidate column that is not blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", F.col(c)) for c in candidates])


def longest_text(*candidates: str):
    """The candidate with most characters other than white space; the first of equals; blanks never."""
    inked = lambda c: F.length(F.regexp_replace(F.col(c), r"[ \t\n\r]", ""))
    rows = F.filter(F.array(*[F.struct((-inked(c)).alias("less"), F.lit(i).alias("i"), F.col(c).alias("text")) for i, c in enumerate(candidates)]), lambda x: x["less"] < 0)
    return F.array_min(rows)["text"]


def joined_pages(pages: DataFrame) -> DataFrame:
    """file and text with page marks, up to and with the first page that holds the distribution list."""
    from juriscope.operators.lines import until_first

    kept = until_first(pages, F.contains(F.upper("text"), F.lit("AMPLIATIONS")), "file", "page")
    page = F.concat(F.lit("=== PAGE "), F.col("page").cast("string"), F.lit(" ===\n"), "text")
    return kept.select("file", "page", page.alias("t")).groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "t"))), lambda x: x["t"]), "\n").alias("text"))


def token_usage(answers: DataFrame, json_col: str = "answer") -> DataFrame:
    """Prompt, completion and total tokens of language-model answers; 0 where missing."""
    part = lambda n: F.coalesce(F.get_json_object(json_col, f"$.usage.{n}").try_cast("int"), F.lit(0)).alias(n)
    return answers.select(part("prompt_tokens"), part("completion_tokens"), part("total_tokens"))
