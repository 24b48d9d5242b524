"""Corrections as edits: what a grammar suggests, which of it is taken, and the text that results."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriscope.sources.adapters import Adapter


#: Characters of texts that a grammar is given at once, and rows and bytes of a batch that a worker holds; a longer text stands alone, whole.
PIECE = 1 << 18
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 200, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def in_pieces(frames: Iterator[pd.DataFrame], most: int = PIECE) -> Iterator[pd.DataFrame]:
    """Frames of texts in frames of at most so many characters."""
    for f in frames:
        start, held = 0, 0
        for i, n in enumerate(f["text"].str.len().fillna(0)):
            if i > start and held + n > most:
                yield f.iloc[start:i].reset_index(drop=True)
                start, held = i, 0
            held += n
        if start < len(f):
            yield f.iloc[start:].reset_index(drop=True)


def suggested(texts: DataFrame, grammar: Adapter) -> DataFrame:
    """key, start, stop, word (what stands there) and replacement (the best suggestion) of what a grammar finds in texts (key, text).

    ``grammar`` turns frames of key and text into frames of key, start, stop and
    suggestions; places are counted in characters from 0, stop exclusive, and the
    best suggestion is first.  Keys are distinct and of an atomic type.  What lies outside its text is left out.
    """
    kind = texts.schema["key"].dataType.simpleString()

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in in_pieces(frames):
            text = dict(zip(f["key"], f["text"], strict=True))
            for g in grammar(iter([f])):
                rows = [(k, a, b, text[k][a:b], x[0]) for k, a, b, x in zip(g["key"], g["start"], g["stop"], g["suggestions"], strict=True) if x is not None and len(x) and x[0] is not None and 0 <= a and b <= len(text[k])]
                yield pd.DataFrame(rows, columns=["key", "start", "stop", "word", "replacement"])

    return texts.select("key", "text").mapInPandas(work, f"key {kind}, start int, stop int, word string, replacement string")


def taken(found: DataFrame, accepted: DataFrame | None = None) -> DataFrame:
    """key, start, stop and replacement of the edits that may be made.

    Left out: edits of at most two characters, of words with an initial capital,
    and of words that ``accepted`` (word) lists.
    """
    told = found.where((F.col("stop") - F.col("start") > 2) & ~F.col("word").rlike(r"^\p{Lu}"))
    if accepted is not None:
        told = told.join(accepted.select("word").distinct(), "word", "left_anti")
    return told.select("key", "start", "stop", "replacement")


def scheduled(start: list[int], stop: list[int]) -> list[int]:
    """Which of edits, in order of their ends, are made: as many as can be without two of them meeting; the one that ends first, then the next that starts after it."""
    out, last = [], 0
    for i, (a, b) in enumerate(zip(start, stop, strict=True)):
        if a >= last:
            out.append(i)
            last = b
    return out


def edited(texts: DataFrame, edits: DataFrame) -> DataFrame:
    """key, text, n_edits (made) and n_left (met by another) of texts (key, text); a text without edits stays.

    A text and its edits are one row, as long as the text; texts are dealt by key.
    """
    kind = texts.schema["key"].dataType.simpleString()
    one = F.struct("stop", (-F.col("start")).alias("back"), "replacement")  # of edits with one end the shortest first
    listed = edits.groupBy("key").agg(F.sort_array(F.collect_list(one)).alias("e"))
    listed = listed.select("key", F.transform("e", lambda x: -x["back"]).alias("start"), F.col("e.stop").alias("stop"), F.col("e.replacement").alias("replacement"))
    rows = texts.select("key", "text").join(listed, "key", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for i in range(b.num_rows):  # one text's edits at a time are Python objects
                text, start, stop, new = (b.column(c)[i].as_py() for c in ("text", "start", "stop", "replacement"))
                if start is None:
                    made.append((text, 0, 0))
                    continue
                some, parts, at = scheduled(start, stop), [], 0
                for j in some:
                    parts += [text[at : start[j]], new[j]]
                    at = stop[j]
                made.append(("".join(parts) + text[at:], len(some), len(start) - len(some)))
            yield pa.RecordBatch.from_arrays([b.column("key"), *[pa.array([x[c] for x in made], t) for c, t in enumerate((pa.string(), pa.int32(), pa.int32()))]], ["key", "text", "n_edits", "n_left"])

    return rows.mapInArrow(work, f"key {kind}, text string, n_edits int, n_left int")


def corrected(texts: DataFrame, grammar: Adapter, accepted: DataFrame | None = None) -> DataFrame:
    """Texts (key, text) with a grammar's edits made; keys are distinct, and null texts stay null."""
    for name, value in BATCHES.items():
        texts.sparkSession.conf.set(name, value)
    texts = texts.repartition("key")  # for the grammar's work, and for the join with its edits
    return edited(texts, taken(suggested(texts.where(F.col("text").isNotNull()), grammar), accepted))
