"""Toxicity by non-negative positive-unlabelled learning.

Some texts are confirmed toxic; the rest is unlabelled and holds toxic texts
too, a share of them that is the class prior.  The risk of a linear classifier
is put together from the two: what positives cost as positives, weighted by the
prior, and what unlabelled texts cost as negatives less what positives would
cost as negatives.  The second part cannot be negative for the true risk; where
its estimate is, the step goes against it, which keeps the classifier from
learning the unlabelled toxic texts as clean.

The score is calibrated on texts that the classifier did not see: two halves of
the sample are scored by the other half's classifier, and a slope and an offset
are fitted to those scores by the same risk.

Features are hashed words and word beginnings, damped counts in unit length;
those of the sample's rarest words are left out.
Counting and scoring run in numpy over whole texts, a batch at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import binaries, slices
from .hashing import WORD_BYTES, Buffer, U
from .stages import arrow_map, read_table, staged, trimmed

#: Features; bytes of a word's beginning; score from which a text is called toxic.
BITS, BEGINNING, CUT = 18, 4, 0.3
#: Rows that the classifier is fitted on, at most: confirmed positives, and others of the label table, whose labels it does not see; and bytes of their features.
MOST_POSITIVE, MOST_UNLABELLED, MOST_BYTES = 2000, 6000, 64 << 20
EPOCHS, RATE, DECAY = 160, 0.1, 1e-4
#: Rows of the sample that a feature stands in at least.
LEAST_ROWS = 4
#: The class prior if no row says anything about it.
PRIOR = 0.1


def features(buffer: Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of all texts, by text; the values of a text have length 1."""
    start, end, text = buffer.runs(WORD_BYTES)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    words = buffer.hashes(start, end) >> U(64 - BITS)
    begin = buffer.hashes(start, np.minimum(end, start + BEGINNING)) * U(0x9E3779B97F4A7C15) >> U(64 - BITS)
    keys = np.concatenate([text << BITS | words.astype(np.int64), text << BITS | begin.astype(np.int64)])
    keys.sort()
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    owner, value = keys >> BITS, np.log1p(count)
    return owner, keys & ((1 << BITS) - 1), value / np.sqrt(np.bincount(owner, value * value, minlength=buffer.n))[owner]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Rows:
    """Sparse rows: of each entry its row, feature and value."""

    def __init__(self, n: int, row: np.ndarray, feature: np.ndarray, value: np.ndarray):
        self.n, self.row, self.feature, self.value = n, row, feature, value

    @classmethod
    def of(cls, rows: list[tuple[bytes, bytes]]) -> Rows:
        parts = [np.frombuffer(a, np.int32) for a, _ in rows]
        values = np.concatenate([*[np.frombuffer(b, np.float32) for _, b in rows], np.zeros(0, np.float32)])
        return cls(len(rows), np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in parts]), np.concatenate([*parts, np.zeros(0, np.int32)]), values)

    def some(self, rows: np.ndarray) -> Rows:
        """The rows of a mask."""
        keep = rows[self.row]
        return Rows(int(rows.sum()), (np.cumsum(rows, dtype=np.int32) - np.int32(1))[self.row[keep]], self.feature[keep], self.value[keep])

    def scores(self, weight: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, self.value * weight[self.feature], minlength=self.n) + bias

    def gradient(self, by_row: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.feature, self.value * by_row[self.row], minlength=size)


def risk_gradient(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the non-negative risk by the scores of positives and of unlabelled rows (logistic loss)."""
    sp, su = sigmoid(zp), sigmoid(zu)
    as_negative = -np.log(1 - su + 1e-12).mean() - prior * -np.log(1 - sp + 1e-12).mean()
    if as_negative >= 0:
        return prior * (sp - 1) / len(sp) - prior * sp / len(sp), su / len(su)
    return prior * sp / len(sp), -su / len(su)


def descend(gradient, start: np.ndarray, epochs: int, rate: float) -> np.ndarray:
    """Adam, the whole sample each step."""
    w, first, second = start, np.zeros(len(start)), np.zeros(len(start))
    for epoch in range(1, epochs + 1):
        g = gradient(w)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        w = w - rate * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.99**epoch)) + 1e-8)
    return w


def fit(positive: Rows, unlabelled: Rows, prior: float, size: int) -> np.ndarray:
    """Weights, and the bias last, that make the risk small."""

    def gradient(w: np.ndarray) -> np.ndarray:
        gp, gu = risk_gradient(positive.scores(w[:-1], w[-1]), unlabelled.scores(w[:-1], w[-1]), prior)
        return np.append(positive.gradient(gp, size) + unlabelled.gradient(gu, size) + DECAY * w[:-1], 0.1 * (gp.sum() + gu.sum()))

    return descend(gradient, np.append(np.zeros(size), np.log(prior / (1 - prior))), EPOCHS, RATE)


def calibrated(positive: Rows, p_half: np.ndarray, unlabelled: Rows, u_half: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights by feature and bias; the halves (booleans by row) keep a text on one side in both sets."""
    stands = np.bincount(positive.feature, minlength=1 << BITS) + np.bincount(unlabelled.feature, minlength=1 << BITS)
    kept = np.flatnonzero(stands >= LEAST_ROWS)
    place = np.full(1 << BITS, -1, np.int32)
    place[kept] = np.arange(len(kept))

    def narrowed(x: Rows) -> Rows:
        there = place[x.feature] >= 0
        return Rows(x.n, x.row[there], place[x.feature[there]], x.value[there])

    p, u = narrowed(positive), narrowed(unlabelled)
    del positive, unlabelled
    zp, zu = np.zeros(p.n), np.zeros(u.n)
    slope, offset = 1.0, 0.0
    if all(m.any() for m in (p_half, ~p_half, u_half, ~u_half)):
        for half in (False, True):
            w = fit(p.some(p_half != half), u.some(u_half != half), prior, len(kept))
            zp[p_half == half] = p.scores(w[:-1], w[-1])[p_half == half]
            zu[u_half == half] = u.scores(w[:-1], w[-1])[u_half == half]

        def gradient(c: np.ndarray) -> np.ndarray:
            gp, gu = risk_gradient(np.exp(c[0]) * zp + c[1], np.exp(c[0]) * zu + c[1], prior)
            return np.array([((gp * zp).sum() + (gu * zu).sum()) * np.exp(c[0]), gp.sum() + gu.sum()])

        c = descend(gradient, np.zeros(2), 400, 0.02)
        slope, offset = float(np.exp(c[0])), float(c[1])
    w = fit(p, u, prior, len(kept))
    whole = np.zeros(1 << BITS)
    whole[kept] = slope * w[:-1]
    return whole, slope * float(w[-1]) + offset


def feature_rows(docs: DataFrame) -> DataFrame:
    """id, features and values (int32 and float32 bytes) of (id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buffer in slices(pc.utf8_lower(batch.column(1))):
                text, feature, value = features(buffer)
                bounds = np.searchsorted(text, np.arange(buffer.n + 1))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), binaries(feature.astype(np.int32), bounds), binaries(value.astype(np.float32), bounds)], names=["id", "features", "values"])

    return arrow_map(docs, work, "id long, features binary, values binary")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED, most_bytes: int = MOST_BYTES) -> tuple[np.ndarray, float] | None:
    """Weights and bias from rows that are not held out; None if no text is confirmed toxic, or none is unlabelled.

    Confirmed toxic texts are the positives.  The unlabelled texts are a sample of
    all texts in the label table, with their labels put aside, so toxic ones are
    among them; the class prior is the table's share of toxic rows.  The sample
    is bounded by the parameters: the ids with the least hash, as far as the
    bytes of their features reach.

    Cases: rows with a null id or a null label say nothing; of several labels of
    an id the highest counts.  Of several texts of an id one is taken, by its
    features.  Empty and null texts are texts without features.  The prior is
    held within 0.01 and 0.9, so that neither part of the risk vanishes.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    known = staged(known.join(rows.select("id").distinct(), "id", "left_semi"), "labelled")
    stats = known.agg(F.avg(F.col("toxic").cast("double")).alias("share")).first()
    prior = min(0.9, max(0.01, stats["share"] if stats["share"] else PRIOR))
    positive = known.where(F.col("toxic") == 1).orderBy(F.xxhash64("id"), "id").limit(most_positive).select("id", F.lit(True).alias("positive"))
    unlabelled = known.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(most_unlabelled).select("id", F.lit(False).alias("positive"))
    chosen = {True: [], False: []}
    for r in positive.unionByName(unlabelled).collect():  # as many as the bounds allow
        chosen[r["positive"]].append(r["id"])
    if not chosen[True]:
        return None
    ids = docs.sparkSession.createDataFrame([(i,) for i in sorted({*chosen[True], *chosen[False]})], "id long")
    made = feature_rows(rows.join(F.broadcast(ids), "id", "left_semi").select("id", "text"))
    made = staged(made.groupBy("id").agg(F.min(F.struct("features", "values")).alias("x")).select("id", "x.*"), "sample-features")
    size = {r["id"]: r["n"] for r in made.select("id", F.octet_length("features").alias("n")).collect()}  # as many as the bounds allow
    kept, total = set(), 0
    for i in sorted(size, key=lambda i: zlib.crc32(str(i).encode())):
        total += 2 * size[i]
        if total > most_bytes and kept:
            break
        kept.add(i)
    if len(kept) < len(size):
        made = made.where(F.col("id").isin(*kept))
    found = {r["id"]: (r["features"], r["values"]) for r in made.collect()}  # bounded by most_bytes
    half = {i: n % 2 == 0 for n, i in enumerate(sorted(found))}
    sets = []
    for kind in (True, False):
        own = sorted(i for i in chosen[kind] if i in found)
        sets.append((Rows.of([found[i] for i in own]), np.array([half[i] for i in own], bool)))
    del found
    trimmed()
    (positive_rows, p_half), (unlabelled_rows, u_half) = sets
    del sets
    if not positive_rows.n or not unlabelled_rows.n:
        return None
    try:
        return calibrated(positive_rows, p_half, unlabelled_rows, u_half, prior)
    finally:
        trimmed()


def score(docs: DataFrame, model: tuple[np.ndarray, float] | None, text_col: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of each whole text (column ``to``; it replaces one of that name).

    Cases: null and empty texts, and texts without words, get the score of the
    bias alone.  Without a model every score is 0.  Only the text is an input;
    texts may be of any length.  Repeated rows each get the score of their text;
    other columns stay as they are; an empty table gives no rows.
    """
    keep = [c for c in docs.columns if c not in (text_col, to)]
    weight, bias = (model[0].astype(np.float32), model[1]) if model else (np.zeros(1 << BITS, np.float32), 0.0)
    none = model is None
    where = docs.schema[text_col]
    schema = T.StructType([*[docs.schema[c] for c in keep], where, T.StructField(to, T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for first, last, buffer in slices(pc.utf8_lower(column)):
                text, feature, value = features(buffer)
                out = np.zeros(buffer.n) if none else sigmoid(np.bincount(text, value * weight[feature], minlength=buffer.n) + bias)
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(first, last - first) for i in range(batch.num_columns)], pa.array(out)], names=[*keep, text_col, to])

    return arrow_map(docs.select(*keep, text_col), work, schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
