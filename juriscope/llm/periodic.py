"""Periodic runs of words: Main-Lorentz divide and conquer on interned word ids.

A document's words become ids.  Its sequence is halved again and again; a run
lies in one smallest segment, whose midpoint it crosses.  For the words after a
midpoint m, Z-functions tell how far the sequence from m agrees with that from
m + q, and how far it agrees read backwards from m - 1 and m + q - 1; the sum
gives the run of period q there.  The same is done for the words before m.  A
run of exponent 4 has two periods on one side, so q can only be where the word
at m (or m - 1) comes again, and only there are the Z-functions looked up.

All segments of a level, of many documents, are worked on at once in numpy.  A
Z-value is found by comparing hashes of slices by doubling and halving steps.
Runs found are compared word by word; should a hash have lied, the document is
done anew with Z-functions made by comparing words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import SPACE, same_bytes, slices
from .hashing import PRIMES, Buffer, U, powers, ragged
from .stages import arrow_map, read_table

#: A run's least length in words, and in periods.
LEAST, EXPONENT = 6, 4
#: Periods that are tried first, so that multiples of those found need no trial; work only.
TURNS = (8, 128)
RUNS = "array<struct<start:long,length:long,period:long>>"
MADE = ("runs", "collapsed")
#: What white space is, as a regular expression.
BLANKS = r"[\x20\x09-\x0D]+"


class Runs(NamedTuple):
    """Runs of many documents end to end, by start, then period: first word, end (exclusive), period."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray


def interned(buffer: Buffer, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Ids of words: equal if and only if their bytes are."""
    _, first, ids = np.unique(buffer.hashes(start, stop), return_index=True, return_inverse=True)
    size, one = stop - start, first[ids]
    if same_bytes(buffer.data, start[one], size[one], buffer.data, start, size).all():
        return ids
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(buffer.raw[a:b], len(known)) for a, b in zip(start.tolist(), stop.tolist(), strict=True)], np.int64)


class Sequence:
    """Ids end to end, with polynomial hashes of slices modulo two primes."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.exact, self.prefix = ids, False, []
        for which, prime in enumerate(PRIMES):
            up, _ = powers(which, len(ids) + 1)
            terms = (ids + 1).astype(U) % U(prime) * up[: len(ids)] % U(prime)
            self.prefix.append(np.concatenate([np.zeros(1, U), np.cumsum(terms, dtype=U)]))

    def residues(self, which: int, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        prime, prefix, (_, down) = U(PRIMES[which]), self.prefix[which], powers(which, len(self.ids) + 1)
        return (prefix[start + n] - prefix[start]) % prime * down[start] % prime

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether n words from a and from b agree."""
        out = np.ones(len(a), bool)
        for which in range(len(PRIMES)):
            out &= self.residues(which, a, n) == self.residues(which, b, n)
        return out

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Z-values: how many words from a and from b agree, ``most`` at most."""
        return self.reach(a, b, most, lambda x, y, done, n: self.equal(x + done, y + done, n), 1)

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words up to a and up to b, each inclusive, agree."""
        return self.reach(a, b, most, lambda x, y, done, n: self.equal(x + 1 - done - n, y + 1 - done - n, n), -1)

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, same: Callable, way: int) -> np.ndarray:
        done = np.zeros(len(a), np.int64)
        if self.exact:
            for i, (x, y, n) in enumerate(zip(a.tolist(), b.tolist(), most.tolist(), strict=True)):
                first = 0 if way > 0 else 1 - n
                differ = np.flatnonzero(self.ids[x + first : x + first + n] != self.ids[y + first : y + first + n])
                done[i] = n if not len(differ) else differ[0] if way > 0 else n - 1 - differ[-1]
            return done
        # one word at first, as most pairs go no further; then twice as many as long as all agree, then half as many
        live = np.flatnonzero(most > 0)
        live = live[self.ids[a[live]] == self.ids[b[live]]]
        done[live] = 1
        step, grows = np.ones(len(a), np.int64), np.ones(len(a), bool)
        while len(live):
            step[live] = np.where(grows[live], step[live] * 2, step[live] // 2)
            live = live[step[live] > 0]
            n = np.minimum(step[live], most[live] - done[live])
            agree = same(a[live], b[live], done[live], n) & (n > 0)
            done[live[agree]] += n[agree]
            grows[live] &= agree & (n == step[live])
        return done


def crossing(seq: Sequence, low: np.ndarray, middle: np.ndarray, high: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repetitions that cross the midpoints of segments and have two periods to the right (or left) of them: first word, end and period, cut at the segment."""
    ids = seq.ids
    most = np.minimum((high - low) // EXPONENT, (high - middle if right else middle - low) // 2)
    which = np.repeat(np.arange(len(low)), most)
    q = ragged(np.ones(len(most), np.int64), most)
    m = middle[which]
    near = m if right else m - 1
    again = near + q if right else near - q
    hit = np.flatnonzero(ids[near] == ids[again])
    # two periods on this side: the words in the middle and at the end of the first period come again too
    for share in (1, 2):
        part = (q[hit] - 1) // share
        a, b = (near[hit] + part, again[hit] + part) if right else (near[hit] - part, again[hit] - part)
        hit = hit[ids[a] == ids[b]]
    which, q = which[hit], q[hit]
    found = []
    for turn in (*TURNS, None):
        now = q <= turn if turn else np.ones(len(q), bool)
        start, end, period, segment = reaching(seq, low, middle, high, which[now], q[now], right)
        found.append((start, end, period))
        which, q = which[~now], q[~now]
        for s, e, p in per_segment(start, end, period, segment, len(low)) if len(q) else ():
            # a multiple of a run's period that lies within the run gives this run again
            again = (p[which] > 0) & (q % np.maximum(p[which], 1) == 0) & (q <= (e[which] - middle[which] if right else middle[which] - s[which]))
            which, q = which[~again], q[~again]
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    return start, end, period


def reaching(seq: Sequence, low: np.ndarray, middle: np.ndarray, high: np.ndarray, which: np.ndarray, q: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The repetitions of periods q over the midpoints of segments, by their Z-values: first word, end, period, segment."""
    m = middle[which]
    at = m if right else m - q
    ahead = seq.forward(at, at + q, high[which] - at - q)
    good = ahead >= (q if right else 1)  # on the right two periods agree; on the left the run reaches over the midpoint
    which, q, m, at, ahead = which[good], q[good], m[good], at[good], ahead[good]
    behind = seq.backward(at - 1, at + q - 1, at - low[which])
    start, end = at - behind, at + q + ahead
    keep = (end - start >= np.maximum(LEAST, EXPONENT * q)) & (start < m) & (end > m)
    start, end, q, which = start[keep], end[keep], q[keep], which[keep]
    one = smallest(start, end, q, which)
    return start[one], end[one], q[one], which[one]


def smallest(start: np.ndarray, end: np.ndarray, period: np.ndarray, *also: np.ndarray) -> np.ndarray:
    """Of rows of one interval (and what else is given) the one of smallest period."""
    keys = (*also, start, end)
    order = np.lexsort((period, *keys))
    first = np.ones(len(order), bool)
    first[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order[first]


def per_segment(start: np.ndarray, end: np.ndarray, period: np.ndarray, segment: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The first run of each of n segments, then the second, and so on: start, end, period (0 for none)."""
    while len(segment):
        _, first = np.unique(segment, return_index=True)
        out = np.zeros((3, n), np.int64)
        out[:, segment[first]] = start[first], end[first], period[first]
        yield out
        start, end, period, segment = (np.delete(x, first) for x in (start, end, period, segment))


def repetitions(seq: Sequence, bounds: np.ndarray) -> Runs:
    """All runs of the documents that lie between bounds."""
    low, high = bounds[:-1], bounds[1:]
    found = []
    while True:
        long = high - low >= LEAST
        low, high = low[long], high[long]
        if not len(low):
            break
        middle = (low + high) // 2
        found += [crossing(seq, low, middle, high, right) for right in (True, False)]
        low, high = np.stack([low, middle], 1).ravel(), np.stack([middle, high], 1).ravel()
    if not found:
        return Runs(*[np.zeros(0, np.int64)] * 3)
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    # to the longest in the document
    text = np.searchsorted(bounds, start, side="right") - 1
    left = seq.backward(start - 1, start + period - 1, start - bounds[text])
    ahead = seq.forward(end - period, end, bounds[text + 1] - end)
    start, end = start - left, end + ahead
    one = smallest(start, end, period)
    start, end, period = start[one], end[one], period[one]
    order = np.lexsort((period, start))
    return Runs(start[order], end[order], period[order])


def verified(ids: np.ndarray, bounds: np.ndarray, runs: Runs) -> np.ndarray:
    """Whether each run's words, one period apart, are the same, and those next to it are not."""
    out = np.ones(len(runs.start), bool)
    size = runs.end - runs.start - runs.period
    for first in range(0, len(size), 4096):  # runs of many words are compared in turns
        some = slice(first, first + 4096)
        edges = np.concatenate([[0], np.cumsum(size[some])])
        at = 0
        while at < len(edges) - 1:
            to = max(at + 1, int(np.searchsorted(edges, edges[at] + (1 << 20), side="right")) - 1)
            a = ragged(runs.start[some][at:to], size[some][at:to])
            differ = ids[a] != ids[a + np.repeat(runs.period[some][at:to], size[some][at:to])]
            out[first + at : first + to] = np.add.reduceat(differ, edges[at:to] - edges[at]) == 0
            at = to
    text = np.searchsorted(bounds, runs.start, side="right") - 1
    for place, inside, away in ((runs.start - 1, runs.start > bounds[text], runs.period), (runs.end, runs.end < bounds[text + 1], -runs.period)):
        out[inside] &= ids[place[inside]] != ids[place[inside] + away[inside]]
    return out


def runs_of(ids: np.ndarray, bounds: np.ndarray) -> Runs:
    """The runs of all documents, whose ids stand end to end."""
    seq = Sequence(ids)
    found = repetitions(seq, bounds)
    if not verified(ids, bounds, found).all():
        seq.exact = True
        found = repetitions(seq, bounds)
    return found


def kept_words(n: int, runs: Runs) -> np.ndarray:
    """Whether each of n words stays: those in no run after its first period."""
    edge = np.bincount(runs.start + runs.period, minlength=n + 1) - np.bincount(runs.end, minlength=n + 1)
    return np.cumsum(edge[:n]) == 0


def joined(buffer: Buffer, start: np.ndarray, stop: np.ndarray, text: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    start, stop, text = start[keep], stop[keep], text[keep]
    last = np.ones(len(text), bool)
    last[:-1] = text[1:] != text[:-1]
    data = buffer.data.copy()
    data[stop[~last]] = 32  # white space follows every word that another one follows
    size = stop - start + ~last
    edge = np.zeros(len(data) + 2, np.int8)
    np.add.at(edge, start, 1)
    np.subtract.at(edge, start + size, 1)
    out = data[np.cumsum(edge[: len(data)], dtype=np.int8).view(bool)]
    ends = np.concatenate([[0], np.cumsum(np.bincount(text, size, minlength=buffer.n))]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(buffer.n, pa.py_buffer(ends), pa.py_buffer(out.tobytes())).cast(pa.string())


def listed(runs: Runs, bounds: np.ndarray) -> pa.Array:
    """The runs of each document, words numbered from its first."""
    text = np.searchsorted(bounds, runs.start, side="right") - 1
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(bounds) - 1))]).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(runs.start - bounds[text]), pa.array(runs.end - runs.start), pa.array(runs.period)], names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def periodic_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns but the text) with runs and collapsed of whole texts.

    runs: first word (from 0), length and period, in words, of every maximal
    stretch of at least 6 words and 4 periods, by start, then period.
    collapsed: the words that no run holds after its first period, joined by a
    space.  Words are what ASCII white space divides.

    Cases: null text counts as empty, has no runs and collapses to the empty
    text.  Texts may be of any length.  Repeated rows each get their runs;
    columns of the input named runs or collapsed give way to the results.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in (text_col, *MADE)]
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("runs", T._parse_datatype_string(RUNS)), T.StructField("collapsed", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buffer in slices(batch.column(len(keep))):
                start, stop, text = buffer.runs(~SPACE)
                bounds = np.searchsorted(text, np.arange(buffer.n + 1))
                found = runs_of(interned(buffer, start, stop), bounds)
                collapsed = joined(buffer, start, stop, text, kept_words(len(start), found))
                columns = [batch.column(i).slice(first, last - first) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, listed(found, bounds), collapsed], names=[*keep, "runs", "collapsed"])

    return arrow_map(docs.select(*keep, F.col(text_col).cast("string").alias("__text")), work, schema)


def planted(text: Column, doc_id: Column) -> Column:
    """The text of a document, for one in ten with a tail of its words repeated in place of what stood there."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def tail(x: Column) -> Column:
        n, a, p = x["n"], x["a"], x["p"]
        again = F.transform(F.sequence(a, n - 1), lambda i: F.get(x["words"], (a + F.pmod(i - a, p)).cast("int")))
        return F.concat_ws(" ", F.slice(x["words"], F.lit(1), a.cast("int")), again)

    def measured(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        return F.struct(words.alias("words"), n.alias("n"), a.alias("a"), p.alias("p"))

    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    bound = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))  # noqa: E731  (the value is computed once)
    made = bound(words, lambda w: F.when(F.size(w) > 0, bound(measured(w), tail)).otherwise(text))
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.isNotNull(), made).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    out = periodic_runs(docs).withColumn("best", best)
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
