"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a rolling hash of its last bytes says so, so equal passages
are cut alike in whatever document they stand.  A chunk is encoded as a text of
its own, once; where the same bytes come again, its ids are taken over.  The
chunks that recur most in the whole corpus are found by counting digests,
encoded once for all, and sent to every worker as a table of bounded size; a
worker remembers others that it met, within a bound.

The ids of neighbouring chunks don't always add up to those of the whole, since
a token can span the cut.  So each cut is repaired: a window around it is
encoded anew as one string.  Its ids must begin with those that the left chunk
has for the window's first segment and end with those that the right chunk has
for its last; what lies between replaces the chunks' ids.  Where they do not
agree, the window grows, by twice as much each time, over as many chunks as it
takes, at most to the whole text.

Segments start where the pre-tokeniser always ends a token: where white space
follows a character that is none, and neither side's tokens depend on the other.
New text is encoded by segments, and a segment that recurs is encoded once,
within a bound, over the life of a Python worker.  Memories compare bytes, so a
collision of hashes costs time and nothing else.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import os
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import Buffer, U, ragged
from .merges import Merges, byte_names, merges_of
from .stages import arrow_map, kept, read_table, remembering, trimmed

#: Bytes of text that are worked on at once, and that are encoded at once; a longer text stands alone, whole.
SLICE, ENCODED = 1 << 19, 1 << 17
#: Bytes that the rolling hash sees; mean, least and most bytes of a chunk.
WINDOW, MEAN_BITS, LEAST, MOST = 32, 11, 256, 1 << 16
#: Odd factors of the four words of the window.
ROLL = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
#: A worker's memory: chunks in each of two generations; segments, and bytes of segments.
CHUNKS, SEGMENTS, SEGMENT_BYTES = 1024, 300_000, 1 << 23
#: The table of the chunks that recur most in the corpus: chunks, and bytes of their text, at most.
SHARED_CHUNKS, SHARED_BYTES = 1024, 1 << 21

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# White space beyond ASCII, in UTF-8.
WIDE_SPACES = tuple(chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


class Recent(dict):
    """A memory of bounded size: when it is full, what was not used since it was half full goes."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def find(self, key):
        got = self.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.keep(key, got)
        return got

    def keep(self, key, value) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value


#: What pre-tokenisers see: letters (ASCII, and U+00C0 to U+00FF but for two signs, as two bytes), signs other than the apostrophe, and the rest.
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
SIGN = np.zeros(256, bool)
SIGN[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = True


def letters(data: np.ndarray) -> np.ndarray:
    """Whether each byte is of a letter that is known here; other letters count as unknown."""
    out = LETTER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = data[lead + 1]
    lead = lead[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
    out[lead] = True
    out[lead + 1] = True
    return out


def safe_starts(buffer: Buffer, letter: np.ndarray | None = None) -> np.ndarray:
    """Where segments start: each text that isn't empty, and each safe place within it.

    ``letter``: with it, places between a letter and what is none, and between
    a sign and a letter, are safe too; so they are in texts without special
    tokens, as a pre-tokeniser's letters never go with other characters but for
    a space or apostrophe before them.
    """
    data = buffer.data
    space = SPACE[data]
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    wide = np.zeros(len(at), bool)
    last = data[at - 1]
    for x in WIDE_SPACES:
        near = np.flatnonzero((last == x[-1]) & (at >= len(x)))
        for back in range(2, len(x) + 1):
            near = near[data[at[near] - back] == x[-back]]
        wide[near] = True
    mark = np.zeros(len(data) + 1, bool)
    mark[at[~wide]] = True
    mark[buffer.starts[:-1][np.diff(buffer.starts) > 0]] = True
    if letter is not None:
        sign = SIGN[data]
        mark[1:-1] |= letter[:-1] & sign[1:] | sign[:-1] & letter[1:]
    return np.flatnonzero(mark[:-1])


def cuts(buffer: Buffer) -> np.ndarray:
    """Starts of the chunks of all texts, in order; the content before a place alone decides on it, and no character is cut."""
    n = len(buffer.data)
    marks = np.zeros(0, np.int64)
    if n > WINDOW:
        eights = np.ndarray(n - 7, "<u8", buffer.raw, strides=(1,))
        rolling = np.zeros(n - WINDOW, U)
        for at, factor in zip(range(0, WINDOW, 8), ROLL, strict=True):
            rolling += eights[at : at + n - WINDOW] * U(factor)
        marks = np.flatnonzero(rolling >> U(64 - MEAN_BITS) == 0) + WINDOW
        for _ in range(3):  # to the start of the next character
            marks = marks + ((marks < n) & ((buffer.data[np.minimum(marks, n - 1)] & 0xC0) == 0x80))
    out: list[int] = []
    bounds = np.searchsorted(marks, buffer.starts)
    for i in range(buffer.n):
        start, end = int(buffer.starts[i]), int(buffer.starts[i + 1])
        if start == end:
            continue
        out.append(start)
        last = start
        for mark in (*marks[bounds[i] : bounds[i + 1]].tolist(), end):
            while mark - last > MOST:
                last += MOST
                while last < end and buffer.data[last] & 0xC0 == 0x80:
                    last += 1
                if last < end:
                    out.append(last)
            if mark - last >= LEAST and mark - start >= WINDOW and mark < end:
                out.append(mark)
                last = mark
    return np.array(out, np.int64)


class Store:
    """Ids of segments: a table of one place a slot by the segment's hash, and bytes and ids end to end.

    A segment is found if its bytes agree.  When the store is full it starts anew, so its size is bounded.
    """

    def __init__(self, kind: type, bits: int = 19, limit: int = SEGMENTS, limit_bytes: int = SEGMENT_BYTES):
        self.kind, self.bits, self.limit, self.limit_bytes = kind, bits, limit, limit_bytes
        self.clear()

    def clear(self) -> None:
        self.keys, self.places = np.zeros(1 << self.bits, U), np.full(1 << self.bits, -1, np.int32)
        self.starts, self.lengths, self.flat = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, self.kind)
        self.at, self.sizes, self.raw = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.uint8)
        self.n = self.used = self.bytes = 0

    def room(self) -> None:
        if self.n > self.limit or self.bytes > self.limit_bytes or self.used > self.limit_bytes:
            self.clear()

    def find(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The place of each segment (its key, and its bytes in ``data``), or -1."""
        slot = (keys >> U(64 - self.bits)).astype(np.int64)
        out = np.where(self.keys[slot] == keys, self.places[slot], np.int32(-1))
        hit = np.flatnonzero(out >= 0)
        out[hit[~same_bytes(self.raw, self.at[out[hit]], self.sizes[out[hit]], data, start[hit], size[hit])]] = -1
        return out

    @staticmethod
    def grown(x: np.ndarray, n: int) -> np.ndarray:
        return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])

    def add(self, keys: np.ndarray, flat: np.ndarray, lengths: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Keep the ids of new segments; their places.  Of several that share a slot one can be found again."""
        n, used, total = self.n + len(keys), self.used + len(flat), self.bytes + int(size.sum())
        self.starts, self.lengths, self.flat = self.grown(self.starts, n), self.grown(self.lengths, n), self.grown(self.flat, used)
        self.at, self.sizes, self.raw = self.grown(self.at, n), self.grown(self.sizes, n), self.grown(self.raw, total)
        self.starts[self.n : n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.n : n] = lengths
        self.flat[self.used : used] = flat
        self.at[self.n : n] = self.bytes + np.cumsum(size) - size
        self.sizes[self.n : n] = size
        self.raw[self.bytes : total] = data[ragged(start, size)]
        places = np.arange(self.n, n)
        slot = (keys >> U(64 - self.bits)).astype(np.int64)
        self.places[slot] = places
        self.keys[slot] = keys[self.places[slot] - self.n]
        self.n, self.used, self.bytes = n, used, total
        return places

    def get(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[places]
        return self.flat[ragged(self.starts[places], lengths)], lengths


def same_bytes(one: np.ndarray, at: np.ndarray, size: np.ndarray, other: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether slices of ``one`` and of ``other`` are equal, pair by pair."""
    out = size == length
    both = np.flatnonzero(out & (length > 0))
    if len(both):
        differ = one[ragged(at[both], length[both])] != other[ragged(start[both], length[both])]
        ends = np.cumsum(length[both])
        out[both] = ~np.logical_or.reduceat(differ, ends - length[both])
    return out


class Encoder:
    """One tokenizer file and what this worker remembers of its work."""

    def __init__(self, path: str, merges: Merges | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.merges = merges or merges_of(path)
        self.type = self.merges.kind
        self.store, self.chunks = Store(self.type), Recent(CHUNKS)
        self.shared: dict = {}
        self.reused = self.made = self.grew = 0

    def ordinary(self, buffer: Buffer) -> bool:
        """No special token is written out in the texts, and merges can be made here."""
        return self.merges.usable and not any(x in buffer.raw for x in self.special)

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def fresh(self, buffer: Buffer, start: np.ndarray, end: np.ndarray, letter: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of slices that were not met before: one pre-token by merges, anything else by the library."""
        single = np.zeros(len(start), bool)
        if letter is not None:
            lead = start + ((buffer.data[start] == 32) & (end - start > 1))
            for inside in (letter, SIGN[buffer.data]):
                total = np.concatenate([[0], np.cumsum(inside)])
                single |= total[end] - total[lead] == end - lead
        ids, lengths = self.merges.run(buffer.data, start[single], end[single]) if single.any() else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if single.all():
            return ids, lengths
        every = np.zeros(len(start), np.int64)
        every[single] = lengths
        rest = np.flatnonzero(~single)
        raw, other = buffer.raw, []
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            other += self.plain([raw[a:b].decode() for a, b in zip(start[some].tolist(), end[some].tolist(), strict=True)])
        every[rest] = [len(x) for x in other]
        out = np.zeros(int(every.sum()), np.int64)
        begin = np.cumsum(every) - every
        out[ragged(begin[single], every[single])] = ids
        out[ragged(begin[rest], every[rest])] = np.concatenate([np.array(x, np.int64) for x in other])
        return out, every

    def pieces(self, buffer: Buffer, start: np.ndarray, end: np.ndarray, letter: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each slice of the buffer, end to end, and how many each has."""
        if not len(start):
            return np.zeros(0, self.type), np.zeros(0, np.int64)
        self.store.room()
        keys, size = buffer.hashes(start, end), end - start
        places = self.store.find(keys, buffer.data, start, size)
        missing = np.flatnonzero(places < 0)
        while len(missing):  # more than once only where slices of one hash differ
            new, first, which = np.unique(keys[missing], return_index=True, return_inverse=True)
            at = missing[first]
            same = same_bytes(buffer.data, start[at][which], size[at][which], buffer.data, start[missing], size[missing])
            added = self.store.add(new, *self.fresh(buffer, start[at], end[at], letter), buffer.data, start[at], size[at])
            places[missing[same]] = added[which[same]]
            missing = missing[~same]
        return self.store.get(places)

    def encode(self, buffer: Buffer) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's start, with the total at the end."""
        letter = letters(buffer.data) if len(buffer.data) and self.ordinary(buffer) else None
        safe = safe_starts(buffer, letter)
        if not len(safe):
            return np.zeros(0, self.type), np.zeros(buffer.n + 1, np.int64)
        chunk = cuts(buffer)
        mark = np.zeros(len(buffer.data), bool)
        mark[safe] = True
        mark[chunk] = True
        begin = np.flatnonzero(mark)  # segments of the chunks, each chunk a text of its own
        flat, every = self.chunk_ids(buffer, chunk, begin, letter)
        before = np.concatenate([[0], np.cumsum(every)])
        parts, last = [], 0
        for s, e, ids in self.joins(buffer, chunk, safe, begin, flat, before):
            parts += [flat[before[last] : before[s]], ids]
            every[s:e] = 0
            every[s] = len(ids)
            last = e
        parts.append(flat[before[last] :])
        total = np.concatenate([[0], np.cumsum(every)])
        return np.concatenate(parts).astype(self.type), total[np.searchsorted(begin, buffer.starts)]

    def chunk_ids(self, buffer: Buffer, chunk: np.ndarray, begin: np.ndarray, letter: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, each as a text of its own, end to end, and how many each segment has."""
        raw, hits, known = buffer.raw, [], {}
        misses: dict[tuple, tuple[int, int]] = {}
        need = np.ones(len(begin), bool)
        first = np.searchsorted(begin, chunk)
        for x, y, s, e in zip(chunk.tolist(), [*chunk[1:].tolist(), len(buffer.data)], first.tolist(), [*first[1:].tolist(), len(begin)], strict=True):
            key = (letter is None, raw[x:y])  # which places are safe decides on the segments
            if key not in known and key not in misses:
                found = self.shared.get(key) or self.chunks.find(key)
                if found is None:
                    misses[key] = (s, e)
                    continue
                known[key] = found
            hits.append((s, e, key))
            need[s:e] = False
        self.reused, self.made = self.reused + len(hits), self.made + len(misses)
        new, lengths = self.pieces(buffer, begin[need], np.append(begin[1:], len(buffer.data))[need], letter)
        every = np.zeros(len(begin), np.int64)
        every[need] = lengths
        before = np.concatenate([[0], np.cumsum(every)])
        for key, (s, e) in misses.items():
            known[key] = (new[before[s] : before[e]].copy(), every[s:e].astype(np.int32))
            self.chunks.keep(key, known[key])
        parts, last = [], 0
        for s, e, key in hits:
            ids, counts = known[key]
            parts += [new[last : before[s]], ids]
            last = before[s]
            every[s:e] = counts
        parts.append(new[last:])
        return np.concatenate(parts), every

    def joins(self, buffer: Buffer, chunk: np.ndarray, safe: np.ndarray, begin: np.ndarray, flat: np.ndarray, before: np.ndarray) -> list[tuple[int, int, list[int]]]:
        """What replaces the ids of segments s to e, for each join, in order.

        A stretch runs from one safe place to the next.  Stretches with a cut in
        them or after them are open; a window is a run of open ones and, where
        the text has them, a closed one on either side, whose ids must agree.
        """
        start = np.zeros(len(buffer.data) + 1, bool)
        start[buffer.starts] = True
        inner = chunk[~start[chunk]]
        if not len(inner):
            return []
        n = len(safe)
        ends = np.append(safe[1:], len(buffer.data))
        head = start[safe]  # first stretch of a text
        tail = np.append(head[1:], True)
        at = before[np.searchsorted(begin, np.append(safe, len(buffer.data)))]  # ids before each stretch
        of = np.append(np.searchsorted(begin, safe), len(begin))
        is_open = np.zeros(n, bool)
        is_open[np.searchsorted(safe, inner, side="left") - 1] = True
        done: dict[tuple[int, int], list[int]] = {}
        while True:
            first = np.flatnonzero(is_open & (head | ~np.append(False, is_open[:-1])))
            last = np.flatnonzero(is_open & (tail | ~np.append(is_open[1:], False)))
            todo = [(a, b) for a, b in zip(first.tolist(), last.tolist(), strict=True) if (a, b) not in done]
            if not todo:
                return [(int(of[a]), int(of[b + 1]), done[a, b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            wide = [(a - (not head[a]), b + (not tail[b])) for a, b in todo]
            got = self.plain([buffer.raw[safe[x] : ends[y]].decode() for x, y in wide])
            for (a, b), (x, y), ids in zip(todo, wide, got, strict=True):
                left, right = flat[at[x] : at[a]].tolist(), flat[at[b + 1] : at[y + 1]].tolist()
                if len(ids) >= len(left) + len(right) and ids[: len(left)] == left and ids[len(ids) - len(right) :] == right:
                    done[a, b] = ids[len(left) : len(ids) - len(right)]
                else:
                    self.grew += 1
                    more = b - a + 1
                    lo, hi = a, b
                    while lo > a - more and not head[lo]:
                        lo -= 1
                    while hi < b + more and not tail[hi]:
                        hi += 1
                    is_open[lo : hi + 1] = True


def encoder(path: str, merges: Merges | None = None) -> Encoder:
    """A worker's encoder of a file; it lives until the worker does other work.  What its making took is given back.

    A task has one core, so the library starts no threads there, each of which would hold memory of its own.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held = kept()
    if path not in held:
        held[path] = Encoder(path, merges)
        gc.collect()
        trimmed()
    return held[path]


def as_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column end to end, and offsets; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, Buffer]]:
    """Runs of rows of about ``limit`` bytes with their buffer."""
    data, offsets = as_texts(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        buffer = Buffer.over(data[offsets[first] : offsets[last]].tobytes(), offsets[first : last + 1] - offsets[first])
        yield first, last, buffer
        first = last


def binaries(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow binary column of slices of ``flat``."""
    size = flat.itemsize
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds * size, np.int32)), pa.py_buffer(flat.tobytes())])


def shared_chunks(docs: DataFrame, path: str, text_col: str = "text", most: int = SHARED_CHUNKS, most_bytes: int = SHARED_BYTES) -> dict:
    """The chunks that would cost most if they were encoded wherever they stand, with their ids: a table for all workers.

    Every chunk of the corpus is counted by digest.  Of those that recur, the
    ``most`` with the most bytes in repeats are taken, up to ``most_bytes`` of
    text; each is encoded once.  The bounds keep what is sent to the workers
    bounded; they decide on work alone, not on ids.  A chunk is fetched from the
    first partition that counted it; where a scan is cut differently the second
    time, it is not found and stays out of the table.  Reads ``docs`` twice.
    """
    texts, merges = docs.select(F.col(text_col).cast("string").alias("text")), merges_of(path)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
        for batch in batches:
            for _, _, buffer in slices(batch.column(0)):
                start = cuts(buffer)
                yield [buffer.raw[x:y] for x, y in zip(start.tolist(), [*start[1:].tolist(), len(buffer.raw)], strict=True)]

    def digest(chunk: bytes) -> bytes:
        return hashlib.blake2b(chunk, digest_size=16).digest()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for some in chunks(batches):
            found = Counter(some)
            yield pa.RecordBatch.from_arrays([pa.array([digest(x) for x in found], pa.binary()), pa.array(found.values(), pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array([part] * len(found), pa.int64())], names=["digest", "n", "size", "part"])

    counted = arrow_map(texts, count, "digest binary, n long, size long, part long").groupBy("digest").agg(F.sum("n").alias("n"), F.max("size").alias("size"), F.min("part").alias("part")).where("n > 1")
    wanted, total = {}, 0
    for r in counted.orderBy(F.desc((F.col("n") - 1) * F.col("size")), "digest").limit(most).collect():  # bounded by ``most``
        total += r["size"]
        if total > most_bytes:
            break
        wanted[bytes(r["digest"])] = r["part"]
    if not wanted:
        return {}

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        mine = {x for x, p in wanted.items() if p == part}
        if not mine:
            return
        for some in chunks(batches):
            found = [x for x in dict.fromkeys(some) if digest(x) in mine]
            mine -= {digest(x) for x in found}
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["chunk"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, merges)
        for batch in batches:
            raw = batch.column(0).to_pylist()
            buffer = Buffer([x for x in raw if not any(s in x for s in enc.special)])
            if not buffer.n or not enc.merges.usable:
                continue
            letter = letters(buffer.data)
            begin = safe_starts(buffer, letter)
            ids, counts = enc.pieces(buffer, begin, np.append(begin[1:], len(buffer.data)), letter)
            per = np.searchsorted(begin, buffer.starts)
            before = np.concatenate([[0], np.cumsum(counts)])
            yield pa.RecordBatch.from_arrays([pa.array([buffer.raw[a:b] for a, b in zip(buffer.starts[:-1], buffer.starts[1:], strict=True)], pa.binary()), binaries(ids, before[per]), binaries(counts.astype(np.int32), per)], names=["chunk", "ids", "counts"])

    rows = arrow_map(arrow_map(texts, fetch, "chunk binary"), work, "chunk binary, ids binary, counts binary").collect()  # bounded by ``most_bytes``
    return {(False, bytes(r["chunk"])): (np.frombuffer(r["ids"], merges.kind), np.frombuffer(r["counts"], np.int32)) for r in rows}


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None, shared: dict | None = None) -> DataFrame:
    """``keep`` (default: all columns but the text) with n_tokens and ids, little-endian unsigned 32-bit integers.

    The ids are those that the tokenizers library gives the whole text with
    ``add_special_tokens=False``; ``path`` is a byte-level tokenizer's file, at
    the same place on every executor.  ``shared``: the table of recurring chunks;
    None: that of ``docs``, for which they are read twice more.

    Cases: null text counts as empty and has no ids.  Special tokens written out
    in a text get their own ids, as in the library.  Repeated rows each get their
    ids; columns of the input named n_tokens or ids give way to the results.
    """
    keep = others(docs, text_col, keep)
    shared = shared_chunks(docs, path, text_col) if shared is None else shared
    return arrow_map(docs.select(*keep, F.col(text_col).cast("string").alias("__text")), remembering(encoding(path, keep, shared)), encoded_schema(docs, keep))


def others(docs: DataFrame, text_col: str, keep: list[str] | None, *made: str) -> list[str]:
    """The columns that stay beside the results."""
    return [c for c in (keep if keep is not None else docs.columns) if c not in (text_col, "n_tokens", "ids", *made)]


def encoded_schema(docs: DataFrame, keep: list[str]) -> T.StructType:
    return T.StructType([*[docs.schema[c] for c in keep], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])


def encoding(path: str, keep: list[str], shared: dict) -> Callable:
    """Batches of (*keep, text) made batches of (*keep, n_tokens, ids)."""
    merges = merges_of(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, merges)
        enc.shared = shared
        for batch in batches:
            for first, last, buffer in slices(batch.column(batch.num_columns - 1), ENCODED):
                ids, bounds = enc.encode(buffer)
                columns = [batch.column(i).slice(first, last - first) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(bounds)), binaries(ids.astype("<u4"), bounds)], names=[*keep, "n_tokens", "ids"])

    return work


def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens end to end, and start and length by id."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    byte = {name: x for x, name in byte_names().items()}
    vocab = file["model"]["vocab"] | {x["content"]: x["id"] for x in file["added_tokens"]}
    tokens = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        tokens[i] = bytes(byte[c] for c in token)
    lengths = np.array([len(x) for x in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


@functools.cache
def cached_bytes(path: str):
    return token_bytes(path)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with its ids made text again, special tokens included; ids that make no UTF-8 give U+FFFD.

    Cases: null and empty ids give the empty text.
    """
    keep = [c for c in encoded.columns if c != to]
    schema = T.StructType([*[encoded.schema[c] for c in keep], T.StructField(to, T.StringType())])
    return arrow_map(encoded.select(*keep), decoding(path, keep, keep.index(ids_col), to), schema)


def decoding(path: str, keep: list[str], where: int, to: str) -> Callable:
    """Batches of ``keep``, ids at ``where``, with the decoded text as one more column."""
    table = cached_bytes(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts, lengths = table
        for batch in batches:
            column = batch.column(where).cast(pa.large_binary()).fill_null(b"")
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1)
                ids = np.frombuffer(raw[offsets[first] : offsets[last]].tobytes(), "<u4")
                out = data[ragged(starts[ids], lengths[ids])]
                ends = np.concatenate([[0], np.cumsum(lengths[ids])])
                bounds = ends[(offsets[first : last + 1] - offsets[first]) // 4]
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(first, last - first) for i in range(len(keep))], texts(out, bounds)], names=[*keep, to])
                first = last

    return work


def encode_decode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None, to: str = "decoded", shared: dict | None = None) -> DataFrame:
    """``decode(encode(docs))``, both by the one Python worker of a task, so that a core needs one worker's memory.

    Cases: as in ``encode`` and ``decode``; a column of the input named ``to`` gives way to the result.
    """
    keep = others(docs, text_col, keep, to)
    schema = T.StructType([*encoded_schema(docs, keep), T.StructField(to, T.StringType())])
    shared = shared_chunks(docs, path, text_col) if shared is None else shared
    first, then = encoding(path, keep, shared), decoding(path, [*keep, "n_tokens", "ids"], len(keep) + 1, to)
    return arrow_map(docs.select(*keep, F.col(text_col).cast("string").alias("__text")), remembering(lambda batches: then(first(batches))), schema)


def texts(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow string column of slices of bytes; what is not UTF-8 is replaced."""
    raw = data.tobytes()
    inner = bounds[1:-1][bounds[1:-1] < len(data)]
    try:
        raw.decode()
        good = not ((data[inner] & 0xC0) == 0x80).any()
    except UnicodeDecodeError:
        good = False
    if good:
        return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int32)), pa.py_buffer(raw)])
    return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.string())


def public_path(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_path("byte_bpe_50k.json")
    made = encode_decode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
