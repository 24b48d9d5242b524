"""Token counts of whole texts for a sentencepiece BPE model, huge ones by overlapping chunks.

A text longer than a chunk is encoded in chunks that overlap around each cut.
Ids and their offsets in the text are spliced at a place in the overlap that
begins a token in both chunks and is proven stable: no piece of the vocabulary
holds the two characters beside it next to each other, so no merge can ever
join what it divides, and what lies on one side does not depend on the other.
The chunks must agree on all tokens between the first and the last such place
they share.  Where the overlap holds none, or they do not agree, it is widened,
by twice as much each time, at most to the whole text.

So a task holds a text and the state of one or two chunks, not of a whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import public_path
from .stages import arrow_map, kept, read_table, remembering

#: Characters of a chunk, and of an overlap at first, to each side of a cut.
CHUNK, OVERLAP = 1 << 15, 128
#: Characters of short texts that are encoded in one call.
CALL = 1 << 18
#: More tokens than this are over the limit.
LIMIT = 4096
MADE = ("n_bytes", "n_tokens", "over_limit")


class Pieces:
    """A sentencepiece model, and what its vocabulary proves about places in a text."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, max(1, overlap)
        self.spliced = self.widened = 0
        with open(path, "rb") as f:
            told = proto.ModelProto.FromString(f.read())
        kinds = told.SentencePiece.Type
        spec, trained = told.normalizer_spec, told.trainer_spec
        #: Characters map one to one to symbols, and what is not in the vocabulary falls back to bytes.
        self.plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces and trained.model_type == trained.BPE and trained.byte_fallback and not trained.treat_whitespace_as_suffix
        self.before = int(spec.add_dummy_prefix)
        self.length, self.inner = np.zeros(len(told.pieces), np.int64), np.zeros(len(told.pieces), bool)
        pairs = set()
        for i, x in enumerate(told.pieces):
            if x.type == kinds.BYTE:  # the bytes of a character after its first add no length
                self.inner[i] = int(x.piece[1:-1], 16) >> 6 == 2
                self.length[i] = not self.inner[i]
            elif x.type not in (kinds.CONTROL, kinds.UNKNOWN):
                self.length[i] = len(x.piece)
                pairs.update(ord(a) << 21 | ord(b) for a, b in zip(x.piece, x.piece[1:], strict=False))
        self.pairs = np.array(sorted(pairs), np.int64)

    def stable(self, text: str, low: int, high: int) -> np.ndarray:
        """Places p, low < p < high, that no merge can cross."""
        code = np.frombuffer(text[low:high].encode("utf-32-le"), "<u4").astype(np.int64)
        code[code == 32] = 0x2581  # how pieces write a blank
        pair = code[:-1] << 21 | code[1:]
        found = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return low + 1 + np.flatnonzero(self.pairs[found] != pair)

    def encoded(self, text: str, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of text[low:high], and the place in the text where each begins."""
        ids = self.model.encode(text[low:high], return_type="numpy")
        ends = np.cumsum(self.length[ids])
        if len(ends) and ends[-1] != high - low + self.before:
            raise ValueError("ids and characters of a chunk do not add up")
        return ids, ends - self.length[ids] - self.inner[ids] + (low - self.before)

    def ids(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a whole text, run after run."""
        n = len(text)
        if n <= self.chunk or not self.plain:
            yield self.model.encode(text, return_type="numpy")
            return
        start = low = 0  # the tokens before ``start`` are told; the chunk in hand begins at ``low``
        cut, wide = self.chunk, self.overlap
        while True:
            cut, wide, places = self.overlapping(text, start, cut, wide)
            high = min(n, cut + wide)
            ids, begin = self.encoded(text, low, high)
            first = int(np.searchsorted(begin, start)) if start else 0
            if high == n:
                yield ids[first:]
                return
            next_low = max(start, cut - wide)
            # the next chunk's first tokens, to the end of the overlap, must be this one's last
            at, agreed = self.common(text, next_low, high, ids, begin, places)
            if not agreed:
                wide *= 2
                self.widened += 1
                continue
            last = int(np.searchsorted(begin, at))
            yield ids[first:last]
            self.spliced += 1
            start, low = at, next_low
            cut, wide = cut + self.chunk, self.overlap

    def overlapping(self, text: str, start: int, cut: int, wide: int) -> tuple[int, int, np.ndarray]:
        """The overlap around a cut, widened until it holds a stable place or reaches the end of the text."""
        while True:
            low, high = max(start, cut - wide), min(len(text), cut + wide)
            places = self.stable(text, low, high)
            if len(places) or high == len(text):
                return cut, wide, places
            wide *= 2
            self.widened += 1

    def common(self, text: str, low: int, high: int, ids: np.ndarray, begin: np.ndarray, places: np.ndarray) -> tuple[int, bool]:
        """A stable place where both the chunk in hand and the overlap, encoded as the next chunk's head, begin a token; whether they agree between the first and last of these."""
        other, other_begin = self.encoded(text, low, high)
        both = np.intersect1d(np.intersect1d(begin, other_begin), places)
        if len(both) < len(places):
            return -1, False
        one = slice(*np.searchsorted(begin, [both[0], both[-1]]))
        two = slice(*np.searchsorted(other_begin, [both[0], both[-1]]))
        return int(both[len(both) // 2]), np.array_equal(ids[one], other[two]) and np.array_equal(begin[one], other_begin[two])

    def counts(self, texts: list[str]) -> np.ndarray:
        """How many tokens each text has."""
        out, held, size = np.zeros(len(texts), np.int64), [], 0

        def told() -> None:
            out[held] = [len(x) for x in self.model.encode([texts[i] for i in held], num_threads=1, return_type="numpy")]
            held.clear()

        for i, x in enumerate(texts):
            if len(x) > self.chunk:
                out[i] = sum(len(part) for part in self.ids(x))
                continue
            held.append(i)
            size += len(x)
            if size >= CALL:
                told()
                size = 0
        if held:
            told()
        return out


def token_counts(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None, limit: int = LIMIT) -> DataFrame:
    """``keep`` (default: all columns but the text) with n_bytes (UTF-8), n_tokens and over_limit of whole texts.

    ``path`` is a sentencepiece model's file, at the same place on every executor.
    Counted as the library does without begin, end and added special tokens;
    strings of special tokens in a text are text.

    Cases: null text counts as empty and has no tokens.  Texts may be of any
    length.  Repeated rows each get their counts; columns of the input named
    n_bytes, n_tokens or over_limit give way to the results.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in (text_col, *MADE)]
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if ("pieces", path) not in kept():
            kept()[("pieces", path)] = Pieces(path)
        pieces = kept()[("pieces", path)]
        for batch in batches:
            texts = [x or "" for x in batch.column(len(keep) + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep) + 1], pa.array(pieces.counts(texts))], names=[*keep, "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*keep, F.octet_length(text).cast("long").alias("n_bytes"), text.alias("__text"))
    return arrow_map(rows, remembering(work), schema).withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), public_path("piece_bpe_32k.model"), keep=["doc_id"])
