"""Token ids in files: frequency-ranked, byte-aligned, with separate control bytes.

Ids are replaced by their rank in the corpus, the most frequent first, so most
take one byte.  A rank takes 1 to 4 bytes, low byte first.  How many stands
apart, two bits a rank, four ranks a control byte.  Reading looks each control
byte up in a table of four lengths, so no loop runs over the ids.

A file set is a folder with ``ranks`` (rank, id) and ``blocks``.  A block holds
some documents in order: their ids and token counts, control bytes and data
bytes, and where it starts within its part.  Parts are ranges of doc_id in
order.  Both are written by Spark's committer, so a lost task leaves nothing
half done, on any store that Spark can write to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import SIGN, SPACE, Encoder, binaries, encoder, letters, public_path, slices
from .hashing import Buffer
from .merges import merges_of
from .stages import arrow_map, new_path, read_table, remembering, staged

#: Ids of a block, about; a longer document makes a longer block.
BLOCK = 1 << 18
END = 1

LENGTHS = ((np.arange(256)[:, None] >> np.arange(0, 8, 2)) & 3).astype(np.uint8) + np.uint8(1)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    padded = np.zeros(-(-len(code) // 4) * 4, np.uint8)
    padded[: len(code)] = code
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks of a block."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    start = ends - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[start].astype(np.uint32)
    for byte in (1, 2, 3):
        more = np.flatnonzero(lengths > byte)
        out[more] |= raw[start[more] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return out


#: Lower case of ASCII, and of the second byte of U+00C0 to U+00DE.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def folded(buffer: Buffer, letter: np.ndarray) -> Buffer:
    """The buffer with known letters in lower case; every place stays where it was."""
    data = FOLD[buffer.data]
    second = np.flatnonzero(letter[1:] & (buffer.data[:-1] == 0xC3)) + 1
    upper = second[(data[second] >= 0x80) & (data[second] <= 0x9E)]
    data[upper] += 32
    return Buffer.over(data.tobytes(), buffer.starts)


def words_of(enc: Encoder, buffer: Buffer) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, and where each text's start, with the total at the end."""
    letter = letters(buffer.data) if len(buffer.data) else None
    if letter is not None:
        low = folded(buffer, letter)
        buffer, letter = (low, letter) if enc.ordinary(low) else (buffer, None)
    start, stop, text = buffer.runs(~SPACE)
    if letter is not None:
        sign, mark = SIGN[buffer.data], np.zeros(len(buffer.data) + 1, bool)
        mark[1:-1] = letter[:-1] & sign[1:] | sign[:-1] & letter[1:]
        mark[buffer.starts] = False  # neighbours of two texts
        ending = mark.copy()
        mark[start] = True
        ending[stop] = True
        start, stop = np.flatnonzero(mark), np.flatnonzero(ending)
        text = np.searchsorted(buffer.starts, start, side="right") - 1
    flat, lengths = enc.pieces(buffer, start, stop, letter)
    per = np.bincount(text, lengths, minlength=buffer.n).astype(np.int64)
    return flat, np.concatenate([[0], np.cumsum(per)])


def encode_words(docs: DataFrame, path: str, end: int | None = END) -> DataFrame:
    """doc_id and ids (16 or 32 bits each, as the vocabulary needs) of whole texts, for a tokenizer that drops white space.

    Such a tokenizer never joins what white space divides, nor, where no special
    token is written out, letters and signs; so each word is encoded once,
    within a bound, in a worker's life.  Upper case is folded before, where that
    cannot make a special token.
    """

    merges = merges_of(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, merges)
        for batch in batches:
            for first, last, buffer in slices(batch.column(1)):
                flat, bounds = words_of(enc, buffer)
                if end is not None:
                    flat = np.insert(flat, bounds[1:], end).astype(enc.type)
                    bounds = bounds + np.arange(buffer.n + 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), binaries(flat, bounds)], names=["doc_id", "ids"])

    return arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), remembering(work), "doc_id long, ids binary")


def frequency_ranks(encoded: DataFrame, width: type) -> np.ndarray:
    """Ids by falling count over the whole corpus, ties by id; as many rows as the vocabulary has reach the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for value in batch.column(0):
                own = np.bincount(np.frombuffer(value.as_buffer() or b"", width))
                if len(own) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(own) - len(counts), np.int64)])
                counts[: len(own)] += own
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts[ids])], names=["id", "n"])

    rows = arrow_map(encoded.select("ids"), work, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return np.array([r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))], np.uint32)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int | None = END) -> None:
    """Encode whole texts and write them under ``path`` in ascending doc_id order.

    Cases: null and empty texts have the end id alone.  Rows with a null doc_id
    come first; rows with one doc_id stand together, in order of their ids.
    Texts may be of any length.  Other columns are not read, whatever their names;
    an empty table writes no blocks.
    """
    spark = docs.sparkSession
    width = merges_of(tokenizer).kind
    encoded = staged(encode_words(docs, tokenizer, end), "ids")
    order = frequency_ranks(encoded, width)
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(order)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, number = TaskContext.get().partitionId(), 0, 0
        held_ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            counts = np.array([len(x) for x in held], "<u4")
            control, data = pack(rank[np.concatenate(held)])
            missing = bytes(x is None for x in held_ids)
            names = np.array([0 if x is None else x for x in held_ids], "<i8").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, number, start, int(counts.sum()), names, missing, counts.tobytes(), control, data)], names=["part", "block", "start", "n", "doc_ids", "no_id", "counts", "control", "data"])

        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held_ids.append(doc_id)
                held.append(np.frombuffer(value.as_buffer() or b"", width))
                size += len(held[-1])
                if size >= BLOCK:
                    yield block()
                    start, number, size, held_ids, held = start + size, number + 1, 0, [], []
        if held:
            yield block()

    schema = "part long, block long, start long, n long, doc_ids binary, no_id binary, counts binary, control binary, data binary"
    arrow_map(encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids"), work, schema).write.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (unsigned 32 bits, low byte first) of the documents in a file set."""
    order = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], "<u4")  # as many as the vocabulary has
    blocks = spark.read.parquet(f"{path}/blocks")
    total, first = 0, {}
    for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # a row for each part
        first[r["part"]], total = total, total + r["n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                counts = np.frombuffer(r["counts"], "<u4").astype(np.int64)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                ids = order[unpack(r["control"], r["data"], int(bounds[-1]))]
                names = pa.array(np.frombuffer(r["doc_ids"], "<i8"), mask=np.frombuffer(r["no_id"], np.uint8).astype(bool))
                yield pa.RecordBatch.from_arrays([names, pa.array(bounds[:-1] + (first[r["part"]] + r["start"])), pa.array(counts), binaries(ids, bounds)], names=["doc_id", "start", "n_tokens", "ids"])

    return arrow_map(blocks, work, "doc_id long, start long, n_tokens long, ids binary")


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-file")
    write_ids(read_table(spark, sf_dir, "documents"), path, public_path("word_bpe_49k.json"))
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
