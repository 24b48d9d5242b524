"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order of its nearest pivots.  Each pivot keeps
an inverted file: the vectors that have it among their first ``prefix`` pivots,
with its place in their order.  A query reads the files of its own nearest
pivots, sums the footrule distance between the places (a vector that is not in
a file counts as place ``prefix``), and the nearest vectors by that distance get
their exact inner product.

Pivots come from a bounded sample; every row is indexed.  The index is split by
row into blocks of bounded size, whatever the cluster, each with the inverted
files of its own rows.  It is a table that is built once and written; any number
of query sets can be sent to it.  Blocks stay where they are and queries visit them.

Largest inner product is turned into nearest angle by one more component,
``sqrt(longest**2 - length**2)`` for rows and 0 for queries, so that vectors of
unequal length are ordered rightly too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stages import arrow_map, read_table, staged
from .topk import block_of, blocks_for, matrix, ranked, vectors_of, visited

#: Rows of a block, on average.
BLOCK_ROWS = 32768
#: Pivots; places kept of a row (256 at most: one byte) and read for a query; share of a block's distinct vectors that is reranked.
PIVOTS, PREFIX, QUERY_PREFIX, SHARE = 1024, 128, 40, 0.125
#: Rows whose distances to all pivots are held at once.
AT_ONCE = 4096


def orders(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of the ``prefix`` nearest pivots of each row, nearest first."""
    prefix = min(prefix, len(pivots))
    out = np.zeros((len(x), prefix), np.int32)
    for at in range(0, len(x), AT_ONCE):
        near = -(x[at : at + AT_ONCE] @ pivots.T)
        if prefix < near.shape[1]:
            some = np.argpartition(near, prefix - 1, axis=1)[:, :prefix]
            some.sort(axis=1)
            out[at : at + AT_ONCE] = np.take_along_axis(some, np.argsort(np.take_along_axis(near, some, 1), axis=1, kind="stable"), 1)
        else:
            out[at : at + AT_ONCE] = np.argsort(near, axis=1, kind="stable")
    return out


def inverted(order: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot the rows that have it, by place, and the places."""
    n, prefix = order.shape
    flat = np.argsort(order.T.ravel(), kind="stable")  # place after place, so each file is in order of place
    starts = np.searchsorted(order.T.ravel()[flat], np.arange(pivots + 1))
    rows, places = (flat % n).astype("<u4"), (flat // n).astype(np.uint8)
    return [(rows[a:b], places[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]


def footrule(files: dict[int, tuple[np.ndarray, np.ndarray]], n: int, prefix: int, query: np.ndarray) -> np.ndarray:
    """Distance of each row, less what a row would have that is in none of the files."""
    out = np.zeros(n, np.int32)
    for place, pivot in enumerate(query.tolist()):
        if pivot in files:
            rows, places = files[pivot]
            out[rows] += np.abs(places.astype(np.int32) - place) - (prefix - place)
    return out


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Unit-length rows whose angle to a query falls as the inner product grows."""
    x = x / longest
    return np.column_stack([x, np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))])


@dataclass
class Index:
    """A written index: its table, and of each length of vector the pivots (lifted) and the greatest length.

    Table: dim, block, seq (order within a block), pivot (null: vectors), and two
    binaries: of a pivot's file the rows and the places; of vectors the distinct
    vectors and, by member, its id and the number of its vector.
    """

    table: DataFrame
    pivots: dict[int, np.ndarray]
    longest: dict[int, float]
    rows: int
    prefix: int

    @property
    def blocks(self) -> int:
        return blocks_for(self.rows, BLOCK_ROWS)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors_of(df, id_col, vector_col).where(F.exists("vector", lambda x: x != 0))


def build(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, prefix: int = PREFIX) -> Index:
    """The index of all rows.  ``pivots`` is the documented bound of the sample that it is fitted on: that many rows with the least hash of their id."""
    c = staged(usable(rows, id_col, vector_col), "indexed-rows")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    found = c.groupBy("dim").agg(F.max(length).alias("longest"), F.count("*").alias("n")).collect()  # a row for each length of vector
    longest, n = {r["dim"]: r["longest"] for r in found}, sum(r["n"] for r in found)
    chosen = {}
    for dim in longest:
        sample = c.where(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
        chosen[dim] = lifted(np.array([r["vector"] for r in sample], np.float64), longest[dim])
    n_blocks = blocks_for(n, BLOCK_ROWS)

    def posted(dim: int, block: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([b.column("id").to_numpy() for b in held])
        vectors = np.concatenate([matrix(b.column("vector"), dim) for b in held])
        _, first, copy_of = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, dim * 8))).ravel(), return_index=True, return_inverse=True)
        files = inverted(orders(lifted(vectors[first], longest[dim]), chosen[dim], prefix), len(chosen[dim]))
        members = ids.astype("<i8").tobytes() + copy_of.astype("<u4").tobytes()
        out = [(None, vectors[first].astype("<f8").tobytes(), members), *((p, r.tobytes(), s.tobytes()) for p, (r, s) in enumerate(files) if len(r))]
        columns = [pa.array([dim] * len(out), pa.int32()), pa.array([block] * len(out), pa.int32()), pa.array(range(len(out)), pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([x[0] for x in out], pa.int32()), *(pa.array([x[i] for x in out], pa.binary()) for i in (1, 2))], names=["dim", "block", "seq", "pivot", "one", "two"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(2)])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                here = (int(keys[0, a]), int(keys[1, a]))
                if here != where and held:
                    yield from posted(*where, held)
                    held = []
                where = here
                held.append(batch.slice(a, b - a))
        if held:
            yield from posted(*where, held)

    placed = c.withColumn("block", block_of(n_blocks)).select("dim", "block", "id", "vector").repartition("dim", "block").sortWithinPartitions("dim", "block", "id")
    table = staged(arrow_map(placed, work, "dim int, block int, seq long, pivot int, one binary, two binary"), "permutation-index")
    return Index(table, chosen, longest, n, prefix)


class Block:
    """One block of the index, as a worker holds it; ``reranked`` and ``seen`` count vectors over queries."""

    def __init__(self, dim: int, batches: list[pa.RecordBatch]):
        self.files: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for pivot, one, two in zip(*(batch.column(c).to_pylist() for c in ("pivot", "one", "two")), strict=True):
                if pivot is not None:
                    self.files[pivot] = (np.frombuffer(one, "<u4"), np.frombuffer(two, np.uint8))
                    continue
                self.vectors = np.frombuffer(one, "<f8").reshape(-1, dim)
                n = len(two) // 12
                ids, copy_of = np.frombuffer(two[: 8 * n], "<i8"), np.frombuffer(two[8 * n :], "<u4")
                order = np.argsort(copy_of, kind="stable")  # ids ascend within copies
                self.ids, self.starts = ids[order], np.searchsorted(copy_of[order], np.arange(len(self.vectors) + 1))
        self.reranked = self.seen = 0

    def nearest(self, query_id: int, q: np.ndarray, order: np.ndarray, k: int, prefix: int, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best that the files lead to."""
        n = len(self.vectors)
        amount = min(n, int(np.ceil(share * n)))
        distance = footrule(self.files, n, prefix, order)
        near = np.flatnonzero(distance <= np.partition(distance, amount - 1)[amount - 1])  # ties at the bar all come along
        score = (self.vectors[near] * q).sum(axis=1)
        self.reranked, self.seen = self.reranked + len(near), self.seen + n
        enough = min(len(near), k + 1)
        keep = np.flatnonzero(score >= -np.partition(-score, enough - 1)[enough - 1])
        a, b = self.starts[near[keep]], self.starts[near[keep] + 1]
        b = np.minimum(b, a + k + 1)  # k + 1 copies of a vector are all that can matter
        at = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange(int((b - a).sum()))
        ids, scores = self.ids[at], np.repeat(score[keep], b - a)
        other = ids != query_id
        ids, scores = ids[other], scores[other]
        first = np.lexsort((ids, -scores))[:k]
        return ids[first], scores[first]


def search(index: Index, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", query_prefix: int = QUERY_PREFIX, share: float = SHARE) -> DataFrame:
    """The k best rows that the index finds for each query; columns and cases as in ``nearest``."""
    pivots, longest, prefix = index.pivots, index.longest, index.prefix

    def load(dim: int, batches: list[pa.RecordBatch]) -> Block:
        return Block(dim, batches)

    def answer(block: Block, q_ids: np.ndarray, qs: np.ndarray):
        unit = np.column_stack([qs / np.linalg.norm(qs, axis=1, keepdims=True), np.zeros(len(qs))])
        found = [block.nearest(int(i), q, order, k, prefix, share) for i, q, order in zip(q_ids, qs, orders(unit, pivots[qs.shape[1]], query_prefix), strict=True)]
        return np.repeat(q_ids, [len(x) for x, _ in found]), np.concatenate([x for x, _ in found]), np.concatenate([s for _, s in found])

    q = usable(queries, id_col, vector_col).where(F.col("dim").isin(*longest) if longest else F.lit(False))
    parts = visited(index.table, q, queries.count(), index.blocks, load, answer, "query_id long, vec_id long, score double")
    return ranked(parts, k, F.desc("score"))


def nearest(queries: DataFrame, rows: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, prefix: int = PREFIX, query_prefix: int = QUERY_PREFIX, share: float = SHARE) -> DataFrame:
    """About the k rows with the largest inner product with each query.

    Result: query_id, rank (from 1), vec_id, score (the exact product in doubles);
    ties go to the smaller id.

    Cases: a row whose id is null, or whose vector is null, empty, zero, or holds
    a null or non-finite component, takes no part.  Only vectors of one length
    are compared (each length has pivots of its own).  Of rows with one id and
    length the least vector counts.  A query's own id is no candidate.  Copies of
    a vector stand once in a block and come out by id.  Other columns are not
    read, whatever their names; empty tables give no rows.
    """
    return search(build(rows, id_col, vector_col, pivots, prefix), queries, k, id_col, vector_col, query_prefix, share)


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return nearest(rows.where(F.col("vec_id") % 20 == 0), rows)
