"""Exact top-k search by no-random-access aggregation over sorted component lists.

Every dimension is a list of all candidates sorted by what they add to the
score.  The lists are only read in sequence, all to the same depth.  At a depth
every candidate has a lower bound (what was read, and the least possible for the
rest) and an upper bound (what was read, and the list's frontier for the rest).
Reading stops once no outsider's upper bound reaches the k-th lower bound; the
few that remain get their final scores.

Since all lists are read to one depth, "read so far" depends on the list and
its direction, not on the query: candidate v has been met in list j once
``v[j]`` is at or beyond the frontier ``t[j]``.  Both bounds of a whole batch of
queries are therefore matrix products over components clipped at the frontier.

Candidates lie in blocks of bounded size, which stay where they are; queries
visit them.  A block's lists are built once, in pieces of growing length, and a
query takes the k-th score that it has found in one piece as a lower bound for
the next.  How deep a round reads is learnt from the rounds before it: a depth
at which too few queries stop is not tried again in that block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stages import arrow_map, read_table

#: Rows of a block of candidates, on average; queries that are answered at once.
BLOCK_ROWS, QUERY_ROWS = 65536, 256
#: Rows of a block's first piece and of its longest; each piece is twice the one before.
FIRST_PIECE, LONGEST_PIECE = 256, 4096
#: Shares of the lists that rounds read; share of a piece that may remain for final scores; share of queries that must stop for a depth to be tried again.
DEPTHS, REMAINDER, WORTH = (0.5, 0.75, 0.875), 0.125, 0.25


def vectors_of(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, vector of doubles) of rows whose id is set and whose vector has finite components only; one row an id and length, the least vector."""
    v = F.col(vector_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    good = df.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).where(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", bad))
    return good.groupBy("id", F.size("vector").alias("dim")).agg(F.min("vector").alias("vector"))


def blocks_for(rows: int, block_rows: int) -> int:
    return max(1, -(-rows // block_rows))


def block_of(n_blocks: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")


def visited(blocks: DataFrame, queries: DataFrame, n_queries: int, n_blocks: int, load: Callable, answer: Callable, schema: str) -> DataFrame:
    """Each query with each block of its dimension, once.

    ``blocks``: (dim, block, and columns that ``load`` knows), in any order but for
    the column ``seq``, which orders the rows of a block.  ``load(dim, batches of
    a block's rows)`` makes of them what ``answer(loaded, ids, vectors)`` searches;
    that yields tuples of columns by ``schema``.  A task streams a block and then its
    queries, so it holds one block and one batch.  Where there are fewer blocks
    than cores, queries are split and a block is copied for each split, so that there
    are about as many copies in all as cores.
    """
    spark = queries.sparkSession
    splits = max(1, min(-(-spark.sparkContext.defaultParallelism // n_blocks), -(-n_queries // QUERY_ROWS)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    names = [c for c in blocks.columns if c not in ("dim", "block")]
    q = queries.select("dim", every(n_blocks).alias("block"), F.pmod(F.xxhash64("id", F.lit(7)), F.lit(splits)).cast("int").alias("split"), F.lit(1).alias("kind"), F.col("id").alias("q_id"), F.col("vector").alias("q_vector"))
    c = blocks.select("dim", "block", every(splits).alias("split"), F.lit(0).alias("kind"), *names)
    both = c.unionByName(q, allowMissingColumns=True)
    placed = both.repartition("dim", "block", "split").sortWithinPartitions("dim", "block", "split", "kind", "seq", "q_id")
    fields = schema.replace(" long", "").replace(" int", "").replace(" double", "").split(", ")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, held, loaded = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                dim, block, split, kind = (int(x) for x in keys[:, a])
                part = batch.slice(a, b - a)
                if (dim, block, split) != where:
                    where, held, loaded = (dim, block, split), [], None
                if kind == 0:
                    held.append(part.select(names))
                    continue
                if loaded is None:
                    if not held:  # no candidate of this length in the block
                        continue
                    loaded, held = load(dim, held), []
                for at in range(0, part.num_rows, QUERY_ROWS):
                    some = part.slice(at, QUERY_ROWS)
                    ids = some.column("q_id").to_numpy()
                    columns = answer(loaded, ids, matrix(some.column("q_vector"), dim))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=fields)

    return arrow_map(placed, work, schema)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def exact_type(q: np.ndarray, most: np.ndarray) -> type:
    """The fastest type in which no sum of products of whole numbers is rounded; ``most``: the largest components of the candidates."""
    total = float((np.abs(q).max(axis=0) * most).sum()) if len(q) else 0.0
    return np.float32 if total < 2**24 else np.float64 if total < 2**53 else object


def whole(x: np.ndarray, kind: type) -> np.ndarray:
    return np.array([[int(a) for a in row] for row in x], object).reshape(x.shape) if kind is object else x.astype(kind)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


class Lists:
    """A block's candidates in pieces, each with its sorted lists; and what was learnt of depths.

    ``stopped`` and ``reads`` count, over queries and pieces, where reading ended: before the end of the lists, and in all.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.most = np.abs(vectors).max(axis=0) if len(vectors) else np.zeros(vectors.shape[1])
        self.pieces: dict[type, list] = {}
        self.tried = np.zeros((2, len(DEPTHS)))
        self.useful = np.zeros((2, len(DEPTHS)))
        self.stopped = self.reads = 0

    def cut(self, kind: type) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, components, components of each list in ascending order) of the pieces."""
        if kind not in self.pieces:
            made, at, size = [], 0, FIRST_PIECE
            while at < len(self.ids):
                block = whole(self.vectors[at : at + size], kind)
                made.append((self.ids[at : at + size], block, np.sort(block, axis=0)))
                at, size = at + size, min(2 * size, LONGEST_PIECE)
            self.pieces = {kind: made}
        return self.pieces[kind]

    def search(self, q: np.ndarray, q_ids: np.ndarray, k: int) -> tuple[list, list]:
        """The k best (ids, scores) of each query, whole numbers given as doubles."""
        kind = exact_type(q, self.most)
        q = whole(q, kind)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        found_ids = [np.zeros(0, np.int64)] * len(q)
        found = [np.zeros(0, kind)] * len(q)
        floor = np.full(len(q), -float("inf"), object if kind is object else np.float64)
        for ids, block, lists in self.cut(kind):
            n = len(block)
            mine = ids[None, :] == q_ids[:, None]
            active = np.arange(len(q))
            for number, depth in enumerate([*(int(n * share) for share in DEPTHS), n]):
                known = np.array([len(found[i]) == k for i in active], bool)
                group = int(known.all()) if len(active) else 1
                if not len(active):
                    break
                if depth < n:
                    tried = self.tried[group, number]
                    if depth == 0 or (tried and self.useful[group, number] < WORTH * tried):
                        continue
                    upper, alive = self.bounded(up[active], down[active], block, lists, depth, floor[active], mine[active], k, bool(group))
                    few = alive.sum(axis=1) <= max(REMAINDER * n, k)
                    self.tried[group, number] += len(active)
                    self.useful[group, number] += few.sum()
                    self.stopped += int(few.sum())
                else:  # every list is read: both bounds are the score
                    upper = q[active] @ block.T
                    alive = (upper >= floor[active][:, None]) & ~mine[active]
                    few = np.ones(len(active), bool)
                for row in np.flatnonzero(few):  # no outsider qualifies: final scores of the rest
                    some = np.flatnonzero(alive[row])
                    if not len(some):
                        continue
                    i = active[row]
                    score = upper[row, some] if depth == n else block[some] @ q[i]
                    got_ids, got = np.concatenate([found_ids[i], ids[some]]), np.concatenate([found[i], score])
                    keep = best(got, got_ids, k)
                    found_ids[i], found[i] = got_ids[keep], got[keep]
                    if len(keep) == k:
                        floor[i] = found[i][-1]
                active = active[~few]
            self.reads += len(q)
        return found_ids, found

    @staticmethod
    def bounded(up, down, block, lists, depth: int, floor, mine, k: int, known: bool) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds of all candidates at a depth, and which of them can still qualify."""
        n = len(block)
        top, bottom = lists[n - depth], lists[depth - 1]
        upper = up @ np.maximum(block, top).T + down @ np.minimum(block, bottom).T
        bar = floor
        if not known and n > k:  # lower bounds raise the bar only where fewer than k final scores are known
            lower = up @ np.where(block >= top, block, lists[0]).T + down @ np.where(block <= bottom, block, lists[-1]).T
            lower[mine] = -(1 << 200) if lower.dtype == object else -(2.0**62)
            bar = np.maximum(bar, np.sort(lower, axis=1)[:, n - k] if lower.dtype == object else np.partition(lower, n - k, axis=1)[:, n - k])
        return upper, (upper >= bar[:, None]) & ~mine


def ended(x) -> int:
    """A score as a long; beyond one, its end."""
    return max(-(1 << 63), min((1 << 63) - 1, int(x)))


def top_k(queries: DataFrame, rows: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: float | None = 64.0) -> DataFrame:
    """The k rows with the highest integer inner product with each query, exactly.

    ``scale``: a component x counts as floor(scale * x), in doubles; None: it is a whole number already.
    Result: query_id, rank (from 1), vec_id, score; ties go to the smaller id.

    Cases: a row whose id is null, or whose vector is null or holds a null or
    non-finite component (before or after scaling), takes no part.  Only vectors
    of one length are compared; empty ones score 0 with one another.  Of rows
    with one id and length the least vector counts.  A query's own id is no
    candidate.  With fewer than k candidates all are returned.  Scores beyond a
    long are held at its ends.  Other columns are not read, whatever their names;
    empty tables give no rows.
    """
    scaled = (lambda df: df.withColumn("v", F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * scale)).select(F.col(id_col).alias("id"), "v")) if scale else (lambda df: df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")))
    q, c = vectors_of(scaled(queries), "id", "v"), vectors_of(scaled(rows), "id", "v")
    n_blocks = blocks_for(rows.count(), BLOCK_ROWS)
    blocks = c.select("dim", block_of(n_blocks).alias("block"), F.col("id").alias("seq"), "vector")

    def load(dim: int, batches: list[pa.RecordBatch]) -> Lists:
        ids = np.concatenate([b.column("seq").to_numpy() for b in batches])
        return Lists(ids, np.floor(np.concatenate([matrix(b.column("vector"), dim) for b in batches])))

    def answer(lists: Lists, q_ids: np.ndarray, vectors: np.ndarray):
        found_ids, found = lists.search(np.floor(vectors), q_ids, k)
        scores = np.array([ended(x) for got in found for x in got], np.int64)
        return np.repeat(q_ids, [len(x) for x in found_ids]), np.concatenate([*found_ids, np.zeros(0, np.int64)]), scores

    parts = visited(blocks, q, queries.count(), n_blocks, load, answer, "query_id long, vec_id long, score long")
    return ranked(parts, k, F.desc("score"))


def ranked(parts: DataFrame, k: int, order) -> DataFrame:
    """The first k of each query, out of the first k of each block."""
    w = Window.partitionBy("query_id").orderBy(order, "vec_id")
    return parts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return top_k(rows.where(F.col("vec_id") % 20 == 0), rows)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
