"""Centroid clustering by kd-tree filtering, exact in integers.

The vectors of a partition are laid out in blocks, and a kd-tree is built over
each block once: a node holds the count of its vectors, their sum and their
box, as integers.  Blocks and trees are a written table.  In a round each block
is filtered with the centroids: at a node the candidate nearest to the middle of
its box is compared with every other; one that is farther from every point of
the box is strictly dominated and pruned.  A node with one candidate left is
assigned whole, by its count and sum; at a leaf the vectors are compared with
the candidates that are left.  Only counts and sums leave a block, a row for
each of its clusters, and Spark adds them up.

Distances are sums of squares of integers.  They are computed in double
precision where no step can leave the integers that doubles hold, and in 64-bit
integers elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .stages import arrow_map, read_table, staged

#: Vectors of a block, and of a leaf, at most.
BLOCK, LEAF = 4096, 16
#: Components may lie between -LARGEST and LARGEST, so that squared distances in up to 2**12 dimensions fit in 64 bits.
LARGEST = 1 << 24
DIMS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, 2
TREE = "ids binary, no_id binary, vectors binary, first binary, last binary, child binary"


class Tree:
    """A kd-tree over vectors (n x d, int64), which it puts in order; node i holds vectors first[i] to last[i], and its children are child[i] and child[i] + 1 (0: a leaf)."""

    def __init__(self, vectors: np.ndarray, first: np.ndarray, last: np.ndarray, child: np.ndarray):
        self.vectors, self.first, self.last, self.child = vectors, first, last, child
        sums = np.concatenate([np.zeros((1, vectors.shape[1]), np.int64), np.cumsum(vectors, axis=0)])
        self.count, self.sum = last - first, sums[last] - sums[first]
        self.low, self.high = np.zeros_like(self.sum), np.zeros_like(self.sum)
        for i in range(len(child) - 1, -1, -1):  # children come after their node
            if child[i]:
                both = slice(child[i], child[i] + 2)
                self.low[i], self.high[i] = self.low[both].min(axis=0), self.high[both].max(axis=0)
            else:
                own = vectors[first[i] : last[i]]
                self.low[i], self.high[i] = own.min(axis=0), own.max(axis=0)


def grown(vectors: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the vectors, and first, last and child of the nodes: each node is halved along its widest side, unless all its vectors are one."""
    order = np.arange(len(vectors))
    first, last, child = [0], [len(vectors)], [0]
    at = 0
    while at < len(first):
        a, b = first[at], last[at]
        own = vectors[order[a:b]]
        wide = own.max(axis=0) - own.min(axis=0)
        side = int(wide.argmax())
        if b - a > leaf and wide[side]:
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, side], half)]
            child[at] = len(first)
            first += [a, a + half]
            last += [a + half, b]
            child += [0, 0]
        at += 1
    return order, np.array(first, np.int64), np.array(last, np.int64), np.array(child, np.int64)


def number(vectors: np.ndarray, centroids: np.ndarray) -> type:
    """double if all sums of products below are integers that doubles hold, else 64-bit integers."""
    most = max([int(np.abs(x).max()) for x in (vectors, centroids) if x.size] or [0])
    return np.float64 if vectors.shape[1] * (4 * most) ** 2 < 1 << 52 else np.int64


class Filter:
    """A tree and centroids (k x d, int64), and where the vectors belong."""

    def __init__(self, tree: Tree, centroids: np.ndarray):
        self.tree, self.centroids = tree, centroids
        self.kind = number(tree.vectors, centroids)
        self.z = centroids.astype(self.kind)
        self.norm = (self.z * self.z).sum(axis=1)
        self.compared = 0

    def nearest(self, points: np.ndarray, among: np.ndarray, scale: int = 1) -> np.ndarray:
        """The nearest centroid among candidates (n x k) to each of points / scale; ties go to the smaller number."""
        far = scale * self.norm - 2 * (points.astype(self.kind) @ self.z.T)
        worst = np.inf if self.kind is np.float64 else np.iinfo(np.int64).max
        return np.where(among, far, worst).argmin(axis=1)

    def run(self) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Nodes that go whole to one cluster ("node"), and vectors of leaves ("leaf"), with the cluster of each."""
        t, k = self.tree, len(self.centroids)
        nodes, among = np.zeros(1, np.int64), np.ones((1, k), bool)
        while len(nodes):
            low, high = t.low[nodes].astype(self.kind), t.high[nodes].astype(self.kind)
            best = self.nearest(t.low[nodes] + t.high[nodes], among, 2)
            for c in np.unique(best):
                own = np.flatnonzero(best == c)
                way = self.z - self.z[c]  # where a box reaches farthest towards each other candidate
                gain = 2 * (high[own] @ np.maximum(way, 0).T + low[own] @ np.minimum(way, 0).T) - (self.norm - self.norm[c])
                among[own] &= (gain >= 0) | (np.arange(k) == c)  # else c is nearer to every point of the box
            point = (t.low[nodes] == t.high[nodes]).all(axis=1)  # all vectors are one, and the middle of the box
            whole = point | (among.sum(axis=1) == 1)
            yield "node", nodes[whole], best[whole]
            leaf = ~whole & (t.child[nodes] == 0)
            if leaf.any():
                size = t.count[nodes[leaf]]
                rows = np.repeat(t.first[nodes[leaf]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                self.compared += len(rows)
                yield "leaf", rows, self.nearest(t.vectors[rows], np.repeat(among[leaf], size, axis=0))
            inner = ~whole & ~leaf
            nodes, among = np.stack([t.child[nodes[inner]], t.child[nodes[inner]] + 1], 1).ravel(), np.repeat(among[inner], 2, axis=0)

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """Count and sum of each cluster."""
        t, k = self.tree, len(self.centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, t.vectors.shape[1]), np.int64)
        for what, at, cluster in self.run():
            np.add.at(count, cluster, t.count[at] if what == "node" else 1)
            np.add.at(total, cluster, t.sum[at] if what == "node" else t.vectors[at])
        return count, total

    def assigned(self) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance of each vector, in the tree's order."""
        t = self.tree
        out = np.zeros(len(t.vectors), np.int64)
        for what, at, cluster in self.run():
            if what == "leaf":
                out[at] = cluster
            else:
                size = t.count[at]
                out[np.repeat(t.first[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.repeat(cluster, size)
        away = t.vectors - self.centroids[out]
        return out, (away * away).sum(axis=1)


def whole_vectors(rows: DataFrame, dims: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id and vector (doubles) of rows whose vector has ``dims`` components, all finite."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size(vector_col) == dims) & finite).select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))


def integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x * scale).cast("long"))


def starts(vectors: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The vectors of least sha256 of ``seed:id``, in ascending order of it (k rows); rows without an id come last, ties go by the vector."""
    order = [F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last(), "v"]
    rows = vectors.select("id", integers(F.col("vector"), scale).alias("v")).orderBy(*order).limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def blocks_of(vectors: DataFrame, dims: int, scale: int, block: int = BLOCK) -> DataFrame:
    """Blocks of the vectors of each partition, in tree order, with the nodes of their trees."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def made() -> pa.RecordBatch:
            ids, v = pa.concat_arrays([x for x, _ in held]), np.concatenate([x for _, x in held])
            order, first, last, child = grown(v)
            names = ids.take(pa.array(order))
            columns = (names.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"), names.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), v[order].astype("<i4"), first.astype("<i4"), last.astype("<i4"), child.astype("<i4"))
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in columns], names=[c.split()[0] for c in TREE.split(", ")])

        for batch in batches:
            flat = np.floor(scale * batch.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(-1, dims)
            if flat.size and np.abs(flat).max() > LARGEST:
                raise ValueError(f"components times {scale} may lie between -{LARGEST} and {LARGEST}")
            at = 0
            while at < len(flat):
                to = min(len(flat), at + block - size)
                held.append((batch.column(0).slice(at, to - at), flat[at:to].astype(np.int64)))
                size, at = size + to - at, to
                if size == block:
                    yield made()
                    held, size = [], 0
        if held:
            yield made()

    return arrow_map(vectors.select("id", "vector"), work, TREE)


def trees(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, Tree]]:
    """Ids and tree of each block of a batch."""
    for r in batch.to_pylist():
        ids = pa.array(np.frombuffer(r["ids"], "<i8"), mask=np.frombuffer(r["no_id"], np.uint8).astype(bool))
        first, last, child = (np.frombuffer(r[c], "<i4").astype(np.int64) for c in ("first", "last", "child"))
        yield ids, Tree(np.frombuffer(r["vectors"], "<i4").reshape(-1, dims).astype(np.int64), first, last, child)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: of each cluster the sum of its vectors by their count, rounded down; an empty one stays."""
    dims = centroids.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for _, tree in trees(batch, dims):
                n, s = Filter(tree, centroids).totals()
                count += n
                total += s
        at = np.repeat(np.flatnonzero(count), dims)
        place = np.tile(np.arange(dims), len(at) // dims)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(place), pa.array(count[at]), pa.array(total[at, place])], names=["cluster", "place", "n", "s"])

    told = arrow_map(blocks, work, "cluster long, place long, n long, s long").groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out = centroids.copy()
    for r in told.collect():  # a row for each component of each centroid
        out[r["cluster"], r["place"]] = r["s"] // r["n"]
    return out


def clustered(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Vectors with their cluster and squared distance (id, cluster, distance), and the centroids after the last round.

    Components are floor(scale * x).  Vectors of another length, or that are
    null or hold a null or non-finite component, take no part.  With fewer than
    k vectors each is a centroid; without any there are none and no rows.  Ties
    go to the centroid of the smaller number, equal centroids included.  Rows
    that repeat count as often as they come; rows without an id are clustered
    too, and are the last to be a first centroid.  Integers beyond LARGEST are an
    error, as sums would not fit.  Other columns are not read, whatever their names.
    """
    vectors = whole_vectors(rows, dims, id_col, vector_col)
    blocks = staged(blocks_of(vectors, dims, scale), "kd-trees")
    centroids = starts(vectors, k, seed, scale).reshape(-1, dims)
    for _ in range(rounds):
        if len(centroids):
            centroids = moved(blocks, centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, tree in trees(batch, dims):
                cluster, distance = Filter(tree, centroids).assigned()
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return arrow_map(blocks, work, "id long, cluster int, distance long"), centroids


def op11_kdtree_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustered(read_table(spark, sf_dir, "embeddings"))
    found = staged(found, "clusters")
    each = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # a row for each cluster
    names = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    told = each.join(F.broadcast(spark.createDataFrame(names, "cluster int, centroid_sha256 string")), "cluster")
    told = told.crossJoin(F.broadcast(each.agg(F.sum("cluster_inertia").alias("inertia"))))  # one row
    return found.withColumnRenamed("id", "vec_id").join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same rows in DuckDB's SQL, for ids that do not repeat: every vector with every centroid, round by round."""
    far = lambda v, c: f"list_sum(list_transform(range(1, {dims + 1}), lambda i: ({v}[i] - {c}[i]) * ({v}[i] - {c}[i])))"
    down = "(s - (((s % n) + n) % n)) // n"
    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS k, v AS c FROM (SELECT sha256(concat('{seed}:', CAST(vec_id AS VARCHAR))) AS h, v FROM v ORDER BY h LIMIT {k}))",
    ]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT vec_id, v, k, {far('v', 'c')} AS d FROM v, c{i}) GROUP BY vec_id)")
        if i < rounds:
            parts.append(f"m{i} AS (SELECT k, list({down} ORDER BY p) AS c FROM (SELECT k, p, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range(1, {dims + 1})) AS p FROM a{i}) GROUP BY k, p) GROUP BY k)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} ON m{i}.k = c{i}.k)")
    last = f"a{rounds}"
    return f"""WITH {", ".join(parts)} SELECT vec_id, k AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
 (SELECT sha256(array_to_string(c, ',')) FROM c{rounds} WHERE c{rounds}.k = {last}.k) AS centroid_sha256 FROM {last}"""


ORACLE = sql()
