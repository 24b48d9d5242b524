import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from juriscope.llm import permutation, topk
from juriscope.llm.permutation import Block, build, nearest, op2_permutation_index, search
from juriscope.llm.topk import Lists, op1_topk, top_k

SCHEMA = "vec_id long, embedding array<float>, score string, rank string, block string, id int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "y", "z", 0) for i, v in vectors], SCHEMA)


def vectors_in(spark, folder):
    rows = sorted(spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect())
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)


def brute(q_ids, qs, ids, vs, k):
    out = []
    for i, q in zip(q_ids, qs, strict=True):
        score = vs @ q
        order = sorted((-s, j) for s, j in zip(score.tolist(), ids.tolist(), strict=True) if j != i)[:k]
        out.append([(j, -s) for s, j in order])
    return out


def pairs(got_ids, got):
    return [[(int(a), int(b)) for a, b in zip(x, y, strict=True)] for x, y in zip(got_ids, got, strict=True)]


def test_bounds_give_the_exact_best():
    rng = np.random.default_rng(3)
    for scale, spread in ((16, 6), (4, 1), (1 << 20, 1 << 19), (1 << 40, 1 << 39)):
        vs = np.floor(rng.normal(size=(9000, 12)) * spread) if scale < 1 << 30 else np.floor(rng.normal(size=(900, 6)) * spread)
        ids = np.arange(len(vs)) * 3
        exact = np.array([[int(x) for x in r] for r in vs], object)
        lists = Lists(ids, vs)
        for part in (slice(0, None, 180), slice(1, None, 170)):
            assert pairs(*lists.search(vs[part], ids[part], 10)) == [[(a, int(b)) for a, b in r] for r in brute(ids[part], exact[part], ids, exact, 10)]


def test_bounds_hold_at_every_depth():
    rng = np.random.default_rng(6)
    block, q = np.floor(rng.normal(size=(300, 8)) * 9), np.floor(rng.normal(size=(5, 8)) * 9)
    lists, score = np.sort(block, axis=0), q @ block.T
    for depth in (1, 30, 150, 299):
        upper, alive = Lists.bounded(np.maximum(q, 0), np.minimum(q, 0), block, lists, depth, np.full(5, -np.inf), np.zeros((5, 300), bool), 7, False)
        assert (upper >= score).all()
        assert all(alive[i, np.argsort(-score[i], kind="stable")[:7]].all() for i in range(5))


def test_reading_stops_before_the_end(spark):
    """On driver vectors, which point every way, lists must be read far, yet most queries stop before the end."""
    ids, vs = vectors_in(spark, "/root/testdata/sf0.1")
    whole = np.floor(vs * 64)
    lists, which = Lists(ids, whole), np.flatnonzero(ids % 20 == 0)
    got = pairs(*lists.search(whole[which], ids[which], 20))
    assert got == [[(a, int(b)) for a, b in r] for r in brute(ids[which], whole[which], ids, whole, 20)]
    assert lists.stopped > 0.5 * lists.reads


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = table(spark, [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.0, 0.0]), (6, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [3.0, 2.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (9, []), (10, [])])
    query = rows.where("vec_id = 0")
    assert [tuple(r) for r in top_k(query, rows).orderBy("rank").collect()] == [(0, 1, 6, 64 * 64 + 128 * 128), (0, 2, 7, 20480), (0, 3, 5, 0)]
    assert [tuple(r) for r in nearest(query, rows).orderBy("rank").collect()] == [(0, 1, 6, 5.0), (0, 2, 7, 5.0)]
    assert [tuple(r) for r in top_k(rows.where("vec_id = 9"), rows).collect()] == [(9, 1, 10, 0)]
    empty = rows.limit(0)
    assert top_k(empty, empty).collect() == nearest(empty, empty).collect() == nearest(query, empty).collect() == nearest(empty, rows).collect() == []


def test_components_and_scores_beyond_a_long(spark):
    rows = spark.createDataFrame([(0, [1e18, -1.0]), (1, [3e17, 0.3]), (2, [-5e18, 0.0]), (3, [1e-3, -1e-3]), (4, [1e308, 0.0])], "vec_id long, embedding array<double>")
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows.collect() if i != 4}  # 64e308 is not finite
    want = sorted(((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(whole[0], v, strict=True)))), i) for i, v in whole.items() if i))
    assert [(r["vec_id"], r["score"]) for r in top_k(rows.where("vec_id = 0"), rows).orderBy("rank").collect()] == [(i, -s) for s, i in want]


def test_copies_do_not_crowd_out(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 8))
    rows = table(spark, [(i, [1.0] * 8) for i in range(400)] + [(1000 + i, [float(x) for x in v]) for i, v in enumerate(vectors)])
    got = nearest(rows.where("vec_id = 1000"), rows, k=5).orderBy("rank").collect()
    ids = np.array([*range(400), *range(1000, 1300)])
    all_vectors = np.concatenate([np.ones((400, 8)), vectors.astype(np.float32).astype(float)])
    want = brute([1000], [all_vectors[400]], ids, all_vectors, 5)[0]
    assert len({r["vec_id"] for r in got} & {a for a, _ in want}) >= 4


def test_blocks_and_splits_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = table(spark, [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(700, 6)))])
    want = top_k(rows.where("vec_id % 3 = 0"), rows, 4).collect()
    monkeypatch.setattr(topk, "BLOCK_ROWS", 90)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    assert sorted(top_k(rows.where("vec_id % 3 = 0"), rows, 4).collect()) == sorted(want)


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_recall_where_a_fifth_at_most_is_reranked(spark, scale):
    ids, vs = vectors_in(spark, f"/root/testdata/sf{scale}")
    which = np.flatnonzero(ids % 20 == 0)
    want = brute(ids[which], vs[which], ids, vs, 20)
    found = {}
    for r in op2_permutation_index(spark, f"/root/testdata/sf{scale}").collect():
        found.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    recall = np.mean([len(found[int(i)].keys() & {a for a, _ in w}) / 20 for i, w in zip(ids[which], want, strict=True)])
    assert recall >= 0.9 and all(len(x) == 20 for x in found.values())
    assert all(abs(s - vs[ids == j][0] @ vs[ids == i][0]) < 1e-12 for i, x in list(found.items())[:5] for j, s in x.items())


def test_recall_where_pivots_are_few(spark):
    """A full block, made with the mean and covariance of the table: one pivot for 32 rows, which the tables themselves are too small for."""
    _, vs = vectors_in(spark, "/root/testdata/sf0.1")
    made = np.random.default_rng(5).multivariate_normal(vs.mean(axis=0), np.cov(vs.T), permutation.BLOCK_ROWS).astype(np.float32)
    ids = np.arange(len(made))
    rows = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": list(made)}))
    index = build(rows)
    assert index.blocks == 1 and len(index.pivots[64]) * 32 <= len(made)
    which = np.flatnonzero(ids % 100 == 0)
    want = brute(ids[which], made[which].astype(float), ids, made.astype(float), 20)
    found = {}
    for r in search(index, rows.where("vec_id % 100 = 0"), 20).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = np.mean([len(found[int(i)] & {a for a, _ in w}) / 20 for i, w in zip(ids[which], want, strict=True)])
    assert recall >= 0.93, recall


def test_an_index_is_reranked_in_part_and_serves_many_query_sets(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    index = build(rows)
    assert index.blocks == 1
    files = index.table.orderBy("seq").drop("dim", "block").collect()
    block = Block(64, [pa.RecordBatch.from_pylist([r.asDict() for r in files])])
    ids, vs = vectors_in(spark, folder)
    orders = permutation.orders(np.column_stack([vs[::50], np.zeros(len(vs[::50]))]), index.pivots[64], permutation.QUERY_PREFIX)
    for i, q, order in zip(ids[::50], vs[::50], orders, strict=True):
        block.nearest(int(i), q, order, 20, index.prefix, permutation.SHARE)
    assert block.reranked < 0.2 * block.seen
    one, other = search(index, rows.where("vec_id % 40 = 0")), search(index, rows.where("vec_id % 20 = 0"))
    both = {tuple(r) for r in other.collect()}
    assert {tuple(r) for r in one.collect()} <= both


def test_every_query_is_answered(spark, sf):
    n = spark.read.parquet(f"{sf}/embeddings.parquet").where("vec_id % 20 = 0").count()
    assert op1_topk(spark, sf).groupBy("query_id").agg(F.max("rank").alias("r")).where("r = 20").count() == n
