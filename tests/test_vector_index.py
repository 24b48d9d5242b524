"""The vector index: recall against all pairs, how much of the table is scored, and growth by new vectors only."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from juriscope.operators import vector_index
from juriscope.operators.vector_index import Planes


def test_recall_and_share_scored(spark, tmp_path):
    e, path, planes = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), str(tmp_path / "index"), Planes()
    assert vector_index.extend(spark, path, e, planes) == e.count()
    asked = e.where("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    got = {}
    for r in vector_index.nearest_by_index(spark, path, asked, e, 10, planes).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    rows = e.orderBy("vec_id").collect()
    ids, v = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    for q, found in got.items():
        score = v @ v[np.searchsorted(ids, q)]
        best = ids[np.lexsort((ids, -score))[:10]]
        hits += len({i for _, i, _ in found} & set(best.tolist()))
        assert sorted(found) == sorted(found, key=lambda x: (-round(x[2], 9), x[1])) and found[0][1] == q
        assert all(s == pytest.approx(score[np.searchsorted(ids, i)]) for _, i, s in found)
    assert len(got) == 200 and hits / 2000 >= 0.93
    usable = vector_index.usable(e, "embedding", 64).select(vector_index.digest(F.col("vector")).alias("digest"))
    scored = vector_index.candidates(spark, path, asked.withColumn("vector", F.col("vector").cast("array<double>")), usable, planes, 3, 160).groupBy("query_id").count()
    assert scored.agg(F.avg("count")).first()[0] < 0.1 * len(ids)


def test_only_new_vectors_are_added(spark, tmp_path):
    path, planes = str(tmp_path / "index"), Planes(dims=3, tables=8, bits=2, words=1)
    rows = [(1, [1.0, 0.0, 0.1]), (2, [0.0, 1.0, 0.0]), (3, [1.0, 0.0, 0.1]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [1.0, float("nan"), 0.0]), (7, [1.0, 2.0]), (8, [1.0, None, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert vector_index.extend(spark, path, df, planes) == 2
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = files()
    assert vector_index.extend(spark, path, df, planes) == 0
    more = df.where("vec_id <> 2").unionByName(spark.createDataFrame([(9, [1.0, 0.1, 0.1])], df.schema))
    assert vector_index.extend(spark, path, more, planes) == 1 and before <= files()
    asked = spark.createDataFrame([(0, [1.0, 0.0, 0.1]), (1, None), (2, [0.0, 0.0, 0.0])], "query_id long, vector array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in vector_index.nearest_by_index(spark, path, asked, more, 3, planes).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 3), (0, 3, 9)]  # vector 2 is in the index, and no longer an article
    assert [r["vec_id"] for r in vector_index.nearest_by_index(spark, path, asked, more, 1, planes).collect()] == [1]
    with pytest.raises(ValueError, match="other planes"):
        vector_index.extend(spark, path, df, Planes(dims=3))


def test_many_copies_of_a_vector(spark, tmp_path):
    path, planes = str(tmp_path / "index"), Planes(dims=2, tables=4, bits=2, words=1)
    df = spark.range(5000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 > 0, F.array(F.lit(1.0), F.lit(0.5))).otherwise(F.array(F.lit(0.0), F.col("id") + 1.0)).alias("embedding"))
    vector_index.extend(spark, path, df, planes)
    asked = spark.createDataFrame([(0, [1.0, 0.5])], "query_id long, vector array<double>")
    assert [r["vec_id"] for r in vector_index.nearest_by_index(spark, path, asked, df, 5, planes).orderBy("rank").collect()] == [1, 2, 4, 5, 7]
