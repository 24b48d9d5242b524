"""The graph in buckets: what a merge touches, what it counts, and what a merge that dies leaves."""

import os

import pytest
from pyspark.sql import functions as F

from juriscope.operators import graph
from juriscope.plans import ingestion
from juriscope.sources import graph_store


def tables(spark, laws, content):
    rows = [(law, i, f"{content} {i}", i) for law, n in laws.items() for i in range(n)]
    nodes = spark.createDataFrame([(x, x, "title", "En vigueur") for x in laws], "id string, title string, promulgated string, status string")
    arts = spark.createDataFrame(rows, "law_number string, index string, content string, article_no long")
    arts = graph.article_nodes(arts)
    return {"laws": nodes, "articles": arts, "edges": graph.edges(arts, nodes)}


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def contents(spark, folder):
    return {r["id"]: r["content"] for r in graph_store.read_graph(spark, folder, "articles").collect()}


def test_a_merge_touches_its_buckets_alone(spark, tmp_path):
    folder = str(tmp_path / "graph")
    laws = {f"2020 - {i}": 3 for i in range(40)}
    first = graph_store.merge(spark, folder, tables(spark, laws, "old"), buckets=16)
    assert first.created == {"laws": 40, "articles": 120, "edges": 120} and set(first.replaced.values()) == {0}
    before, places = files(folder), graph_store.manifest(spark, folder)
    second = graph_store.merge(spark, folder, tables(spark, {"2020 - 7": 1, "new": 2}, "new"))
    assert second.created == {"laws": 2, "articles": 3, "edges": 3}
    assert second.replaced == {"laws": 1, "articles": 3, "edges": 3} and second.buckets <= 2
    after = files(folder)
    assert all(after[f] == t for f, t in before.items())
    moved = {b for b, p in graph_store.manifest(spark, folder)["articles"].items() if places["articles"].get(b) != p}
    assert len(moved) == second.buckets
    got = contents(spark, folder)
    assert len(got) == 117 + 3 and got["2020 - 7_ART_0"] == "new 0" and "2020 - 7_ART_1" not in got and got["2020 - 8_ART_1"] == "old 1"
    assert graph_store.read_graph(spark, folder, "edges").count() == 120


def test_a_merge_that_dies_leaves_the_graph(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "graph")
    graph_store.merge(spark, folder, tables(spark, {"a": 2, "b": 2}, "old"), buckets=4)

    def dies(*args):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(graph_store, "switched", dies)
        with pytest.raises(RuntimeError):
            graph_store.merge(spark, folder, tables(spark, {"a": 1}, "new"))
    assert contents(spark, folder) == {"a_ART_0": "old 0", "a_ART_1": "old 1", "b_ART_0": "old 0", "b_ART_1": "old 1"}
    twice = tables(spark, {"a": 1}, "new")
    twice["articles"] = twice["articles"].unionByName(twice["articles"])
    with pytest.raises(ValueError, match="more than once"):
        graph_store.merge(spark, folder, twice)
    assert len(contents(spark, folder)) == 4
    graph_store.merge(spark, folder, tables(spark, {"a": 1}, "new"))
    assert contents(spark, folder) == {"a_ART_0": "new 0", "b_ART_0": "old 0", "b_ART_1": "old 1"}


def test_empty_buckets_reload_and_clearing(spark, tmp_path):
    folder = str(tmp_path / "graph")
    assert graph_store.read_graph(spark, folder, "laws") is None and graph_store.cleared(spark, folder) == 0
    graph_store.merge(spark, folder, tables(spark, {"a": 2, "b": 2}, "old"), buckets=4)
    got = graph_store.merge(spark, folder, tables(spark, {"a": 0}, "new"))
    assert got.replaced == {"laws": 1, "articles": 2, "edges": 2} and set(contents(spark, folder)) == {"b_ART_0", "b_ART_1"}
    got = graph_store.merge(spark, folder, tables(spark, {"c": 1}, "new"), reload=True)
    assert got.replaced == {"laws": 2, "articles": 2, "edges": 2} and contents(spark, folder) == {"c_ART_0": "new 0"}
    none = {n: t.limit(0) for n, t in tables(spark, {"c": 1}, "x").items()}
    assert graph_store.merge(spark, folder, none).buckets == 0 and contents(spark, folder) == {"c_ART_0": "new 0"}
    assert graph_store.cleared(spark, folder) == 2 and graph_store.read_graph(spark, folder, "articles") is None


def test_first_vector_counts_and_articles_without_one_are_told(spark):
    people = "array<struct<name:string,role:string>>"
    laws = spark.createDataFrame([("x.json", ("7", "o", "2020-01-02", "", []), [("1", "one"), ("2", "two"), ("3", " "), ("1", "again")])], f"file string, metadata struct<lawNumber:string,lawObject:string,lawDate:string,source:string,signatories:{people}>, articles array<struct<index:string,content:string>>")
    found = spark.createDataFrame([("x_vectors.json", [("1", [1.0]), ("1", [9.0]), ("2", None)])], "file string, articles array<struct<index:string,vector:array<double>>>")
    made, lacking = ingestion.graph_tables(laws, found.repartition(2))
    assert [(r["id"], r["content"], r["embedding"]) for r in made["articles"].collect()] == [("7_ART_1", "again", [1.0])]
    assert [tuple(r) for r in lacking.collect()] == [("7", "2", "x.json")]
    assert made["edges"].count() == 1 and made["laws"].select(F.col("promulgated").cast("string")).first()[0] == "2020-01-02"
