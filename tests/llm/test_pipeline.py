import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from juriscope.llm.stages import staged


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf), name)
        assert docs.columns == columns and docs.count() > 0.5 * before
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert out.where("not round_trip").count() == 0 and out.count() == docs.count()


LONG = "lorem ipsum dolor " * 60_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, base array<int>, found string, size string, ids string"
ROWS = [
    (1, "one two three four five six seven", "a", "s1"),
    (1, "one two three four five six seven", "a", "s1"),
    (2, "One, two three four five six seven!", "a", "s2"),
    (3, None, None, None),
    (4, "", None, "s1"),
    (None, "no id at all", "b", "s2"),
    (None, None, None, None),
    (5, "x password=abcdefghijklmnop y", "b", None),
    (6, LONG, "b", "s3"),
    (7, "\x1c \u3000 \n", "b", "s3"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), f"score {i}", [7], "f", "big", "i") for i, t, lang, s in ROWS], SCHEMA)


def of(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, sf, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, sf)
    rows = [r.asDict() for r in staged(out, "odd").collect()]
    ids = sorted((r["doc_id"] for r in rows), key=str)
    if name == "bpe":
        assert len(rows) == len(ROWS) and all(r["round_trip"] for r in rows) and {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4)} == {0}
        assert "text" not in out.columns and {r["score"] for r in rows if r["doc_id"] == 5} == {"score 5"}
    else:
        assert out.columns == odd.columns
        assert all((r["score"], r["base"], r["found"], r["size"], r["ids"]) == (f"score {r['doc_id']}", [7], "f", "big", "i") for r in rows)
    if name == "toxicity":
        assert set(of(out)) <= set(of(odd)) and ids.count(1) in (0, 2)
    if name == "near-dedup":
        assert ids == sorted([1, 3, 4, 5, 6, 7, None, None], key=str)
    if name == "secrets":
        assert [r["text"] for r in rows if r["doc_id"] == 5] == ["x [SECRET] y"] and len(rows) == len(ROWS)
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
    if name == "mixing":
        assert {3, 4, None} <= set(ids) and len({r["text"] for r in rows} - {t for _, t, *_ in ROWS}) == 0
        assert of(out) == of(stage(spark, odd.repartition(3), sf))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, sf, odd, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, odd.limit(0), sf).collect() == []


def test_stages_agree_with_plain_python(spark, sf):
    """The pipeline's decisions on the smallest documents, each against a brute-force version of its stage."""
    from test_text import brute_classes, python_secrets

    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 300")
    stages = dict(corpus_pipeline.STAGES)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    classes, _ = brute_classes(rows)
    assert sorted(r["doc_id"] for r in stages["near-dedup"](spark, docs, sf).collect()) == sorted(set(classes.values()))
    for r in stages["secrets"](spark, docs, sf).collect():
        text = dict(rows)[r["doc_id"]] or ""
        spans = sorted(tuple(map(int, x.split(":")[1:])) for x in python_secrets(text)[1].split(",") if x)
        want, at = "", 0
        for s, e in spans:
            if s >= at:
                want += text[at:s] + "[SECRET]"
            at = max(at, e)
        assert r["text"] == want + text[at:]
    from juriscope.llm import mixing, toxicity

    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mix(docs).collect()}
    times = {}
    for r in stages["mixing"](spark, docs, sf).collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert times == {i: n for i, (t, size) in taken.items() if (n := int(t / size + 0.5) if size else 1)}
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    want = {r["doc_id"] for r in toxicity.score(docs, model).where(F.col("score") < toxicity.CUT).collect()}
    assert {r["doc_id"] for r in stages["toxicity"](spark, docs, sf).collect()} == want


def test_entry_lists_all():
    names = __spark_entry__.queries()
    assert {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
