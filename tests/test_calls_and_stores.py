"""Calls that fail, and results that are kept: answers, vectors of chunks, texts that OCR read."""

import os
import re
import uuid

import pandas as pd
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from juriscope.operators import edits, vectors
from juriscope.plans import extraction
from juriscope.sources import adapters, calls, ocr_cache
from juriscope.sources.vector_store import VectorStore


def tools():
    """Functions that travel to workers by value, as these cannot import this file."""

    def asked_in(folder):
        """How often each name was written down."""
        out = {}
        for f in os.listdir(folder):
            name = f.rsplit(".", 1)[0]
            out[name] = out.get(name, 0) + 1
        return out

    def noted(folder, name):
        open(os.path.join(folder, f"{name}.{uuid.uuid4().hex}"), "w").close()

    def word_grammar(frames):
        """Finds fault with "ei" in words, and with whole words that hold it: edits that meet."""
        for f in frames:
            rows = []
            for k, t in zip(f["key"], f["text"], strict=True):
                for m in re.finditer(r"\w*ei\w*", t):
                    rows.append((k, m.start(), m.end(), [m[0].replace("ei", "ie"), "second"]))
                    rows.append((k, m.start(), m.end() + 4, ["too wide"]))
                    rows.append((k, m.end() - 2, m.end(), ["xx"]))
                    rows.append((k, m.start(), m.end(), []))
                rows.append((k, len(t) - 2, len(t) + 3, ["outside"]))
            yield pd.DataFrame(rows, columns=["key", "start", "stop", "suggestions"])

    return asked_in, noted, word_grammar


asked_in, noted, word_grammar = tools()


def answers(df):
    return {r["file"]: r["answer"] for r in df.collect()}


def test_answers_are_asked_for_once(spark, tmp_path):
    def shout(frames):
        for f in frames:
            yield f.assign(answer=[t.upper() for t in f["text"]])[["file", "answer"]]

    def other(frames):
        for f in frames:
            yield f.assign(answer="?")[["file", "answer"]]

    docs = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", " "), ("a", "x")], "file string, text string")
    cache = str(tmp_path / "cache")
    found, failed, told = calls.ask_all(docs, shout, cache)
    assert answers(found) == {"a": "X", "b": "Y"} and (told.answered, told.failed) == (2, 1)
    assert [tuple(r) for r in failed.collect()] == [("c", "no answer")]
    assert answers(calls.ask_all(docs, other, cache)[0]) == {"a": "X", "b": "Y", "c": "?"}
    assert answers(calls.ask_all(docs, other, cache, force=True)[0]) == {"a": "?", "b": "?", "c": "?"}
    assert calls.ask_all(docs.limit(0), other, str(tmp_path / "none"))[0].collect() == []


def test_one_failing_call_keeps_no_other_back(spark, tmp_path):
    folder = str(tmp_path / "asked")
    os.makedirs(folder)

    def ask(frames):
        for f in frames:
            for name in f["file"]:
                noted(folder, name)
            if "bad" in set(f["file"]):
                raise TimeoutError("no line")
            if "shaky" in set(f["file"]) and asked_in(folder)["shaky"] < 3:
                raise ConnectionError("again")
            yield f.assign(answer=['{"usage": {"prompt_tokens": 2, "completion_tokens": 1, "total_tokens": 3}}'] * len(f))[["file", "answer"]]

    docs = spark.createDataFrame([(x, "t") for x in ("a", "b", "bad", "c", "shaky")], "file string, text string").coalesce(1)
    found, failed, told = calls.ask_all(docs, ask, str(tmp_path / "cache"), retries=2, pause=0.0)
    assert set(answers(found)) == {"a", "b", "c", "shaky"}
    assert [tuple(r) for r in failed.collect()] == [("bad", "TimeoutError: no line")]
    assert (told.answered, told.failed, told.unasked, told.prompt_tokens, told.completion_tokens, told.total_tokens) == (4, 1, 0, 8, 4, 12)
    count = asked_in(folder)
    assert count["a"] == 2 and count["bad"] == 4 and count["shaky"] == 3  # once together, then alone, three times at most
    assert [r["error"] for r in spark.read.parquet(str(tmp_path / "cache.failed")).collect()] == ["TimeoutError: no line"]


def test_the_budget_of_failures(spark, tmp_path):
    def fails(frames):
        for f in frames:
            raise ValueError("no")
            yield f

    docs = spark.createDataFrame([(str(i), "t") for i in range(40)], "file string, text string")
    _, failed, told = calls.ask_all(docs, fails, str(tmp_path / "cache"), retries=0, budget=5, wave=10)
    assert told.answered == 0 and 5 < told.failed < 40 and told.unasked == 40 - told.failed == 40 - failed.count()


def test_a_run_that_dies_repeats_nothing_that_was_answered(spark, tmp_path):
    folder, cache = str(tmp_path / "asked"), str(tmp_path / "cache")
    os.makedirs(folder)
    docs = spark.createDataFrame([(f"f{i}", "t") for i in range(30)], "file string, text string")

    def asking(dies):
        def ask(frames):
            for f in frames:
                for name in f["file"]:
                    noted(folder, name)
                if dies and len(os.listdir(folder)) > 15:
                    os._exit(1)  # the worker is lost, and with it the job
                yield f.assign(answer="yes")[["file", "answer"]]

        return ask

    with pytest.raises((PySparkException, Py4JJavaError)):
        calls.ask_all(docs, asking(True), cache, wave=6)
    kept = {r["file"] for r in spark.read.parquet(cache).collect()}
    assert 0 < len(kept) < 30
    before = asked_in(folder)
    found, _, told = calls.ask_all(docs, asking(False), cache, wave=6)
    assert len(answers(found)) == 30 and told.answered == 30 - len(kept)
    after = asked_in(folder)
    assert all(after[x] == before[x] for x in kept) and all(after.get(f"f{i}", 0) == before.get(f"f{i}", 0) + 1 for i in range(30) if f"f{i}" not in kept)


def test_a_model_sees_each_chunk_once(spark, tmp_path):
    folder = str(tmp_path / "seen")
    os.makedirs(folder)

    @vectors.adapter
    def embed(frames):
        for f in frames:
            for c in f["chunk"]:
                noted(folder, c[:20].replace("/", ""))
            yield f.assign(vector=[[float(len(c)), 1.0] if c != "none" else None for c in f["chunk"]])[["key", "vector"]]

    long = "first part. " + "x" * 30 + "."
    df = spark.createDataFrame([(1, "one"), (2, "two words"), (3, "one"), (4, long), (5, None), (6, "none")], "key long, content string")
    store = VectorStore(str(tmp_path / "store"), embed)
    got = {r["key"]: r["vector"] for r in store.vectors_of(df, most=20).collect()}
    assert got == {1: [3.0, 1.0], 2: [9.0, 1.0], 3: [3.0, 1.0], 4: [(11 + 31) / 2, 1.0], 5: [0.0, 1.0]}
    assert store.embedded == 5 and set(asked_in(folder).values()) == {1}
    plain = {r["key"]: r["vector"] for r in vectors.embed_texts(df.where("key < 5"), embed, 20).collect()}
    assert plain == {k: v for k, v in got.items() if k < 5}
    before = asked_in(folder)
    again = VectorStore(str(tmp_path / "store"), embed)
    more = df.unionByName(spark.createDataFrame([(7, "new"), (8, "two words")], df.schema))
    assert {r["key"]: r["vector"] for r in again.vectors_of(more, most=20).collect()} == {**got, 7: [3.0, 1.0], 8: [9.0, 1.0]}
    after = asked_in(folder)
    assert again.embedded == 1 and {k for k in after if after[k] != before.get(k, 0)} == {"new", "none"}


def test_texts_of_files_that_did_not_change(spark, tmp_path):
    folder, cache = str(tmp_path / "read"), str(tmp_path / "cache")
    os.makedirs(folder)

    def ocr(frames):
        for f in frames:
            for name in f["file"]:
                noted(folder, name)
            yield pd.DataFrame([(n, p, t) for n, c in zip(f["file"], f["content"], strict=True) for p, t in enumerate(bytes(c).decode().split("|"), 1)], columns=["file", "page", "text"])

    def pages(rows):
        df = spark.createDataFrame([(n, bytearray(c, "utf-8")) for n, c in rows.items()], "file string, content binary")
        return sorted(map(tuple, ocr_cache.pages_through_cache(df, ocr, cache).collect()))

    first = {"a": "one|two", "b": " | ", "c": "three| "}
    expected = [("a", 1, "one"), ("a", 2, "two"), ("b", 1, " "), ("b", 2, " "), ("c", 1, "three"), ("c", 2, " ")]
    assert pages(first) == expected and asked_in(folder) == {"a": 1, "b": 1, "c": 1}
    assert pages(first) == expected and asked_in(folder) == {"a": 1, "b": 2, "c": 1}  # only the blank one is read again
    assert pages({"a": "other"}) == [("a", 1, "other")] and asked_in(folder)["a"] == 2
    assert pages({"a": "one|two"}) == [("a", 1, "one"), ("a", 2, "two")] and asked_in(folder)["a"] == 2

    def native(frames):
        for f in frames:
            yield pd.DataFrame([(n, p, f"own {n}{p}") for n in f["file"] for p in (1, 2)], columns=["file", "page", "text"])

    files = spark.createDataFrame([(n, bytearray(b"")) for n in "abc"], "file string, content binary")
    read = spark.createDataFrame(expected, "file string, page int, text string")
    assert sorted(map(tuple, adapters.with_native_text(read, files, native).collect())) == [("a", 1, "one"), ("a", 2, "two"), ("b", 1, "own b1"), ("b", 2, "own b2"), ("c", 1, "three"), ("c", 2, "own c2")]


def test_edits(spark):
    df = spark.createDataFrame([(1, "le premeir texte"), (2, "Premeir et dernier"), (3, ""), (4, None), (5, "neige et peine"), (6, "rein")], "key long, text string")
    accepted = spark.createDataFrame([("neige",)], "word string")
    got = {r["key"]: (r["text"], r["n_edits"], r["n_left"]) for r in edits.corrected(df, word_grammar, accepted).collect()}
    assert got == {1: ("le premier texte", 1, 1), 2: ("Premeir et dernier", 0, 0), 3: ("", 0, 0), 4: (None, 0, 0), 5: ("too widepiene", 2, 0), 6: ("rien", 1, 0)}
    assert edits.corrected(df.limit(0), word_grammar).collect() == []
    assert edits.scheduled([0, 0, 3, 2, 6], [3, 5, 6, 7, 9]) == [0, 2, 4]


def test_grammar_in_the_life_of_an_act(spark):
    text = "LOI N° 2020 - 07 DU 24 MARS 2020\nportant exemple d'un premeir\nL'ASSEMBLEE NATIONALE a délibéré\nLe Président de la République promulgue la loi\nArticle 1er : Le premeir texte\nArticle 2 : rien\nFait à Cotonou, le 24 mars 2020\nAMPLIATIONS"
    docs = spark.createDataFrame([("d", text), ("e", None)], "doc_id string, text string")
    register = spark.createDataFrame([], "priority int, name string, role string")
    read = lambda **k: {r["doc_id"]: r for r in extraction.extract_laws(docs, register, **k).collect()}["d"]
    plain = read()
    got = read(grammar=word_grammar, header="LOI N° [number]\n\n[object]\n\nL'Assemblée nationale [assembly]")
    assert plain["articles"][0]["content"] == "Article 1er : Le premeir texte" and got["articles"][0]["content"] == "Article 1er : Le premier texte"
    assert got["articles"][1]["content"] == "Article 2 : rien" and got["metadata"]["lawObject"] == "portant exemple d'un premier"
    kept = read(grammar=word_grammar, accepted=spark.createDataFrame([("premeir",), ("premeir tex",)], "word string").withColumn("x", F.lit(1)))
    assert kept["articles"][0]["content"] == "Article 1er : Le premeir texte"
