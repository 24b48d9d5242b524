"""Line states in two levels against those along one window, and the register join against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from juriscope.operators import lines, metadata, quality, scans


def documents(spark):
    rng = random.Random(4)
    some = ["Article 1 : texte", "Fait à Cotonou, le 1 mars 2020", "le Président promulgue", "suite", "", "TITRE I", "LOI N° 1", "portant"]
    rows = [(d, n, rng.choice(some)) for d in range(12) for n in sorted(rng.sample(range(200), rng.choice([0, 1, 30, 90])))]
    return spark.createDataFrame(rows, "doc_id long, line_no int, line string")


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_scans_equal_windows(spark, size):
    df = documents(spark)
    rows = lambda x: sorted(map(tuple, x.collect()))
    assert rows(scans.body_state(df, size=size)) == rows(lines.body_state(df))
    assert rows(scans.sections(df, size=size)) == rows(lines.sections(df))
    assert rows(scans.articles(df, size=size)) == rows(lines.articles(df))
    event = F.when(F.col("line").startswith("LOI"), "number").when(F.col("line") == "portant", "object")
    held = df.withColumn("field", lines.held(event)).where("field is not null")
    assert rows(scans.header_fields(df, event, size).select("doc_id", "line_no", "line", "field")) == rows(held.select("doc_id", "line_no", "line", "field"))


def test_a_document_of_many_lines_is_many_tasks(spark):
    n = 2_000_000
    line = F.when(F.col("id") == 17, "promulgue").when(F.col("id") % 500_000 == 400_000, "Article 3 : x").when(F.col("id") == n - 5, "Fait à Cotonou, le 2 mai").otherwise("texte")
    df = spark.range(n).select(F.lit(1).alias("doc_id"), F.col("id").cast("int").alias("line_no"), line.alias("line"))
    got = {(r["section"],): r["count"] for r in scans.sections(df).groupBy("section").count().collect()}
    assert got == {("header",): 400_000, ("body",): n - 5 - 400_000, ("footer",): 5}
    assert scans.body_state(df).where("in_body").count() == n - 5 - 17
    # no window or group is keyed by the document alone but for the summaries, a row for each slice
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dealt = scans.scanned(scans.sliced(df), x=("ever", F.col("line") == "promulgue")).groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in dealt) < 0.5 * n


def test_register_join_equals_all_pairs(spark):
    rng = random.Random(6)
    word = lambda a, b: "".join(rng.choice("aaabcdé ") for _ in range(rng.randint(a, b)))
    names = sorted({word(0, 9) for _ in range(150)} | {"aaaaa", "aa", "b", "abc", "abcd", "aaaa"})
    register = spark.createDataFrame([(i, x, f"r{i % 3}") for i, x in enumerate(names)] + [(900, "abcd", "again")], "priority int, name string, role string")
    texts = [(i % 20, i, word(0, 30)) for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, line_no int, line string")
    got = {(r["doc_id"], r["name"], r["role"], r["line_no"]) for r in metadata.signatories(df, register).collect()}

    def plain(x):
        return x.strip(" ").upper().replace("É", "E").lower().strip(" ")

    best = {}
    for doc, n, line in texts:
        text = plain(line)
        if not text:
            continue
        for i, name in enumerate(names):
            key = plain(name)
            hits = sum(key[j : j + 3] in text for j in range(len(key) - 2))
            if key and (key in text or hits >= 3):
                k = (doc, name, f"r{i % 3}")
                best[k] = min(best.get(k, n), n)
                break
    assert got == {(*k, n) for k, n in best.items()}


def test_frequent_trigrams_bring_no_candidates(spark):
    register = spark.range(2000).select(F.col("id").alias("n"), F.concat(F.lit("le "), F.substring(F.md5(F.col("id").cast("string")), 1, 10)).alias("key"))
    texts = register.where("n % 40 = 0").select(F.concat(F.lit("le "), "key").alias("text"))
    found = metadata.candidates(texts, register.select("key"))
    every = texts.select("text", F.explode(F.array_distinct(metadata.grams(F.col("text")))).alias("g")).join(register.select("key", F.explode(F.array_distinct(metadata.grams(F.col("key")))).alias("g")), "g").select("text", "key").distinct()
    assert found.where(F.expr("contains(text, key)")).count() == 50
    assert every.count() == 50 * 2000  # "le " is in all
    assert found.count() < 0.1 * 50 * 2000


def test_unknown_words_either_way(spark):
    df = spark.createDataFrame([(1, "alpha beta alpha œuvre l'eau"), (2, ""), (3, None), (4, "Bêta gamma-delta abc")], "doc_id long, text string")
    known = spark.createDataFrame([("beta",), ("delta",)], "word string")
    rows = lambda most: sorted(map(tuple, quality.unknown_words(df, known, most=most).collect()))
    assert rows(100) == rows(0) == [(1, 4), (2, 0), (3, 0), (4, 1)]


def test_words_are_split_as_by_ranges_without_trying_them(spark):
    assert "a-z" not in quality.WORDS and "A-Z" not in quality.WORDS
    every = spark.range(1, 0x3000).select(F.concat(F.lit("a"), F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')"), F.lit("b")).alias("t"))
    same = F.split("t", quality.WORDS) == F.split("t", r"[^a-zA-Zàâéèêëîïôûùçœ'-]+")
    assert every.where(~same).count() == 0
