import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from juriscope.llm import licenses, mixing, neardup, secrets, stages, toxicity, warc
from juriscope.llm.hashing import Buffer


def bag(text):
    words = re.findall(r"[A-Za-z0-9_\u0080-\U0010ffff]+", text.lower())
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)] if words else [])


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute_classes(rows):
    """(id, text) to class ids by comparing all pairs that share a shingle."""
    bags = {i: bag(t or "") for i, t in rows}
    parent = {i: i for i in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids, near = sorted(bags), set()
    where = {}
    for i in ids:
        for s in bags[i]:
            where.setdefault(s, []).append(i)
    pairs = {(a, b) for v in where.values() for n, a in enumerate(v) for b in v[n + 1 :]}
    for a, b in pairs:
        s = similarity(bags[a], bags[b])
        if abs(s - 0.8) < 0.02:
            near.add((a, b))
        if s >= 0.8:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in ids}, near


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    shared = rng.integers(1, 2**63, 40).astype(np.uint64)
    a, b = rng.integers(1, 12, 40), rng.integers(1, 12, 40)
    text, shingle, weight = np.repeat([0, 1], 40), np.concatenate([shared, shared]), np.concatenate([a, b])
    signed = neardup.signatures(text, shingle, weight, 2, 6000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((signed[0] == signed[1]).mean() - want) < 0.03
    alone = neardup.signatures(text[:40], shared, a, 1, 6000)
    assert (alone[0] == signed[0]).all()


def test_bags_count_shingles():
    some = ["a b c d e a b c d e a", "", "one", "Été à la mer, oui", "x_1 y z w v u", "!!!"]
    raw = [x.lower().encode() for x in some]
    text, shingle, weight = neardup.bags(Buffer(raw))
    for i, x in enumerate(some):
        assert sorted(weight[text == i].tolist()) == sorted(bag(x).values())


def test_near_duplicates_of_the_documents(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, near = brute_classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in neardup.op3_near_duplicates(spark, sf).collect()}
    assert len(got) == len(rows)
    assert got == want  # verified exactly; no pair of these tables is missed by the bands


def thue_morse(n):
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


def test_unrelated_long_words_are_not_one_class(spark):
    rows = [(i, x) for n in (1024, 2048) for i, x in enumerate(thue_morse(n), n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: r[1] for r in neardup.near_duplicates(docs).collect()} == {i: i for i, _ in rows}
    assert neardup.one_of_each(docs).count() == len(rows)


def test_hot_groups_are_dealt(spark, monkeypatch):
    """A large group of near copies, most of them near the lead, some only near one another; and very long texts."""
    monkeypatch.setattr(neardup, "HOT", 7)
    monkeypatch.setattr(neardup, "HOT_GROUP", 4)
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    far = [f"far{k}" if k % 40 == 0 else w for k, w in enumerate(base)]
    rows = [(i, " ".join([*(far if i % 3 == 0 else base)[:-1], f"end{i}"])) for i in range(60)]
    rows += [(i, " ".join(base).upper() + "!") for i in range(100, 130)]
    long = " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(40000))
    rows += [(200, long), (201, long + " more"), (202, long + ".")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want, _ = brute_classes(rows)
    assert {r[0]: r[1] for r in neardup.near_duplicates(docs).collect()} == want and len(set(want.values())) >= 2


def test_dealing_loses_no_pair(spark):
    left = spark.range(100).select(F.when(F.col("id") < 70, 1).otherwise(F.col("id")).alias("k"), "id")
    right = spark.createDataFrame([(1, "x"), (75, "y"), (500, "z")], "k long, v string")
    one, every = neardup.dealt(left, right, "k", "id", 9)
    got = one.join(every, ["k", "deal"])
    assert got.count() == 71 and got.select("id").distinct().count() == 71
    assert one.where("k = 1").groupBy("deal").count().count() == 8 and every.where("k = 1").count() == 8


def test_kept_rows_do_not_depend_on_the_order(spark):
    rows = [(1, "one two three four five six", "b"), (1, "one two three four five six", "a"), (2, "other", "z"), (None, "other", "y"), (3, "other", None)]
    schema = "doc_id int, text string, class_id string"
    want = {(1, "one two three four five six", "a"), (2, "other", "z"), (None, "other", "y")}
    for n in (1, 4):
        docs = spark.createDataFrame(rows[::-1] if n == 4 else rows, schema).repartition(n)
        assert {tuple(r) for r in neardup.one_of_each(docs).collect()} == want
    with pytest.raises(TypeError):
        neardup.near_duplicates(spark.createDataFrame([("a", "b")], "doc_id string, text string"))

def test_chains_and_odd_texts(spark):
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(100)]
    rows, text = [], list(words)
    for i in range(12):  # each is near the one before it, and the ends are far apart
        rows.append((100 + i, " ".join(text)))
        for k in range(2 * i, 2 * i + 2):
            text[k] = f"x{i}_{k}"
    rows += [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "One, two!"), (6, None), (7, "solo"), (None, "one two"), (8, "same same same same same same"), (8, "same same same same same same"), (9, "same same same same same same same")]
    docs = spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id long, text string, class_id int")
    got = [(r[0], r[1]) for r in neardup.near_duplicates(docs).collect()]
    assert len(got) == len(rows)
    classes = dict(got)
    want, _ = brute_classes([r for r in rows if r[0] is not None and r[0] != 8] + [(8, "same same same same same same")])
    assert {i: classes[i] for i in want} == want and classes[None] is None
    kept = [r[0] for r in neardup.one_of_each(docs).collect()]
    assert sorted(x for x in kept if x is not None) == sorted(set(want.values())) and kept.count(None) == 1
    assert neardup.near_duplicates(docs.limit(0)).collect() == []


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"  # enough confirmed rows to learn from
    rows = toxicity.op5_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    s, y = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows])
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])
    assert auc > 0.9
    odd = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "!!", 7)], "doc_id long, text string, score int")
    scored = toxicity.score(odd, (np.ones(1 << toxicity.BITS), -2.0)).collect()
    assert {round(r["score"], 6) for r in scored} == {round(1 / (1 + np.exp(2.0)), 6)} and scored[0]["text"] is None
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(odd, none) is None and toxicity.score(odd.limit(0), None).collect() == []


def test_mixture(spark, sf):
    rows = mixing.op6_mixing(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source"), "doc_id").collect()
    by = {}
    for r in rows:
        x = by.setdefault(r["source"], [r["target"], r["source_size"], 0, 0])
        x[2] += r["taken"]
        x[3] += r["size"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(t - taken) <= 1 and size == s and t <= 3 * s for t, s, taken, size in by.values())
    assert abs(sum(x[0] for x in by.values()) - sum(x[1] for x in by.values())) < 1e-3


def test_mixture_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 0), (1, "a b c", "x", 0), (2, None, "x", 0), (None, "d\te\x0b\nf g", None, 0), (3, "é", "y", 0), (4, "", "z", 0)], "doc_id long, text string, source string, size int")
    got = [tuple(r) for r in mixing.mix(docs).collect()]
    assert len(got) == 6 and sorted(r[1] for r in got) == [0, 0, 1, 3, 3, 4]
    assert mixing.mix(docs.limit(0)).collect() == []
    # sizes: x 6, y 1, z 0, null 4; weights 5, 2, 1, 5: z stops at 0, the others share 11 words by weight
    assert {r[0]: r[3] for r in got} == pytest.approx({1: 55 / 12, 2: 55 / 12, None: 55 / 12, 3: 22 / 12, 4: 0.0})


def python_fill(sizes, weights, cap):
    """Targets by rounds: deal what is left over what is not full, until none is above its cap."""
    full, names = set(), sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    while True:
        left, open_ = sum(sizes.values()) - sum(cap * sizes[s] for s in full), [s for s in names if s not in full]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        more = {s for s in open_ if weight[s] * level > cap * sizes[s]}
        if not more:
            return {s: float(cap * sizes[s]) if s in full else weight[s] * level for s in names}
        full |= more


def test_filling_against_rounds(spark):
    rng = random.Random(21)
    for n in (1, 2, 7, 40):
        sizes = {(None if i == 3 else f"s{rng.randint(0, 999)}-{i}"): rng.choice([0, 1, 5, 50, 4000]) for i in range(n)}
        docs = spark.createDataFrame([(i, "w " * (size // 2), s) for s, size in sizes.items() for i in range(2)] + [(9, "w" if size % 2 else "", s) for s, size in sizes.items()], "doc_id long, text string, source string")
        want = python_fill(sizes, mixing.WEIGHTS, 3)
        got = mixing.mix(docs.withColumn("keep", F.col("source"))).collect()
        sources = {r["source"]: r["target"] for r in mixing.water_fill(spark.createDataFrame([(s, mixing.WEIGHTS[i % 3], size) for i, (s, size) in enumerate(sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or "")))], "source string, weight long, source_size long")).collect()}
        assert sources == pytest.approx(want) and len(got) == 3 * n
        assert sum(r["taken"] for r in got) == pytest.approx(sum(sizes.values()), abs=n)


def test_mixture_of_long_texts(spark):
    docs = spark.createDataFrame([(1, "a " * 2_000_000, "x"), (2, "b", "y")], "doc_id long, text string, source string")
    assert {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()} == {1: 1_999_998, 2: 3}


def test_running_sums(spark):
    rows = [(i % 7, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(6)
    got = [(r["k"], r["v"], r["place"], r["before"]) for r in stages.running(df, [F.col("k"), F.col("v").desc()], {"before": F.col("v")}, "sums").collect()]
    want, total = [], 0
    for place, (k, v) in enumerate(sorted(rows, key=lambda x: (x[0], -x[1]))):
        want.append((k, v, place, total))
        total += v
    assert sorted(got) == sorted(want)


def plain_risk(zp, zu, prior):
    """The non-negative risk in plain loops, and what a step descends."""
    loss = lambda z, y: math.log1p(math.exp(-z if y else z))
    toxic = prior * sum(loss(z, 1) for z in zp) / len(zp)
    clean = sum(loss(z, 0) for z in zu) / len(zu) - prior * sum(loss(z, 0) for z in zp) / len(zp)
    return (toxic + clean) if clean >= 0 else -clean


def test_risk_gradient_against_differences():
    rng = np.random.default_rng(4)
    met = set()
    for prior, shift in ((0.1, 0.0), (0.6, -3.0), (0.9, 4.0), (0.8, 6.0)):
        zp, zu = rng.normal(size=7) + shift, rng.normal(size=11) - shift
        clean = np.log1p(np.exp(zu)).mean() - prior * np.log1p(np.exp(zp)).mean()
        met.add(clean >= 0)
        gp, gu = toxicity.risk_gradient(zp, zu, prior)
        for z, g in ((zp, gp), (zu, gu)):
            for i in range(len(z)):
                was, out = z[i], []
                for step in (1e-5, -1e-5):
                    z[i] = was + step
                    out.append(plain_risk(zp, zu, prior))
                z[i] = was
                assert (out[0] - out[1]) / 2e-5 == pytest.approx(g[i], abs=1e-6)
    assert met == {True, False}


def test_calibration_mends_the_scale():
    """Out-of-fold slopes and offsets give about the share of positives that is there."""
    rng = np.random.default_rng(5)
    toxic = rng.random(600) < 0.3
    rows = toxicity.Rows(600, np.repeat(np.arange(600), 3), np.stack([np.where(toxic, 1, 2), rng.integers(3, 9, 600), rng.integers(9, 40, 600)], 1).ravel(), np.full(1800, 3**-0.5))
    half = np.arange(600) % 2 == 0
    weight, bias = toxicity.calibrated(rows.some(toxic), half[toxic], rows, half, 0.3)
    p = toxicity.sigmoid(rows.scores(weight, bias))
    assert p[toxic].min() > toxicity.CUT > p[~toxic].max() and abs(p.mean() - 0.3) < 0.1


def test_toxicity_of_odd_rows(spark):
    words = ["vile", "awful", "nice", "calm", "green", "blue"]
    rng = random.Random(6)
    rows = [(i, " ".join([rng.choice(words[:2] if i % 4 == 0 else words[2:]) for _ in range(8)])) for i in range(400)]
    rows += [(500, None), (500, "vile " * 300_000), (None, "vile"), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("s"))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(500, 1), (500, 0), (501, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model, to="p").collect()
    again = toxicity.train(docs.repartition(7), labels.repartition(3))
    assert np.array_equal(model[0], again[0]) and model[1] == again[1]
    assert len(got) == len(rows) and all(r["score"] == "s" and 0 <= r["p"] <= 1 for r in got)
    assert np.mean([(r["p"] >= toxicity.CUT) == (r["doc_id"] % 4 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 400]) > 0.97
    assert [r["p"] for r in got if r["doc_id"] is None][0] > 0.5
    small = toxicity.train(docs, labels, most_bytes=2000)
    assert small is None or len(small[0]) == len(model[0])
    assert {r["p"] for r in toxicity.score(docs, None, to="p").collect()} == {0.0}


def python_secrets(text, scope=secrets.SCOPE):
    base = []
    for kind, pattern, group, least in ((0, secrets.ASSIGN, 1, 12), (1, secrets.ACCESS, 0, 18), (2, "[0-9a-f]+", 0, 16)):
        base += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if len(m[group]) >= least]
    weak = [(m.start(), 3, m.end()) for m in re.finditer(secrets.IDENT, text, re.ASCII) if len(m[1]) >= 3]
    weak += [(m.start(), 4, m.end()) for m in re.finditer(secrets.KEY, text) if not any(s < m.end() and m.start() < e for s, _, e in base)]
    weak += [(m.start(), 5, m.end()) for m in re.finditer(secrets.ENDPOINT, text)]
    role = [1, 0, 1, 0, 1, 2]
    near = lambda a, b: b[0] - a[2] <= scope and a[0] - b[2] <= scope and role[a[1]] != role[b[1]] and 1 in (role[a[1]], role[b[1]])
    added = [a for a in weak if any(near(a, b) for b in base + weak)]
    said = lambda found: ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))
    return said(base), said(base + added)


def test_secrets_against_loops(spark):
    rng = random.Random(4)
    parts = ["password=", "TOKEN : ", "api_key=\"", "apikey", "'", "secret", " ", "\n", "é🎉", "AKIA", "ABCDEFGHIJKLMNOP", "deadbeefdeadbeef", "0123456789abcdef0", "x" * 40, "Zx9" * 11, "user=bob_1", "login: amy", "https://a.example/x", "word ", "abc", "=", ":", "lorem ipsum " * 20]
    some = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)] + ["", None, "token=secret:abcdefghijklmnop", "deadbeefdeadbeef " * 3000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(some)], "doc_id long, text string, base string")
    got = secrets.find_secrets(docs).select("doc_id", secrets.written(F.col("base")).alias("b"), secrets.written(F.col("found")).alias("f")).collect()
    for r in got:
        assert (r["b"], r["f"]) == python_secrets(some[r["doc_id"]] or ""), some[r["doc_id"]]
    assert any(r["b"] != r["f"] for r in got)


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é password=abcdefghijklmnop end", 5), (2, None, None), (3, "clean", 5)], "doc_id long, text string, n_chars long")
    assert [tuple(r) for r in secrets.redacted(docs).orderBy("doc_id").collect()] == [(1, "é [SECRET] end", 14), (2, None, None), (3, "clean", 5)]


def licence(name, start):
    return next(t for i, t in licenses.KNOWN if i == name and t.startswith(start))


def test_licences(spark):
    text = licence("MIT", "MIT License")
    wrapped = text.replace("COPYRIGHT HOLDERS", "\n  COPYRIGHT HOLDERS")
    headed = "Copyright (c) 2020 Somebody\n© Others\n(c) 1999 more\nCOPYRIGHT: 2001, 2002 X\n"
    long = "words and words \n" * 100_000 + "Licensed under the MIT License.\n" + "x" * 1_000_000
    rows = [(1, text), (2, headed + text.upper().replace(",", " ;")), (3, text + " more"), (4, None), (5, "Intro\n  Licenced under the Apache LICENCE, version 2.0!\nReleased under the MIT License\nEnd"), (6, "© only"), (7, text), (7, text), (8, wrapped), (None, "ALL RIGHTS RESERVED"), (9, long), (10, licence("BSD-3-Clause", "Redis").replace("\n", "\n\n * "))]
    docs = spark.createDataFrame([(a, b, "z", "y") for a, b in rows], "doc_id long, text string, digest string, line_licenses string")
    want = {1: ("MIT", ""), 2: ("MIT", ""), 3: (None, ""), 4: (None, ""), 5: (None, "Apache-2.0,MIT"), 6: (None, ""), 7: ("MIT", ""), 8: ("MIT", ""), None: ("LicenseRef-All-Rights-Reserved", "LicenseRef-All-Rights-Reserved"), 9: (None, "MIT"), 10: ("BSD-3-Clause", "")}
    table = spark.createDataFrame([*licenses.KNOWN, ("empty", ""), ("null", None)], "license_id string, text string")
    for known in (licenses.KNOWN, table):
        got = licenses.scan(docs, known).collect()
        assert {r["doc_id"]: (r["license_id"], r["line_licenses"]) for r in got} == want and len(got) == len(rows)
    assert licenses.scan(docs.limit(0)).collect() == [] and {r["license_id"] for r in licenses.scan(docs, table.limit(0)).collect()} == {None}


def test_large_licence_tables_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(1, licence("ISC", "Perm")), (2, "a\nReleased under the MIT License.\n"), (3, ""), (3, ""), (4, None)], "doc_id long, text string")
    want = sorted(map(str, licenses.scan(docs).collect()))
    monkeypatch.setattr(licenses, "PLAN_LINES", 0)
    assert sorted(map(str, licenses.scan(docs).collect())) == want
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", 0)
    assert sorted(map(str, licenses.scan(docs).collect())) == want


def test_revisits_repeated_and_long(spark):
    headers = {"ETag": '"a"', **{f"X-{i}": "v" * 1000 for i in range(500)}}
    rows = [(1, "response", "http://a.com/x?ref=main", "2020-01-01 00:00:00", 200, None, headers)] * 2 + [(2, "revisit", f"a.com/x?ref={ref}", "2020-01-02 00:00:00", 304, None, {"ETag": '"a"'}) for ref in ("main", "main", "dev")]
    df = spark.createDataFrame(rows, "record_id long, warc_type string, url string, date string, status int, digest string, headers map<string,string>")
    got = sorted((r["url_key"], r["verdict"], len(r["headers"] or {})) for r in warc.resolve_revisits(df).collect())
    assert got == [("a.com/x?ref=dev", "no-earlier-response", 0), *[("a.com/x?ref=main", "etag", 501)] * 2]


def test_records_of_pages_meet_every_verdict(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>") for i in range(1001)], "page_id long, url string, html string")
    got = warc.resolve_revisits(warc.page_records(pages)).collect()
    assert len(got) == 1001 and {r["verdict"] for r in got} == {"etag", "last-modified", "digest", "unchecked", "validator-mismatch", "no-earlier-response"}
    assert {r["refers_to"] % 4 for r in got if r["refers_to"] is not None} == {0, 1}


def test_revisits(spark):
    def rec(i, kind, url, at, status, headers, digest=None):
        return (i, kind, url, at, status, digest, headers, "extra")

    day = "2020-01-0"
    rows = [
        rec(1, "response", "http://www.A.com:80/x/?utm_source=f#top", day + "1 00:00:00", 200, {"ETag": 'W/"a"', "Content-Length": "9", "X": "1"}, "d1"),
        rec(2, "response", "https://a.com/x", day + "2 00:00:00", 200, {"ETag": '"b"', "Last-Modified": "m"}, "d2"),
        rec(3, "revisit", "http://a.com/x", day + "1 12:00:00", 304, {"etag": '"a"', "Cache-Control": "no", "Content-Length": "0"}),
        rec(4, "revisit", "http://a.com/x", day + "3 00:00:00", 304, {"etag": '"a"'}),
        rec(5, "revisit", "http://a.com/x", day + "3 00:00:00", 304, {"last-modified": "m", "Date": None}),
        rec(6, "revisit", "http://a.com/x", day + "3 00:00:00", 304, None, "d2"),
        rec(7, "revisit", "http://a.com/x", "2019-01-01 00:00:00", 304, None),
        rec(8, "revisit", None, day + "3 00:00:00", 304, None),
        rec(9, "response", "http://a.com/x", day + "2 12:00:00", 404, None),
        rec(10, "revisit", "http://a.com/x", None, 304, None),
        rec(11, "revisit", "http://a.com/x", day + "2 00:00:00", 304, None),
    ]
    df = spark.createDataFrame(rows, "record_id long, warc_type string, url string, date string, status int, digest string, headers map<string,string>, verdict string")
    got = {r["record_id"]: (r["refers_to"], r["verdict"], r["status"], r["headers"]) for r in warc.resolve_revisits(df).collect()}
    b = {"etag": '"b"', "last-modified": "m"}
    assert got == {
        3: (1, "etag", 200, {"etag": '"a"', "content-length": "9", "x": "1", "cache-control": "no"}),
        4: (2, "validator-mismatch", None, None),
        5: (2, "last-modified", 200, b),
        6: (2, "digest", 200, b),
        7: (None, "no-earlier-response", None, None),
        8: (None, "no-earlier-response", None, None),
        10: (None, "no-earlier-response", None, None),
        11: (2, "unchecked", 200, b),
    }
    assert warc.resolve_revisits(df.limit(0)).collect() == []


def test_secrets_of_very_many_matches(spark):
    """40,000 strings in a text, and 16,000 parts that complete one another, in a few seconds."""
    hexes = "deadbeefdeadbeef0 " * 40000
    mixed = " ".join(f"user=u{i} {'Zx9' * 12} https://h{i}.example/x password=abcdefghijkl{i}" for i in range(4000))
    docs = spark.createDataFrame([(1, hexes), (2, mixed)], "doc_id long, text string")
    began = time.time()
    got = {r["doc_id"]: (r["b"], r["f"]) for r in secrets.find_secrets(docs).select("doc_id", secrets.written(F.col("base")).alias("b"), secrets.written(F.col("found")).alias("f")).collect()}
    assert time.time() - began < 30
    assert got[2] == python_secrets(mixed) and got[1][0].count(",") == 39999 and got[1][1] == got[1][0]


def test_redaction_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, "a password=abcdefghijklmnop " + "deadbeefdeadbeef," * 200, [1], "f"), (1, None, None, "g")], "doc_id long, text string, base array<int>, found string")
    rows = [tuple(r) for r in secrets.redacted(docs).orderBy("found").collect()]
    assert rows == [(1, "a [SECRET] " + "[SECRET]," * 200, [1], "f"), (1, None, None, "g")]
