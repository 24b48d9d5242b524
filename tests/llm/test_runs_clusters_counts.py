import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from juriscope.llm import kdtree, periodic, tokencounts
from juriscope.llm.bpe import public_path

SMALL = "/root/testdata/sf0.001"


# --- periodic runs ---------------------------------------------------------


def runs_by_loops(words):
    """Every maximal stretch by period, compared word by word; the smallest period of one stretch stays."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                out.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def planted_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def told(words):
    runs = runs_by_loops(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
    text = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    longest = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *longest, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(text))


def sequences():
    rng = random.Random(5)
    for k in (1, 2, 3, 40):
        for _ in range(60):
            yield [rng.randrange(k) for _ in range(rng.randint(0, 90))]
    for _ in range(100):
        base = [rng.randrange(3) for _ in range(rng.randint(1, 9))]
        ends = [[rng.randrange(4) for _ in range(rng.randint(0, 20))] for _ in range(2)]
        yield ends[0] + base * rng.randint(1, 12) + base[: rng.randint(0, len(base))] + ends[1]
    a, b, f, g = [0], [1], [0], [0, 1]
    for _ in range(7):
        a, b, f, g = a + b, b + a, g, g + f
    yield from (a, a * 5, g, [0] * 3000, ([0] * 8 + [1]) * 300, list(range(200)) * 9)


@pytest.mark.parametrize("exact", [False, True])
def test_runs_of_sequences(exact):
    lists = list(sequences())
    ids, bounds = np.array([x for w in lists for x in w]), np.concatenate([[0], np.cumsum([len(w) for w in lists])])
    seq = periodic.Sequence(ids)
    seq.exact = exact
    found = periodic.repetitions(seq, bounds)
    assert periodic.verified(ids, bounds, found).all()
    text = np.searchsorted(bounds, found.start, side="right") - 1
    got = [[] for _ in lists]
    for i, s, e, q in zip(text, found.start, found.end, found.period, strict=True):
        got[i].append((int(s - bounds[i]), int(e - s), int(q)))
    assert got == [runs_by_loops(w) for w in lists]


def test_a_hash_that_lies_is_found_out(monkeypatch):
    lists = [w for w in sequences() if len(w) > 5][:200]
    ids, bounds = np.array([x for w in lists for x in w]), np.concatenate([[0], np.cumsum([len(w) for w in lists])])
    right = periodic.runs_of(ids, bounds)
    monkeypatch.setattr(periodic.Sequence, "equal", lambda self, a, b, n: n <= 3)
    for one, other in zip(right, periodic.runs_of(ids, bounds), strict=True):
        assert one.tolist() == other.tolist()


def test_op12_equals_loops(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = {r["doc_id"]: told(planted_words(r["doc_id"], r["text"])) for r in rows}
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = {r["doc_id"]: tuple(r[c] for c in columns) for r in periodic.op12_periodic_runs(spark, SMALL).collect()}
    assert got == expected
    assert sum(x[0] > 0 for x in got.values()) > 5


def test_runs_of_odd_rows(spark):
    texts = ["a " * 9, None, "", " \t\n", "x", "a b " * 5, "a\x1cb " * 7, "é à " * 4, "word " * 40_000, "a " * 9, "\x0b".join("qrs" * 3), "1 1 1 1 1", "1 1 1 1 1 1"]
    df = spark.createDataFrame([(i % 10, x, "kept", 1.5) for i, x in enumerate(texts)], "doc_id long, text string, runs string, period double")
    out = periodic.periodic_runs(df).collect()
    assert set(out[0].asDict()) == {"doc_id", "period", "runs", "collapsed"}
    for r, text in zip(out, texts, strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = [(0, len(words), 1)] if len(words) > 1000 else runs_by_loops(words)
        assert [tuple(x) for x in r["runs"]] == runs
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in dropped)
    assert periodic.periodic_runs(df.limit(0)).collect() == []
    nulls = df.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text")).limit(2)
    assert [tuple(r) for r in periodic.periodic_runs(nulls).collect()] == [(None, [], "")] * 2


def test_planting(spark):
    texts = ["", None, "  ", "one", "a b c d e f g h i j", "\t a\nb \x1c c  d "]
    df = spark.createDataFrame([(10 * i + k, t) for i, t in enumerate(texts) for k in range(10)] + [(None, "a b")], "doc_id long, text string")
    for r in df.withColumn("new", periodic.planted(F.col("text"), F.col("doc_id"))).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["new"] or "")
        assert words == (["a", "b"] if r["doc_id"] is None else planted_words(r["doc_id"], r["text"]))


# --- clusters --------------------------------------------------------------


def lloyd(ids, vectors, k, rounds, seed):
    order = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"{seed}:{ids[i]}".encode()).hexdigest(), vectors[i]))
    centroids = [vectors[i] for i in order[:k]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c, strict=True))
    near = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        cluster = [near(v) for v in vectors]
        for c in range(len(centroids)):
            own = [v for v, x in zip(vectors, cluster, strict=True) if x == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return centroids, [(near(v), far(v, centroids[near(v)])) for v in vectors]


@pytest.mark.parametrize("case", ["few values", "one hot vector", "far apart", "large"])
def test_trees_equal_loops(case):
    rng = np.random.default_rng(3)
    n, d, k = 700, 6, 9
    v = {"few values": rng.integers(0, 2, (n, d)), "one hot vector": rng.integers(-9, 9, (n, d)), "far apart": rng.integers(0, 5, (n, 1)) * 1000 + rng.integers(0, 30, (n, d)), "large": rng.integers(-(1 << 24), 1 << 24, (n, d))}[case]
    if case == "one hot vector":
        v[: n // 2] = v[0]
    centroids = v[rng.permutation(n)[:k]].copy()
    if case == "few values":
        centroids[4] = centroids[2]
    order, first, last, child = kdtree.grown(v)
    tree = kdtree.Tree(v[order], first, last, child)
    filtered = kdtree.Filter(tree, centroids)
    assert filtered.kind is (np.int64 if case == "large" else np.float64)
    cluster, distance = filtered.assigned()
    exact = ((v[order][:, None].astype(object) - centroids[None].astype(object)) ** 2).sum(axis=2)
    nearest = [min(range(k), key=lambda c: (row[c], c)) for row in exact]
    assert cluster.tolist() == nearest
    assert distance.tolist() == [row[c] for row, c in zip(exact, nearest, strict=True)]
    count, total = filtered.totals()
    assert count.tolist() == np.bincount(nearest, minlength=k).tolist()
    assert total.tolist() == [v[order][np.array(nearest) == c].sum(axis=0).tolist() for c in range(k)]
    if case in ("far apart", "one hot vector"):
        assert filtered.compared < 2 * n  # of two passes: some nodes went whole


def test_clusters_of_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-9, 9)) / 4 for _ in range(3)], i) for i in range(200)]
    rows += [(900, None, 1), (901, [1.0, None, 2.0], 1), (902, [1.0, float("nan"), 2.0], 1), (903, [float("inf"), 0.0, 0.0], 1), (904, [1.0, 2.0], 1), (None, [1.0, 2.0, 3.0], 1), (7, rows[7][1], 1), (7, rows[7][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster int").repartition(3)
    found, centroids = kdtree.clustered(df, k=12, rounds=3, dims=3)
    kept = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows if v and len(v) == 3 and all(x is not None and np.isfinite(x) for x in v)]
    kept = sorted(kept, key=lambda r: r[0] is None)
    expected, cluster = lloyd([i for i, _ in kept], [v for _, v in kept], 12, 3, 2)
    assert centroids.tolist() == expected
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(((i, *c) for (i, _), c in zip(kept, cluster, strict=True)), key=key)
    few, centroids = kdtree.clustered(df.where("vec_id < 5"), k=12, rounds=2, dims=3)
    assert len(centroids) == 5 and few.agg(F.sum("distance")).collect()[0][0] == 0
    none, centroids = kdtree.clustered(df.limit(0), k=12, rounds=2, dims=3)
    assert none.collect() == [] and centroids.shape == (0, 3)


def test_op11_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMALL}/embeddings.parquet')")
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({kdtree.ORACLE})").fetchall()
    assert sorted(map(tuple, kdtree.op11_kdtree_clusters(spark, SMALL).select(*columns).collect())) == sorted(expected)


# --- token counts ----------------------------------------------------------

PARTS = ["a", "aa", "é", " ", "   ", "\n", "\t", "<s>", "</s>", "<unk>", "▁", "🎉", "。", "the ", "word", "xkqjz", "0", " 1", "ﬁ", "é", "\x00", "\x1c", "Ωλ", "漢字", "<0x0A>", "ab" * 9]


@pytest.fixture(scope="module")
def model():
    return SentencePieceProcessor(model_file=public_path("piece_bpe_32k.model"))


def test_spliced_ids_equal_the_librarys(model):
    rng = random.Random(3)
    for chunk, overlap in ((50, 1), (50, 7), (200, 16), (1000, 128)):
        pieces = tokencounts.Pieces(public_path("piece_bpe_32k.model"), chunk, overlap)
        texts = ["a" * 5000, " " * 5000, "ab" * 4000, "🎉" * 3000, "x" + "a" * 999 + " " + "a" * 3001, "a" * 1000 + "b" + "a" * 1000, "", "x" * chunk, "x" * (chunk + 1)]
        for _ in range(100):
            some = rng.sample(PARTS, rng.randint(1, len(PARTS)))
            texts.append("".join(rng.choice(some) for _ in range(rng.randint(0, 1500))))
        for text in texts:
            assert np.concatenate(list(pieces.ids(text))).tolist() == model.encode(text)
        assert pieces.counts(texts).tolist() == [len(x) for x in model.encode(texts)]
        assert pieces.spliced > 0 and pieces.widened > 0


def test_stable_places_are_where_no_piece_goes_across(model):
    pieces = tokencounts.Pieces(public_path("piece_bpe_32k.model"))
    names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    text = "The licence, 漢字 aXq  1st🎉 end."
    places = set(pieces.stable(text, 0, len(text)).tolist())
    for p in range(1, len(text)):
        pair = text[p - 1 : p + 1].replace(" ", "▁")
        assert (p in places) == (not any(pair in x for x in names))


def test_op13_equals_the_library(spark, model):
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    expected = {i: (len(x.encode()), len(model.encode(x)), len(model.encode(x)) > 4096) for i, x in rows.items()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokencounts.op13_token_counts(spark, SMALL).collect()}
    assert got == expected


def test_counts_of_odd_rows(spark, model):
    texts = [None, "", " ", "a", "<s>a</s>", "long text of words " * 9000, "a" * 200_000, "a", "漢" * 40_000]
    df = spark.createDataFrame([(i % 7, x, "x", 9) for i, x in enumerate(texts)], "doc_id long, text string, n_tokens string, other int")
    out = tokencounts.token_counts(df, public_path("piece_bpe_32k.model")).collect()
    assert [tuple(r) for r in out] == [(i % 7, 9, len((x or "").encode()), len(model.encode(x or "")), len(model.encode(x or "")) > 4096) for i, x in enumerate(texts)]
    assert tokencounts.token_counts(df.limit(0), public_path("piece_bpe_32k.model")).collect() == []
