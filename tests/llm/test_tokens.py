import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from juriscope.llm import bpe, tokenfile
from juriscope.llm.hashing import Buffer

PARTS = ["a", "é", " ", "  ", "\n", "\t", " ", "'s", "'", "1", "23", "word", "!", "。", "\x1c", "🎉", "　x", "ab cd", "Éé×", "ÿ", "A", "aaaa", "...", "('s)", "ſ", "İ", "Σ", "the ", "Licence "]


def texts(special):
    rng = random.Random(7)
    parts = PARTS + (["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>"] if special else [])
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 300))) for _ in range(250)]
    long = "".join(rng.choice(PARTS) for _ in range(4000))
    return out + ["", None, "x" * 70000, " " * 3000, long, "new start " + long, long[:5000] + " other end"]


def test_encoders_agree_with_the_library():
    for file in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = bpe.public_path(file)
        plain, own = Tokenizer.from_file(path), bpe.Encoder(path)
        for special in (False, True):
            for size in (1 << 21, 3000):
                some = texts(special)
                for first, last, buffer in bpe.slices(pa.array(some, pa.string()), size):
                    ids, bounds = own.encode(buffer) if file[0] == "b" else tokenfile.words_of(own, buffer)
                    for i in range(first, last):
                        assert ids[bounds[i - first] : bounds[i - first + 1]].tolist() == plain.encode(some[i] or "", add_special_tokens=False).ids
        assert file[0] != "b" or own.reused > 0


def thue_morse(n):
    """Two words of n letters that are equal modulo any power of two under every polynomial hash, for n = 2**10 or more."""
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


def agrees(own, plain, some, size=1 << 21):
    for first, last, buffer in bpe.slices(pa.array(some, pa.string()), size):
        ids, bounds = own.encode(buffer)
        for i in range(first, last):
            assert ids[bounds[i - first] : bounds[i - first + 1]].tolist() == plain.encode(some[i] or "", add_special_tokens=False).ids


def test_words_that_collide_modulo_two_to_the_64th():
    for n in (1024, 2048):
        some = [*thue_morse(n), *thue_morse(n)[::-1], "x " + thue_morse(n)[1], "y " + thue_morse(n)[0]]
        for file in ("byte_bpe_50k.json", "word_bpe_49k.json"):
            path = bpe.public_path(file)
            plain, own = Tokenizer.from_file(path), bpe.Encoder(path)
            _, _, buffer = next(bpe.slices(pa.array(some, pa.string())))
            ids, bounds = own.encode(buffer) if file[0] == "b" else tokenfile.words_of(own, buffer)
            for i, x in enumerate(some):
                assert ids[bounds[i] : bounds[i + 1]].tolist() == plain.encode(x, add_special_tokens=False).ids


def test_memories_compare_bytes(monkeypatch):
    path = bpe.public_path("byte_bpe_50k.json")
    plain, own = Tokenizer.from_file(path), bpe.Encoder(path)
    monkeypatch.setattr(Buffer, "hashes", lambda self, start, end: (np.asarray(end - start) % 3).astype(np.uint64) << np.uint64(50))
    agrees(own, plain, ["one two three", "six ten", "two one", "aa bb cc dd", "bb aa dd cc", *texts(False)[:20]])


def test_cuts_inside_words_are_repaired(monkeypatch):
    path = bpe.public_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    rng = random.Random(11)
    some = texts(True) + [" ".join("".join(rng.choice("étaoinshrdlu'") for _ in range(rng.randint(1, 60))) for _ in range(200)) for _ in range(20)]
    some += ["a" * 5000 + " " + "b'll" * 900, "<|endoftext|>" * 300, "x" * 100 + "<|endoftext|>" + "y" * 100]
    for least, bits, most in ((1, 2, 7), (4, 3, 50), (64, 5, 300)):
        for name, value in (("LEAST", least), ("MEAN_BITS", bits), ("MOST", most)):
            monkeypatch.setattr(bpe, name, value)
        for size in (1 << 21, 3000):
            own = bpe.Encoder(path)
            agrees(own, plain, some, size)
            assert own.reused > 0


def test_joins_grow_until_the_ids_agree():
    path = bpe.public_path("byte_bpe_50k.json")
    plain, own = Tokenizer.from_file(path), bpe.Encoder(path)
    rng = random.Random(12)
    some = [" ".join(rng.choice(["alpha", "beta", "gamma's", "été", "12"]) for _ in range(4000))]
    agrees(own, plain, some)
    assert len(own.chunks) > 5 and not own.grew
    for (_, raw), (ids, counts) in own.chunks.items():  # spoil what the first windows are compared with
        if not some[0].encode().startswith(raw):
            ids[: counts[:2].sum()] += 1
        if not some[0].encode().endswith(raw):
            ids[len(ids) - counts[-2:].sum() :] += 1
    before = own.made
    agrees(own, plain, some)
    assert own.grew > 5 and own.made == before


def test_chunks_shared_by_the_corpus(spark):
    path = bpe.public_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    rng = random.Random(13)
    passage = " ".join(rng.choice(["alpha", "beta", "gamma's", "été", "12"]) for _ in range(3000))
    some = [f"{i} start {passage} end {i}" for i in range(12)] + ["alone", None, "", passage]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(4)
    table = bpe.shared_chunks(docs, path)
    assert len(table) > 2 and sum(len(x) for _, x in table) <= bpe.SHARED_BYTES
    for (_, raw), (ids, _) in table.items():
        assert ids.tolist() == plain.encode(raw.decode(), add_special_tokens=False).ids
    assert bpe.shared_chunks(docs, path, most=3).keys() <= table.keys() and len(bpe.shared_chunks(docs, path, most_bytes=10)) == 0
    for shared in (table, {}):
        for r in bpe.encode(docs, path, shared=shared).collect():
            assert np.frombuffer(r["ids"], "<u4").tolist() == plain.encode(some[r["doc_id"]] or "", add_special_tokens=False).ids


def test_round_trip(spark):
    path = bpe.public_path("byte_bpe_50k.json")
    some = texts(True)
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(some)], "doc_id long, text string, ids string, n_tokens int")
    got = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    plain = Tokenizer.from_file(path)
    for i, t in enumerate(some):
        assert got[i]["decoded"] == (t or "") and np.frombuffer(got[i]["ids"], "<u4").tolist() == plain.encode(t or "", add_special_tokens=False).ids
    assert {r["doc_id"]: r for r in bpe.encode_decode(docs.withColumn("decoded", F.lit(0)), path).collect()} == got
    assert bpe.encode(docs.limit(0), path).collect() == []
    bad = spark.createDataFrame([(1, bytes(np.array([124, 222], "<u4"))), (2, None)], "doc_id long, ids binary")
    out = {r["doc_id"]: r["decoded"] for r in bpe.decode(bad, path).collect()}
    assert out[1] == plain.decode([124, 222], skip_special_tokens=False) and out[2] == ""


def test_packing():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 5, 1000):
        ranks = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = tokenfile.pack(ranks)
        assert len(control) == -(-n // 4) and (tokenfile.unpack(control, data, n) == ranks).all()


def test_op4_and_op8_against_the_library(spark, sf):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    path = bpe.public_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    got = {r["doc_id"]: r for r in bpe.op4_bpe(spark, sf).collect()}
    for i, t in docs:
        ids = plain.encode(t, add_special_tokens=False).ids
        text = plain.decode(ids, skip_special_tokens=False)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    plain, start = Tokenizer.from_file(bpe.public_path("word_bpe_49k.json")), 0
    rows = {r["doc_id"]: r for r in tokenfile.op8_token_file(spark, sf).collect()}
    for i, t in docs:
        ids = [*plain.encode(t, add_special_tokens=False).ids, 1]
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(rows) == len(docs)


def test_file_of_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(3, "b c"), (None, "none"), (1, None), (3, "b c"), (2, "")], "doc_id long, text string")
    tokenfile.write_ids(docs, str(tmp_path / "a"), bpe.public_path("word_bpe_49k.json"))
    rows = tokenfile.read_ids(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 3] and [r["n_tokens"] for r in rows] == [2, 1, 1, 3, 3] and [r["start"] for r in rows] == [0, 2, 3, 4, 7]
    tokenfile.write_ids(docs.limit(0), str(tmp_path / "b"), bpe.public_path("word_bpe_49k.json"))
    assert tokenfile.read_ids(spark, str(tmp_path / "b")).collect() == []


def test_file_of_long_texts_and_clashing_columns(spark, tmp_path):
    path = bpe.public_path("word_bpe_49k.json")
    long = "word " * 200_000 + "end"
    docs = spark.createDataFrame([(2, long, "x", 1), (1, "a", "y", 2)], "doc_id long, text string, ids string, start int")
    tokenfile.write_ids(docs, str(tmp_path / "c"), path)
    got = {r["doc_id"]: (r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in tokenfile.read_ids(spark, str(tmp_path / "c")).collect()}
    plain = Tokenizer.from_file(path)
    one, two = ([*plain.encode(t, add_special_tokens=False).ids, 1] for t in ("a", long))
    assert got == {1: (0, one), 2: (len(one), two)}
