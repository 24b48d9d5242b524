"""Near duplicates by BagMinHash signatures, banded and verified on multisets.

A document is a bag of five-word shingles.  For each shingle, each doubling
interval of weights [0,1), [1,2), [2,4), ... carries a Poisson process of points
(time, signature place, weight level) that depends on the shingle and interval
alone.  A point counts in a document if its level is below the shingle's count
there; the earliest point of each place is the signature.  Two documents agree
on a place with the probability of their weighted Jaccard similarity.  Points
beyond the time by which all places are surely full are never made, so a
document costs little more than its shingles.

Documents of one word sequence, by a 128-bit digest of their words, stand for one
another from the start.  The signatures of the others are cut in bands.
Documents that agree on a band are candidates.
They are verified on the whole bags: multiset intersection over union, exactly.
Within a band's group pairs are not told one by one.  A document is central by
the sizes of its groups; the original of many copies agrees with most of them
and comes first.  Each document meets the most central one of its groups, then
what is still apart meets the most central one of each of its groups.  Last,
the documents of one group that are in different classes are compared within
the join that finds them, which lets links only through; so no link that joins
two classes is left out, and no list of pairs is made.

A lead that very many documents meet, and a group of very many members, are dealt
over several tasks: the lead's bag, or the group's, is copied once for each.  The
joins of the components carry two numbers a row and are left to adaptive
execution, which splits their large partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import slices
from .hashing import WORD_BYTES, Buffer, U, mixed
from .stages import arrow_map, read_table, staged

SHINGLE, THRESHOLD = 5, 0.8
#: Bands and places of each: at 0.8 a pair is missed once in 14,000.
BANDS, ROWS = 24, 5
#: Expected points a place before the time limit; a document with an empty place is done again with twice the time.
POINTS = 8.0
#: Ids up to this number are broadcast (16 MB); more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Rows of one key that a task compares; keys with more are dealt over several.
HOT = 256
#: Members of a band's group that a task compares with one another.
HOT_GROUP = 4096


def shingles(buffer: Buffer, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of n words of each text, and the text of each; fewer than n words make one shingle."""
    start, end, text = buffer.runs(WORD_BYTES)
    words = buffer.hashes(start, end)
    if not len(words):
        return words, text
    count = len(words) - n + 1
    full = np.zeros(0, np.int64)
    if count > 0:
        full = np.flatnonzero(text[: count] == text[n - 1 :])
    out = np.zeros(len(full), U)
    for k in range(n):
        out += words[full + k] * U((0x9E3779B97F4A7C15 * (2 * k + 3)) & (2**64 - 1))
    per = np.bincount(text, minlength=buffer.n)
    short = np.flatnonzero((per > 0) & (per < n))
    if len(short):
        first = np.searchsorted(text, short)
        more = np.zeros(len(short), U)
        for k in range(n - 1):
            there = per[short] > k
            more[there] += words[first[there] + k] * U((0xC2B2AE3D27D4EB4F * (2 * k + 3)) & (2**64 - 1))
        out, owner = np.concatenate([out, more]), np.concatenate([text[full], short])
        order = np.argsort(owner, kind="stable")
        return mixed(out[order]), owner[order]
    return mixed(out), text[full]


def bags(buffer: Buffer, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts: text (ascending), hash (ascending in a text), count."""
    hashes, text = shingles(buffer, n)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(hashes)))


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, places: int) -> np.ndarray:
    """(n, places) signature of texts 0..n-1; a text without shingles has all ones."""
    none = U(2**64 - 1)
    out = np.full(n * places, none, U)
    total = np.bincount(text, weight, minlength=n)
    limit = np.divide(POINTS, total, out=np.zeros(n), where=total > 0)
    element = np.arange(len(text))
    again = np.ones(n, bool)
    while len(element):
        level, most = 0, int(weight[element].max())
        own = element
        k = 0
        while level < most:
            size = max(1, level)
            own = own[weight[own] > level]
            seed = mixed(shingle[own] ^ U((0xA0761D6478BD642F * (k + 1)) & (2**64 - 1)))
            at, time, points = own, np.zeros(len(own)), 0
            while len(at):
                points += 1
                key = mixed(seed + U((0xE7037ED1A0B428DB * points) & (2**64 - 1)))
                time = time - np.log(((key >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / (places * size)
                stay = time <= limit[text[at]]
                at, time, seed, key = at[stay], time[stay], seed[stay], key[stay]
                more = mixed(key)
                place = (more & U(0xFFFFFFFF)).astype(np.int64) % places
                good = slice(None) if size == 1 else np.flatnonzero(level + (more >> U(32)).astype(np.int64) % size < weight[at])
                packed = time[good].astype(np.float32).view(np.uint32).astype(U) << U(32) | key[good] & U(0xFFFFFFFF)
                np.minimum.at(out, text[at[good]] * places + place[good], packed)
            k, level = k + 1, max(1, 2 * level)
        again = (out.reshape(n, places) == none).any(axis=1) & (total > 0)
        limit = limit * 2
        element = np.flatnonzero(again[text])
    return out.reshape(n, places)


def banded(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands) hashes of the bands, each band's number in its hash."""
    parts = signature.reshape(len(signature), bands, rows)
    factors = np.array([(0x9E3779B97F4A7C15 * (2 * r + 1)) & (2**64 - 1) for r in range(rows)], U)
    sums = (mixed(parts) * factors).sum(axis=2, dtype=U)
    return mixed(sums ^ (np.arange(1, bands + 1, dtype=U) * U(0xD6E8FEB86659FD93)))


def word_digests(buffer: Buffer) -> list[bytes]:
    """128 bits of each text's words, joined by single blanks."""
    inside = WORD_BYTES[buffer.data]
    after = np.zeros(len(inside), bool)
    after[1:] = inside[:-1] & ~inside[1:]
    after[buffer.starts[:-1][np.diff(buffer.starts) > 0]] = False
    kept = inside | after
    flat = np.where(inside, buffer.data, np.uint8(32))[kept].tobytes()
    bounds = np.concatenate([[0], np.cumsum(kept)])[buffer.starts].tolist()
    return [hashlib.blake2b(flat[a:b].rstrip(b" "), digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def sketch(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """id, digest of the words, and the bands; no bands for texts without words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buffer in slices(pc.utf8_lower(batch.column(1))):
                text, shingle, weight = bags(buffer)
                signed = signatures(text, shingle, weight, buffer.n, bands * rows)
                keys = banded(signed, bands, rows).view(np.int64)
                there = np.bincount(text, minlength=buffer.n) > 0
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(there * bands)]).astype(np.int32)), pa.array(keys[there].ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(word_digests(buffer), pa.binary()), lists], names=["id", "words", "bands"])

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), work, "id long, words binary, bands array<long>")


def bag_rows(docs: DataFrame) -> DataFrame:
    """id and the bag as a set: each shingle once for each time that it occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buffer in slices(pc.utf8_lower(batch.column(1))):
                text, shingle, weight = bags(buffer)
                rank = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
                flat = (np.repeat(shingle, weight) + rank.astype(U) * U(0x589965CC75374CC3)).view(np.int64)
                per = np.bincount(np.repeat(text, weight), minlength=buffer.n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), lists], names=["id", "bag"])

    return arrow_map(docs, work, "id long, bag array<long>")


def by_ids(df: DataFrame, ids: DataFrame, n: int, how: str) -> DataFrame:
    """Semi or anti join with n distinct ids: broadcast if they are few, else by shuffle."""
    return df.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, "id", how)


def dealt(left: DataFrame, right: DataFrame, key: str, by: str, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``deal``, so that a join by (key, deal) meets no more than about ``most`` left rows in a task.

    Left rows of a key with more are dealt by the hash of ``by``; the right rows of
    that key are copied for each deal.  Keys with more are at most one in ``most``
    left rows; they are broadcast if they are few, else joined by shuffle.
    """
    most = most or HOT
    hot = staged(left.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most).select(key, F.ceil(F.col("n") / most).cast("int").alias("deals")), "hot-keys")
    n = hot.count()
    if not n:
        return left.withColumn("deal", F.lit(0)), right.withColumn("deal", F.lit(0))
    hot = F.broadcast(hot) if n <= BROADCAST_IDS else hot
    deals = F.coalesce("deals", F.lit(1))
    one = left.join(hot, key, "left").withColumn("deal", F.pmod(F.xxhash64(by), deals).cast("int")).drop("deals")
    every = right.join(hot, key, "left").withColumn("deal", F.explode(F.sequence(F.lit(0), deals - 1))).drop("deals")
    return one, every


class Verifier:
    """Exact similarity of candidate pairs; each document's bag is made once."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, threshold: float):
        self.docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        self.threshold = threshold
        self.have: DataFrame | None = None

    def bags(self, ids: DataFrame) -> DataFrame:
        """(id, bag) of these ids, and of others asked for before."""
        if self.have is not None:
            ids = ids.join(self.have.select("id"), "id", "left_anti")
        ids = staged(ids, "ids-to-verify")
        new = staged(bag_rows(by_ids(self.docs, ids, ids.count(), "left_semi").select("id", "text")), "bags")
        self.have = new if self.have is None else self.have.unionByName(new)
        return self.have

    def near(self, x: str, y: str) -> Column:
        """Whether two bags reach the threshold; their sizes alone often tell that they don't."""
        small, large, both = F.least(F.size(x), F.size(y)), F.greatest(F.size(x), F.size(y)), F.size(F.array_intersect(x, y))
        return (small >= self.threshold * large) & (both >= self.threshold * (F.size(x) + F.size(y) - both))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold."""
        have = self.bags(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
        sides = []
        for side, bag in (("a", "x"), ("b", "y")):
            ids = staged(pairs.select(F.col(side).alias("id")).distinct(), "sides")
            sides.append(by_ids(have, ids, ids.count(), "left_semi").select(F.col("id").alias(side), F.col("bag").alias(bag)))
        met, y = dealt(pairs, sides[1], "b", "a")
        return staged(met.join(sides[0], "a").join(y, ["b", "deal"]).where(self.near("x", "y")).select("a", "b").distinct(), "links")

    def links_within(self, groups: DataFrame) -> DataFrame:
        """The linked pairs of different label within a group: (key, head, label, bands).

        A pair that shares several groups is compared in the one of least key.
        """
        have = self.bags(groups.select(F.col("head").alias("id")).distinct())
        rows = groups.join(have, F.col("head") == F.col("id")).select("key", "head", "label", "bands", "bag")
        hot = staged(groups.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_GROUP).select("key"), "hot-groups")
        if hot.isEmpty():
            return staged(self.compared(rows, rows, ["key"]), "links")
        cold = rows.join(hot, "key", "left_anti")
        one, every = dealt(rows.join(hot, "key", "left_semi"), rows.join(hot, "key", "left_semi"), "key", "head", HOT_GROUP)
        return staged(self.compared(cold, cold, ["key"]).unionByName(self.compared(one, every, ["key", "deal"])).distinct(), "links")

    def compared(self, one: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
        """Linked pairs (a, b) of different label among rows that agree in ``on``."""
        x, y = one.alias("x"), other.alias("y")
        once = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.key")
        met = (F.col("x.head") > F.col("y.head")) & (F.col("x.label") != F.col("y.label")) & once & self.near("x.bag", "y.bag")
        for c in on:
            met = (F.col(f"x.{c}") == F.col(f"y.{c}")) & met
        return x.join(y, met).select(F.col("x.head").alias("a"), F.col("y.head").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every id in the links: the least id that it is linked with, however far.

    Each round takes the least label among neighbours, then the label of that
    label; rounds grow with the logarithm of the longest chain in practice.
    """
    edges = staged(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = staged(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("label")), "labels")
    while True:
        near = edges.join(labels, F.col("v") == F.col("id")).groupBy("u").agg(F.min("label").alias("m"))
        hooked = labels.join(near, F.col("id") == F.col("u")).select("id", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("id").alias("root"), F.col("label").alias("beyond"))
        new = staged(hooked.join(jump, F.col("label") == F.col("root"), "left").select("id", "was", F.least("label", F.coalesce("beyond", "label")).alias("label")), "labels")
        if new.where(F.col("was") != F.col("label")).isEmpty():
            return new.select("id", "label")
        labels = new.select("id", "label")


def still_apart(members: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of groups whose members have different labels: key, head, label, lead and the lead's label."""
    labels = components(links).select(F.col("id").alias("head"), "label")
    told = staged(members.join(labels, "head", "left").select("key", "head", "lead", F.coalesce("label", "head").alias("label")), "told")
    stats = told.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.when(F.col("head") == F.col("lead"), F.col("label"))).alias("lead_label"))
    return staged(told.join(stats.where(F.col("low") != F.col("high")).select("key", "lead_label"), "key"), "apart")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Each row's id and class_id, the least id of the documents that it is linked with, over any number of links.

    Two documents are linked if the multiset Jaccard similarity of their
    five-word shingles is at least ``threshold``.  Words are runs of letters,
    digits, underscores and non-ASCII characters, in lower case; a text of one
    to four words is one shingle.

    Cases: null and empty texts, and texts without words, are alone.  Texts of one
    word sequence are one class before anything else.  Rows with one id count as
    one document, linked by any of its texts; each row is returned.  A null id is
    alone, with a null class.  Ids are integers; other types raise TypeError.
    Texts may be of any length.  Other columns are not read, whatever their names;
    an empty table gives no rows.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} is not of an integer type")
    seen = staged(sketch(docs, id_col, text_col, bands, rows), "sketches")
    known = seen.where(F.col("id").isNotNull() & (F.size("bands") > 0))
    heads = staged(known.groupBy("words").agg(F.min("id").alias("head"), F.first("bands").alias("bands")), "heads")
    same = known.select("id", "words").join(heads.select("words", "head"), "words").where(F.col("id") != F.col("head")).select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()

    keys = heads.select("head", F.explode("bands").alias("key"))
    groups = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = staged(keys.join(groups, "key"), "band-groups")
    central = shared.groupBy("head").agg(F.sum("n").alias("weight"))
    weighed = shared.join(central, "head").select("key", "head", F.struct("weight", (-F.col("head")).alias("less")).alias("place"))
    leads = weighed.groupBy("key").agg(F.max("place").alias("lead"))
    members = staged(weighed.join(leads, "key").select("key", "head", (-F.col("lead.less")).alias("lead"), F.col("lead.weight").alias("weight")), "members")

    verify = Verifier(docs, id_col, text_col, threshold)
    best = F.max(F.struct("weight", (-F.col("lead")).alias("less")))
    first = staged(members.where(F.col("head") != F.col("lead")).groupBy(F.col("head").alias("a")).agg(best.alias("best")).select("a", (-F.col("best.less")).alias("b")), "pairs")
    links = None
    if not first.isEmpty():
        links = verify.links(first)
        apart = still_apart(members, links)
        pairs = apart.where(F.col("label") != F.col("lead_label")).select(F.col("head").alias("a"), F.col("lead").alias("b")).distinct()
        pairs = staged(pairs.join(first, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            links = links.unionByName(verify.links(pairs))
        apart = still_apart(members, links)
        if not apart.isEmpty():
            links = links.unionByName(verify.links_within(apart.join(heads.select("head", "bands"), "head")))
    every = same if links is None else same.unionByName(links)
    labels = components(every)
    return seen.select("id").join(labels, "id", "left").select(F.col("id").alias(id_col), F.coalesce("label", "id").alias("class_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the first document of each class, and all rows with a null id.

    Cases: as in ``near_duplicates``.  Of rows with one id the one that is least
    as JSON stays, so reruns agree.  All columns stay as they are.
    """
    classes = staged(near_duplicates(docs, id_col), "classes")
    gone = staged(classes.where(F.col(id_col) != F.col("class_id")).select(F.col(id_col).cast("long").alias("__gone")).distinct(), "gone")
    name = "__row_id"
    some = lambda ids, how: docs.withColumn(name, F.col(id_col).cast("long")).join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, F.col(name) == F.col("__gone"), how).drop(name)
    again = staged(classes.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("__gone")).count().where("count > 1").drop("count"), "repeated")
    if again.isEmpty():
        return some(gone, "left_anti")
    stays = again.join(gone, "__gone", "left_anti")
    row = F.struct(*[F.col(c) for c in docs.columns])
    one = some(stays, "left_semi").groupBy(id_col).agg(F.min_by(row, F.to_json(row)).alias("__row")).select("__row.*")
    return some(gone.unionByName(again).distinct(), "left_anti").unionByName(one)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
