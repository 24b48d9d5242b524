"""Secret scans with multipart credential linking, in Column expressions only.

Spans of one kind come from the pieces between matches and the matches: their
lengths, summed along the text, are the places of the matches.

Some parts mean nothing alone: a name that could be an account, a string that
could be a key, an address.  Within a scope, an interval of the text around
each part, they are joined with the parts that complete them.  The interval join
is a sweep over the parts of one text in order of place, once from each end, that
carries the nearest part of each role; so it takes one pass, not pairs.

Folds over a text's matches run in two levels, over blocks of about the square
root of their number: Spark copies an array whenever a fold appends to it, and
so copies a short one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .stages import read_table

# Patterns of the parts.  The first three are reported wherever they stand.
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}+"
IDENT = r"""(?:(?i:username|user|login|account_id|client_id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)"""
KEY = r"[A-Za-z0-9+/]{32,}+={0,2}"
ENDPOINT = r"(?:https?|postgres|mysql|redis|amqp|mongodb)://[A-Za-z0-9._~:/?@%&=+-]+"

LEAST_SECRET, LEAST_ACCESS = 12, 18
#: Code points around a part within which another can complete it.
SCOPE = 400
KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
NONE = -(10**9)


#: Items of a block of a fold, at least.
BLOCK = 64


def let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def stepped(state: Column, result: Column) -> Column:
    return F.struct(state.alias("state"), result.alias("result"))


def scanned(items: Column, state: Column, step, kind: str) -> Column:
    """What ``step(state, item)``, a struct of ``state`` and ``result``, gives along an array: the results in order, of type ``kind``.

    Two levels: each block of items is folded into a short array, and those are
    joined at the end; the state runs through all blocks.
    """
    none, no_blocks = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def one(acc: Column, x: Column) -> Column:
        return let(step(acc["state"], x), lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["out"], r["result"]).alias("out")))

    def block(acc: Column, xs: Column) -> Column:
        folded = F.aggregate(xs, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return let(folded, lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["out"], r["out"]).alias("out")))

    def over(xs: Column, n: Column, size: Column) -> Column:
        blocks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")), lambda i: F.slice(xs, i * size + 1, size))).otherwise(F.array())
        return F.aggregate(blocks, F.struct(state.alias("state"), no_blocks.alias("out")), block, lambda acc: F.flatten(acc["out"]))

    # an expression that a lambda uses is computed anew for each element, so the items are bound first
    return let(items, lambda xs: let(F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(F.size(xs))).cast("int")), lambda size: over(xs, F.size(xs), size)))


SPAN = "struct<s:int,k:int,e:int>"


def spans(text: Column, pattern: str, kind: int, least: int, group: int = 0) -> Column:
    """Spans (start, kind, end) of the leftmost non-overlapping matches whose group has ``least`` characters or more.

    Places are code points.  Each piece of text stands before its match; the last has none.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    sizes = F.transform(parts, lambda x: F.struct(F.length(x["piece"]).alias("before"), F.coalesce(F.length(x["match"]), F.lit(0)).alias("own"), F.coalesce(F.length(x["value"]), F.lit(-1)).alias("value")))

    def step(at: Column, x: Column) -> Column:
        start = at + x["before"]
        end = start + x["own"]
        return stepped(end, F.struct(start.alias("s"), F.when(x["value"] >= least, kind).otherwise(-1).alias("k"), end.alias("e")))

    found = F.filter(scanned(sizes, F.lit(0), step, SPAN), lambda x: x["k"] >= 0)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


#: What a part completes: an account (access, ident), a secret (assign, key), a place (endpoint).
ROLE = {"assign": 1, "access": 0, "hex": 1, "ident": 0, "key": 1, "endpoint": 2}


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), kind + 1)


def _sweep(parts: Column, scope: int, forward: bool) -> Column:
    """For each part, in order: bits of the other roles that have a part within the scope on the side swept from."""
    state = F.struct(*[F.lit(NONE).alias(f"r{i}") for i in range(3)])

    def step(acc: Column, x: Column) -> Column:
        return let(_role(x["k"]), lambda role: met(acc, x, role))

    def met(acc: Column, x: Column, role: Column) -> Column:
        far = x["e"] if forward else -x["s"]
        near = x["s"] if forward else -x["e"]
        bits = sum((F.when((role != i) & (near - acc[f"r{i}"] <= scope), 1 << i).otherwise(0) for i in range(3)), F.lit(0))
        return stepped(F.struct(*[F.when(role == i, F.greatest(acc[f"r{i}"], far)).otherwise(acc[f"r{i}"]).alias(f"r{i}") for i in range(3)]), bits)

    return scanned(parts, state, step, "int")


def _covered(parts: Column) -> Column:
    """Each part, in order, and whether it is weak and overlaps a base part.  A sweep from each end carries the base parts' farthest place."""
    ahead = scanned(parts, F.lit(NONE), lambda at, x: stepped(F.when(x["k"] < 3, F.greatest(at, x["e"])).otherwise(at), at > x["s"]), "boolean")
    back = scanned(F.reverse(parts), F.lit(-NONE), lambda at, x: stepped(F.when(x["k"] < 3, F.least(at, x["s"])).otherwise(at), at < x["e"]), "boolean")
    return F.transform(F.arrays_zip(parts.alias("part"), ahead.alias("f"), F.reverse(back).alias("b")), lambda x: F.struct(x["part"].alias("part"), ((x["part"]["k"] >= 3) & (x["f"] | x["b"])).alias("covered")))


def linked(parts: Column, scope: int) -> Column:
    """The weak parts that a complementary part is in scope of.

    A key needs an account or an endpoint; an ident needs a secret; an endpoint needs a secret.
    """
    forward, backward = _sweep(parts, scope, True), F.reverse(_sweep(F.reverse(parts), scope, False))
    joined = F.arrays_zip(parts.alias("part"), forward.alias("f"), backward.alias("b"))

    def completed(x: Column) -> Column:
        bits = x["f"].bitwiseOR(x["b"])
        wanted = F.when(_role(x["part"]["k"]) == 1, bits.bitwiseAND(0b101)).otherwise(bits.bitwiseAND(0b010))
        return (x["part"]["k"] >= 3) & (wanted != 0)

    return F.transform(F.filter(joined, completed), lambda x: x["part"])


def written(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat(F.element_at(kinds, x["k"] + 1), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")


def by_place(found: Column) -> Column:
    """By start, then kind as listed (the fields of a span stand in that order)."""
    return F.array_sort(found)


def find_secrets(docs: DataFrame, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """``docs`` with ``base`` and ``found``: arrays of (s, k, e), the base spans and all spans, by start and kind.

    No shuffle and no Python: a row's spans come from that row.

    Cases: null text counts as empty and has no spans.  Repeated rows each get
    their spans.  A weak key that overlaps a base span is that span's and is not
    told again.  Texts may be of any length; places are code points.  All columns
    of the input stay; ``base`` and ``found`` replace columns of those names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(spans(text, ASSIGN, 0, LEAST_SECRET, 1), spans(text, ACCESS, 1, LEAST_ACCESS), spans(text, HEX, 2, 16))
    weak = F.concat(spans(text, IDENT, 3, 3, 1), spans(text, KEY, 4, 32), spans(text, ENDPOINT, 5, 8))
    marked = docs.withColumn("__base", by_place(base)).withColumn("__weak", weak)
    return joined_spans(marked, scope)


def joined_spans(marked: DataFrame, scope: int) -> DataFrame:
    """Weak parts joined with what completes them; rows without weak parts skip the sweeps."""
    base, weak = F.col("__base"), F.col("__weak")
    none = F.array().cast(f"array<{SPAN}>")
    marked = marked.withColumn("__all", F.when(F.size(weak) > 0, by_place(F.concat(base, weak))).otherwise(none))
    shown = F.transform(F.filter(_covered(F.col("__all")), lambda x: (x["part"]["k"] != 4) | ~x["covered"]), lambda x: x["part"])
    marked = marked.withColumn("__parts", F.when(F.exists("__all", lambda x: x["k"] == 4), shown).otherwise(F.col("__all")))
    added = F.when(F.exists("__parts", lambda x: x["k"] >= 3), linked(F.col("__parts"), scope)).otherwise(none)
    return marked.withColumn("base", base).withColumn("found", F.when(F.size(weak) > 0, by_place(F.concat(base, added))).otherwise(base)).drop("__base", "__weak", "__all", "__parts")


def redacted(docs: DataFrame, mask: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every span of its text replaced by ``mask``; n_chars follows if there is one.

    Cases: null stays null; spans that overlap are replaced by one mask; other
    columns stay as they are, whatever their names.  Repeated rows each get theirs.
    """
    only = docs.select(*docs.columns, F.struct("*").alias("__row"))
    seen = find_secrets(only.select("__row", F.col("text")), "text", scope)
    text = F.col("text")
    empty = F.lit(0)

    def step(at: Column, x: Column) -> Column:
        kept = F.concat(F.substr(text, at + 1, x["s"] - at), F.lit(mask))
        return stepped(F.greatest(at, x["e"]), F.when(x["s"] >= at, kept).otherwise(""))

    last = F.array_max(F.transform("found", lambda x: x["e"]))
    cut = F.concat(F.array_join(scanned(F.col("found"), empty, step, "string"), ""), F.substr(text, last + 1))
    clean = seen.withColumn("__clean", F.when(F.size("found") > 0, cut).otherwise(text))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("__clean").alias(name)
        if name == "n_chars":
            return F.when(F.size("found") > 0, F.length("__clean").cast(docs.schema[name].dataType)).otherwise(F.col("__row")[name]).alias(name)
        return F.col("__row")[name].alias(name)

    return clean.select(*map(column, docs.columns))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    count = lambda kind: F.size(F.filter("base", lambda x: x["k"] == kind)).cast("long")
    return find_secrets(docs).select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))


def _sql_kind(kind: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''").replace("{16,}+", "{16,}").replace("{32,}+", "{32,}")
    return f"""
  SELECT row_id, {kind} AS k, s, e FROM (
    SELECT row_id, len(v) AS n, CAST(sum(len(p) + coalesce(len(m), 0)) OVER w AS BIGINT) AS e, CAST(sum(len(p) + coalesce(len(m), 0)) OVER w - coalesce(len(m), 0) AS BIGINT) AS s
    FROM (SELECT row_id, unnest(string_split_regex(text, '{p}')) AS p, unnest(regexp_extract_all(text, '{p}', 0)) AS m,
                 unnest(regexp_extract_all(text, '{p}', {group})) AS v, generate_subscripts(string_split_regex(text, '{p}'), 1) AS i
          FROM d WHERE regexp_matches(text, '{p}'))
    WINDOW w AS (PARTITION BY row_id ORDER BY i ROWS UNBOUNDED PRECEDING)) WHERE n >= {least}"""


ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
base AS MATERIALIZED ({" UNION ALL ".join(_sql_kind(*x) for x in ((0, ASSIGN, 1, 12), (1, ACCESS, 0, 18), (2, HEX, 0, 16)))}),
weak AS MATERIALIZED ({" UNION ALL ".join(_sql_kind(*x) for x in ((3, IDENT, 1, 3), (4, KEY, 0, 32), (5, ENDPOINT, 0, 8)))}),
own AS (SELECT * FROM weak w WHERE k <> 4 OR NOT EXISTS (SELECT 1 FROM base b WHERE b.row_id = w.row_id AND b.s < w.e AND w.s < b.e)),
parts AS (SELECT *, [1, 0, 1, 0, 1, 2][k + 1] AS role FROM (SELECT * FROM base UNION ALL SELECT * FROM own)),
added AS (
  SELECT DISTINCT a.row_id, a.k, a.s, a.e FROM parts a JOIN parts b
    ON a.row_id = b.row_id AND a.role <> b.role AND (a.role = 1 OR b.role = 1) AND b.s - a.e <= {SCOPE} AND a.s - b.e <= {SCOPE}
  WHERE a.k >= 3),
told AS (SELECT row_id, k, s, e, {list(KINDS)}[k + 1] || ':' || s || ':' || e AS t FROM (SELECT * FROM base UNION ALL SELECT * FROM added)),
r AS (
  SELECT row_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
         coalesce(string_agg(t, ',' ORDER BY s, k) FILTER (WHERE k < 3), '') AS base, string_agg(t, ',' ORDER BY s, k) AS spans
  FROM told GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r USING (row_id)
"""
