"""WARC records: not-modified revisits resolved to the full response that they repeat.

A revisit (a server's 304, or a crawler's own) has no body.  It is joined as of
its date with the latest earlier full response of the same canonical URL; that
response counts if a validator of the revisit agrees with it; and the answer is
the response's headers, with those that a 304 may change taken from the revisit.

The as-of join runs in two steps so that a URL with very many captures is not
one task.  Captures are cut by date into slots.  The last full response of each
(URL, slot) is one row; a window over those few rows carries the latest one into
each slot; and within a slot a window over its own records finds a later one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stages import read_table

#: Seconds of a slot.
SLOT_SECONDS = 3600
# Headers that a not-modified answer may bring up to date (RFC 9110, 15.4.5; RFC 9111, 4.3.4).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "age", "warning")
# Query parameters that do not choose a resource.
TRACKING = r"(?:utm_[a-z]+|fbclid|gclid|sessionid)"


def canonical_url(url: Column) -> Column:
    """Scheme and ``www.`` dropped, host in lower case, default port, fragment, tracking parameters and closing slashes dropped.

    Null stays null.
    """
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, r"^[^/?]*", 0)), r"^www\.", ""), r":(?:80|443)$", "")
    rest = F.regexp_replace(u, r"^[^/?]*", "")
    rest = F.regexp_replace(rest, r"([?&])" + TRACKING + r"=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, r"&+", "&"), r"\?&", "?")
    rest = F.regexp_replace(rest, r"[?&]+$", "")
    rest = F.regexp_replace(rest, r"/+$", "")
    return F.concat(host, rest)


def lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that then agree the last in order stays; null is empty."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    last = F.aggregate(
        F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>")),
        F.array().cast("array<struct<key:string,value:string>>"),
        lambda acc, e: F.array_append(F.filter(acc, lambda x: x["key"] != e["key"]), e),
    )
    return F.map_from_entries(last)


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers, those in PERMITTED replaced or joined by the fresh ones."""
    allowed = F.map_filter(fresh, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(kept, allowed)


def strong(tag: Column) -> Column:
    """An entity tag for weak comparison: without W/ and white space."""
    return F.regexp_replace(F.trim(tag), r"^W/", "")


def resolve_revisits(records: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """Each revisit with the response that it repeats.

    ``records``: record_id, warc_type ("response" or "revisit"), url, date
    (timestamp), status (int), digest (of the payload; a revisit's may be null),
    headers (map).

    Result, a row for each revisit: record_id, url_key, refers_to (the latest
    earlier full response, null if there is none), verdict ("no-earlier-response",
    "validator-mismatch", "etag", "last-modified", "digest" or "unchecked"),
    status (the response's, where the verdict accepts it) and headers (merged).

    Validators: the entity tag decides if both have one; else Last-Modified;
    else the digest; with none on both sides the latest response is taken
    "unchecked".  A full response is one of status 200 with type "response".

    Cases: a revisit without URL or date has no earlier response.  Records with
    one date are ordered by record_id; "earlier" means before in (date, record_id).
    Repeated rows are each resolved.  Null headers are empty.  Other columns are
    not read; an empty table gives no rows.
    """
    order = F.struct("date", "record_id")
    r = records.select(
        "record_id", F.col("warc_type"), canonical_url(F.col("url")).alias("url_key"), F.col("date").cast("timestamp").alias("date"), F.col("status").cast("int").alias("status"), "digest", lower_keys(F.col("headers")).alias("headers")
    )
    r = r.withColumn("slot", F.floor(F.unix_timestamp("date") / slot_seconds))
    full = (F.col("warc_type") == "response") & (F.col("status") == 200)
    whole = F.when(F.coalesce(full, F.lit(False)) & F.col("date").isNotNull() & F.col("url_key").isNotNull(), F.struct("date", "record_id", "status", "digest", F.to_json("headers").alias("headers")))
    r = r.withColumn("whole", whole)
    lost = r.where((F.col("warc_type") == "revisit") & (F.col("date").isNull() | F.col("url_key").isNull())).withColumn("found", F.lit(None).cast(r.schema["whole"].dataType))
    r = r.where(F.col("date").isNotNull() & F.col("url_key").isNotNull())

    slots = r.groupBy("url_key", "slot").agg(F.max("whole").alias("last"))
    before = F.last("last", ignorenulls=True).over(Window.partitionBy("url_key").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    carried = slots.withColumn("carried", before).select("url_key", "slot", "carried")
    own = F.last("whole", ignorenulls=True).over(Window.partitionBy("url_key", "slot").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    seen = r.withColumn("own", own).where(F.col("warc_type") == "revisit").join(carried, ["url_key", "slot"], "left")
    found = seen.withColumn("found", F.coalesce("own", "carried")).drop("own", "carried").unionByName(lost.select(*[c for c in seen.columns if c not in ("own", "carried")], "found"))

    stored = F.from_json(F.col("found.headers"), "map<string,string>")
    f = found.withColumn("stored", stored)
    tag, their_tag = strong(F.col("headers")["etag"]), strong(F.col("stored")["etag"])
    since, their_since = F.col("headers")["last-modified"], F.col("stored")["last-modified"]
    verdict = (
        F.when(F.col("found").isNull(), "no-earlier-response")
        .when(tag.isNotNull() & their_tag.isNotNull(), F.when(tag == their_tag, "etag").otherwise("validator-mismatch"))
        .when(since.isNotNull() & their_since.isNotNull(), F.when(since == their_since, "last-modified").otherwise("validator-mismatch"))
        .when(F.col("digest").isNotNull() & F.col("found.digest").isNotNull(), F.when(F.col("digest") == F.col("found.digest"), "digest").otherwise("validator-mismatch"))
        .otherwise("unchecked")
    )
    f = f.withColumn("verdict", verdict)
    good = ~F.col("verdict").isin("no-earlier-response", "validator-mismatch")
    return f.select(
        "record_id", "url_key", F.col("found.record_id").alias("refers_to"), "verdict", F.when(good, F.col("found.status")).alias("status"), F.when(good, merged_headers(F.col("stored"), F.col("headers"))).alias("headers")
    )


def page_records(pages: DataFrame) -> DataFrame:
    """Four crawls of ``pages`` as WARC records, by rule, so that a revisit has up to two earlier responses.

    Day 0 takes a full response of every page but those whose id leaves 3 on
    division by 11, a second after another in order of page_id.  Day 1 meets
    changed pages (0 on division by 3): a new body, tag and date.  On day 2 every
    page is revisited and answers 304: by tag; by date alone (5 on division by 7);
    by the payload's digest alone (4); with a tag that no crawl took (6); or with
    no validator at all (0 on division by 13).  On day 3 pages that day 0 left out
    get a response, too late for the revisit.
    """
    at = lambda day: F.timestamp_seconds(F.lit(1_700_000_000 + 86_400 * day) + F.col("page_id"))
    hashed = lambda version: F.sha2(F.concat(F.coalesce("html", F.lit("")), F.lit("" if version == 0 else "+")), 256)
    tagged = lambda version: F.concat(F.lit('"'), F.substring(F.col(f"d{version}"), 1, 16), F.lit('"'))
    dated = lambda version: F.concat(F.lit(f"day {version} "), F.pmod("page_id", F.lit(28)).cast("string"))
    rest = lambda n: F.pmod("page_id", F.lit(n))
    there = lambda entries: F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull())
    p = pages.select("page_id", "url", hashed(0).alias("d0"), hashed(1).alias("d1"), F.octet_length(F.col("html")).alias("n"))

    def response(number: int, day: int, version: int, taken: Column) -> DataFrame:
        headers = there([F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), tagged(version), F.lit("Last-Modified"), dated(version), F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Content-Length"), (F.col("n") + version).cast("string")])
        return p.where(taken).select((F.col("page_id") * 4 + number).alias("record_id"), F.lit("response").alias("warc_type"), "url", at(day).alias("date"), F.lit(200).alias("status"), F.col(f"d{version}").alias("digest"), headers.alias("headers"))

    changed = rest(3) == 0
    now = lambda made: F.when(changed, made(1)).otherwise(made(0))
    bare, by_date, by_digest = rest(13) == 0, rest(7) == 5, rest(7) == 4
    tag = F.when(bare | by_date | by_digest, None).when(rest(7) == 6, F.lit('"new"')).otherwise(F.concat(F.lit("W/"), now(tagged)))
    headers = there([F.lit("etag"), tag, F.lit("Last-Modified"), F.when(bare | by_digest, None).otherwise(now(dated)), F.lit("Cache-Control"), F.lit("max-age=600"), F.lit("Content-Length"), F.lit("0")])
    digest = F.when(by_digest & ~bare, now(lambda version: F.col(f"d{version}")))
    revisit = p.select((F.col("page_id") * 4 + 2).alias("record_id"), F.lit("revisit").alias("warc_type"), "url", at(2).alias("date"), F.lit(304).alias("status"), digest.alias("digest"), headers.alias("headers"))
    return response(0, 0, 0, rest(11) != 3).unionByName(response(1, 1, 1, changed)).unionByName(revisit).unionByName(response(3, 3, 0, rest(11) == 3))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve_revisits(page_records(read_table(spark, sf_dir, "pages")))
    text = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return out.select("record_id", "url_key", "refers_to", "verdict", "status", text.alias("headers"))


def _canonical_sql(url: str) -> str:
    u = f"regexp_replace(regexp_replace(trim({url}), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    host = f"regexp_replace(regexp_replace(lower(regexp_extract({u}, '^[^/?]*', 0)), '^www\\.', ''), ':(?:80|443)$', '')"
    rest = f"regexp_replace({u}, '^[^/?]*', '')"
    rest = f"regexp_replace({rest}, '([?&]){TRACKING}=[^&]*', '\\1', 'g')"
    rest = f"regexp_replace(regexp_replace({rest}, '&+', '&', 'g'), '\\?&', '?', 'g')"
    rest = f"regexp_replace(regexp_replace({rest}, '[?&]+$', ''), '/+$', '')"
    return f"{host} || {rest}"


ORACLE = f"""
WITH p AS (
  SELECT page_id, {_canonical_sql("url")} AS url_key, [sha256(coalesce(html, '')), sha256(coalesce(html, '') || '+')] AS d, strlen(html) AS n FROM pages),
f AS (
  SELECT page_id * 4 + number AS record_id, url_key, 1700000000 + 86400 * number + page_id AS ts, d[version + 1] AS digest,
         '"' || left(d[version + 1], 16) || '"' AS tag, 'day ' || version || ' ' || (page_id % 28) AS day, n + version AS n
  FROM p, (VALUES (0, 0), (1, 1), (3, 0)) v(number, version)
  WHERE url_key IS NOT NULL AND CASE number WHEN 0 THEN page_id % 11 <> 3 WHEN 1 THEN page_id % 3 = 0 ELSE page_id % 11 = 3 END),
r AS (
  SELECT page_id * 4 + 2 AS record_id, url_key, 1700000000 + 172800 + page_id AS ts, page_id % 13 = 0 AS bare, page_id % 7 AS rest,
         CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END AS version, d[version + 1] AS digest, 'day ' || version || ' ' || (page_id % 28) AS day FROM p),
s AS (
  SELECT record_id, url_key, ts, CASE WHEN bare OR rest IN (4, 5) THEN NULL WHEN rest = 6 THEN '"new"' ELSE '"' || left(digest, 16) || '"' END AS tag,
         CASE WHEN bare OR rest IN (4, 5) THEN NULL WHEN rest = 6 THEN '"new"' ELSE 'W/"' || left(digest, 16) || '"' END AS sent,
         CASE WHEN bare OR rest = 4 THEN NULL ELSE day END AS day, CASE WHEN rest = 4 AND NOT bare THEN digest END AS digest FROM r),
j AS (
  SELECT s.*, f.record_id AS refers_to, f.tag AS their_tag, f.day AS their_day, f.digest AS their_digest, f.n
  FROM s ASOF LEFT JOIN f ON s.url_key = f.url_key AND s.ts > f.ts),
v AS (
  SELECT *, CASE WHEN refers_to IS NULL THEN 'no-earlier-response'
                 WHEN tag IS NOT NULL THEN CASE WHEN tag = their_tag THEN 'etag' ELSE 'validator-mismatch' END
                 WHEN day IS NOT NULL THEN CASE WHEN day = their_day THEN 'last-modified' ELSE 'validator-mismatch' END
                 WHEN digest IS NOT NULL THEN CASE WHEN digest = their_digest THEN 'digest' ELSE 'validator-mismatch' END
                 ELSE 'unchecked' END AS verdict FROM j)
SELECT record_id, url_key, refers_to, verdict, CASE WHEN verdict NOT IN ('no-earlier-response', 'validator-mismatch') THEN 200 END AS status,
       CASE WHEN verdict NOT IN ('no-earlier-response', 'validator-mismatch') THEN
         'cache-control=max-age=600;' || CASE WHEN n IS NOT NULL THEN 'content-length=' || n || ';' ELSE '' END || 'content-type=text/html'
         || ';etag=' || coalesce(sent, their_tag) || ';last-modified=' || coalesce(day, their_day) END AS headers
FROM v
"""
