"""Mixing sources to target weights by capped water-filling.

Each source's share of the words wanted follows its weight.  A source stops at
``max_epochs`` times its own size; what it cannot take is dealt again over the
others in proportion to their weights, until none is above its cap.  A source
that is to be taken 2.3 times gives every document twice, and the documents
that come first in a seeded order once more, until their words reach 0.3 of
the source; the document on that border gives the fraction that is missing.

The order's running sum is never taken over a whole source: words are summed
by slice of the seeded hash, the slice on the border is found from those sums,
and only its documents are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stages import read_table, running, staged

#: Weights by the rank of a source, repeating.
WEIGHTS = (5, 2, 1)
#: Slices of the seeded order within a source.
SLICES = 4096
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded(key: Column, seed: int) -> Column:
    """Hex digest that puts documents in an order that only the seed and the key decide."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def water_fill(sources: DataFrame, share: float = 1.0, max_epochs: int = 3) -> DataFrame:
    """``sources`` (source, weight, source_size) with its target.

    Sources fill in order of their cap over their weight.  At each, the level is
    what is left for it and those after it over their weights; the first source
    that the level does not fill sets it, and those before it stop at their caps.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    sources = staged(sources, "mix-sources")
    total = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    wanted = (total["size"] or 0) if share == 1.0 else float(total["size"] or 0) * share
    ordered = running(sources, [cap / F.col("weight"), F.col("source").asc_nulls_first()], {"held": cap, "passed": F.col("weight")}, "mix-order")
    left, still = F.lit(wanted) - F.col("held"), F.lit(total["weight"] or 0) - F.col("passed")
    first = ordered.where(F.col("weight") * left <= cap * still).agg(F.min_by(left.cast("double") / still.cast("double"), "place").alias("level")).first()
    if first["level"] is None:
        return sources.withColumn("target", cap.cast("double"))
    reached = F.col("weight") * F.lit(float(first["level"]))
    return sources.withColumn("target", F.least(reached, cap.cast("double")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: int = 0, slices: int = SLICES) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row.

    ``taken``: words that the mix takes from the row, repeats counted; the sum
    over a source is its target to a word.

    Cases: null text and text without words have size 0 and are taken 0 times.
    Null is a source of its own, the last.  A source without words has target 0.
    Rows with one doc_id, whether equal or not, are each counted; they stand
    together in the seeded order, by size, and those of one size share the
    fraction that falls to them in the order of their rank.  Texts may be of any
    length.  Other columns are not read, whatever their names; an empty table
    gives no rows.
    """
    sized = staged(docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size")), "mix-sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running(by_source, [F.col("source").asc_nulls_last()], {}, "mix-ranks")
    weight = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    targets = staged(water_fill(ranked.withColumn("weight", weight).drop("place"), max_epochs=max_epochs), "mix-targets")

    width = F.try_divide(F.col("target"), F.col("source_size"))
    plan = targets.withColumn("whole", F.coalesce(F.floor(width), F.lit(0)).cast("long"))
    plan = plan.withColumn("extra", F.greatest(F.floor(F.col("target") + 0.5).cast("long") - F.col("whole") * F.col("source_size"), F.lit(0)))
    key = seeded(F.col("doc_id"), seed)
    placed = sized.withColumn("key", key).withColumn("slice", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % slices)
    sums = placed.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    same = F.col("p.source").eqNullSafe(F.col("s.source"))
    borders = sums.withColumn("before", before).alias("s").join(plan.alias("p"), same).select(
        F.col("s.source").alias("source"), "slice", "before", "source_size", "target", "whole", "extra", (F.col("before") + F.col("words") <= F.col("extra")).alias("inside"), (F.col("before") >= F.col("extra")).alias("outside")
    )
    joined = placed.alias("d").join(borders.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.slice") == F.col("b.slice"))).select("d.doc_id", "d.size", "d.key", "d.source", "d.slice", "b.source_size", "b.target", "b.whole", "b.extra", "b.before", "b.inside", "b.outside")
    clear = joined.where(F.col("inside") | F.col("outside")).withColumn("part", F.when(F.col("inside"), F.col("size")).otherwise(0))
    order = Window.partitionBy("source", "slice").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    unclear = joined.where(~F.col("inside") & ~F.col("outside"))
    reached = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    unclear = unclear.withColumn("part", F.least(F.greatest(F.col("extra") - reached, F.lit(0)), F.col("size")))
    taken = F.least(F.col("whole") * F.col("size") + F.col("part"), F.col("size") * max_epochs)
    return clear.unionByName(unclear).select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), taken.cast("long").alias("taken"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat('0:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
c AS (
  SELECT *, coalesce(sum(3 * source_size) OVER o, 0) AS held, total - coalesce(sum(weight) OVER o, 0) AS open
  FROM (SELECT *, sum(weight) OVER () AS total FROM w)
  WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT CAST((SELECT sum(source_size) FROM s) - held AS DOUBLE) / CAST(open AS DOUBLE) AS level FROM c
  WHERE weight * ((SELECT sum(source_size) FROM s) - held) <= 3 * source_size * open
  ORDER BY 3 * source_size / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN weight * (SELECT level FROM l) > 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE weight * (SELECT level FROM l) END AS target
  FROM w),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
e AS (SELECT *, greatest(CAST(floor(target + 0.5) AS BIGINT) - whole * source_size, 0) AS extra FROM p),
o AS (
  SELECT doc_id, size, source_size, target, whole, extra,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY (CAST(concat('0x', left(key, 8)) AS BIGINT)) % 4096, key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(least(whole * size + least(greatest(extra - before, 0), size), 3 * size) AS BIGINT) AS taken
FROM o
"""
