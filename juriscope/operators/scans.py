"""The line states of documents of any length: scans in two levels.

``lines.py`` runs along a document in one window, so a document is one task.
Here a document is cut into slices of lines.  Each slice is folded to a summary
(the last event, whether there was one, a sum); the summaries, a row for each
slice, are scanned along the document; and each slice starts from what came
before it.  A task holds a slice, whatever the document's length.

Lines are shuffled once, by document and slice, with what came before each slice;
lines that are dealt by document already are not shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriscope.functions.fuzzy import is_closing, looks_like_article
from juriscope.functions.text import begins, contains, starts_with, trimmed
from juriscope.rules import FRENCH_LAW, Rules

#: Numbers of lines that a slice spans.
SLICE = 4096
#: How a state is folded over some lines: the last that is not null, the greatest, the least, the sum.
FOLDS = {"last": lambda c: F.last(c, ignorenulls=True), "ever": F.max, "least": F.min, "sum": F.sum}
SUMMARY = {"last": lambda c, line: F.max_by(c, F.when(c.isNotNull(), line)), "ever": lambda c, line: F.max(c), "least": lambda c, line: F.min(c), "sum": lambda c, line: F.sum(c)}


def sliced(lines: DataFrame, size: int = SLICE) -> DataFrame:
    """Lines with the slice of their document that they lie in."""
    return lines.withColumn("slice", F.floor(F.col("line_no") / size).cast("long"))


def scanned(lines: DataFrame, **states: tuple[str, Column]) -> DataFrame:
    """Lines (doc_id, slice, line_no, ...) with each state along its document, as a name and (fold, value of a line).

    Folds: ``last`` (the last value so far that is not null), ``ever`` (the greatest
    so far), ``least`` (the least so far), ``sum`` (of all so far).  Each includes the line itself.
    """
    made = lines.select("*", *[c.alias(f"__{n}") for n, (_, c) in states.items()])
    folded = made.groupBy("doc_id", "slice").agg(*[SUMMARY[fold](F.col(f"__{n}"), F.col("line_no")).alias(n) for n, (fold, _) in states.items()])
    earlier = Window.partitionBy("doc_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # a row for each slice
    before = folded.select("doc_id", "slice", *[FOLDS[fold](n).over(earlier).alias(f"__{n}") for n, (fold, _) in states.items()])
    # what came before a slice stands in it as a line before its first, so no join is needed
    before = before.where(reduce(lambda a, n: a | F.col(f"__{n}").isNotNull(), states, F.lit(False))).withColumn("__line", F.lit(False))
    both = made.withColumn("__line", F.lit(True)).unionByName(before, allowMissingColumns=True)
    within = Window.partitionBy("doc_id", "slice").orderBy("__line", "line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = both.select(*lines.columns, "__line", *[FOLDS[fold](f"__{n}").over(within).alias(n) for n, (fold, _) in states.items()])
    return told.where("__line").drop("__line")


def body_state(lines: DataFrame, rules: Rules = FRENCH_LAW, size: int = SLICE) -> DataFrame:
    """Whether each line lies in the body, as ``lines.body_state`` tells it."""
    event = F.when(is_closing(F.col("line"), rules), False).when(contains(F.col("line"), rules.promulgation), True)
    told = scanned(sliced(lines, size), state=("last", event))
    return told.select("doc_id", "line_no", F.coalesce("state", F.lit(False)).alias("in_body"))


def sections(lines: DataFrame, rules: Rules = FRENCH_LAW, size: int = SLICE) -> DataFrame:
    """Each line with its section, as ``lines.sections`` tells it: the footer has begun if the last closing so far is at or after the first article so far."""
    closes = F.when(begins(F.col("line"), "f"), starts_with(F.col("line"), "Fait à")).otherwise(False)
    opens = looks_like_article(F.col("line"), rules)
    told = scanned(sliced(lines, size), first=("least", F.when(opens, F.col("line_no"))), closed=("ever", F.when(closes, F.col("line_no"))))
    section = F.when(F.col("closed") >= F.col("first"), "footer").when(F.col("first").isNotNull(), "body").otherwise("header")
    return told.select("doc_id", "line_no", "line", section.alias("section"))


def article_numbers(lines: DataFrame, rules: Rules = FRENCH_LAW, size: int = SLICE) -> DataFrame:
    """Trimmed lines with the number of the article that they lie in, 0 before the first."""
    told = scanned(sliced(lines, size), article_no=("sum", looks_like_article(F.col("line"), rules).cast("long")))
    return told.select("doc_id", "line_no", trimmed(F.col("line")).alias("line"), "article_no")


def articles(lines: DataFrame, rules: Rules = FRENCH_LAW, size: int = SLICE) -> DataFrame:
    """Each article with its lines joined by a blank, as ``lines.articles`` tells it.

    A slice joins its own lines of an article first, so a document's long last
    article reaches its row as a string for each slice.
    """
    kept = article_numbers(lines, rules, size).where((F.col("article_no") > 0) & (F.col("line") != "")).withColumn("slice", F.floor(F.col("line_no") / size))
    text = lambda by: F.array_join(F.sort_array(F.collect_list(F.struct(by, "line")))["line"], " ")
    parts = kept.groupBy("doc_id", "slice", "article_no").agg(text("line_no").alias("line"))
    return parts.groupBy("doc_id", "article_no").agg(text("slice").alias("content"))


def header_fields(header: DataFrame, event: Column, size: int = SLICE) -> DataFrame:
    """Header lines with the field that the last trigger opened, as ``event`` names it; those before the first are left out."""
    return scanned(sliced(header, size), field=("last", event)).where(F.col("field").isNotNull()).drop("slice")
