"""Documents as ordered lines, and the state machines over them as windows.

All windows share one partitioning (document) and order (line), so a plan that
uses several shuffles once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriscope.functions.fuzzy import contains_target, is_closing, looks_like_article, may_close, with_normal_form, within_distance
from juriscope.functions.text import apart, contains, corrected, holds, is_blank, is_title, starts_with, trimmed, trimmed_column
from juriscope.operators.acts import MARK, any_of, city_event, due_only, ends_footer, header_event, lead
from juriscope.rules import FRENCH_LAW, Rules


def by_line():
    """The one window of this module: a document's lines so far."""
    return Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def to_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, line_no and line of each document."""
    return docs.select("doc_id", F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line_no", "line"))


def held(event: Column) -> Column:
    """The last event so far that is not null."""
    return F.last(event, ignorenulls=True).over(by_line())


def ever(flag: Column) -> Column:
    return F.max(flag).over(by_line())


def joined(by: list[str], line: str = "line", sep: str = "\n"):
    """Lines of a group in order, as one string."""
    return F.array_join(F.sort_array(F.collect_list(F.struct("line_no", line)))[line], sep)


def repaired(lines: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """OCR lines corrected; within the body articles are normalised and titles dropped; the closing formula is restored."""
    line = F.col("line")
    printed = F.when((line >= "!") & (line < "\x7f"), True).otherwise(~is_blank(line))
    # a line that is known to be there takes less code, by which the methods stay under the JVM's limit
    base = lines.where(line.isNotNull()).select("doc_id", "line_no", trimmed_column(line).alias("line")).where(printed).select("doc_id", apart(F.col("line_no")).alias("line_no"), corrected(line, rules).alias("line"))
    # each test of a line stands once, before the window, which carries its answer
    closes = {c: f"closes_{i}" for i, c in enumerate(rules.closings)}
    near = lambda c: F.when(F.col("may_close"), within_distance(line, c, 20, 3)).otherwise(False)
    told = base.withColumn("may_close", may_close(line, rules)).select("doc_id", "line_no", "line", contains(line, rules.promulgation).alias("opens"), *[near(c).alias(name) for c, name in closes.items()])
    told = told.withColumn("ends", any_of(F.col(name) for name in closes.values()))
    earlier = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(F.col("ends"), False).when(F.col("opens"), True), ignorenulls=True).over(earlier)
    out = told.withColumn("before", before).withColumn("in_body", F.coalesce("before", F.lit(False)) | F.col("opens"))
    closing = line
    for c, name in closes.items():
        closing = F.when(F.col(name), F.concat(F.lit(c), F.substring("line", len(c) + 1, 1 << 30))).otherwise(closing)
    inside = F.col("in_body") & ~F.col("ends")
    out = out.withColumn("article", F.when(inside, looks_like_article(line, rules)).otherwise(False))
    # no line that opens an article is a title, as the two begin with unlike letters
    out = with_normal_form(out.where(~(inside & is_title(line))), "article", rules)
    new = F.when(F.col("in_body") & F.col("ends"), closing).when(F.col("article"), F.col("normal")).otherwise(line)
    return out.select("doc_id", "line_no", new.alias("line"), "in_body")


def body_state(lines: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """Whether each line lies in the body: on from the promulgation, off at the closing formula, as often as they come."""
    event = F.when(is_closing(F.col("line"), rules), False).when(contains(F.col("line"), rules.promulgation), True)
    return lines.select("doc_id", "line_no", F.coalesce(held(event), F.lit(False)).alias("in_body"))


def sections(lines: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """Each line with its section: header, body from the first article, footer from the closing after it."""
    article = ever(looks_like_article(F.col("line"), rules))
    with_body = lines.withColumn("has_article", article)
    foot = ever(F.col("has_article") & starts_with(F.col("line"), "Fait à"))
    section = F.when(F.col("foot"), "footer").when(F.col("has_article"), "body").otherwise("header")
    return with_body.withColumn("foot", foot).select("doc_id", "line_no", "line", section.alias("section"))


def section_rows(lines: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """doc_id, ``lines`` (line_no, line and whether it opens an article, in order), and of how many the header (h), and header and body together (b), consist.

    Each line is tested once, before a document's lines are gathered.
    """
    opens = looks_like_article(F.col("line"), rules)
    told = lines.select("doc_id", "line_no", "line", opens.alias("opens"), F.when(starts_with(F.col("line"), "Fait à"), F.col("line_no")).alias("c"))
    each = told.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "line", "opens"))).alias("lines"), F.min(F.when(F.col("opens"), F.col("line_no"))).alias("a"), F.collect_list("c").alias("c"))
    each = each.withColumn("f", F.array_min(F.filter("c", lambda x: x >= F.col("a"))))
    before = lambda c: F.when(F.col(c).isNull(), F.size("lines")).otherwise(F.array_position(F.col("lines")["line_no"], F.col(c)).cast("int") - 1)
    return each.select("doc_id", "lines", before("a").alias("h"), before("f").alias("b"))


def section_text(name: str) -> Column:
    """A section of ``section_rows`` as text."""
    start, stop = {"header": (F.lit(0), F.col("h")), "body": (F.col("h"), F.col("b")), "footer": (F.col("b"), F.size("lines"))}[name]
    return F.array_join(F.slice(F.col("lines")["line"], start + 1, stop - start), "\n").alias(name)


def section_texts(lines: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """Header, body and footer of each document; a missing one is empty."""
    return section_rows(lines, rules).select("doc_id", *map(section_text, ("header", "body", "footer")))


def marked_sections(lines: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """doc_id, ``lines`` (line_no, piece: the line with its lead, and the lead's length, in order), of how many the header (h), and header and body together (b), consist, and of each section whether a line of it is odd.

    Each line is tested once, as a column, before a document's lines are gathered.
    A line is odd if it can't be read by itself: it is to be trimmed, left out or
    cut, by what stands in it, or has two meanings.
    """
    line, section = F.col("line"), F.col("section")
    told = lines.withColumn("opens", looks_like_article(line, rules))
    # the last closing so far is that of a footer if an article stands at or before it
    told = told.withColumn("closing", starts_with(line, "Fait à"))
    at = lambda c: F.when(F.col(c), F.col("line_no"))
    told = told.select("*", F.min(at("opens")).over(by_line()).alias("first"), F.max(at("closing")).over(by_line()).alias("last"))  # at once, as each select is a window of its own
    told = told.withColumn("section", F.when(F.col("last") >= F.col("first"), "f").when(F.col("first").isNotNull(), "b").otherwise("h"))
    low = F.col("low")
    told = told.withColumn("low", F.when(section != "b", F.lower(line)))
    event = F.when(section == "h", header_event(line, rules, low)).when(section == "b", F.when(F.col("opens"), "a")).otherwise(city_event(line, low))
    told = told.withColumn("lead", F.when(section == "f", lead(event, "\n")).otherwise(lead(event, " ")))
    apart = rf"[\n\r\x0B\f\x{{85}}\x{{2028}}\x{{2029}}{MARK}]"
    odd = ~((line >= "!") & (F.right(line, F.lit(1)) >= "!")) | F.when(section == "h", (F.length(line) < 3) | line.rlike(rf"{apart}| , |.LOI|LOI$")).otherwise(line.rlike(apart))
    odd = odd | ((section == "f") & holds(low, "Fait à") & ends_footer(line, low))
    told = told.select("doc_id", "line_no", F.concat("lead", "line").alias("piece"), F.length("lead").alias("lead"), "section", odd.alias("odd"), ((section == "h") & F.startswith(line, F.lit("LOI"))).alias("title"))
    is_odd = [F.coalesce(F.bool_or((section == s) & F.col("odd")), F.lit(False)) for s in "hbf"]
    listed = F.sort_array(F.collect_list(F.struct("line_no", "piece", "lead"))).alias("lines")
    return told.groupBy("doc_id").agg(listed, F.count_if(section == "h").cast("int").alias("h"), F.count_if(section != "f").cast("int").alias("b"), (is_odd[0] | (F.count_if("title") > 1)).alias("odd_h"), is_odd[1].alias("odd_b"), is_odd[2].alias("odd_f"))


def of_section(name: str) -> tuple[Column, Column]:
    """A section of ``marked_sections``: its lines with their leads as one text, and without them, each a line of its own."""
    start, stop = {"h": (F.lit(0), F.col("h")), "b": (F.col("h"), F.col("b")), "f": (F.col("b"), F.size("lines"))}[name]
    bare = F.transform(F.slice("lines", start + 1, stop - start), lambda x: F.substr(x["piece"], x["lead"] + 1))
    return F.array_join(F.slice(F.col("lines")["piece"], start + 1, stop - start), ""), F.array_join(bare, "\n")


def articles(lines: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """Each article with its lines joined by a blank; lines before the first are left out."""
    numbered = lines.select("doc_id", "line_no", trimmed(F.col("line")).alias("line"), F.sum(looks_like_article(F.col("line"), rules).cast("int")).over(by_line()).alias("article_no"))
    return numbered.where((F.col("article_no") > 0) & (F.col("line") != "")).groupBy("doc_id", "article_no").agg(joined(["doc_id"], sep=" ").alias("content"))


def renumbered(articles: DataFrame) -> DataFrame:
    """Articles of an amending act: one counts only if it bears the number that is due; others are part of the one before.

    ``articles``: doc_id, article_no, number (int), content.
    """
    one = F.struct(F.col("article_no").cast("int").alias("place"), F.col("number").cast("string").alias("index"), "content")
    listed = articles.groupBy("doc_id").agg(F.sort_array(F.collect_list(one)).alias("a"))
    return renumbered_of(listed)


def renumbered_of(listed: DataFrame) -> DataFrame:
    """The same of documents whose articles stand in their row: doc_id, a (place, index, content)."""
    return listed.select("doc_id", F.explode(due_only(F.col("a"))).alias("x")).select("doc_id", F.col("x.place").alias("number"), "x.content")


def between_first(lines: DataFrame, start: Column, stop: Column) -> DataFrame:
    """Lines from the first that starts to the line before the first stop at or after it."""
    everything = Window.partitionBy("doc_id")
    marked = lines.withColumn("first", F.min(F.when(start, F.col("line_no"))).over(everything)).withColumn("stops", stop)
    marked = marked.withColumn("last", F.min(F.when(F.col("stops") & (F.col("line_no") >= F.col("first")), F.col("line_no"))).over(everything))
    return marked.where((F.col("line_no") >= F.col("first")) & (F.col("last").isNull() | (F.col("line_no") < F.col("last")))).drop("first", "last", "stops")


def header_fields(header: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """Number, object, deliberation and president: each line goes to the field that the last trigger opened."""
    line = trimmed(F.col("line"))
    target = F.lit(False)
    for t in rules.assembly:
        target = target | contains_target(F.col("line"), t, 3)
    starts = F.lit(False)
    for s in rules.object_starts:
        starts = starts | starts_with(F.col("line"), s)
    event = F.when(starts_with(F.col("line"), "LOI"), "number").when(starts, "object").when(target, "deliberation").when(contains(F.col("line"), rules.promulgation), "president")
    told = header.withColumn("line", line).where(F.length("line") > 2).withColumn("field", held(event)).where(F.col("field").isNotNull())
    return told.groupBy("doc_id", "field").agg(joined(["doc_id"], sep=" ").alias("value"))


def until_first(pages: DataFrame, hit: Column, by: str, order: str) -> DataFrame:
    """Rows up to and with the first hit."""
    before = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return pages.withColumn("done", F.coalesce(F.max(hit).over(before), F.lit(False))).where(~F.col("done")).drop("done")
