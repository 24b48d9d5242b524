"""The life of an act: text to lines, sections, metadata, articles, signatories, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriscope.functions.fuzzy import let, standard_number
from juriscope.functions.text import after_first, french_date, from_first_digit, is_blank, repair_date, single_line_column, source_url, valid_url, written_date, written_month
from juriscope.operators import acts, edits
from juriscope.operators.lines import marked_sections, of_section, repaired, to_lines
from juriscope.operators.metadata import signatories
from juriscope.rules import FRENCH_LAW, Rules
from juriscope.sources.adapters import Adapter
from juriscope.sources.shared import shared_path

PEOPLE = "array<struct<name:string,role:string>>"
ARTICLES = "array<struct<index:string,content:string>>"


def act_sections(texts: DataFrame, rules: Rules = FRENCH_LAW, header: str = acts.HEADER, footer: str = acts.FOOTER) -> DataFrame:
    """``texts`` (doc_id, header, body, footer) with head and foot (cleaned texts) and articles, each an expression over the document's row."""
    told = texts.withColumn("head", let(acts.cleaned_header(F.col("header"), rules), lambda x: acts.header_text(x, header)))
    told = told.withColumn("foot", F.when(is_blank(F.col("footer")), "").otherwise(let(acts.cleaned_footer(F.col("footer")), lambda x: acts.footer_text(x, footer))))
    return told.withColumn("articles", acts.articles_of(F.col("body"), rules))


def marked_acts(rows: DataFrame, rules: Rules = FRENCH_LAW, header: str = acts.HEADER, footer: str = acts.FOOTER) -> DataFrame:
    """``act_sections`` of rows as ``marked_sections`` gives them: only sections that hold an odd line are read from their whole text; each step is a column, so Spark compiles it."""
    wanted = [c for c in rows.columns if c not in ("lines", "h", "b", "odd_h", "odd_b", "odd_f")]
    whole = {s: F.when(F.col(f"odd_{s}"), of_section(s)[1]).otherwise(of_section(s)[0]).alias(f"whole_{s}") for s in "hbf"}
    told = rows.select(*wanted, *whole.values(), "odd_h", "odd_b", "odd_f", (F.size("lines") > F.col("b")).alias("closed"))
    told = told.withColumn("elsewhere", acts.in_porto_novo(F.col("whole_f")))
    either = lambda s, of_text, of_marks: F.when(F.col(f"odd_{s}"), of_text).otherwise(of_marks).alias(f"marks_{s}")
    w = lambda s: F.col(f"whole_{s}")
    told = told.select(*wanted, "whole_h", "closed", "elsewhere", either("h", acts.header_marks(w("h"), rules), w("h")), either("b", acts.body_marks(w("b"), rules), w("b")), either("f", acts.footer_marks(w("f"), F.col("elsewhere")), acts.in_city(w("f"), F.col("elsewhere"))))
    # each part is a column of its own, as a struct would be made anew for each of its fields
    kinds = acts.header_kinds(F.col("marks_h"))
    told = told.select("*", *[c.alias(f"lines_{x}") for x, c in kinds.items()])
    head, foot = acts.header_text(acts.header_parts(w("h"), {x: F.col(f"lines_{x}") for x in kinds}, single_line_column), header), acts.footer_text(acts.footer_parts(F.col("marks_f"), F.col("elsewhere")), footer)
    return told.select(*wanted, head.alias("head"), F.when(F.col("closed"), foot).otherwise("").alias("foot"), acts.as_articles(acts.pieces_of(F.col("marks_b"))).alias("articles"))


def read_fields(told: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """Sections with law_number, law_object, law_date, and the articles that count."""
    kept = told.columns
    told = told.withColumn("law_number", acts.number_in(F.col("head"), rules)).withColumn("law_object", acts.object_in(F.col("head"), rules))
    told = told.select(*kept, from_first_digit(single_line_column(F.col("law_number"))).alias("law_number"), single_line_column(F.col("law_object")).alias("law_object"))
    # most dates are written without a slip, so they need no step that Spark does not compile
    said = F.col("said")
    told = told.withColumn("said", after_first(F.col("law_number"), "DU")).withColumn("month", written_month(said))
    plain = F.when(F.col("month").isin(*rules.months), written_date(said, F.col("month"), rules)).otherwise(french_date(let(said, lambda x: repair_date(x, F.col("year"), rules)), rules))
    told = told.withColumn("law_date", F.coalesce(plain, acts.closing_date(F.col("foot"), F.col("year"), rules))).drop("said", "month")
    return told.withColumn("articles", F.when(F.contains("head", F.lit("modifiant")), acts.due_only(F.col("articles"))).otherwise(F.col("articles")))


def grammar_corrected(told: DataFrame, grammar: Adapter, accepted: DataFrame | None = None) -> DataFrame:
    """Sections with the header and each article as a grammar corrects them; an article's number is read anew."""
    key = lambda place: F.to_json(F.struct("doc_id", F.lit(0).alias("place") if place is None else F.col(place).alias("place"))).alias("key")
    head = told.select(key(None), F.col("head").alias("text"))
    each = told.select("doc_id", F.explode("articles").alias("a")).select(key("a.place"), F.col("a.content").alias("text"))
    fixed = edits.corrected(head.unionByName(each), grammar, accepted).where("n_edits > 0")
    fixed = fixed.select(F.from_json("key", f"doc_id {told.schema['doc_id'].dataType.simpleString()}, place int").alias("key"), "text")
    new = fixed.groupBy("key.doc_id").agg(F.map_from_entries(F.collect_list(F.struct("key.place", "text"))).alias("new"))
    at = lambda place, old: F.coalesce(F.try_element_at("new", place), old)
    article = lambda x: let(at(x["place"], x["content"]), lambda c: F.struct(x["place"].alias("place"), standard_number(c).alias("index"), c.alias("content")))
    return told.join(new, "doc_id", "left").withColumn("head", at(F.lit(0), F.col("head"))).withColumn("articles", F.transform("articles", article)).drop("new")


def act_fields(texts: DataFrame, rules: Rules = FRENCH_LAW, header: str = acts.HEADER, footer: str = acts.FOOTER, grammar: Adapter | None = None, accepted: DataFrame | None = None) -> DataFrame:
    """``texts`` (doc_id, header, body, footer, type, year) with head and foot (cleaned texts), law_number, law_object, law_date and articles."""
    told = act_sections(texts, rules, header, footer)
    return read_fields(told if grammar is None else grammar_corrected(told, grammar, accepted), rules)


def people_of(told: DataFrame, register: DataFrame, rules: Rules = FRENCH_LAW) -> DataFrame:
    """doc_id and its signatories, distinct, in order of their first line."""
    lines = told.select("doc_id", F.posexplode(F.split("foot", "\n")).alias("line_no", "line"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "name", "role"))), lambda x: F.struct(x["name"].alias("name"), x["role"].alias("role")))
    return signatories(lines, register, rules).groupBy("doc_id").agg(listed.alias("signatories"))


def extract_laws(docs: DataFrame, register: DataFrame, rules: Rules = FRENCH_LAW, header: str = acts.HEADER, footer: str = acts.FOOTER, grammar: Adapter | None = None, accepted: DataFrame | None = None) -> DataFrame:
    """``docs`` (doc_id, text[, type, year]) as acts: doc_id, metadata and articles, in the shape of the act JSON.

    ``year`` stands in for one that is misread.  A document without lines has blank
    metadata and no articles.  ``grammar`` corrects the cleaned header and each
    article, but for the words that ``accepted`` lists.  The acts are read once,
    into a table of the shared folder, when this is called.
    """
    rows = marked_sections(repaired(to_lines(docs), rules).select("doc_id", "line_no", "line"), rules)
    extra = [F.col(c).cast("string").alias(c) if c in docs.columns else F.lit(d).cast("string").alias(c) for c, d in (("type", "loi"), ("year", None))]
    rows = docs.select("doc_id", *extra).join(rows, "doc_id", "left").withColumn("lines", F.coalesce("lines", F.array().cast(rows.schema["lines"].dataType)))
    told = marked_acts(rows.fillna(0, ["h", "b"]).fillna(False, ["odd_h", "odd_b", "odd_f"]), rules, header, footer)
    told = read_fields(told if grammar is None else grammar_corrected(told, grammar, accepted), rules)
    # written, as the register is met by the lines of all acts first and by each act's own after
    path = shared_path(docs.sparkSession, "acts-read")
    told.select("doc_id", "type", "foot", "law_number", "law_object", "law_date", "articles").write.parquet(path)
    told = docs.sparkSession.read.parquet(path)
    out = told.join(people_of(told, register, rules), "doc_id", "left")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    source = source_url(F.col("type"), F.col("law_number"))
    metadata = F.struct(blank("law_number").alias("lawNumber"), blank("law_object").alias("lawObject"), blank("law_date").alias("lawDate"), F.when(valid_url(source), source).alias("source"), F.coalesce("signatories", F.array().cast(PEOPLE)).alias("signatories"))
    articles = F.transform("articles", lambda x: F.struct(x["index"].alias("index"), x["content"].alias("content")))
    return out.select("doc_id", metadata.alias("metadata"), F.coalesce(articles, F.array().cast(ARTICLES)).alias("articles"))
