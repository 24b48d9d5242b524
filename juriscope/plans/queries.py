"""The library's queries over the driver's tables, with their SQL.

Acts are made from orders, line items and parts by one SQL text that Spark and
DuckDB both run: a title, number, object and formulas by order, and an article
for each line item with a label that is sometimes misread.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from juriscope.functions import fuzzy, text
from juriscope.operators import acts, dictionary, edits, graph, lines, metadata, quality, scans, vector_index, vectors
from juriscope.plans import extraction, ingestion
from juriscope.rules import FRENCH_LAW
from juriscope.sources import adapters, graph_store
from juriscope.sources.shared import shared_path
from juriscope.streaming.incremental import new_only

LAW_LINES = """
WITH o AS (SELECT o_orderkey AS doc_id, o_custkey % 25 AS nk, o_orderstatus AS st, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d FROM {orders}),
n AS (SELECT doc_id, nk, st, y, d, CASE m WHEN 1 THEN 'janvier' WHEN 2 THEN 'février' WHEN 3 THEN 'mars' WHEN 4 THEN 'avril' WHEN 5 THEN 'mai' WHEN 6 THEN 'juin' WHEN 7 THEN 'juillet' WHEN 8 THEN 'août' WHEN 9 THEN 'septembre' WHEN 10 THEN 'octobre' WHEN 11 THEN 'novembre' ELSE 'décembre' END AS mo FROM o),
a AS (SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS k, l_partkey FROM {lineitem}),
p AS (SELECT p_partkey, p_name FROM {part})
SELECT doc_id, 1 AS line_no, 'RÉPUBLIQUE DU BENIN' AS line FROM n
UNION ALL SELECT doc_id, 2, concat('LOI N° ', CAST(y AS VARCHAR(10)), ' - ', CAST(doc_id % 100 AS VARCHAR(10)), ' DU ', CAST(d AS VARCHAR(10)), ' ', upper(mo), ' ', CAST(y AS VARCHAR(10))) FROM n
UNION ALL SELECT doc_id, 3, CASE WHEN st = 'F' THEN 'modifiant la loi de finances' ELSE 'portant code du travail' END FROM n
UNION ALL SELECT doc_id, 4, 'LASSEMBLEE NATIONALE A DELIBERE' FROM n
UNION ALL SELECT doc_id, 5, 'Le President de la Republique promulgue la loi dont la teneur suit' FROM n
UNION ALL SELECT doc_id, 6, 'TITRE I DISPOSITIONS GENERALES' FROM n
UNION ALL SELECT a.doc_id, CAST(100 + 2 * k AS INT), concat(CASE a.l_partkey % 4 WHEN 0 THEN 'Article ' WHEN 1 THEN 'Articie ' WHEN 2 THEN 'ARTICLE ' ELSE 'Arficle ' END, CAST(CASE WHEN a.l_partkey % 5 = 0 THEN k + 40 ELSE k END AS VARCHAR(10)), CASE a.l_partkey % 3 WHEN 0 THEN '.- ' WHEN 1 THEN ' : ' ELSE ' ' END, p_name) FROM a JOIN p ON p_partkey = a.l_partkey JOIN n ON n.doc_id = a.doc_id
UNION ALL SELECT doc_id, 9000, concat('Fait à ', CASE WHEN nk % 2 = 0 THEN 'Cotonou' ELSE 'Porto-Novo' END, ', le ', CAST(d AS VARCHAR(10)), ' ', mo, ' ', CAST(y AS VARCHAR(10))) FROM n
UNION ALL SELECT n.doc_id, 9001, concat(r.n_name, '.-') FROM n JOIN {nation} r ON r.n_nationkey = n.nk
UNION ALL SELECT doc_id, 9002, 'Le Garde des Sceaux' FROM n
UNION ALL SELECT n.doc_id, 9003, r.n_name FROM n JOIN {nation} r ON r.n_nationkey = (n.nk + 7) % 25
UNION ALL SELECT doc_id, 9004, 'AMPLIATIONS' FROM n
UNION ALL SELECT doc_id, 9005, 'Erratum : la loi promulgue ce qui suit' FROM n WHERE st = 'O'
UNION ALL SELECT doc_id, 9006, 'Article 99 : texte repris' FROM n WHERE st = 'O'
UNION ALL SELECT doc_id, 9007, 'Falt à Cotonou, le 1 mars 2000' FROM n WHERE st = 'O'
"""
L = LAW_LINES.format(orders="orders", lineitem="lineitem", part="part", nation="nation")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def law_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of LAW_LINES, those of an order in one row: doc_id and lines (line_no, line).

    Line items meet the parts once and their orders once.  Rows are dealt by doc_id,
    which Spark knows, so what goes by act after this is not shuffled again.
    """
    said = lambda c: F.col(c).cast("string")
    case = lambda c, words, other: reduce(lambda x, iw: F.when(c == iw[0], iw[1]).otherwise(x), enumerate(words), F.lit(other))
    line = lambda i, c: F.struct((F.lit(i) if isinstance(i, int) else i).alias("line_no"), (F.lit(c) if isinstance(c, str) else c).alias("line"))
    date = [f("o_orderdate").alias(n) for f, n in ((F.year, "y"), (F.month, "m"), (F.day, "d"))]
    n = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), (F.col("o_custkey") % 25).alias("nk"), F.col("o_orderstatus").alias("st"), *date).repartition("doc_id")
    mo = F.coalesce(F.element_at(F.array(*map(F.lit, FRENCH_LAW.months)), F.col("m")), F.lit("décembre"))
    told = [
        (1, "RÉPUBLIQUE DU BENIN"),
        (2, F.concat(F.lit("LOI N° "), said("y"), F.lit(" - "), (F.col("doc_id") % 100).cast("string"), F.lit(" DU "), said("d"), F.lit(" "), F.upper(mo), F.lit(" "), said("y"))),
        (3, F.when(F.col("st") == "F", "modifiant la loi de finances").otherwise("portant code du travail")),
        (4, "LASSEMBLEE NATIONALE A DELIBERE"),
        (5, "Le President de la Republique promulgue la loi dont la teneur suit"),
        (6, "TITRE I DISPOSITIONS GENERALES"),
        (9000, F.concat(F.lit("Fait à "), F.when(F.col("nk") % 2 == 0, "Cotonou").otherwise("Porto-Novo"), F.lit(", le "), said("d"), F.lit(" "), mo, F.lit(" "), said("y"))),
        (9002, "Le Garde des Sceaux"),
        (9004, "AMPLIATIONS"),
    ]
    again = [(9005, "Erratum : la loi promulgue ce qui suit"), (9006, "Article 99 : texte repris"), (9007, "Falt à Cotonou, le 1 mars 2000")]
    made = lambda rows: F.array(*[line(i, c) for i, c in rows])
    none = F.array().cast("array<struct<line_no:int,line:string>>")
    # what a line says of its part is made once for each part
    key = F.col("l_partkey")
    word, after = case(key % 4, ("Article ", "Articie ", "ARTICLE "), "Arficle "), case(key % 3, (".- ", " : "), " ")
    label = F.struct(word.alias("word"), F.when(key % 5 == 0, 40).otherwise(0).alias("more"), F.concat(after, "p_name").alias("rest"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name").groupBy("l_partkey").agg(F.collect_list(label).alias("labels"))
    order = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    a = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), *order).join(parts, "l_partkey", "left")
    a = a.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(*order, "labels"))).alias("items"))
    read = lambda i: lambda x: line((102 + 2 * i).cast("int"), F.concat(x["word"], (x["more"] + i + 1).cast("string"), x["rest"]))
    articles = F.flatten(F.transform("items", lambda item, i: F.coalesce(F.transform(item["labels"], read(i)), none)))
    nations = table(spark, sf, "nation").groupBy("n_nationkey").agg(F.collect_list(F.struct("n_name")).alias("names"))
    named = lambda n, key, to: n.join(nations.select(F.col("n_nationkey").alias(to), F.col("names").alias(f"{to}_names")), key == F.col(to), "left")
    n = named(named(n.join(a, "doc_id", "left"), F.col("nk"), "signs"), (F.col("nk") + 7) % 25, "seals")
    signs = F.transform("signs_names", lambda x: line(9001, F.concat(x["n_name"], F.lit(".-"))))
    seals = F.transform("seals_names", lambda x: line(9003, x["n_name"]))
    every = F.concat(made(told), F.coalesce(articles, none), F.coalesce(signs, none), F.coalesce(seals, none), F.when(F.col("st") == "O", made(again)).otherwise(none))
    return n.select("doc_id", every.alias("lines"))


def law_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of LAW_LINES, dealt by doc_id."""
    return law_rows(spark, sf).select("doc_id", F.inline("lines"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _any(c: str, words, how: str = "starts_with(lower({c}), '{w}')") -> str:
    return "(" + " OR ".join(how.format(c=c, w=w.lower()) for w in words) + ")"


_EARLY = "(" + " OR ".join(f"contains(left(line, 25), '{d}')" for d in FRENCH_LAW.delimiters) + ")"
_HITS = " + ".join(f"CAST(contains(left(lower(trim(line)), 7), '{g}') AS INT)" for g in ("ar", "rt", "ti", "ic", "cl", "le"))
ART = f"""CASE WHEN trim(line) = '' THEN false WHEN starts_with(line, 'ARTICLES') AND {_EARLY} THEN true WHEN starts_with(lower(line), 'articles') THEN false
 ELSE (starts_with(lower(trim(line)), 'article') OR {_HITS} >= 3) AND regexp_matches(left(lower(trim(line)), 15), '^art.*([0-9]+|1er|premier|unique)') END"""
OBJ = _any("line", FRENCH_LAW.object_starts)
W = "OVER (PARTITION BY doc_id ORDER BY line_no)"


@query(f"SELECT doc_id, line_no, {ART} AS is_article FROM ({L})")
def article_detect(spark, sf):
    return law_lines(spark, sf).select("doc_id", "line_no", fuzzy.looks_like_article(F.col("line")).alias("is_article"))


ARTICLES = f"""SELECT doc_id, CAST(g AS BIGINT) AS article_no, string_agg(trim(line), ' ' ORDER BY line_no) AS content FROM
 (SELECT *, sum(CAST({ART} AS INT)) {W} AS g FROM ({L})) WHERE g > 0 GROUP BY doc_id, g"""


@query(f"""SELECT doc_id, article_no, content, CASE WHEN starts_with(lower(content), 'article') THEN trim(regexp_replace(split_part(content, ':', 1), '(?i)article', '', 'g')) ELSE 'UNKNOWN' END AS "index" FROM ({ARTICLES})""")
def article_group(spark, sf):
    return lines.articles(law_lines(spark, sf)).select("doc_id", "article_no", "content", fuzzy.standard_number(F.col("content")).alias("index"))


SECTIONS = f"""SELECT doc_id, line_no, line, CASE WHEN max(CAST(a AND starts_with(lower(line), 'fait à') AS INT)) {W} = 1 THEN 'footer' WHEN a THEN 'body' ELSE 'header' END AS section
 FROM (SELECT *, max(CAST({ART} AS INT)) {W} = 1 AS a FROM ({L}))"""


@query("SELECT doc_id, " + ", ".join(f"coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE section = '{s}'), '') AS {s}" for s in ("header", "body", "footer")) + f" FROM ({SECTIONS}) GROUP BY doc_id")
def section_texts(spark, sf):
    return lines.section_texts(law_lines(spark, sf))


@query(f"""SELECT doc_id, line_no, coalesce(last_value(CASE WHEN starts_with(line, 'Fait à') OR starts_with(line, 'Falt à') THEN false WHEN contains(lower(line), 'promulgue') THEN true END IGNORE NULLS) {W}, false) AS in_body FROM ({L})""")
def body_state(spark, sf):
    return lines.body_state(law_lines(spark, sf))


NUMBERS = f"""SELECT doc_id, trim(regexp_extract(string_agg(line, ' ' ORDER BY line_no), '[0-9].*', 0)) AS law_number FROM
 (SELECT *, min(CASE WHEN starts_with(lower(line), 'loi') THEN line_no END) OVER (PARTITION BY doc_id) AS s, min(CASE WHEN {OBJ} THEN line_no END) OVER (PARTITION BY doc_id) AS e FROM ({L})) WHERE line_no >= s AND line_no < e GROUP BY doc_id"""


@query(NUMBERS)
def law_number(spark, sf):
    return metadata.law_numbers(law_lines(spark, sf))


@query(f"""SELECT doc_id, string_agg(line, ' ' ORDER BY line_no) AS law_object FROM
 (SELECT *, min(CASE WHEN {OBJ} THEN line_no END) OVER (PARTITION BY doc_id) AS s, min(CASE WHEN line_no > 3 AND contains(lower(line), 'nationale') THEN line_no END) OVER (PARTITION BY doc_id) AS e FROM ({L})) WHERE line_no >= s AND line_no < e GROUP BY doc_id""")
def law_object(spark, sf):
    return metadata.law_objects(law_lines(spark, sf))


_MONTHS = " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(FRENCH_LAW.months))


@query(f"""SELECT doc_id, make_date(CAST(p[4] AS INT), CASE p[3] {_MONTHS} END, CAST(p[2] AS INT)) AS law_date FROM (SELECT doc_id, string_split(lower(regexp_extract(law_number, 'DU .*', 0)), ' ') AS p FROM ({NUMBERS}))""")
def law_date(spark, sf):
    return metadata.law_dates(metadata.law_numbers(law_lines(spark, sf)))


@query(f"""SELECT doc_id, field, string_agg(line, ' ' ORDER BY line_no) AS value FROM (SELECT *, last_value(CASE WHEN starts_with(lower(line), 'loi') THEN 'number' WHEN {OBJ} THEN 'object'
 WHEN contains(lower(line), 'assemblee') OR contains(lower(line), 'nationale') OR regexp_matches(line, '^NATION_[0-9]+(\\.|$)') THEN 'deliberation' WHEN contains(lower(line), 'promulgue') THEN 'president' END IGNORE NULLS) {W} AS field FROM ({SECTIONS}) WHERE section = 'header') WHERE field IS NOT NULL GROUP BY doc_id, field""")
def header_fields(spark, sf):
    return lines.header_fields(lines.sections(law_lines(spark, sf)).where("section = 'header'"))


@query(f"SELECT doc_id, line_no FROM ({L}) WHERE regexp_matches(upper(trim(line)), '^(TITRE|CHAPITRE|SECTION|LIVRE|SOUS-SECTION)\\s+[0-9IVXERPM]+')")
def title_lines(spark, sf):
    return law_lines(spark, sf).where(text.is_title(F.col("line"))).select("doc_id", "line_no")


@query(f"SELECT doc_id, line_no, " + " OR ".join(f"levenshtein(substr(line, {i + 1}, 7), 'Article') <= 2 AND length(left(line, 10)) >= {i + 7}" for i in range(4)) + f" AS near FROM ({L})")
def levenshtein_window(spark, sf):
    return law_lines(spark, sf).select("doc_id", "line_no", fuzzy.within_distance(F.col("line"), "Article", 10, 2).alias("near"))


_NAME = "lower(trim(strip_accents(upper({}))))"
_GRAM3 = "len(list_filter(range(1, greatest(length({b}) - 1, 1)), lambda i: length({b}) >= 3 AND contains({a}, substr({b}, i, 3)))) >= 3"


@query(f"""WITH s AS (SELECT doc_id, line_no, {_NAME.format("line")} AS t FROM (SELECT *, last_value(CASE WHEN starts_with(line, 'Fait à') THEN 1 WHEN line = 'AMPLIATIONS' THEN 0 END IGNORE NULLS) {W} AS inside FROM ({L})) WHERE inside = 1 AND NOT starts_with(line, 'Fait à')),
 r AS (SELECT n_nationkey AS priority, n_name AS name, 'country' AS role, {_NAME.format("n_name")} AS k FROM nation),
 m AS (SELECT doc_id, line_no, arg_min(name, priority) AS name FROM s JOIN r ON contains(t, k) OR {_GRAM3.format(a="t", b="k")} GROUP BY doc_id, line_no)
 SELECT doc_id, name, 'country' AS role, min(line_no) AS line_no FROM m GROUP BY doc_id, name""")
def signatory_match(spark, sf):
    register = table(spark, sf, "nation").select(F.col("n_nationkey").alias("priority"), F.col("n_name").alias("name"), F.lit("country").alias("role"))
    return metadata.signatories(metadata.signature_lines(law_lines(spark, sf)), register)


@query("SELECT doc_id, strip_accents(text) AS plain, regexp_replace(upper(replace(replace(replace(upper(source), 'I', '1'), 'L', '1'), 'O', '0')), '[^0-9]', '', 'g') AS digits, length(text) AS n FROM documents")
def accent_strip(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", text.strip_accents(F.col("text")).alias("plain"), text.ocr_digits(F.col("source")).alias("digits"), F.length("text").cast("long").alias("n"))


def _replaced(c: str) -> str:
    for a, b in FRENCH_LAW.corrections:
        c = "replace({}, '{}', '{}')".format(c, a.replace("'", "''"), b.replace("'", "''"))
    return c


@query(f"SELECT doc_id, md5({_replaced('text')}) AS corrected FROM documents")
def corrections(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.corrected(F.col("text"))).alias("corrected"))


_GAP = r"[ \t\n\x0B\f\r]*"
_JOIN = rf"regexp_replace({{}}, '(\w)-{_GAP[:-1]}*\n{_GAP}(\w)', '\1\2', 'g')"
_LISTED = rf"regexp_replace({_JOIN.format(_JOIN.format("replace(text, chr(13), '')"))}, '\n{_GAP}-{_GAP}', chr(1), 'g')"
_ONE_LINE = rf"regexp_replace(regexp_replace({_LISTED}, '{_GAP}\n{_GAP}', ' ', 'g'), '[ \t]{{2,}}', ' ', 'g')"


@query(rf"SELECT doc_id, md5(regexp_replace(replace({_ONE_LINE}, chr(1), chr(10) || '- '), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')) AS one_line FROM documents")
def single_line(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.md5(text.single_line(F.col("text"))).alias("one_line"))


@query("""SELECT doc_id, CAST(coalesce(sum(CASE WHEN k.word IS NULL THEN 1 ELSE 0 END) FILTER (WHERE length(w.word) >= 4), 0) AS BIGINT) AS n_unknown FROM
 (SELECT doc_id, unnest(list_transform(string_split_regex(coalesce(text, ''), '[^a-zA-Zàâéèêëîïôûùçœ''-]+'), lambda x: regexp_replace(lower(strip_accents(x)), '[^a-z]', '', 'g'))) AS word FROM documents) w
 LEFT JOIN (SELECT DISTINCT word FROM (SELECT unnest(list_transform(string_split_regex(text, '\\s+'), lambda x: regexp_replace(lower(strip_accents(x)), '[^a-z]', '', 'g'))) AS word FROM benchmark) WHERE length(word) > 2) k ON w.word = k.word GROUP BY doc_id""")
def lexicon_unknown(spark, sf):
    return quality.unknown_words(table(spark, sf, "documents"), quality.lexicon(table(spark, sf, "benchmark")))


_LAWS = f"SELECT n.doc_id, law_number, coalesce(c, 0) AS n_articles FROM ({NUMBERS}) n LEFT JOIN (SELECT doc_id, count(*) AS c FROM ({ARTICLES}) GROUP BY doc_id) USING (doc_id)"


def _acts(spark, sf, *wanted: str) -> DataFrame:
    """doc_id, law_number and what is wanted of header, footer, n_articles and articles, from one pass over the lines; what is not wanted is not carried."""
    rows = lines.section_rows(law_lines(spark, sf)).select("doc_id", lines.section_text("header"), lines.section_text("footer"), F.slice("lines", F.col("h") + 1, F.size("lines") - F.col("h")).alias("rest"))
    made = {
        "header": F.col("header"),
        "footer": F.col("footer"),
        "n_articles": F.size(F.filter("rest", lambda x: x["opens"])).cast("long"),
        "articles": acts.articles_in(F.col("rest")),
    }
    return rows.withColumn("law_number", acts.law_number(F.col("header"))).select("doc_id", "law_number", *[made[w].alias(w) for w in wanted])


def _laws(spark, sf):
    return _acts(spark, sf, "n_articles")


@query(f"SELECT doc_id, 'Structure: < 2 articles' AS error FROM ({_LAWS}) WHERE n_articles < 2")
def qa_structure(spark, sf):
    return quality.structure_errors(_laws(spark, sf))


@query(f"SELECT doc_id, law_number, n_articles, trim(law_number) <> '' AND n_articles >= 2 AS passes FROM ({_LAWS})")
def strict_gate(spark, sf):
    return quality.gate(_laws(spark, sf))


@query("""WITH d AS (SELECT doc_id, source, md5(text) AS key FROM documents), a AS (SELECT * FROM d WHERE source < 'src3') SELECT * FROM a UNION ALL SELECT * FROM d WHERE source >= 'src3' AND key NOT IN (SELECT key FROM a)""")
def priority_union(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", F.md5("text").alias("key"))
    return graph.priority_union(d.where("source < 'src3'"), d.where("source >= 'src3'"), "key")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_existing(spark, sf):
    return new_only(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id").select("doc_id", "lang")


@query("SELECT doc_id, key FROM (SELECT doc_id, md5(text) AS key, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def first_law_dedupe(spark, sf):
    return graph.first_by(table(spark, sf, "documents").select("doc_id", F.md5("text").alias("key")), "key", "doc_id")


@query("""SELECT conv_id, turn FROM (SELECT *, coalesce(max(CAST(contains(upper(text), 'THE') AS INT)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM conversations) WHERE done = 0""")
def page_stop(spark, sf):
    return lines.until_first(table(spark, sf, "conversations"), F.contains(F.upper("text"), F.lit("THE")), "conv_id", "turn").select("conv_id", "turn")


_INK = "length(regexp_replace({}, '[ \\t\\n\\r]', '', 'g'))"


@query(f"""SELECT page_id, md5(CASE WHEN {_INK.format("html")} >= {_INK.format("url")} THEN html ELSE url END) AS best, CASE WHEN trim(url) <> '' THEN url ELSE html END AS first FROM pages""")
def best_page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(adapters.longest_text("html", "url")).alias("best"), adapters.first_text("url", "html").alias("first"))


_SENTENCES = r"string_split(regexp_replace(text, '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), chr(1))"


@query(f"""SELECT doc_id, CAST(generate_subscripts(c, 1) - 1 AS INTEGER) AS chunk_no, unnest(c) AS chunk FROM (SELECT doc_id, CASE WHEN c[-1] = '' THEN c[:-2] ELSE c END AS c FROM
 (SELECT doc_id, list_reduce(list_prepend([''], list_transform({_SENTENCES}, lambda x: [x])), lambda a, v: CASE WHEN a[-1] = '' THEN list_append(a[:-2], v[1]) WHEN length(a[-1]) + length(v[1]) + 1 <= 512 THEN list_append(a[:-2], a[-1] || ' ' || v[1]) ELSE list_append(a, v[1]) END) AS c FROM documents WHERE text IS NOT NULL))""")
def chunk_pack(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(text.chunks(F.col("text"))).alias("chunk_no", "chunk"))


@query("""SELECT label, list(round(m, 6) ORDER BY i) AS mean FROM (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i) GROUP BY label""")
def chunk_mean(spark, sf):
    return vectors.mean_vector(table(spark, sf, "embeddings"), "label", "embedding").select("label", F.transform("vector", lambda x: F.round(x, 6)).alias("mean"))


@query("""SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 6) AS score FROM embeddings ORDER BY score DESC, vec_id LIMIT 10""")
def cosine_topk(spark, sf):
    e = table(spark, sf, "embeddings")
    return vectors.cosine_top_k(e, e.where("vec_id = 0"), 10).select("vec_id", F.round("score", 6).alias("score"))


PLANES = vector_index.Planes()
_SIDES = lambda first, n: f"list_transform(range({first}, {first} + {n}), lambda p: list_sum(list_transform(range(1, {PLANES.dims + 1}), lambda i: v[i] * signs[p * {PLANES.dims} + i])))"
_AT = PLANES.tables * PLANES.bits
_NEAR = f"""WITH planes AS MATERIALIZED (SELECT list(CASE WHEN substr(md5(concat(p, ':', i)), 1, 1) < '8' THEN 1.0 ELSE -1.0 END ORDER BY p, i) AS signs FROM range({_AT + 64 * PLANES.words}) t(p), range({PLANES.dims}) u(i)),
 e AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
 s AS MATERIALIZED (SELECT vec_id, v, {_SIDES(0, _AT)} AS t, list_transform({_SIDES(_AT, 64 * PLANES.words)}, lambda x: x > 0) AS sketch FROM (SELECT min(vec_id) AS vec_id, v FROM e GROUP BY v), planes),
 b AS (SELECT vec_id, slot, sum(CASE WHEN x > 0 THEN 1 << j ELSE 0 END) AS bucket, list(j ORDER BY abs(x), j)[:2] AS near FROM (SELECT vec_id, slot, j, t[slot * {PLANES.bits} + j + 1] AS x FROM s, range({PLANES.tables}) a(slot), range({PLANES.bits}) c(j)) GROUP BY vec_id, slot),
 asked AS (SELECT vec_id AS query_id, slot, unnest([bucket, xor(bucket, 1 << near[1]), xor(bucket, 1 << near[2])]) AS bucket FROM b JOIN s USING (vec_id) WHERE v IN (SELECT v FROM e WHERE vec_id % 100 = 0)),
 met AS (SELECT DISTINCT query_id, vec_id FROM asked JOIN b USING (slot, bucket)),
 kept AS (SELECT query_id, vec_id, rank() OVER (PARTITION BY query_id ORDER BY len(list_filter(list_zip(o.sketch, q.sketch), lambda z: z[1] <> z[2]))) AS rn, list_cosine_similarity(o.v, q.v) AS score, o.v AS v, q.v AS w FROM met JOIN s o USING (vec_id) JOIN s q ON q.vec_id = query_id)"""


@query(f"{_NEAR} SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (SELECT x.vec_id AS query_id, y.vec_id, score FROM kept JOIN e x ON x.v = w AND x.vec_id % 100 = 0 JOIN e y ON y.v = kept.v WHERE rn <= 160)) WHERE rank <= 10")
def vector_index_topk(spark, sf):
    """The ten nearest of every hundredth vector, by the index."""
    e, path = table(spark, sf, "embeddings"), shared_path(spark, "vector-index")
    vector_index.extend(spark, path, e, PLANES)
    asked = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return vector_index.nearest_by_index(spark, path, asked, e, 10, PLANES).withColumn("score", F.round("score", 6))


@query("SELECT d.doc_id, e.label, len(e.embedding) AS dims FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id")
def article_vector_join(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label", F.lit(0).alias("at"))
    found, _ = vectors.with_vectors(table(spark, sf, "documents").select("doc_id"), e, ["doc_id"], "at")
    return found.select("doc_id", "label", F.size("embedding").cast("long").alias("dims"))


def _law_nodes(spark, sf) -> DataFrame:
    """One node for each law number; only the documents that win are read for their objects and dates."""
    won = graph.first_by(_acts(spark, sf, "header", "footer"), "law_number", "doc_id")
    date = acts.law_date(F.col("law_number"), F.col("footer"), F.lit(None).cast("string"))
    return graph.law_nodes(won.select("doc_id", "law_number", acts.law_object(F.col("header")).alias("law_object"), date.alias("law_date")))


def _articles(spark, sf) -> DataFrame:
    """doc_id, law_number, article_no, content and index of each article."""
    arts = _acts(spark, sf, "articles").select("doc_id", "law_number", F.explode("articles").alias("a")).select("doc_id", F.col("a.place").cast("long").alias("article_no"), F.col("a.content").alias("content"), "law_number")
    return arts.withColumn("index", fuzzy.number_at_start(F.col("content"), 24))


def _article_nodes(arts: DataFrame) -> DataFrame:
    return graph.article_nodes(arts.withColumn("article_no", F.struct("article_no", "doc_id")).drop("doc_id"))


_INDEX = "lower(regexp_extract(left(content, 24), '(?i)([0-9]+[a-z0-9-]*|premier|un)(\\s|[.:,-]|$)', 1))"
_ARTS = f"SELECT a.doc_id, article_no, content, law_number, {_INDEX} AS i FROM ({ARTICLES}) a JOIN ({NUMBERS}) n ON a.doc_id = n.doc_id"
_NODES = f"SELECT law_number || '_ART_' || i AS id, 'Article ' || i AS label, law_number, content FROM (SELECT *, row_number() OVER (PARTITION BY law_number, i ORDER BY article_no DESC, doc_id DESC) AS rn FROM ({_ARTS})) WHERE rn = 1"


@query(_NODES)
def graph_nodes(spark, sf):
    return _article_nodes(_articles(spark, sf)).select("id", "label", "law_number", "content")


_DATES = f"SELECT doc_id, law_number, make_date(CAST(p[4] AS INT), CASE p[3] {_MONTHS} END, CAST(p[2] AS INT)) AS law_date FROM (SELECT doc_id, law_number, string_split(lower(regexp_extract(law_number, 'DU .*', 0)), ' ') AS p FROM ({NUMBERS}))"


@query(f"""SELECT law_number AS id, arg_min(law_object, doc_id) AS title, arg_min(law_date, doc_id) AS promulgated, 'En vigueur' AS status FROM ({_DATES}) JOIN (SELECT doc_id, line AS law_object FROM ({L}) WHERE line_no = 3) USING (doc_id) GROUP BY law_number""")
def graph_laws(spark, sf):
    return _law_nodes(spark, sf)


@query(f"SELECT DISTINCT id AS src, law_number AS dst FROM ({_NODES})")
def graph_edges(spark, sf):
    # an edge needs no text, so none is carried to the nodes and laws that it joins
    nodes = _article_nodes(_articles(spark, sf).withColumn("content", F.lit(None).cast("string")))
    laws = _acts(spark, sf).select(F.col("law_number").alias("id")).distinct()
    return graph.edges(nodes, laws)


@query("""SELECT c_custkey AS id, c_mktsegment AS value FROM customer UNION ALL SELECT o_custkey, 'new' FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def graph_upsert(spark, sf):
    new = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("value"))
    old = table(spark, sf, "orders").select(F.col("o_custkey").alias("id")).distinct().withColumn("value", F.lit("new"))
    return graph.upsert(old, new)


@query("""SELECT s_nationkey AS law_number, s_suppkey AS id FROM supplier UNION ALL SELECT c_nationkey, c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)""")
def graph_replace(spark, sf):
    old = table(spark, sf, "customer").select(F.col("c_nationkey").alias("law_number"), F.col("c_custkey").alias("id"))
    return graph.replace_children(old, table(spark, sf, "supplier").select(F.col("s_nationkey").alias("law_number"), F.col("s_suppkey").alias("id")))


@query(f"SELECT (SELECT count(DISTINCT law_number) FROM ({NUMBERS})) AS n_laws, (SELECT count(*) FROM ({_NODES})) AS n_articles")
def graph_counts(spark, sf):
    index = lambda a: fuzzy.number_at_start(a["content"], 24)
    each = _acts(spark, sf, "articles").select("law_number", F.explode_outer(F.transform("articles", index)).alias("index"))
    by_law = each.groupBy("law_number").agg(F.count_distinct("index").alias("n"))
    return by_law.agg(F.count("*").alias("n_laws"), F.sum("n").cast("long").alias("n_articles"))


def _merged(spark, sf):
    """A graph of suppliers with an article for each part that they sent, and a merge that gives every third supplier anew."""
    path = shared_path(spark, "graph")
    law = F.concat(F.lit("L"), F.col("l_suppkey").cast("string")).alias("law_number")
    sent = table(spark, sf, "lineitem").select(law, F.col("l_suppkey"), F.col("l_partkey").cast("string").alias("index"), F.col("l_linenumber").alias("article_no"))
    every = table(spark, sf, "supplier").select(F.concat(F.lit("L"), F.col("s_suppkey").cast("string")).alias("law_number"), F.col("s_suppkey").alias("doc_id"), F.col("s_name").alias("law_object"), F.lit(None).cast("date").alias("law_date"))

    def tables(laws: DataFrame, rows: DataFrame, content: str) -> dict[str, DataFrame]:
        nodes, arts = graph.law_nodes(laws), graph.article_nodes(rows.withColumn("content", F.lit(content)))
        return {"laws": nodes, "articles": arts, "edges": graph.edges(arts, nodes)}

    counts = [graph_store.merge(spark, path, tables(every, sent, "old"))]
    third = every.where("doc_id % 3 = 0").withColumn("law_object", F.lit("new"))
    counts.append(graph_store.merge(spark, path, tables(third, sent.where("l_suppkey % 3 = 0 AND article_no = 1"), "new")))
    return path, counts


_SENT = "SELECT DISTINCT l_suppkey AS s, l_partkey AS p, {} AS content FROM lineitem"
_GRAPH = f"(SELECT * FROM ({_SENT.format("'old'")}) WHERE s % 3 <> 0 UNION ALL SELECT * FROM ({_SENT.format("'new'")} WHERE l_linenumber = 1) WHERE s % 3 = 0)"


@query(f"SELECT concat('L', s, '_ART_', p) AS id, concat('L', s) AS law_number, content, CASE WHEN s % 3 = 0 THEN 'new' ELSE s_name END AS title FROM {_GRAPH} JOIN supplier ON s = s_suppkey")
def graph_merge(spark, sf):
    path, _ = _merged(spark, sf)
    laws = graph_store.read_graph(spark, path, "laws").select(F.col("id").alias("dst"), "title")
    found = graph_store.read_graph(spark, path, "edges").join(laws, "dst").withColumnRenamed("src", "id")
    return graph_store.read_graph(spark, path, "articles").join(found, "id").select("id", "law_number", "content", "title")


_N = "(SELECT count(*) FROM ({}) x{})"


@query(f"""SELECT 1 AS merge, 'laws' AS name, (SELECT count(*) FROM supplier) AS created, 0 AS replaced UNION ALL SELECT 1, unnest(['articles', 'edges']), {_N.format(_SENT.format("''"), "")}, 0
 UNION ALL SELECT 2, 'laws', (SELECT count(*) FROM supplier WHERE s_suppkey % 3 = 0), (SELECT count(*) FROM supplier WHERE s_suppkey % 3 = 0)
 UNION ALL SELECT 2, unnest(['articles', 'edges']), {_N.format(_SENT.format("''") + " WHERE l_linenumber = 1", " WHERE s % 3 = 0")}, {_N.format(_SENT.format("''"), " WHERE s % 3 = 0")}""")
def graph_merge_counts(spark, sf):
    _, counts = _merged(spark, sf)
    rows = [(i, name, c.created[name], c.replaced[name]) for i, c in enumerate(counts, 1) for name in c.created]
    return spark.createDataFrame(rows, "merge int, name string, created long, replaced long")


_TOK = "list_distinct(list_filter(string_split_regex(lower({}), '[\\s,.:;!\"''()-]+'), lambda x: length(x) > 1))"


@query(f"""SELECT page_id, CASE WHEN len(p) > 0 THEN round(len(list_intersect(p, {_TOK.format("html")})) / len(p), 6) ELSE 0.0 END AS score FROM
 (SELECT page_id, {_TOK.format("url")} AS p, html FROM pages)""")
def partial_jaccard(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.round(text.partial_jaccard(F.col("url"), F.col("html")), 6).alias("score"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_access(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query(f"SELECT count(*) AS n_laws, CAST(sum(n_articles) AS BIGINT) AS n_articles, count(*) FILTER (WHERE n_articles < 2) AS n_short FROM ({_LAWS})")
def run_counters(spark, sf):
    return _laws(spark, sf).agg(F.count("*").alias("n_laws"), F.sum("n_articles").cast("long").alias("n_articles"), F.count(F.when(F.col("n_articles") < 2, 1)).alias("n_short"))


@query(f"""SELECT doc_id, x.number AS number, x.content AS content FROM (SELECT doc_id, unnest(list_reduce(list_prepend([{{'number': 0, 'content': ''}}], list_transform(list({{'number': CAST(CASE WHEN contains(i, 'pre') OR contains(i, 'er') THEN 1 ELSE coalesce(TRY_CAST(i AS INT), 999999) END AS INTEGER), 'content': content}} ORDER BY article_no), lambda v: [v])),
 lambda a, v: CASE WHEN v[1].number = a[-1].number + 1 THEN list_append(a, v[1]) WHEN len(a) > 1 THEN list_append(a[:-2], {{'number': a[-1].number, 'content': a[-1].content || chr(10) || v[1].content}}) ELSE a END)[2:]) AS x FROM ({_ARTS}) GROUP BY doc_id)""")
def article_renumber(spark, sf):
    one = lambda a: F.struct(a["place"].alias("place"), fuzzy.number_value(fuzzy.number_at_start(a["content"], 24)).cast("string").alias("index"), a["content"].alias("content"))
    return lines.renumbered_of(_acts(spark, sf, "articles").select("doc_id", F.transform("articles", one).alias("a")))


# The normal form of articles step by step, its delimiters and limits typed apart from the rules; corrections and the test of a label are those of the SQL above, which take the rules' values.
_NORMAL = rf"""WITH b AS (SELECT doc_id, line_no, {_replaced("trim(line)")} AS line FROM ({L}) WHERE trim(line) <> ''),
 e AS (SELECT *, starts_with(line, 'Fait à') OR starts_with(line, 'Falt à') AS ends, contains(lower(line), 'promulgue') AS opens FROM b),
 s AS (SELECT *, opens OR coalesce(last_value(CASE WHEN ends THEN false WHEN opens THEN true END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS in_body FROM e),
 k AS (SELECT *, in_body AND NOT ends AND {ART} AS art FROM s WHERE NOT (in_body AND NOT ends AND regexp_matches(upper(line), '^(TITRE|CHAPITRE|SECTION|LIVRE|SOUS-SECTION)\s+[0-9IVXERPM]+'))),
 labelled AS (SELECT *, CASE WHEN len(list_filter([1, 2, 3, 4], lambda i: length(left(line, 10)) >= i + 6 AND levenshtein(substr(left(line, 10), i, 7), 'Article') <= 3)) > 0 THEN 'Article' || substr(line, 8) ELSE line END AS c FROM k),
 marked AS (SELECT * EXCLUDE (c), regexp_matches(left(c, 25), '\.-|- | -|\. |, |:') AS delimited,
  CASE {" ".join(f"WHEN contains(left(c, 25), '{d}') THEN replace(c, '{d}', ':')" for d in (".-", "- ", " -", ". ", ", "))} ELSE c END AS c FROM labelled),
 tidy AS (SELECT * REPLACE (CASE WHEN contains(left(c, 25), '::') THEN replace(left(c, 25), '::', ':') || substr(c, 26) WHEN contains(left(c, 25), ',') THEN replace(left(c, 25), ',', '') || substr(c, 26) ELSE c END AS c) FROM marked),
 numbered AS (SELECT *, CASE WHEN x IN ('premier', 'un') THEN '1' ELSE x END AS n FROM (SELECT *, lower(regexp_extract(left(c, 24), '(?i)([0-9]+[a-z0-9-]*|premier|un)(\s|[.:,-]|$)', 1)) AS x FROM tidy)),
 spread AS (SELECT * REPLACE (CASE WHEN NOT delimited AND n <> '' AND contains(c, n) THEN left(c, instr(c, n) - 1) || n || ' : ' || string_split(substr(c, instr(c, n) + length(n)), n)[1] ELSE c END AS c) FROM numbered),
 content AS (SELECT * REPLACE (CASE WHEN contains(c, ':') THEN trim(substr(c, instr(c, ':') + 1)) ELSE c END AS c) FROM spread),
 spaced AS (SELECT * REPLACE (regexp_replace(regexp_replace(left(c, 25), '((\.-|- | -|\. |, |:)\s*)+', ': ', 'g'), '\s{{2,}}', ' ', 'g') || substr(c, 26) AS c) FROM content),
 colons AS (SELECT * REPLACE (trim(regexp_replace(regexp_replace(left(c, 25), '\s*:\s*', ' : ', 'g'), '\s{{2,}}', ' ', 'g')) || substr(c, 26) AS c) FROM spaced)
 SELECT doc_id, line_no, in_body, CASE WHEN in_body AND ends AND starts_with(line, 'Falt') THEN 'Fait' || substr(line, 5) WHEN art THEN 'Article ' || n || ' : ' || trim(regexp_replace(c, '^:+', '')) ELSE line END AS line FROM colons"""


@query(_NORMAL)
def article_normalize(spark, sf):
    return lines.repaired(law_lines(spark, sf)).select("doc_id", "line_no", "line", "in_body")


@query("SELECT doc_id, 'loi' AS kind, lang AS year, 'https://sgg.gouv.bj/doc/loi-' || doc_id || '/' AS url FROM documents")
def source_urls(spark, sf):
    kind, year = text.file_parts(F.concat(F.lit("loi-"), "lang", F.lit(".pdf")))
    return table(spark, sf, "documents").select("doc_id", kind.alias("kind"), year.alias("year"), text.source_url(kind, F.concat(F.col("doc_id").cast("string"), F.lit(" DU 1 mars"))).alias("url"))




@query("""SELECT o_orderkey AS doc_id, CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE make_date(year(o_orderdate), month(o_orderdate), day(o_orderdate)) END AS DATE) AS day FROM orders""")
def date_parse(spark, sf):
    o = table(spark, sf, "orders")
    names = F.array(*map(F.lit, FRENCH_LAW.months))
    said = F.concat_ws(" ", F.day("o_orderdate").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, "brumaire").otherwise(F.element_at(names, F.month("o_orderdate"))), F.year("o_orderdate").cast("string"))
    return o.select(F.col("o_orderkey").alias("doc_id"), text.french_date(said).alias("day"))


_ORDERED_MONTHS = ", ".join(f"'{m}'" for m in FRENCH_LAW.months)


@query(f"""SELECT o_orderkey AS doc_id, concat(day(o_orderdate), ' ', list_extract([{_ORDERED_MONTHS}], month(o_orderdate)), ' ', year(o_orderdate)) AS said FROM orders""")
def month_repair(spark, sf):
    o = table(spark, sf, "orders")
    month = F.replace(F.element_at(F.array(*map(F.lit, FRENCH_LAW.months)), F.month("o_orderdate")), F.lit("i"), F.lit("l"))
    misread = F.concat(F.translate(F.day("o_orderdate").cast("string"), "1", "I"), F.lit("er "), month, F.lit(" "), F.translate(F.year("o_orderdate").cast("string"), "0", "O"))
    return o.select(F.col("o_orderkey").alias("doc_id"), text.repair_date(misread, F.lit("1900")).alias("said"))


@query(f"SELECT doc_id, line_no, CAST({_HITS} AS BIGINT) AS hits FROM ({L})")
def article_fuzzy_bigram(spark, sf):
    zone = F.left(F.lower(text.trimmed(F.col("line"))), F.lit(7))
    return law_lines(spark, sf).select("doc_id", "line_no", fuzzy.gram_hits(zone, F.lit("article"), 2).cast("long").alias("hits"))


@query(r"""SELECT doc_id, line_no, regexp_replace(regexp_replace(left(line, 25), '((\.-|- | -|\. |, |:)\s*)+', ': ', 'g'), '\s{2,}', ' ', 'g') || substr(line, 26) AS delimited,
 trim(regexp_replace(regexp_replace(left(line, 25), '\s*:\s*', ' : ', 'g'), '\s{2,}', ' ', 'g')) || substr(line, 26) AS spaced FROM (""" + L + ")")
def prefix_normalize(spark, sf):
    return law_lines(spark, sf).select("doc_id", "line_no", text.normalize_delimiters(F.col("line"), 25).alias("delimited"), text.normalize_colons(F.col("line"), 25).alias("spaced"))


_KNOWN = "SELECT word, row_number() OVER (ORDER BY word) AS priority FROM (SELECT DISTINCT w AS word FROM (SELECT unnest(string_split(coalesce(p_name, ''), ' ')) AS w FROM part UNION ALL SELECT unnest(string_split_regex(coalesce(text, ''), '[ \\n]+')) FROM benchmark) WHERE trim(w) <> '')"
_LIST = lambda words: ", ".join(f"({i}, '{w}')" for i, w in enumerate(words))
_ONE_OFF = "(SELECT len(list_filter(range(1, length(low) + 1), lambda i: substr(low, i, 1) <> substr({d}, i, 1)))) = 1"
_AT = "list_filter(range(1, length(low) + 1), lambda i: substr(low, i, 1) <> substr(d.word, i, 1))[1]"


@query(f"""WITH dict AS MATERIALIZED ({_KNOWN}), low AS MATERIALIZED (SELECT DISTINCT lower(word) AS k FROM dict), short AS (SELECT w FROM (VALUES {_LIST(FRENCH_LAW.short_words)}) t(i, w)), common AS (SELECT i, w FROM (VALUES {_LIST(FRENCH_LAW.frequent_words)}) t(i, w)),
 asked AS MATERIALIZED (SELECT word, replace(lower(word), 'œ', 'oe') AS low FROM (SELECT DISTINCT unnest(string_split_regex(text, '[ \n]+')) AS word FROM documents) WHERE regexp_matches(word, '^\\p{{L}}{{2,}}$') AND NOT regexp_matches(word, '^\\p{{Lu}}') AND replace(lower(word), 'œ', 'oe') NOT IN (SELECT k FROM low)),
 near AS (SELECT a.word, a.low, d.word AS entry, priority, substr(low, {_AT}, 1) AS x, substr(d.word, {_AT}, 1) AS y FROM asked a JOIN dict d ON length(d.word) = length(a.low) AND {_ONE_OFF.format(d="d.word")}),
 hits AS (
  SELECT a.word, 1 AS r, priority AS o, d.word AS fixed FROM asked a JOIN dict d ON starts_with(a.word, 'l') AND d.word = 'I' || substr(a.word, 2)
  UNION ALL SELECT word, 2, e.i, k || ' ' || e.w FROM asked JOIN (VALUES (0, 'à'), (1, 'au'), (2, 'aux')) e(i, w) ON length(low) > 2 AND ends_with(low, e.w) JOIN low ON k = left(low, length(low) - length(e.w))
  UNION ALL SELECT word, 3, 0, word FROM asked WHERE regexp_matches(low, '(ois|oise|oises)$')
  UNION ALL SELECT word, 4, i, w FROM asked JOIN common ON length(w) = length(low) AND {_ONE_OFF.format(d="w")}
  UNION ALL SELECT c.word, 5, -(i * 10 + length(low) - i), a.k || ' ' || b.k FROM (SELECT word, low, unnest(range(2, length(low) - 1)) AS i FROM asked) c JOIN low a ON a.k = left(low, i) JOIN low b ON b.k = substr(low, i + 1) WHERE (length(a.k) >= 3 OR a.k IN (SELECT w FROM short)) AND (length(b.k) >= 3 OR b.k IN (SELECT w FROM short))
  UNION ALL SELECT a.word, 6, priority, d.word FROM asked a JOIN dict d ON strip_accents(d.word) = low AND length(d.word) = length(low)
  UNION ALL SELECT word, CASE WHEN (x = 'l' AND y = 'i') OR (contains('gqpyj', x) AND contains('gqpyj', y)) OR (contains('dfhkltb', x) AND contains('dfhkltb', y)) THEN 7 ELSE 8 END, priority, entry FROM near)
 SELECT word, [{", ".join(f"'{r}'" for r in dictionary.RULES)}][r] AS rule, fixed FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY r, o) AS rn FROM hits) WHERE rn = 1 AND fixed <> word""")
def dictionary_repair(spark, sf):
    split = lambda name, c, sep: table(spark, sf, name).select(F.explode(F.split(c, sep)).alias("word"))
    known = split("part", "p_name", " ").unionByName(split("benchmark", "text", "[ \n]+")).where(F.trim("word") != "").distinct()
    ranked = known.withColumn("priority", F.lit(0))  # equals go by the word
    return dictionary.repaired_words(split("documents", "text", "[ \n]+"), ranked)


# Sections of acts whose fields are known by how they are made: misread dates, two cities, a second title, dates that only the footer has.
ACT_PARTS = """
WITH o AS (SELECT o_orderkey AS doc_id, o_orderkey % 4 AS v, o_custkey % 2 AS c, o_custkey % 25 AS nk, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d FROM {orders}),
n AS (SELECT *, CASE m WHEN 1 THEN 'janvier' WHEN 2 THEN 'février' WHEN 3 THEN 'mars' WHEN 4 THEN 'avril' WHEN 5 THEN 'mai' WHEN 6 THEN 'juin' WHEN 7 THEN 'juillet' WHEN 8 THEN 'août' WHEN 9 THEN 'septembre' WHEN 10 THEN 'octobre' WHEN 11 THEN 'novembre' ELSE 'décembre' END AS mo FROM o),
t AS (SELECT *, CASE WHEN v < 2 THEN concat(CAST(y AS VARCHAR(10)), ' - ', CAST(doc_id % 100 AS VARCHAR(10)), ' DU ') ELSE concat(CAST(y AS VARCHAR(10)), ' - ', CAST(doc_id % 100 AS VARCHAR(10))) END AS head,
 CASE WHEN v = 0 THEN concat(CAST(d AS VARCHAR(10)), ' ', upper(mo), ' ', CAST(y AS VARCHAR(10))) WHEN v = 1 THEN concat(CAST(d AS VARCHAR(10)), 'er ', replace(mo, 'i', 'l'), ' ', replace(CAST(y AS VARCHAR(10)), '1', 'I')) ELSE '' END AS read FROM n)
SELECT t.doc_id, v, c, y, m, d, mo, CAST(y AS VARCHAR(10)) AS year, concat(head, read) AS number, r.n_name AS nation,
 concat('RPUBLIQUE DU ', CASE WHEN c = 0 THEN 'BENIN' ELSE 'Dahomey' END, chr(10), 'D', chr(10), 'x/y LOI N° ', head, read, chr(10), 'portant , exemple ', CAST(t.doc_id AS VARCHAR(10)), chr(10), 'du pays- ', chr(10), 'bas', chr(10),
  'L''Assemblée nationale a délibéré et', chr(10), 'adopté', chr(10), 'Le Président promulgue la suite', CASE WHEN v = 1 THEN ' LOI N° 0 portant rien' ELSE '' END) AS header,
 concat('Falt à tort', chr(10), CASE WHEN c = 0 THEN 'Fait à Cotonou, le ' ELSE 'Fait à PORT0-Novo ou Porto-Novo, le ' END, CASE WHEN v = 3 THEN 'x' ELSE concat(CAST(d AS VARCHAR(10)), ' ', mo, ' ', CAST(y AS VARCHAR(10))) END, chr(10), r.n_name, '.-', chr(10), '  ', chr(10), 'Chef de l''Etat', chr(10), 'AMPLIATIONS : PR 6', chr(10), 'autre') AS footer
FROM t JOIN {nation} r ON r.n_nationkey = t.nk
"""
A = ACT_PARTS.format(orders="orders", nation="nation")


def act_parts(spark: SparkSession, sf: str) -> DataFrame:
    # each row is much work, and a small file is one task: rows are dealt first
    return spark.sql(ACT_PARTS, **{t: table(spark, sf, t) for t in ("orders", "nation")}).repartition("doc_id")


@query(f"""SELECT doc_id, CASE c WHEN 0 THEN 'Cotonou' ELSE 'Porto-Novo' END AS city, CASE WHEN v < 3 THEN concat(CASE c WHEN 0 THEN '' ELSE '0-Novo ou Porto-Novo, le ' END, d, ' ', mo, ' ', y) WHEN c = 0 THEN '' ELSE '0-Novo ou Porto-Novo, le x' END AS signed,
 concat(nation, '.-', chr(10), 'Chef de l''Etat') AS signatories FROM ({A})""")
def footer_fields(spark, sf):
    return act_parts(spark, sf).select("doc_id", acts.cleaned_footer(F.col("footer")).alias("f")).select("doc_id", "f.city", "f.signed", "f.signatories")


@query(f"""SELECT doc_id, CASE c WHEN 0 THEN 'BENIN' ELSE 'DAHOMEY' END AS republic, trim(number) AS number, concat('portantexemple ', doc_id, ' du pays- bas') AS object, 'a délibéré et adopté' AS assembly, 'Le Président' AS president FROM ({A})""")
def header_clean(spark, sf):
    return act_parts(spark, sf).select("doc_id", acts.cleaned_header(F.col("header")).alias("h")).select("doc_id", "h.*")


@query(f"""SELECT doc_id, trim(number) AS law_number, concat('portantexemple ', doc_id, ' du pays- bas') AS law_object, CASE WHEN v < 2 OR (v = 2 AND c = 0) THEN make_date(y, m, d) END AS law_date FROM ({A})""")
def act_metadata(spark, sf):
    told = extraction.act_fields(act_parts(spark, sf).withColumn("body", F.lit("")))
    return told.select("doc_id", "law_number", "law_object", "law_date")


# A whole act: its normal lines in sections, the body's articles, those of amending acts folded by the number that is due.
_ACT = f"""WITH marked AS (SELECT *, sum(CAST({ART} AS INT)) {W} AS g FROM ({_NORMAL})),
 body AS (SELECT * FROM (SELECT *, max(CAST(g > 0 AND starts_with(lower(line), 'fait à') AS INT)) {W} AS foot FROM marked) WHERE g > 0 AND foot = 0),
 arts AS (SELECT doc_id, g, content, trim(regexp_replace(split_part(content, ':', 1), '(?i)article', '', 'g')) AS i FROM (SELECT doc_id, g, string_agg(line, ' ' ORDER BY line_no) AS content FROM body GROUP BY doc_id, g)),
 listed AS (SELECT doc_id, list({{'n': CASE WHEN contains(i, 'pre') OR contains(i, 'er') THEN 1 ELSE coalesce(TRY_CAST(i AS INT), 999999) END, 'i': i, 'content': content}} ORDER BY g) AS a FROM arts GROUP BY doc_id),
 due AS (SELECT doc_id, a, list_reduce(list_prepend([{{'n': 0, 'i': '', 'content': ''}}], list_transform(a, lambda v: [v])),
  lambda x, v: CASE WHEN v[1].n = x[-1].n + 1 THEN list_append(x, v[1]) WHEN len(x) > 1 THEN list_append(x[:-2], {{'n': x[-1].n, 'i': x[-1].i, 'content': x[-1].content || chr(10) || v[1].content}}) ELSE x END)[2:] AS d FROM listed),
 people AS (SELECT doc_id, string_agg(name, ', ' ORDER BY line_no) AS people FROM ({SQL["signatory_match"]}) WHERE doc_id IN (SELECT l_orderkey FROM lineitem) GROUP BY doc_id)
 SELECT doc_id, law_number, o.line AS law_object, CAST(law_date AS VARCHAR) AS law_date, concat('https://sgg.gouv.bj/doc/loi-', replace(split_part(law_number, 'DU', 1), ' ', ''), '/') AS source, coalesce(people, '') AS signatories,
  coalesce(array_to_string(list_transform(CASE WHEN starts_with(o.line, 'modifiant') THEN d ELSE a END, lambda v: v.i || '|' || v.content), chr(10)), '') AS articles
 FROM ({_DATES}) JOIN (SELECT doc_id, line FROM ({L}) WHERE line_no = 3) o USING (doc_id) LEFT JOIN due USING (doc_id) LEFT JOIN people USING (doc_id)"""


@query(_ACT)
def act_whole(spark, sf):
    """Acts from their OCR text to the shape of the act JSON, all steps in one plan."""
    every = F.sort_array(F.flatten(F.collect_list("lines")))
    docs = law_rows(spark, sf).groupBy("doc_id").agg(F.array_join(every["line"], "\n").alias("text"))
    register = table(spark, sf, "nation").select(F.col("n_nationkey").alias("priority"), F.col("n_name").alias("name"), F.lit("country").alias("role"))
    m = lambda name, out: F.col(f"metadata.{name}").alias(out)
    people = F.array_join(F.transform("metadata.signatories", lambda x: x["name"]), ", ").alias("signatories")
    each = F.array_join(F.transform("articles", lambda x: F.concat(x["index"], F.lit("|"), x["content"])), "\n").alias("articles")
    return extraction.extract_laws(docs, register).select("doc_id", m("lawNumber", "law_number"), m("lawObject", "law_object"), m("lawDate", "law_date"), m("source", "source"), people, each)


@query("SELECT doc_id, strlen(text) AS size, doc_id || '_vectors.json' AS vectors, list_filter(string_split(lang || '--', '-'), lambda x: x <> '') AS parts FROM documents")
def file_names(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.octet_length("text").cast("long").alias("size"), text.with_suffix(F.concat(F.col("doc_id").cast("string"), F.lit(".json")), ".json", "_vectors.json").alias("vectors"), text.split_kept(F.concat("lang", F.lit("--")), "-").alias("parts"))


@query("SELECT page_id, regexp_matches(url, '^(?i)(https?|ftp|file|jar):') AS valid FROM pages WHERE url IS NOT NULL")
def url_check(spark, sf):
    return table(spark, sf, "pages").where("url is not null").select("page_id", text.valid_url(F.col("url")).alias("valid"))


@query(f"""SELECT doc_id, place, error FROM (SELECT d.doc_id, 1 AS place, concat('LEXIQUE: ', n_unknown, ' mots inconnus dans l''article 1') AS error FROM ({SQL["lexicon_unknown"]}) d WHERE n_unknown > 0)
 UNION ALL SELECT doc_id, 0, 'Structure: < 2 articles' FROM documents UNION ALL SELECT doc_id, 0, 'Structure: lawNumber manquant' FROM documents WHERE doc_id % 3 = 0""")
def qa_errors(spark, sf):
    d = table(spark, sf, "documents")
    number = F.when(F.col("doc_id") % 3 != 0, F.col("lang"))
    laws = d.select("doc_id", F.struct(number.alias("lawNumber")).alias("metadata"), F.array(F.struct(F.lit("1").alias("index"), F.col("text").alias("content"))).alias("articles"))
    return quality.act_errors(laws, quality.lexicon(table(spark, sf, "benchmark")))


@query("""SELECT doc_id, md5(string_agg(CASE WHEN k.word IS NULL AND f THEN w.word || '*' ELSE w.word END, ' ' ORDER BY i)) AS corrected, CAST(count(*) FILTER (WHERE k.word IS NULL AND f) AS INTEGER) AS n_edits FROM
 (SELECT *, length(word) > 2 AND NOT regexp_matches(word, '^\\p{Lu}') AS f FROM (SELECT doc_id, unnest(p) AS word, generate_subscripts(p, 1) AS i FROM (SELECT doc_id, string_split(text, ' ') AS p FROM documents WHERE text IS NOT NULL))) w
 LEFT JOIN (SELECT DISTINCT unnest(string_split_regex(text, '[ \n]+')) AS word FROM benchmark) k ON k.word = w.word GROUP BY doc_id""")
def grammar_edits(spark, sf):
    """Words that no benchmark text has are marked: a grammar that finds fault with every word, and the benchmark's words as those to accept."""

    def every_word(frames):
        for f in frames:
            rows, key, start = [], [], []
            for k, t in zip(f["key"], f["text"], strict=True):
                at = 0
                for w in t.split(" "):
                    rows.append(w)
                    key.append(k)
                    start.append(at)
                    at += len(w) + 1
            yield f.__class__({"key": key, "start": start, "stop": [s + len(w) for s, w in zip(start, rows, strict=True)], "suggestions": [[w + "*"] for w in rows]})

    texts = table(spark, sf, "documents").where("text is not null").select(F.col("doc_id").alias("key"), "text")
    accepted = table(spark, sf, "benchmark").select(F.explode(F.split("text", "[ \n]+")).alias("word"))
    return edits.corrected(texts, every_word, accepted).select(F.col("key").alias("doc_id"), F.md5("text").alias("corrected"), "n_edits")


# Amending acts whose articles come out of turn, numbered in three ways.
AMENDING = "SELECT o_orderkey AS doc_id, concat('Article ', CASE WHEN o_orderkey % 3 = 0 THEN '1er' WHEN o_orderkey % 3 = 1 THEN 'premier' ELSE '1' END, ' : un', chr(10), 'Article 7 : sept', chr(10), 'Article 2 : deux', chr(10), 'Article 2 bis : encore', chr(10), 'Article 3 : ', o_orderpriority) AS body, o_orderpriority AS p FROM {orders}"


@query(f"""WITH a AS ({AMENDING.format(orders="orders")}) SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '1er' WHEN 1 THEN 'premier' ELSE '1' END AS "index", concat(string_split(body, chr(10))[1], chr(10), 'Article 7 : sept') AS content FROM a
 UNION ALL SELECT doc_id, '2', concat('Article 2 : deux', chr(10), 'Article 2 bis : encore') FROM a UNION ALL SELECT doc_id, '3', trim('Article 3 : ' || p) FROM a""")
def amending_index(spark, sf):
    """Articles of amending acts that are due, with their numbers as written."""
    found = spark.sql(AMENDING, orders=table(spark, sf, "orders")).select("doc_id", F.explode(acts.due_only(acts.articles_of(F.col("body")))).alias("a"))
    return found.select("doc_id", "a.index", "a.content")


@query("SELECT concat('loi-', l_orderkey, '_ART_', l_linenumber % 3) AS id, CAST(arg_min(l_quantity, (l_linenumber, l_quantity)) AS DOUBLE) AS first FROM lineitem WHERE l_linenumber % 3 < 2 GROUP BY l_orderkey, l_linenumber % 3")
def vector_first(spark, sf):
    """Articles of acts with the first of the vectors of their index; those without one are left out."""
    lines = table(spark, sf, "lineitem").select(F.concat(F.lit("loi-"), F.col("l_orderkey").cast("string")).alias("law"), "l_linenumber", (F.col("l_linenumber") % 3).cast("string").alias("index"), F.col("l_quantity").cast("double").alias("q"))
    listed = lambda x: F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "q", "index"))), x)
    grouped = lines.groupBy("law").agg(listed(lambda x: F.struct(x["index"].alias("index"), x["index"].alias("content"))).alias("articles"), listed(lambda x: F.struct(x["index"].alias("index"), F.when(x["index"] != "2", F.array(x["q"])).alias("vector"))).alias("vectors"))
    null = F.lit(None).cast("string")
    laws = grouped.select(F.concat("law", F.lit(".json")).alias("file"), F.struct(F.col("law").alias("lawNumber"), null.alias("lawObject"), null.alias("lawDate")).alias("metadata"), "articles")
    found, _ = ingestion.graph_tables(laws, grouped.select(F.concat("law", F.lit("_vectors.json")).alias("file"), F.col("vectors").alias("articles")))
    return found["articles"].select("id", F.get("embedding", F.lit(0)).alias("first"))


def _cut(name: str, make):
    """A query that gives the rows of another by scans in two levels, in slices that cut through every act."""

    def run(spark, sf):
        return make(law_lines(spark, sf))

    run.__name__ = f"{name}_sliced"
    query(SQL[name])(run)


_cut("body_state", lambda x: scans.body_state(x, size=3))
_cut("article_group", lambda x: scans.articles(x, size=3).select("doc_id", "article_no", "content", fuzzy.standard_number(F.col("content")).alias("index")))


@query(SECTIONS)
def sections_sliced(spark, sf):
    return scans.sections(law_lines(spark, sf), size=3)
