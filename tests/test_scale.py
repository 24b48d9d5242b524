"""Steps whose cost must not grow faster than their input: what they are given at once, and rows that stay the same."""

import re

import pandas as pd
from pyspark.sql import functions as F

from juriscope.functions import fuzzy, text
from juriscope.operators import acts, edits, lines
from juriscope.plans import extraction, queries
from juriscope.rules import FRENCH_LAW


def digest(df):
    return tuple(df.select(F.xxhash64(F.to_json(F.struct(*df.columns))).alias("h")).agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)"))).first())


def test_lines_of_acts_are_those_of_their_sql(spark, sf):
    by_sql = spark.sql(queries.LAW_LINES, **{t: queries.table(spark, sf, t) for t in ("orders", "lineitem", "part", "nation")})
    made = queries.law_lines(spark, sf)
    assert made.schema.simpleString() == by_sql.schema.simpleString() and digest(made) == digest(by_sql)


def test_blanks_before_a_line_separator_are_trimmed_at_ends_only(spark):
    rows = spark.createDataFrame([("\x00 a \u0085",), (" \n",), ("a \n",), (None,)], "s string")
    assert [r[0] for r in rows.select(text.trimmed(F.col("s"))).collect()] == ["a \u0085", "", "a", None]


def test_no_label_or_correction_is_lost_to_the_tests_before_it(spark):
    words = [k for k, _ in FRENCH_LAW.corrections]
    rows = spark.createDataFrame([(f"x {w} y",) for w in words] + [("rien",), (None,)], "s string")
    one_by_one = F.col("s")
    for a, b in FRENCH_LAW.corrections:
        one_by_one = F.replace(one_by_one, F.lit(a), F.lit(b))
    assert all(a == b for a, b in rows.select(text.corrected(F.col("s")), one_by_one).collect())
    lines = spark.createDataFrame([("Foit à Cotomou, le",), ("xFait a Cotanou",), ("Fxxx àxCxtonou",), ("rien",), (None,)], "s string")
    assert [r[0] for r in lines.select(fuzzy.within_distance(F.col("s"), "Fait à Cotonou", 20, 3)).collect()] == [True, True, False, False, False]


def test_a_law_node_carries_no_articles(spark, sf):
    plan = queries.graph_laws(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "^[a-z]" not in plan  # by which articles are cut


def test_a_grammar_is_given_bounded_pieces(spark):
    frame = pd.DataFrame({"key": range(6), "text": ["a" * 40] * 4 + ["b" * 500, None]})
    got = list(edits.in_pieces(iter([frame]), 100))
    assert [list(f["key"]) for f in got] == [[0, 1], [2, 3], [4], [5]]


def test_what_is_near_a_target_is_found_behind_the_test_before_it(spark):
    rows = spark.createDataFrame([("l'assemblée",), ("ass",), ("emb x",), ("nationalle",), ("notionale",), ("rien du tout",), ("",), (None,)], "s string")
    seen = [tuple(r) for r in rows.select(*[fuzzy.contains_target(F.col("s"), t, 3) for t in ("assemblee", "nationale")]).collect()]
    assert seen == [(True, False), (True, False), (True, False), (False, True), (False, True), (False, False), (False, False), (False, False)]


def test_index_counts_pairs_before_it_sends_them_on(spark, sf):
    plan = queries.vector_index_topk(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "bound" in plan


def test_slices_of_acts_are_not_shuffled_again(spark, sf):
    for name in ("body_state_sliced", "article_group_sliced", "sections_sliced"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString().split("\n")
        assert not any("Exchange" in x and "slice" in x for x in plan) and not any("Join" in x and "slice" in x for x in plan)


def test_lines_of_acts_with_repeated_and_missing_keys(spark, tmp_path):
    tables = {
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date", "(1, 3, 'O', date'2020-01-02'), (1, 3, 'O', date'2020-01-02'), (2, null, 'F', date'2021-12-31'), (3, 5, null, null), (null, 7, 'O', date'2020-05-05'), (4, 50, 'P', date'2020-08-01')"),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, l_shipdate date, l_linenumber int", "(1, 1, 1, 1, 1, null, 2), (1, 1, 1, 1, 1, null, 2), (1, null, 1, 1, 1, null, 2), (1, 5, 1, 1, 1, null, null), (1, 77, 1, 1, 1, null, 3), (2, 7, null, null, 1, null, 1), (9, 1, 1, 1, 1, null, 1), (null, 1, 1, 1, 1, null, 1), (4, 8, 1, double('NaN'), 1, null, 1), (4, 9, 1, 0, 1, null, 1)"),
        "part": ("p_partkey long, p_name string", "(1, 'un'), (1, 'encore'), (5, null), (7, 'sept'), (8, 'huit'), (9, 'neuf'), (null, 'rien')"),
        "nation": ("n_nationkey int, n_name string", "(0, 'A'), (3, 'B'), (3, 'C'), (5, null), (10, 'D')"),
    }
    for name, (schema, values) in tables.items():
        names = [c.split()[0] for c in schema.split(", ")]
        rows = spark.sql(f"SELECT * FROM VALUES {values} t({', '.join(names)})")
        rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")]).write.parquet(f"{tmp_path}/{name}.parquet")
    by_sql = spark.sql(queries.LAW_LINES, **{t: queries.table(spark, str(tmp_path), t) for t in tables})
    assert sorted(map(repr, queries.law_lines(spark, str(tmp_path)).collect())) == sorted(map(repr, by_sql.collect()))


def test_no_stretch_of_the_normal_form_is_too_long_to_compile(spark, sf):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = queries.article_normalize(spark, sf)._jdf.queryExecution()
    told = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", told))) < 8000  # bytes, the JVM's limit
    some = ["Articie 12.- Le texte", "ARTICLE 3 : un : deux", "Arficle 4 a 4 b", "Article premier, de", "article", "Une ligne", "", None]
    rows = spark.createDataFrame([(x,) for x in some], "line string").withColumn("opens", fuzzy.looks_like_article(F.col("line")))
    got = fuzzy.with_normal_form(rows, "opens").select(fuzzy.normalized_article(F.col("line")), F.coalesce("normal", "line")).collect()
    assert all(a == b for a, b in got) and got[0][0] == "Article 12 : Le texte"


def test_an_acts_fields_are_found_without_exceptions(spark):
    rows = spark.createDataFrame([(1, "LOI N° 2 DU 3 MAI 2004\nportant x\nAssemblée nationale", "", "Fait à Cotonou, le 3 mai 2004", "loi", "2004")], "doc_id long, header string, body string, footer string, type string, year string")
    told = extraction.act_fields(rows)
    assert "array_position" not in told._jdf.queryExecution().optimizedPlan().toString()
    assert told.select("law_number", "law_object", F.col("law_date").cast("string")).collect() == [("2 DU 3 MAI 2004", "portant x", "2004-05-03")]


def test_lines_tested_beforehand_give_the_sections_of_whole_texts(spark):
    heads = ["RÉPUBLIQUE DU BENIN\nLOI N° 2\nportant x", "au DAHOMEY\nx/y LOI N° 3\nportant , y", "LOI N° 4\nsur z\nLOI N° 5", "portant LOI", "LOI N° 6\nD\nfixant\ru\n L'Assemblée nationale a voté \npromulgue", "loi N° 7 LOI 8 LOI 9", "LOI\u0001na\nrelative"]
    bodies = ["Article 1 : un\nsuite\nArticle 2", " Article 3 : a , b\nLOI , c", "Article 4\rArticle 5\n\u0001x", ""]
    feet = ["Fait à Cotonou, le 1 mai 2000\nA. B\nAMPLIATIONS\nC", "Fait à Porto-Novo, le 2 mai 2000\nPORTO-NOVO\nD", "Fait à Cotonou et Porto-Novo\n E \nFait à tort\nF\nJOURNAL OFFICIEL AMPLIATIONS Fait à Cotonou\nG", "Fait à PORTO-NOVO\rH\nFait à Cotonou\nI", ""]
    texts = [(i, "\n".join(x for x in t if x)) for i, t in enumerate((h, b, f) for h in heads for b in bodies for f in feet)]
    told = lines.to_lines(spark.createDataFrame(texts, "doc_id long, text string")).where("trim(line) <> ''")
    whole = extraction.act_sections(lines.section_texts(told)).select("doc_id", "head", "foot", "articles")
    got = extraction.marked_acts(lines.marked_sections(told)).select(*whole.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect())) and got.count() == len(texts)


def test_fields_found_in_a_whole_header_are_those_of_its_lines(spark):
    heads = ["a\nLOI N° 1\nx\nportant y\nz\nl'ASSEMBLEE\nw", "lOİ 2\nSUR a NATIONALE\nrelative", "LOI 3", "portant a\nb", "Définissant\nFIXANT\nnationale", "x LOI\n\nabrogeant\n\n", "LOI\nloi\nSur", "dÉfinissant é", "", "\n", "LOI 4\n portant\nportant\r\nASSEMBLEE", "aſſemblee\nſur\nsurtout"]
    rows = spark.createDataFrame([(h,) for h in heads], "h string")
    pairs = [(acts.number_in, acts.number_lines), (acts.object_in, acts.object_lines)]
    got = rows.select(*[c for whole, by_line in pairs for c in (whole(F.col("h")), by_line(F.split("h", "\n")))]).collect()
    assert [(r[0], r[2]) for r in got] == [(r[1], r[3]) for r in got] and got[0][2] == "portant y\nz"


def test_a_date_without_a_slip_needs_no_repair(spark):
    said = ["3 MAI 2004", "31 FÉVRIER 2004", "29 Février 2003", "0 mai 2004", "32 mai 2004", "1er mai 2004", "3 mai 0000", "3  mai 2004", "l5 mai 2004", "3 mal 2004", "3 mai 2004\u0085", "03 août 1999", "3 mai-2004", "", None]
    rows = spark.createDataFrame([(s, "1990") for s in said], "s string, year string").withColumn("month", text.written_month(F.col("s")))
    by_repair = text.french_date(text.repair_date(F.col("s"), F.col("year")))
    got = rows.select("s", F.col("month").isin(*FRENCH_LAW.months), text.written_date(F.col("s"), F.col("month")), by_repair).collect()
    assert [r[0] for r in got if r[1]] == ["3 MAI 2004", "31 FÉVRIER 2004", "29 Février 2003", "0 mai 2004", "32 mai 2004", "3 mai 0000", "03 août 1999"]
    assert all(r[2] == r[3] for r in got if r[1])


def test_acts_are_read_in_two_windows_and_without_lists_of_header_lines(spark, sf):
    rows = lines.marked_sections(lines.repaired(queries.law_lines(spark, sf)).select("doc_id", "line_no", "line"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 2
    told = extraction.read_fields(extraction.act_sections(spark.createDataFrame([(1, "", "", "", "2004")], "doc_id long, header string, body string, footer string, year string")))
    assert "head_lines" not in told._jdf.queryExecution().analyzed().toString()
