"""Queries against their SQL on the smallest tables, and the whole life of an act."""

import os

import duckdb
import pytest

from juriscope.plans import queries as law
from juriscope.plans.extraction import extract_laws
from juriscope.sources import readers, writers
from juriscope.streaming.incremental import process_new_files

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    return con


def plain(x):
    if hasattr(x, "tolist") or isinstance(x, list):
        return [v if isinstance(v, str) else round(float(v), 5) for v in x]
    return str(x)[:10] if hasattr(x, "year") else x


@pytest.mark.parametrize("name", sorted(law.SQL))
def test_sql(spark, duck, name):
    df = law.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(str([plain(x) for x in r]) for r in df.select(*columns).collect())
    cursor = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({law.SQL[name]})")
    assert got == sorted(str([plain(x) for x in r]) for r in cursor.fetchall())


def test_core_has_no_python(spark):
    for name in ("article_group", "section_texts", "signatory_match", "article_normalize"):
        plan = law.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan


ACT = """RÉPUBLIQUE DU BÉNIN
LOI N° 2020 - 07 DU 24 MARS 2020
portant exemple
L'ASSEMBLEE NATIONALE a délibéré
Le Président de la République promulgue la loi
TITRE I GENERALITES
Articie 1er.- Le premier texte
se poursuit ici
Article 2 : Le second texte
Fait à Cotonou, le 24 mars 2020
Aïcha DUPONT.-
AMPLIATIONS"""


def test_life_of_an_act(spark, tmp_path):
    (tmp_path / "register.csv").write_text("# comment\nAicha DUPONT;Ministre, porte-parole\n", encoding="utf-8")
    register = readers.read_register(spark, str(tmp_path / "register.csv"))
    docs = spark.createDataFrame([(1, ACT), (2, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in extract_laws(docs, register).collect()}
    m = got[1]["metadata"]
    assert (m["lawNumber"], m["lawObject"], m["lawDate"]) == ("2020 - 07 DU 24 MARS 2020", "portant exemple", "2020-03-24")
    assert [s["name"] for s in m["signatories"]] == ["Aicha DUPONT"] and m["source"].endswith("/loi-2020-07/")
    assert [(a["index"], a["content"]) for a in got[1]["articles"]] == [("1er", "Article 1er : Le premier texte se poursuit ici"), ("2", "Article 2 : Le second texte")]
    assert got[2]["articles"] == [] and got[2]["metadata"]["lawNumber"] == ""
    laws = extract_laws(docs, register).select("metadata", "articles")
    writers.write_laws(laws, str(tmp_path / "laws"))
    assert spark.read.json(str(tmp_path / "laws")).count() == 2


def test_stream_reads_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one")
    step = lambda df: df.select("file")
    for _ in range(2):
        process_new_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"), step).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_each_fuzzy_match_stands_once(spark):
    """Two words of the assembly, two cities, and the months of the two dates that an act may have."""
    plan = law.QUERIES["act_metadata"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("levenshtein") == 2 + 2 + 2 * 12


def test_no_acts(spark):
    register = spark.createDataFrame([(1, "Aicha DUPONT", "Ministre")], "priority int, name string, role string")
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert extract_laws(docs.where("doc_id > 2"), register).collect() == []
    assert [(len(r["articles"]), r["metadata"]["lawNumber"]) for r in extract_laws(docs, register).collect()] == [(0, ""), (0, "")]
