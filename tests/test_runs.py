"""Runs from files to graph, and sources against files written by hand."""

import json
import re
import time

import pytest
from pyspark.sql import functions as F

from juriscope import rules, run
from juriscope.functions import fuzzy, text
from juriscope.operators import acts, graph, vectors
from juriscope.plans import extraction, ingestion
from juriscope.sources import adapters, graph_store, readers, writers

ACT = """RÉPUBLIQUE DU BÉNIN
LOI N° 2020 - 07 DU {date}
portant exemple
L'ASSEMBLEE NATIONALE a délibéré
Le Président de la République promulgue la loi
TITRE I GENERALITES
Articie 1er.- Le premier texte
se poursuit ici
Article 2 : Le second texte
Fait à {city}, le {signed}
Aïcha DUPONT.-
Le Garde des Sceaux
{other}
AMPLIATIONS"""


def act(date="24 MARS 2020", city="Cotonou", signed="24 mars 2020", other="Bo"):
    return ACT.format(date=date, city=city, signed=signed, other=other)


def register(spark):
    return spark.createDataFrame([(1, "Aicha DUPONT", "Ministre"), (2, "BO", "Garde"), (3, "Zoé", "Autre")], "priority int, name string, role string")


def test_both_cities_and_misread_dates(spark):
    docs = [
        (1, act()),
        (2, act(city="Porto-Novo")),
        (3, act(date="1er FEVRlER 2O20")),
        (4, act(date="illisible", city="Porto-Novo", signed="3 avrll 2O21")),
        (5, act(date="x", signed="y")),
        (6, act(date="2 mai 20")),
        (7, "rien"),
        (8, None),
    ]
    df = spark.createDataFrame([(i, t, "loi", "2020") for i, t in docs], "doc_id long, text string, type string, year string")
    got = {r["doc_id"]: r for r in extraction.extract_laws(df, register(spark)).collect()}
    assert {i: r["metadata"]["lawDate"] for i, r in got.items()} == {1: "2020-03-24", 2: "2020-03-24", 3: "2020-02-01", 4: "2021-04-03", 5: "", 6: "2020-05-02", 7: "", 8: ""}
    for i in range(1, 7):
        assert [s["name"] for s in got[i]["metadata"]["signatories"]] == ["Aicha DUPONT", "BO"] and len(got[i]["articles"]) == 2
    assert got[7]["articles"] == [] and got[8]["metadata"]["signatories"] == []


def test_shapes_of_cleaned_sections(spark):
    header = "AB/CD\n\nRPUBLIQUE DU BENIN\n\nLOI N° 2025 - 08 DU 24 MARS 2025\n\nportant suite de la loi n° 1 du 27 juin\n1999 portant staiut de\nceux-ci.\n\nL'Assemblée nationale a délibéré et adopté en sa séance du 12 mars\n1999\n\nLe Président de la République promulgue la loi dont la teneur suit"
    footer = "Par ie Président,\nNom TALLE.-\nFait à Cotonou, ie 3 mai 1999\nMinistre\nM ue 45M/7\n123456\nSophie Maxime QU\n\nAMPLIATIONS\nautres"
    row = spark.createDataFrame([(header, footer)], "h string, f string").select(acts.cleaned_header(F.col("h")).alias("h"), acts.cleaned_footer(F.col("f")).alias("f")).first()
    assert row["h"].asDict() == {"republic": "BENIN", "number": "2025 - 08 DU 24 MARS 2025", "object": "portant suite de la loi n° 1 du 27 juin 1999 portant staiut de ceux-ci.", "assembly": "a délibéré et adopté en sa séance du 12 mars 1999", "president": "Le Président de la République"}
    assert row["f"].asDict() == {"city": "Cotonou", "signed": "3 mai 1999", "signatories": "Ministre\nM ue 45M/7\n123456\nSophie Maxime QU"}


def test_templates_by_either_name(spark):
    df = spark.createDataFrame([("h",)], "x string")
    fields = F.struct(*[F.lit(v).alias(n) for n, v in (("republic", "BENIN"), ("number", "1"), ("object", "o"), ("assembly", "a"), ("president", "p"))])
    got = df.select(acts.header_text(fields, "[BENIN/DAHOMEY]|[TO_FILL_LAW_NUMBER]|[object]|[TO_FILL_ASSEMBLY]|[TO_FILL_PRESIDENT]|[TO_FILL_OBJECT]").alias("t")).first()["t"]
    assert got == "BENIN|1|o|a|p|o"


def test_amending_acts_keep_what_is_due(spark):
    body = "\n".join(f"Article {n} : texte {n}" for n in (7, 1, 5, 2, 2, 4, 3))
    got = spark.createDataFrame([(body,)], "b string").select(acts.due_only(acts.articles_of(F.col("b"))).alias("a")).first()["a"]
    assert [(a["index"], a["content"].count("texte")) for a in got] == [("1", 2), ("2", 3), ("3", 1)]
    body = "Article premier : un\nArticle 3 : trois\nArticle 2 : deux\nArticle 1er : encore"
    got = spark.createDataFrame([(body,)], "b string").select(acts.due_only(acts.articles_of(F.col("b"))).alias("a")).first()["a"]
    assert [tuple(a) for a in got] == [(1, "premier", "Article premier : un\nArticle 3 : trois"), (2, "2", "Article 2 : deux\nArticle 1er : encore")]


def test_corrections_by_value(spark):
    """Typed apart from the rules: each slip, and what it becomes."""
    pairs = {"(voir 3.) î": "(voir 3", "a' RP b": "a b", "ArtIcle 4": "Article 4", "Arficle": "Article", "Article 1e'": "Article 1er", "Pait à COIONOU": "Fait à Cotonou", "1er FEVRIER": "1 février", "K/àç(j ds sT": "", "pertant": "portant", "lÉtat": "l'État", "parlequelle": "par lequel le", "fin.)": "fin.)"}
    rows = spark.createDataFrame([(a, b) for a, b in pairs.items()], "a string, b string").select("a", "b", text.corrected(F.col("a")).alias("c")).collect()
    assert {r["a"]: r["c"] for r in rows} == pairs
    assert len(rules.CORRECTIONS) == 58 and len({a for a, _ in rules.CORRECTIONS}) == 58


def test_older_numbers_and_names(spark):
    one = lambda f, v: spark.createDataFrame([(v,)], "c string").select(f(F.col("c")).alias("x")).first()["x"]
    assert one(lambda c: text.leading_number(c, 24), "Article 12.- Le texte est long et suit") == "12"
    assert one(lambda c: text.leading_number(c, 24), "Article 12 bis du texte qui suit ici") == "12" and one(lambda c: text.leading_number(c, 24), "Art 5") == "5"
    assert one(lambda c: text.leading_number(c, 5), "Article 12") is None
    assert one(text.valid_url, "https://a.b/c") is True and one(text.valid_url, "nope://x") is False and one(text.valid_url, None) is False
    assert one(lambda c: text.split_kept(c, ","), "a,,b,,") == ["a", "", "b"] and one(lambda c: text.split_kept(c, ","), "") == [""] and one(lambda c: text.split_kept(c, ","), ",") == []
    assert one(lambda c: text.before_first(c, "promulgue"), "Le Président\nPromulgue la loi") == "Le Président" and one(lambda c: text.replace_early(c, F.lit("a"), F.lit("b"), 3), "aaaaa") == "bbbaa"
    assert one(text.is_numeric, "0123") is True and one(text.is_numeric, "1a") is False and one(fuzzy.is_garbage, "Ampliations") is True and one(fuzzy.is_garbage, "a 12345") is False and one(fuzzy.is_garbage, "a\t12345") is True and one(fuzzy.is_garbage, "a12345z") is True


DELIMITERS = rules.DELIMITERS


def plain_article(line):
    """The normal form of a line that opens an article, step by step."""
    early = lambda c, d: d in c[:25]
    number = re.search(r"(?i)(\d+[a-z0-9-]*|premier|un)(?:\s|[.:,-]|" + "|".join(map(re.escape, DELIMITERS)) + "|$)", "")
    near = any(edit(line[:10][i : i + 7], "Article") <= 3 for i in range(4) if len(line[:10]) >= i + 7)
    labelled = "Article" + line[7:] if near else line
    c = labelled
    for d in DELIMITERS:
        if early(labelled, d):
            c = labelled.replace(d, ":")
            break
    if early(c, "::"):
        c = c[:25].replace("::", ":") + c[25:]
    elif early(c, ","):
        c = c[:25].replace(",", "") + c[25:]
    number = re.search(r"(?i)(\d+[a-z0-9-]*|premier|un)(?=\s|[.:,-]|" + "|".join(map(re.escape, DELIMITERS)) + "|$)", c[:24], re.ASCII)
    number = number[1].lower() if number else ""
    number = "1" if number in ("premier", "un") else number
    x = c
    if not any(early(labelled, d) for d in DELIMITERS) and number and number in c:
        head, rest = c.split(number, 1)
        x = head + number + " : " + rest.split(number, 1)[0]
    x = x.split(":", 1)[1].strip(" \t\n") if ":" in x else x
    p = re.sub(r"(?:(?:" + "|".join(map(re.escape, DELIMITERS)) + r")\s*)+", ": ", x[:25])
    x = re.sub(r"\s{2,}", " ", p) + x[25:]
    p = re.sub(r"\s*:\s*", " : ", x[:25])
    x = re.sub(r"\s{2,}", " ", p).strip() + x[25:]
    return f"Article {number} : " + re.sub("^:+", "", x).strip()


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_article_lines_against_plain_python(spark):
    import random

    rng = random.Random(3)
    labels = ["Article ", "Articie ", "ARTICLE ", "Arficle ", "article ", "Artic1e "]
    numbers = ["1er", "1", "12", "premier", "3-1", "7bis", "unique", "240"]
    seps = [".- ", " : ", " ", ", ", " - ", ". ", " :: ", ".-", ":"]
    rest = ["Le texte suit. Il va", "de la loi 12 et 1er alinéa", "Un, deux : trois", "", "- point", "le 1 mars 12"]
    some = sorted({rng.choice(labels) + rng.choice(numbers) + rng.choice(seps) + rng.choice(rest) for _ in range(400)})
    rows = spark.createDataFrame([(x,) for x in some], "c string").select("c", fuzzy.looks_like_article(F.col("c")).alias("is"), fuzzy.normalized_article(F.col("c")).alias("x")).collect()
    opened = [r for r in rows if r["is"]]
    assert len(opened) > 200
    wrong = [(r["c"], r["x"], plain_article(r["c"])) for r in opened if r["x"] != plain_article(r["c"])]
    assert not wrong, wrong[:5]


def test_sources(spark, tmp_path):
    (tmp_path / "words").mkdir()
    (tmp_path / "words" / "b.txt").write_text("loi  décret\nloi")
    (tmp_path / "words" / "a.txt").write_text("acte")
    assert [r["word"] for r in readers.read_words(spark, str(tmp_path / "words")).collect()] == ["acte", "décret", "loi"]
    (tmp_path / "corrections").mkdir()
    (tmp_path / "corrections" / "1.csv").write_text("a,b\nx,y\nno comma")
    (tmp_path / "corrections" / "2.csv").write_text("a,c\nz,")
    assert readers.read_corrections(spark, str(tmp_path / "corrections")) == (("a", "c"), ("x", "y"), ("z", ""))
    (tmp_path / "t.txt").write_text("# note\nLOI [number]\n")
    assert readers.read_template(spark, str(tmp_path / "t.txt")) == "LOI [number]"
    (tmp_path / "p.properties").write_text("# c\nuri = bolt://x\nuser:me\nempty=\n")
    p = readers.read_properties(spark, str(tmp_path / "p.properties"))
    assert (p.setting("uri"), p.setting("user"), p.setting("empty"), p.setting("none", "d")) == ("bolt://x", "me", "", "d")
    with pytest.raises(KeyError):
        p.setting("none")
    usage = spark.createDataFrame([('{"usage": {"prompt_tokens": 3, "total_tokens": 5}}',), ("{}",)], "answer string")
    assert [tuple(r) for r in adapters.token_usage(usage).collect()] == [(3, 0, 5), (0, 0, 0)]
    assert graph.duplicates(spark.createDataFrame([("a",), ("a",), ("b",)], "id string")).collect()[0]["id"] == "a"
    writers.write_laws(spark.createDataFrame([("f", "x")], "file string, text string"), str(tmp_path / "laws"), pretty=True)
    assert spark.read.text(str(tmp_path / "laws"), wholetext=True).count() == 1


def test_embeddings(spark):
    df = spark.createDataFrame([(1, 1, "la loi la loi"), (1, 2, " "), (2, 1, "mot. " * 300)], "doc_id long, article_no int, content string")
    got = {(r[0], r[1]): r["vector"] for r in vectors.embed_articles(df).collect()}
    assert set(got) == {(1, 1), (2, 1)} and all(sum(x * x for x in v) == pytest.approx(1) for v in got.values())

    @vectors.adapter
    def lengths(frames):
        for f in frames:
            yield f.assign(vector=[[float(len(x))] for x in f["chunk"]])[["key", "vector"]]

    assert {(r[0], r[1]): r["vector"][0] for r in vectors.embed_articles(df, lengths).collect()}[1, 1] == 13.0


def test_runs_from_files_to_graph(spark, tmp_path):
    for name in ("input", "lexicon"):
        (tmp_path / name).mkdir()
    (tmp_path / "input" / "loi-2020-07.pdf").write_text(act())
    (tmp_path / "input" / "loi-2021-01.pdf").write_text(act().replace("2020 - 07", "2021 - 01"))
    (tmp_path / "lexicon" / "w.txt").write_text("premier texte article second")
    (tmp_path / "register.csv").write_text("Aicha DUPONT;Ministre\n")
    go = lambda *a, **k: run.main(spark, [a[0], str(tmp_path), *a[1:]], **k)
    read = tmp_path / "read"
    read.mkdir()

    def ocr(frames):
        for f in frames:
            for name in f["file"]:
                (read / f"{name}.{time.time_ns()}").touch()
            yield from adapters.plain_text(iter([f]))

    assert [go("extract", *a, ocr=ocr)["laws"] for a in (["--pdf", "loi-2020-07.pdf"], [], [], ["--force"])] == [1, 1, 0, 2]
    assert len(list(read.iterdir())) == 2  # a file is read once, forced or not
    law = json.loads((tmp_path / "script" / "loi-2020-07.json").read_text())
    assert law["metadata"]["lawNumber"] == "2020 - 07 DU 24 MARS 2020" and law["metadata"]["signatories"] == [{"name": "Aicha DUPONT", "role": "Ministre"}]
    assert any("mots inconnus dans l'article 1" in r["error"] for r in spark.read.parquet(str(tmp_path / "errors")).collect())
    asked = []

    def ask(frames):
        for f in frames:
            answers = ['{"metadata": {"lawNumber": "2020 - 07 DU 24 MARS 2020", "lawObject": "du modèle"}, "articles": [{"index": "1", "content": "un"}, {"index": "2", "content": "deux"}, {"index": "3", "content": " "}]}' if "2020 - 07" in t else "no json" for t in f["text"]]
            yield f.assign(answer=answers)[["file", "answer"]]

    told = go("model", ask=ask)
    assert (told["laws"], told["answered"], told["failed"], told["unasked"]) == (1, 2, 0, 0) and not asked
    assert go("model", ask=ask)["answered"] == 0
    assert spark.read.parquet(str(tmp_path / "rejected")).first()["reason"] == "lawNumber manquant"
    (tmp_path / "llm" / "broken.json").write_text('{"metadata": ')
    (tmp_path / "llm" / "empty.json").write_text(" ")
    (tmp_path / "script" / "other.json").write_text('{"x": 1}')
    m = json.loads((tmp_path / "llm" / "loi-2020-07.json").read_text())["metadata"]
    assert m["source_pdf"] == "loi-2020-07.pdf" and m["extracted_by"] == "LLM" and m["extracted_at"].endswith("Z")
    first = go("ingest")
    assert {c: first[c] for c in ("laws", "articles", "edges", "rejected", "without_vector", "articles_replaced")} == {"laws": 2, "articles": 4, "edges": 4, "rejected": 3, "without_vector": 0, "articles_replaced": 0}
    rejected = {(r["file"], r["reason"]) for r in spark.read.parquet(str(tmp_path / "rejected")).collect()}
    assert {("broken.json", "JSON illisible"), ("empty.json", "JSON illisible"), ("other.json", "ni metadata ni articles")} <= rejected
    articles = graph_store.read_graph(spark, str(tmp_path / "graph"), "articles")
    assert articles.where("embedding is null").count() == 0 and {r["content"] for r in articles.where("id like '2020%'").collect()} == {"un", "deux"}
    again, reload = go("ingest"), go("reload")
    assert first["embedded"] > 0 and again["embedded"] == reload["embedded"] == 0  # nothing changed, so no chunk is new
    assert all((x["laws"], x["laws_replaced"], x["articles"], x["articles_replaced"], x["edges_replaced"]) == (2, 2, 4, 4, 4) for x in (again, reload))
    assert go("vectors")["vectors"] == 2
    assert go("clear") == {"nodes": 6} and go("clear") == {"nodes": 0}
    twice = spark.createDataFrame([("a",), ("b",)], "file string").select("file", F.struct(F.lit("1").alias("lawNumber")).alias("metadata"), F.array().alias("articles"))
    with pytest.raises(ValueError):
        ingestion.one_of_each_law(twice, twice.limit(0))
