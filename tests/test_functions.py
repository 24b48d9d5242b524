"""Column functions against examples written out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from juriscope.functions import fuzzy, text
from juriscope.operators import dictionary, lines, quality
from juriscope.sources import adapters


def one(spark, f, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("line", "is_one"),
    [("Article 1er.- Le Bénin", True), ("d'article 5", False), ("L'article 5", False), ("Articles 3 et 4", False), ("Articie 12 : x", True), ("ARTICLES 3 : x", True), ("", False), (None, False), ("Article sans numero", False)],
)
def test_article_lines(spark, line, is_one):
    assert one(spark, fuzzy.looks_like_article, line) is is_one


def test_dates(spark):
    assert one(spark, lambda c, y: text.repair_date(c, y), "1er FEVRlER I964", "1999") == "1 février 1964"
    assert one(spark, text.french_date, "31 février 2023") == date(2023, 2, 28)
    assert one(spark, text.french_date, "24 MARS 2025") == date(2025, 3, 24)
    assert one(spark, text.french_date, "40 mars 2025") is None and one(spark, text.french_date, "x") is None


def test_text(spark):
    assert one(spark, text.single_line, "a\n- b\nc") == "a\n- b c"
    assert one(spark, text.single_line, "cons-\ntitution  du\r\npays") == "constitution du pays"
    assert one(spark, text.corrected, "Article 167 :") == "AArticle 167 :"
    assert one(spark, text.strip_accents, "Élève œuvre ñ") == "Eleve œuvre n"
    assert one(spark, text.letters_only, "l'État") == "letat"
    assert one(spark, text.ocr_digits, "I9o4x") == "1904"
    assert one(spark, text.from_first_digit, "LOI N° 2025 - 08 ") == "2025 - 08"
    assert one(spark, lambda c: text.after_first(c, "nationale"), "l'Assemblée NATIONALE a voté") == "a voté"
    assert one(spark, text.trimmed, "\t a \n") == "a" and one(spark, text.is_blank, "  \t") is True
    assert one(spark, lambda w: text.split_word(w, F.array(F.lit("parmi"), F.lit("par"), F.lit("les")), ("le",)), "parmiles") == "parmi les"
    assert one(spark, lambda a, b: text.partial_jaccard(a, b), "le chat noir", "un chat") == pytest.approx(1 / 3)


def test_numbers(spark):
    assert one(spark, lambda c: fuzzy.number_at_start(c, 24), "Article premier : x") == "1"
    assert one(spark, lambda c: fuzzy.number_at_start(c, 24), "Article 1er.- x") == "1er"
    assert one(spark, fuzzy.standard_number, "Article 10 : x") == "10" and one(spark, fuzzy.standard_number, "x") == "UNKNOWN"
    assert [one(spark, fuzzy.number_value, x) for x in ("1er", "premier", "12", "x")] == [1, 1, 12, 999999]


def test_normalized_articles(spark):
    assert one(spark, fuzzy.normalized_article, "Articie 12.- Le texte") == "Article 12 : Le texte"
    assert one(spark, fuzzy.normalized_article, "Une ligne") == "Une ligne"


def test_chunks(spark):
    first, second = "a" * 299 + ".", "b" * 299 + "."
    assert one(spark, text.chunks, f"{first} {second}") == [first, second]
    assert one(spark, text.chunks, "Un. Deux! Trois?") == ["Un. Deux! Trois?"] and one(spark, text.chunks, "") == []


def test_renumbering(spark):
    rows = spark.createDataFrame([(1, i, n, f"t{n}") for i, n in enumerate([7, 1, 5, 2])], "doc_id long, article_no long, number int, content string")
    assert [tuple(r)[1:] for r in lines.renumbered(rows).orderBy("number").collect()] == [(1, "t1\nt5"), (2, "t2")]


def test_pages(spark):
    pages = spark.createDataFrame([("f", 1, "a"), ("f", 2, "Ampliations"), ("f", 3, "c")], "file string, page int, text string")
    assert adapters.joined_pages(pages).first()["text"] == "=== PAGE 1 ===\na\n=== PAGE 2 ===\nAmpliations"


def test_edits(spark):
    df = spark.sql("SELECT 'le chien noire et Paris' AS t, array(named_struct('start', 9, 'stop', 14, 'replacement', 'noir'), named_struct('start', 18, 'stop', 23, 'replacement', 'x'), named_struct('start', 3, 'stop', 8, 'replacement', 'chat')) AS e")
    assert df.select(text.with_edits(F.col("t"), F.col("e")).alias("x")).first()["x"] == "le chat noir et Paris"
    assert df.select(text.with_edits(F.col("t"), F.filter("e", lambda x: F.lit(False))).alias("x")).first()["x"] == "le chien noire et Paris"


def test_dictionary(spark):
    known = ["Ifa", "vie", "parmi", "les", "par", "loi", "décret", "finir", "garde", "texte", "a", None, " "]
    table = spark.createDataFrame([(i, w) for i, w in enumerate(known)], "priority int, word string")
    asked = ["lfa", "vieà", "béninois", "sonl", "parmiles", "decret", "flnir", "tarde", "texle", "loi", "Decret", "x1", "", None, "zzzz", "lfa"]
    got = dictionary.repaired_words(spark.createDataFrame([(w,) for w in asked], "word string"), table).collect()
    assert {r["word"]: (r["rule"], r["fixed"]) for r in got} == {
        "lfa": ("capital i", "Ifa"), "vieà": ("glued", "vie à"), "sonl": ("frequent", "sont"), "parmiles": ("split", "parmi les"),
        "decret": ("accent", "décret"), "flnir": ("shape", "finir"), "tarde": ("distance", "garde"), "texle": ("shape", "texte"),
    }
    rows = [(1, 1, "Le decret decret parmiles Jean decret Paul  "), (1, 2, None), (2, 1, "")]
    out = dictionary.repaired_lines(spark.createDataFrame(rows, "doc_id long, line_no int, line string"), table)
    assert {(r[0], r[1]): r[2] for r in out.collect()} == {(1, 1): "Le décret décret parmi les Jean decret Paul", (1, 2): None, (2, 1): ""}


def test_rejected_acts(spark):
    laws = spark.createDataFrame([(1, "2020-1", 2), (2, " ", 5), (3, None, 5), (4, "2020-2", None)], "doc_id long, law_number string, n_articles long")
    good, bad = quality.accepted_and_rejected(laws)
    assert [r["doc_id"] for r in good.collect()] == [1]
    assert {r["doc_id"]: r["reason"] for r in bad.collect()} == {2: "lawNumber manquant", 3: "lawNumber manquant", 4: "Moins de 2 articles"}
