"""Acts that a language model extracts, and acts, articles and vectors kept as a graph of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriscope.functions.text import french_date, is_blank, with_suffix
from juriscope.operators import graph, quality, vectors
from juriscope.sources import calls
from juriscope.sources.adapters import Adapter
from juriscope.sources.readers import LAW_SCHEMA

ANSWER = LAW_SCHEMA.rsplit(", _corrupt", 1)[0]


def extract_by_model(inputs: DataFrame, ask: Adapter, cache: str, by: str = "LLM", force: bool = False, **limits) -> tuple[DataFrame, DataFrame, calls.Told]:
    """Acts that a model reads from inputs (file, text): those that pass the strict gate, stamped, and the rejected with a reason; and what the calls did.

    Answers are JSON of the act's shape; each input is asked for once and its
    answer cached.  An answer that is no JSON is rejected, like a call that failed;
    one bad act stops no other.  ``limits``: those of ``calls.ask_all``.
    """
    answers, failures, counts = calls.ask_all(inputs, ask, cache, force, **limits)
    told = answers.withColumn("law", F.from_json("answer", f"{ANSWER}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))
    told = told.select("file", "law.metadata", "law.articles", F.col("law.metadata.lawNumber").alias("law_number"), F.coalesce(F.size("law.articles"), F.lit(0)).alias("n_articles"))
    good, bad = quality.accepted_and_rejected(told)
    return quality.stamped(good, "file", by).select("file", "metadata", "articles"), bad.select("file", "reason").unionByName(failures.withColumnRenamed("error", "reason")), counts


def one_of_each_law(model: DataFrame, script: DataFrame) -> DataFrame:
    """Acts (file, metadata, articles) of both sources: the model's win by law number, a script's act counts where the model has none.

    An act without metadata goes by its file's name.  Two acts of the model with one
    number are an error, as either could be meant; of a script's the first file counts.
    """
    keyed = lambda df: df.withColumn("key", F.coalesce("metadata.lawNumber", "file"))
    first, other = keyed(model), keyed(script)
    again = graph.duplicates(first, "key").limit(5).collect()
    if again:
        raise ValueError(f"several acts for {', '.join(str(r['key']) for r in again)}")
    return graph.priority_union(first, graph.first_by(other, "key", "file"), "key")


def law_vectors(laws: DataFrame, embed=vectors.hashed_embedding, blanks: bool = False, most: int = 512) -> DataFrame:
    """file (of the vectors), articles (index, vector) and metadata_vectors of acts (file, metadata, articles).

    Blank articles are left out unless ``blanks``; blank metadata has no vector.
    """
    rows = laws.select("file", F.posexplode("articles").alias("article_no", "a"), F.lit("article").alias("what")).select("file", "what", "article_no", F.col("a.index").alias("index"), F.col("a.content").alias("content"))
    meta = lambda place, field: laws.select("file", F.lit("meta").alias("what"), F.lit(place).alias("article_no"), F.lit("").alias("index"), F.col(f"metadata.{field}").alias("content"))
    every = rows.unionByName(meta(0, "lawNumber")).unionByName(meta(1, "lawObject"))
    kept = every.where(~is_blank(F.col("content")) | (F.lit(blanks) & (F.col("what") == "article")))
    key = F.struct("file", "what", "article_no", "index")
    found = vectors.embed_texts(kept.select(key.alias("key"), F.coalesce("content", F.lit("")).alias("content")), embed, most).select("key.*", "vector")
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("what") == "article", F.struct("article_no", "index", "vector")))), lambda x: F.struct(x["index"].alias("index"), x["vector"].alias("vector")))
    of = lambda place: F.max(F.when((F.col("what") == "meta") & (F.col("article_no") == place), F.col("vector")))
    grouped = found.groupBy("file").agg(listed.alias("articles"), F.struct(of(0).alias("lawNumber_vector"), of(1).alias("lawObject_vector")).alias("metadata_vectors"))
    out = laws.select("file").join(grouped, "file", "left")
    return out.select(with_suffix(F.col("file"), ".json", "_vectors.json").alias("file"), F.current_timestamp().alias("timestamp"), F.coalesce("articles", F.array().cast("array<struct<index:string,vector:array<double>>>")).alias("articles"), "metadata_vectors")


def graph_tables(laws: DataFrame, found: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """laws, articles (with their vector) and edges of acts and their vectors, paired by file name; and the articles left out, as they have no vector (law_number, index, file).

    Of several vectors of an index the first in its file counts; of several
    articles of an index the last that has a vector.
    """
    named = laws.withColumn("vectors", with_suffix(F.col("file"), ".json", "_vectors.json"))
    number = F.coalesce("metadata.lawNumber", F.lit(""))
    nodes = graph.law_nodes(named.select(F.col("file").alias("doc_id"), number.alias("law_number"), F.col("metadata.lawObject").alias("law_object"), F.coalesce(F.try_to_date("metadata.lawDate"), french_date(F.col("metadata.lawDate"))).alias("law_date")))
    each = named.select("file", number.alias("law_number"), "vectors", F.posexplode("articles").alias("article_no", "a")).select("file", "law_number", "vectors", "article_no", F.col("a.index").alias("index"), F.col("a.content").alias("content")).where(~is_blank(F.col("content")))
    listed = found.select(F.col("file").alias("vectors"), F.posexplode("articles").alias("at", "v")).select("vectors", F.col("v.index").alias("index"), F.col("v.vector").alias("embedding"), "at")
    having, lacking = vectors.with_vectors(each, listed.where(F.size("embedding") > 0), ["vectors", "index"], "at")
    articles = graph.article_nodes(having.withColumn("article_no", F.struct("article_no", "file")), "embedding")
    return {"laws": nodes, "articles": articles, "edges": graph.edges(articles, nodes)}, lacking.select("law_number", "index", "file")
