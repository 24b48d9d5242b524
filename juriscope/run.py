"""Command line: ``python -m juriscope.run extract|model|ingest|reload|clear|vectors FOLDER [--pdf NAME] [--force]``.

FOLDER holds ``input`` (files), ``script`` and ``llm`` (acts as JSON), ``vectors``,
``graph`` and ``register.csv``, ``lexicon`` (word files), and may hold ``accepted``
(words that the grammar leaves alone) and ``head.txt``, ``foot.txt`` (templates);
what a command needs must be there.  OCR, the text that a file itself holds, the
language model, the grammar and the embedding are adapters that ``main`` takes.

What could not be read or kept stands in ``rejected``, with its file and reason.
"""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from juriscope.functions.text import file_parts, with_suffix
from juriscope.operators import acts, quality, vectors
from juriscope.plans import extraction, ingestion
from juriscope.sources import adapters, calls, graph_store, ocr_cache, readers, vector_store, writers
from juriscope.streaming.incremental import new_only

COMMANDS = ("extract", "model", "ingest", "reload", "clear", "vectors")


def options(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="juriscope")
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("folder")
    p.add_argument("--pdf", help="the one file to work on")
    p.add_argument("--force", action="store_true", help="work on files that have an output too")
    p.add_argument("--suffix", default="pdf")
    return p.parse_args(argv)


def laws_in(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Acts (file, metadata, articles) of a folder of JSON, and the files that hold none with the reason; none of either if it is not there."""
    try:
        read = readers.read_laws(spark, folder)
    except AnalysisException:
        return spark.createDataFrame([], f"file string, {ingestion.ANSWER}"), spark.createDataFrame([], "file string, reason string")
    return readers.good_and_rejected(read)


def optional(spark: SparkSession, read, path: str, otherwise):
    """What a reader finds, or something else if the file is not there."""
    try:
        return read(spark, path)
    except AnalysisException:
        return otherwise


def pages_of(spark: SparkSession, args: argparse.Namespace, done: str, ocr: adapters.Adapter, native: adapters.Adapter | None) -> DataFrame:
    """file and text of the inputs that have no output yet; a file that was read before is not read anew."""
    files = readers.scan_files(spark, f"{args.folder}/input", args.suffix, args.pdf)
    target = files.withColumn("json", with_suffix(F.col("file"), f".{args.suffix}", ".json"))
    wanted = new_only(target, laws_in(spark, f"{args.folder}/{done}")[0].select(F.col("file").alias("json")), "json", args.force)
    pages = ocr_cache.pages_through_cache(wanted, ocr, f"{args.folder}/ocr")
    if native is not None:
        pages = adapters.with_native_text(pages, wanted, native)
    return adapters.joined_pages(pages)


def main(spark: SparkSession, argv: list[str] | None = None, ocr: adapters.Adapter = adapters.plain_text, ask: adapters.Adapter | None = None, embed=vectors.hashed_embedding, grammar: adapters.Adapter | None = None, native: adapters.Adapter | None = None) -> dict[str, int]:
    """Run one command; its counters."""
    args = options(argv)
    at = lambda name: f"{args.folder}/{name}"
    if args.command == "extract":
        docs = pages_of(spark, args, "script", ocr, native).withColumnRenamed("file", "doc_id")
        kind, year = file_parts(F.col("doc_id"))
        docs = docs.withColumn("text", F.regexp_replace("text", r"(?m)^=== PAGE \d+ ===\n?", "")).withColumn("type", kind).withColumn("year", year)
        shapes = [optional(spark, readers.read_template, at(name), shape) for name, shape in (("head.txt", acts.HEADER), ("foot.txt", acts.FOOTER))]
        accepted = optional(spark, readers.read_words, at("accepted"), None)
        laws = extraction.extract_laws(docs, readers.read_register(spark, at("register.csv")), header=shapes[0], footer=shapes[1], grammar=grammar, accepted=accepted)
        n = writers.write_law_files(laws.withColumn("file", with_suffix(F.col("doc_id"), f".{args.suffix}", ".json")).select("file", "metadata", "articles"), at("script"))
        return {"laws": n, **soft_quality(spark, at, "script")}
    if args.command == "model":
        if ask is None:
            raise ValueError("the command needs a language model: pass ask=")
        good, bad, told = ingestion.extract_by_model(pages_of(spark, args, "llm", ocr, native), ask, at("answers"), force=args.force)
        n = writers.write_law_files(good.withColumn("file", with_suffix(F.col("file"), f".{args.suffix}", ".json")), at("llm"))
        writers.append_errors(bad, at("rejected"))
        return {"laws": n, **dataclasses.asdict(told), **soft_quality(spark, at, "llm")}
    if args.command == "clear":
        return {"nodes": graph_store.cleared(spark, at("graph"))}
    (model, bad), (script, worse) = laws_in(spark, at("llm")), laws_in(spark, at("script"))
    rejected = writers.append_errors(bad.unionByName(worse), at("rejected"))
    laws = ingestion.one_of_each_law(model, script)
    store = vector_store.VectorStore(at("chunks"), embed)
    found = ingestion.law_vectors(laws, store, blanks=args.command == "vectors")
    writers.write_vectors(found, at("vectors"))
    if args.command == "vectors":
        return {"vectors": laws.count(), "rejected": rejected, "embedded": store.embedded}
    tables, lacking = ingestion.graph_tables(laws, readers.read_vector_table(spark, at("vectors")))
    missing = writers.append_errors(lacking.select("file", F.format_string("Article %s sans embedding", "index").alias("reason")), at("rejected"))
    counts = graph_store.merge(spark, at("graph"), tables, reload=args.command == "reload")
    return {**counts.created, **{f"{name}_replaced": n for name, n in counts.replaced.items()}, "rejected": rejected, "without_vector": missing, "embedded": store.embedded}


def soft_quality(spark: SparkSession, at, folder: str) -> dict[str, int]:
    """Quality errors of all acts in a folder are written down; they keep none back."""
    written, unread = laws_in(spark, at(folder))
    errors = quality.act_errors(written.withColumnRenamed("file", "doc_id"), quality.lexicon(readers.read_words(spark, at("lexicon/*")), "word"))
    return {"errors": writers.append_errors(errors, at("errors")), "rejected": writers.append_errors(unread, at("rejected"))}


if __name__ == "__main__":
    print(main(SparkSession.builder.appName("juriscope").getOrCreate()))
