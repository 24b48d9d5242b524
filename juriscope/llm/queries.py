"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, kdtree, licenses, mixing, neardup, periodic, permutation, secrets, tokencounts, tokenfile, topk, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (topk.op1_topk, permutation.op2_permutation_index, neardup.op3_near_duplicates, bpe.op4_bpe, toxicity.op5_toxicity, mixing.op6_mixing, licenses.op7_licenses, tokenfile.op8_token_file, secrets.op9_secrets, warc.op10_warc_revisits, kdtree.op11_kdtree_clusters, periodic.op12_periodic_runs, tokencounts.op13_token_counts)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": topk.ORACLE, "op6_mixing": mixing.ORACLE, "op7_licenses": licenses.ORACLE, "op9_secrets": secrets.ORACLE, "op10_warc_revisits": warc.ORACLE, "op11_kdtree_clusters": kdtree.ORACLE}
