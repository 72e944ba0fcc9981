"""Queries of the training-data operators over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, langid, mixing, packing, passages, quality, secret_scan, simhash, toxicity, warc


def _table(name: str, query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": _table("documents", quality.op1_query),
        "op2_best_fit_packing": _table("documents", packing.op2_query),
        "op3_simhash_near_dedup": _table("documents", simhash.op3_query),
        "op4_exact_dedup": _table("documents", exact_dedup.op4_query),
        "op5_near_passages": _table("documents", passages.op5_query),
        "op6_secret_scan": _table("documents", secret_scan.op6_query),
        "op7_language_id": _table("documents", langid.op7_query),
        "op8_source_mixing": _table("documents", mixing.op8_query),
        "op9_toxicity": lambda spark, sf_dir: toxicity.op9_query(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))),
        "op10_warc": _table("pages", warc.op10_query),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality.OP1_SQL,
        "op4_exact_dedup": exact_dedup.OP4_SQL,
        "op6_secret_scan": secret_scan.OP6_SQL,
        "op8_source_mixing": mixing.OP8_SQL,
        "op10_warc": warc.OP10_SQL,
    }
