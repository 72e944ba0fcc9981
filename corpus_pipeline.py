"""A corpus pipeline over ``documents``: each stage reads what the one before it wrote.

Quality rules, exact dedup, SimHash near-dedup, mixing to source weights, best-fit packing. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stackrill.llm import exact_dedup, mixing, packing, quality, simhash
from stackrill.llm.common import drop_path, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Null and empty texts have too few words and go; repeated rows are
    judged alike; all columns stay, and an empty table gives an empty one."""
    judged = quality.quality_cascade(docs, out="sr_quality", stats=False)
    return judged.where("sr_quality.kept").select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id, of several with that id the last by file and row.
    Null texts equal empty ones; a null id is below all others."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the least id, of several with that id the first by file
    and row; a row without an id only if none has one. Texts without words are one group."""
    return simhash.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it, in the order of virtual finish
    time. A null source is one of its own, the last; texts without words are never taken."""
    return mixing.take_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix, packed into sequences; each copy of a document on its own."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("source mixing", source_mix),
    ("best-fit packing", packed),
]

#: Fingerprints and tokens have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each over the written result of the one before."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return out
        path, before = scratch(spark, f"pipeline-{i}"), path
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
