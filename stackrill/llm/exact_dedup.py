"""Exact dedup as a stateful stream.

Texts are equal if identical after lower-casing A-Z. A pass over the texts writes, for each row, its
id, the SHA-256 of the normalised text and a content locator (file number and row). A
structured-streaming aggregation consumes that log in micro-batches; its keyed state lives in RocksDB,
has no expiry, and retains for each digest the stable id that stays, the locator of its content and the
group's size. The full contents of all hits are then found by their locators and their bytes compared
before any row is dropped: digests whose texts are not all equal are regrouped by the texts themselves.

Rows are pre-aggregated before each shuffle (a hot digest leaves a task as one row, and equal texts
once), hot digests are joined by broadcast, and no group is ever gathered in a task.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, as_bytes, located, scratch, small, spread_join, stored, text_batches

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # Else each of a state's partitions sets aside megabytes of disk before it holds a row.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Micro-batches in which the log of digests is consumed, about.
BATCHES = 3


def normalised(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


@F.arrow_udf(T.BinaryType())
def sha256_digest(texts: pa.Array) -> pa.Array:
    """SHA-256 of each normalised text."""
    return pa.array([hashlib.sha256((t or b"").lower()).digest() for t in as_bytes(texts)], pa.binary())


def stream_state(spark: SparkSession, log_path: str, schema, batches: int, temp: Scratch) -> DataFrame:
    """Consume a log (id, digest, at) as a stream; the final state: digest, keep (id, at), n.

    Each micro-batch writes the groups it changed. ``keep`` and ``n`` only grow, so their maxima
    over all batches are the state, also if a batch was run twice after a failure.
    """
    out, held = temp.path("dedup-updates"), {k: spark.conf.get(k, None) for k in _STATE}
    n_files = max(1, len(spark.read.schema(schema).parquet(log_path).inputFiles()))
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        log = spark.readStream.schema(schema).option("maxFilesPerTrigger", -(-n_files // batches)).parquet(log_path)
        state = log.groupBy("digest").agg(F.max(F.struct("id", "at")).alias("keep"), F.count(F.lit(1)).alias("n"))
        query = (
            state.writeStream.outputMode("update")
            .foreachBatch(lambda changed, batch: changed.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
            .option("checkpointLocation", temp.path("dedup-state"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    changed = spark.read.schema(state.schema).parquet(f"{out}/batch=*") if _has_files(spark, out) else spark.createDataFrame([], state.schema)
    return changed.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("n").alias("n"))


def _has_files(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def copy_groups(rows: DataFrame, digest: Callable[[Column], Column] = sha256_digest, batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """``(log, groups)``: each row's (id, digest, at), and the groups of two rows or more.

    ``rows`` has id, text and the locator ``_sr_at``. ``groups`` has digest, text (only where a digest
    stands for several texts, else null), keep and n; both are stored tables.
    """
    spark = rows.sparkSession
    text_batches(spark)
    texts = rows.select("id", F.col("text").cast("string").alias("text"), F.col("_sr_at").alias("at"))
    path = scratch(spark, "dedup-log")
    log = texts.select("id", digest(F.col("text")).alias("digest"), "at")
    log.write.parquet(path)
    log = spark.read.schema(log.schema).parquet(path)
    with Scratch(spark) as temp:
        hits = temp.stored(stream_state(spark, path, log.schema, batches, temp).where("n > 1"), "dedup-hits")
        # Content of the hits, found by locator; a task's equal texts leave it once.
        members = temp.stored(spread_join(log, hits.select("digest", "n"), ["digest"], "n", 64).select(F.col("at").alias("m"), "digest"), "dedup-members")
        contents = texts.select("at", normalised(F.col("text")).alias("text")).join(small(members, 64), F.col("at") == F.col("m"))
        distinct = contents.select("digest", "text").distinct()
        several = temp.stored(distinct.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"), "dedup-collisions")
        groups = hits.select("digest", F.lit(None).cast("string").alias("text"), "keep", "n")
        if several.count():
            split = contents.join(several, "digest").join(log.select("id", F.col("at").alias("m")), "m").groupBy("digest", "text").agg(F.max(F.struct("id", "at")).alias("keep"), F.count(F.lit(1)).alias("n"))
            groups = groups.join(several, "digest", "left_anti").unionByName(split)
        groups = stored(groups, "dedup-groups")
    return log, groups


def grouped(rows: DataFrame, log: DataFrame, groups: DataFrame, digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """Each row's id, digest and at, with keep and n of its group (null if alone)."""
    plain = groups.where("text is null").select("digest", "keep", "n", F.col("n").alias("rows"))
    out = spread_join(log, plain, ["digest"], "rows", 128, "left")
    split = groups.where("text is not null")
    if split.count():  # digests that stand for several texts: the texts decide
        texts = rows.select("id", digest(F.col("text").cast("string")).alias("digest"), F.col("_sr_at").alias("at"), normalised(F.col("text")).alias("text"))
        own = texts.join(split.select("digest").distinct(), "digest").join(split, ["digest", "text"], "left").drop("text")
        out = out.join(split.select("digest").distinct(), "digest", "left_anti").unionByName(own)
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256_digest, batches: int = BATCHES) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, digest.

    Of equal texts the row with the largest id stays; a null id is below all others; of repeated
    rows with that id, one stays (the last by file and row). Null texts equal empty ones. Columns
    other than the two named are not read. An empty table gives an empty one.
    """
    rows = located(docs, id=F.col(id_col), text=F.col(text_col))
    log, groups = copy_groups(rows, digest, batches)
    alone = F.col("n").isNull()
    return grouped(rows, log, groups, digest).select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("at") == F.col("keep.at"))).alias("kept"),
        "digest",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops; all its columns stay.

    Nulls, empty texts, ties, repeated rows and empty tables have the results stated there.
    """
    docs = located(docs)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), "_sr_at")
    log, groups = copy_groups(rows, digest)
    lost = stored(grouped(rows, log, groups, digest).where(F.col("at") != F.col("keep.at")).select(F.col("at").alias("_sr_lost")), "dedup-lost")
    return docs.join(small(lost, 32), docs["_sr_at"] == lost["_sr_lost"], "left_anti").drop("_sr_at")


def op4_query(docs: DataFrame) -> DataFrame:
    """The digest of :func:`exact_dedup` for each document."""
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


#: DuckDB SQL for the rows of :func:`op4_query`.
OP4_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
