"""Helpers shared by the training-data operators: scratch tables, checked broadcasts, sketches.

Nothing here touches driver-local files: all intermediate tables go to the shared folder that the
session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import uuid
import zlib

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors get these modules with the tasks, so a cluster needs no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__.rpartition(".")[0]])

#: Bytes of an Arrow batch, about; a longer text is a batch of its own.
TEXT_BYTES = 1 << 20
#: A table may be broadcast if it has at most this many bytes, counted before the join.
BROADCAST_BYTES = 16 << 20
#: White space that separates words.
SPACE = b" \t\n\x0b\x0c\r"


def text_batches(spark: SparkSession) -> None:
    """Bound the bytes of this session's Arrow batches, which carry whole texts to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; only where none is set (tests), a local one."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        found = sc._jsc.sc().getCheckpointDir()
        root = found.get() if found.isDefined() else None
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", uuid.uuid4().hex)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; Spark removes it when the session's JVM ends."""
    path = f"{shared_dir(spark)}/stackrill/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it cuts lineage and survives executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables in the shared folder that are dropped when the ``with`` block ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables = spark, [], {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            drop_path(self.spark, path)

    def path(self, name: str) -> str:
        self.paths.append(scratch(self.spark, name))
        return self.paths[-1]

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.tables[id(table)] = (table, path)
        return table

    def drop(self, table: DataFrame) -> None:
        """Delete a stored table that nothing reads any more."""
        path = self.tables.pop(id(table))[1]
        self.paths.remove(path)
        drop_path(self.spark, path)


def located(docs: DataFrame, **columns: Column) -> DataFrame:
    """``columns`` of ``docs`` with ``_sr_at``, a stable locator of each row: (file, row), two longs.

    Rows of a file scan have one already; any other input is first written to the shared folder.
    Without ``columns``, all of ``docs``.
    """
    at = lambda d: F.struct(file_number(d, F.col("_metadata.file_path")).alias("file"), F.col("_metadata.row_index").alias("row")).alias("_sr_at")
    own = [c.alias(k) for k, c in columns.items()] or ["*"]
    if "_metadata" not in docs.columns:
        try:
            return docs.select(*own, at(docs))
        except AnalysisException:
            pass
    docs = stored(docs.select(*own).withColumnRenamed("_metadata", "_sr_own"), "rows")
    return docs.select(*(F.col(c).alias("_metadata" if c == "_sr_own" else c) for c in docs.columns), at(docs))


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast if its counted size is within ``limit``; else Spark shuffles.

    ``df`` should be a stored table, as it is counted here.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


#: Keys above the share 1 / HOT_KEYS of all rows are joined by broadcast: there are fewer than HOT_KEYS.
HOT_KEYS = 4096


def spread_join(rows: DataFrame, groups: DataFrame, key: list[str], size: str, row_bytes: int, how: str = "inner", limit: int = BROADCAST_BYTES, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` joined with ``groups`` on ``key``, without gathering a hot key's rows in one task.

    ``groups`` is a stored table with one row per key; its column ``size`` says how many of the rows
    have that key. If it is too large to broadcast, only keys with more than one in ``hot_keys``
    of all rows are, whose number that bounds, and the others are shuffled. ``size`` stays out.
    """
    plain = groups.drop(size)
    n, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).head()
    if n * row_bytes <= limit:
        return rows.join(F.broadcast(plain), key, how)
    hot = F.col(size) * hot_keys > total
    keys = F.broadcast(groups.where(hot).select(*key))
    cold = rows.join(keys, key, "left_anti").join(groups.where(~hot).drop(size), key, how)
    return rows.join(F.broadcast(groups.where(hot).drop(size)), key).unionByName(cold)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def file_number(docs: DataFrame, path: Column) -> Column:
    """A number for each input file of ``docs``: a hash of its path that no two of them share."""
    files, salt = sorted(set(docs.inputFiles())), 0
    spark = docs.sparkSession
    while len(files) > 1:
        names = spark.createDataFrame([(f,) for f in files], "f string")
        if names.select(F.xxhash64("f", F.lit(salt))).distinct().count() == len(files):
            break
        salt += 1
    return F.xxhash64(path, F.lit(salt))


def giving_back(function):
    """A function of batches after which the task's Python gives its free memory back: Spark keeps the
    process for later tasks, whose executor would have to hold it."""

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):
            pass  # another C library

    return run


def as_bytes(texts: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string array without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return texts.cast(kind).to_pylist()


def crc32_of_id(col: str = "doc_id"):
    """crc32 of the id as text; null ids count as the empty string."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def crc32_py(value: object) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode())
