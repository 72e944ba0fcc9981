"""Listings, tables and resume of batches, through Spark's file systems."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import EXTENSIONS, strip_extension


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files of a folder, wherever Spark can read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isFile())


def find_files(spark: SparkSession, folder: str, pattern: str = "", worklist: list[str] | None = None) -> DataFrame:
    """(path, name, stem) of images whose name begins with ``pattern``, or of a worklist's that exist.

    The listing reads no content. Full paths are kept.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"{pattern}*").load(folder).select("path")
    wanted = None if worklist is None else spark.createDataFrame([(w,) for w in worklist], "name string")
    return select_files(listed, pattern, wanted).select("path", "name", "stem")


def select_files(listed: DataFrame, pattern: str = "", worklist: DataFrame | None = None) -> DataFrame:
    """``listed`` (path) with name and stem: images whose name begins with ``pattern`` and, given a
    ``worklist`` of names or paths, is on it."""
    rows = listed.withColumn("name", F.element_at(F.split("path", "/"), -1))
    rows = rows.where(F.col("name").startswith(pattern) & F.col("name").rlike(r"\.(" + "|".join(e.replace(".", r"\.") for e in EXTENSIONS) + ")$"))
    rows = rows.withColumn("stem", strip_extension(F.col("name")))
    if worklist is not None:
        wanted = worklist.select(F.element_at(F.split(F.rtrim("name"), "/"), -1).alias("name"))
        rows = rows.join(wanted, "name", "left_semi")
    return rows


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in ``spark.checkpoint.dir``; only a local master without one gets a local folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/checkpoints"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return path.toString()


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header at ``path``; for tables of a size that one file should hold."""
    spark = df.sparkSession
    part = f"{path}.parts"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(part)
    source = spark._jvm.org.apache.hadoop.fs.Path(part)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    (only,) = [s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")]
    fs.rename(only, spark._jvm.org.apache.hadoop.fs.Path(path))
    fs.delete(source, True)


def outputs(spark: SparkSession, folder: str, endings: tuple[str, ...] = ("_summary.csv", "_fl.csv")) -> DataFrame:
    """(stem, ending) of the outputs in a folder."""
    rows = [(n.removesuffix(e), e) for n in list_names(spark, folder) for e in endings if n.endswith(e)]
    return spark.createDataFrame(rows, "stem string, ending string")


def read_csvs(spark: SparkSession, folder: str, id_column: str = "file", pattern: str = "") -> DataFrame | None:
    """All CSV tables of a folder whose name has ``pattern``, with the file each row is from.

    Files are read together if their headers agree, else united by name with nulls. None if there
    are none.
    """
    names = [n for n in list_names(spark, folder) if n.endswith(".csv") and pattern in n]
    if not names:
        return None
    heads: dict[str, list[str]] = {}
    for n in names:
        head = spark.read.text(f"{folder}/{n}").head()
        heads.setdefault(head[0] if head else "", []).append(f"{folder}/{n}")
    out = None
    for paths in heads.values():
        df = spark.read.csv(paths, header=True, inferSchema=True).withColumn(id_column, F.element_at(F.split(F.input_file_name(), "/"), -1))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def write_tables(measured: DataFrame, summary: DataFrame, folder: str, key: str = "file", form: str = "parquet") -> None:
    """Measurements and summary, one partition for each image file."""
    for name, df in (("fl", measured), ("summary", summary)):
        df.write.mode("overwrite").option("header", True).partitionBy(key).format(form).save(f"{folder}/{name}")
