"""Relations of the engine. Image stacks are one row per 2-D plane; objects are rows of measurements."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Executors get these modules with the tasks, so a cluster needs no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__.rpartition(".")[0]])

PLANE = T.StructType(
    [T.StructField(n, t) for n, t in (("movie", T.StringType()), ("frame", T.IntegerType()), ("slice", T.IntegerType()), ("channel", T.IntegerType()), ("height", T.IntegerType()), ("width", T.IntegerType()), ("dtype", T.StringType()), ("pixels", T.BinaryType()))]
)
PIXEL = T.StructType([T.StructField(n, t) for n, t in (("movie", T.StringType()), ("frame", T.IntegerType()), ("y", T.IntegerType()), ("x", T.IntegerType()), ("value", T.DoubleType()))])
DETECTION = T.StructType(
    [T.StructField(n, t) for n, t in (("movie", T.StringType()), ("frame", T.IntegerType()), ("class_id", T.IntegerType()), ("score", T.DoubleType()), ("x1", T.DoubleType()), ("y1", T.DoubleType()), ("x2", T.DoubleType()), ("y2", T.DoubleType()))]
)
#: Leading columns of a measurement table. Fixed values.
LEADING = ("label", "frame", "slice", "channel")
#: Keys of the per-frame summary. Fixed values.
SUMMARY_KEYS = ("file", "frame", "channel", "date_time", "timestep", "abslag_in_s", "object_class")


def require(df: DataFrame, *columns: str) -> None:
    """Raise ValueError if ``df`` lacks one of ``columns``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
