"""Streams of measurements: windowed summaries, stream dedup of files, and tracking with state."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.tracks import _distances, assign


def new_files(spark: SparkSession, folder: str, glob: str = "*.tif*") -> DataFrame:
    """Image files as they arrive; a query's checkpoint replaces the search for finished outputs."""
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", glob).load(folder)


def windowed_summary(events: DataFrame, time: str = "ts", width: str = "1 hour", late: str = "10 minutes", by: str = "object_class", value: str = "area") -> DataFrame:
    """Count, sum and mean of each class in tumbling windows; rows later than the watermark drop."""
    rows = events.withWatermark(time, late)
    return rows.groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n", "total", "mean")


_STATE = "tracks binary, fresh int"


def track_stream(objects: DataFrame, max_distance: float = 25.0, gap: int = 2, key: str = "movie") -> DataFrame:
    """Track ids of objects that arrive frame by frame: the state of each movie's open tracks is kept.

    A movie's frames must arrive in order; a frame may not be split between micro-batches.
    """
    out = f"{key} string, frame int, label int, centroid_0 double, centroid_1 double, trackid int"
    names = [x.split()[0] for x in out.split(", ")]

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, fresh = (pickle.loads(state.get[0]), state.get[1]) if state.exists else ({}, 0)
        df = pd.concat(list(batches)).sort_values(["frame", "label"], kind="stable")
        for frame, rows in df.groupby("frame", sort=True):
            at, ids = rows[["centroid_0", "centroid_1"]].to_numpy(float), np.full(len(rows), -1)
            open_ = [t for t, (_, f) in last.items() if frame - f <= gap]
            if open_:
                d = _distances(np.array([last[t][0] for t in open_]), at)
                for i, j in assign(d):
                    if d[i, j] <= max_distance:
                        ids[j] = open_[i]
            for j in np.flatnonzero(ids < 0):
                ids[j], fresh = fresh, fresh + 1
            last.update({int(t): (tuple(p), int(frame)) for t, p in zip(ids, at)})
            last = {t: v for t, v in last.items() if v[1] >= frame - gap}
            yield rows.assign(trackid=ids.astype(np.int32), **{key: k[0]})[names]
        state.update((pickle.dumps(last), fresh))

    return objects.groupBy(key).applyInPandasWithState(step, out, _STATE, "append", GroupStateTimeout.NoTimeout)
