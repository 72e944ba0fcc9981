"""Joins, aggregations and windows over measurement, detection, time and track tables.

All built-in expressions: partial aggregation, pruning and join choice are Catalyst's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import class_name
from ..schema import LEADING, SUMMARY_KEYS, require

POS, NEG = "piPOS", "piNEG"


def lead_columns(df: DataFrame) -> DataFrame:
    """``label, frame, slice, channel`` first, as far as they exist."""
    first = [c for c in LEADING if c in df.columns]
    return df.select(*first, *(c for c in df.columns if c not in first))


def summary_by(df: DataFrame, key: str | Sequence[str], value: str) -> DataFrame:
    """mean, max, min, std (n - 1), q95, q05 and n of ``value`` for each key; null keys drop out."""
    keys = [key] if isinstance(key, str) else list(key)
    v = F.col(value)
    q = lambda p: F.percentile(v, F.lit(p))
    return df.dropna(subset=keys).groupBy(*keys).agg(F.avg(v).alias("mean"), F.max(v).alias("max"), F.min(v).alias("min"), F.stddev_samp(v).alias("std"), q(0.95).alias("q95"), q(0.05).alias("q05"), F.count(v).alias("n"))


def pi_summary(df: DataFrame, keys: Sequence[str] = SUMMARY_KEYS, keep_null_keys: bool = False) -> DataFrame:
    """Counts and areas of each group by state; rows with a null key drop out unless kept."""
    require(df, *keys, "label", "pi_class", "area")
    rows = df if keep_null_keys else df.dropna(subset=list(keys))
    area = lambda state: F.coalesce(F.sum(F.when(F.col("pi_class") == state, F.col("area"))), F.lit(0.0))
    return rows.groupBy(*keys).agg(
        F.count("label").alias("total_count"),
        F.count_if(F.col("pi_class") == NEG).alias("pi_class_neg"),
        F.count_if(F.col("pi_class") == POS).alias("pi_class_pos"),
        area(NEG).alias("area_pineg"),
        area(POS).alias("area_pipos"),
        F.coalesce(F.sum("area"), F.lit(0.0)).alias("area_total"),
    )


def detection_summary(df: DataFrame, by: str = "object_class", score: str = "detection_score") -> DataFrame:
    """Detections of each class: count, score quantiles, and mean per frame (over all frames)."""
    q = F.percentile(score, F.array(*(F.lit(p) for p in (0.05, 0.25, 0.5, 0.75, 0.95))))
    frames = df.agg(F.countDistinct("frame").alias("frames"))
    out = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), q.alias("q")).crossJoin(F.broadcast(frames))
    return out.select(by, "n", *(F.col("q")[i].alias(f"q{p:02d}") for i, p in enumerate((5, 25, 50, 75, 95))), (F.col("n") / F.col("frames")).alias("per_frame"))


def objects_per_frame(df: DataFrame) -> DataFrame:
    """Objects in each frame, by frame."""
    return df.groupBy("frame").agg(F.count(F.lit(1)).alias("n")).orderBy("frame")


def distinct_instances(df: DataFrame, by: Sequence[str] = ("frame",)) -> DataFrame:
    """Labels above 0 in each frame; frames without any count 0."""
    return df.groupBy(*by).agg(F.countDistinct(F.when(F.col("label") > 0, F.col("label"))).alias("instances"))


def object_totals(df: DataFrame, keys: Sequence[str] = ("movie",)) -> DataFrame:
    """Objects (label above 0) over all frames, the largest label, and frames that have objects."""
    return df.where("label > 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("objects"), F.max("label").cast("int").alias("top_label"), F.countDistinct("frame").alias("frames"))


def join_classes(measured: DataFrame, detected: DataFrame, keys: Sequence[str] = ("movie", "frame", "label")) -> DataFrame:
    """Class and score of each object; objects without a detection are ``unknown`` with score 0."""
    d = detected.select(*keys, "object_class", "detection_score")
    return measured.join(d, list(keys), "left").fillna({"object_class": "unknown", "detection_score": 0.0})


def join_per_frame(measured: DataFrame, *tables: DataFrame, keys: Sequence[str] = ("movie", "frame")) -> DataFrame:
    """Left joins of per-frame tables (time, background) on their keys; Spark broadcasts small ones."""
    for t in tables:
        measured = measured.join(t, [k for k in keys if k in t.columns], "left")
    return measured


def relative_intensity(df: DataFrame, columns: Sequence[str] = ("max_intensity", "min_intensity", "mean_intensity"), background: str = "background") -> DataFrame:
    """``rel_*``: intensities over the background; null where that is null or 0."""
    return df.withColumns({f"rel_{c}": F.try_divide(F.col(c), F.col(background)) for c in columns})


def join_second_channel(measured: DataFrame, other: DataFrame, suffix: str = "gfp", keys: Sequence[str] = ("movie", "frame", "label")) -> DataFrame:
    """Mean intensity and background of a second channel for the same object of the same frame."""
    o = other.select(*keys, F.col("mean_intensity").alias(f"mean_intensity_{suffix}"), F.col("background").alias(f"{suffix}_background"))
    return measured.join(o, list(keys), "left")


def join_tracks(measured: DataFrame, tracks: DataFrame, keys: Sequence[str] = ("movie", "frame", "label")) -> DataFrame:
    """Track ids by object key; objects on no track get -1."""
    return measured.join(tracks.select(*keys, "trackid"), list(keys), "left").fillna({"trackid": -1})


def box_centres(detected: DataFrame, names: Mapping[int, str] | None, source: str, least_score: float = 0.5, prefix: str = "oof_") -> DataFrame:
    """Centre points of the boxes that score at least ``least_score``, with class name and source."""
    rows = detected.where(F.col("score") >= least_score)
    return rows.select("movie", "frame", ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"), class_name(F.col("class_id"), names, prefix).alias("object_class"), F.lit(source).alias("source"))


def lock_in(df: DataFrame, keys: Sequence[str] = ("movie", "trackid")) -> DataFrame:
    """Objects of a track after its first piPOS frame become piPOS; track -1 stays as it is.

    Without the columns ``trackid`` and ``pi_class`` the table is returned unchanged.
    """
    if not {"trackid", "pi_class", "frame"} <= set(df.columns):
        return df
    by = [k for k in keys if k in df.columns]
    first = F.min(F.when(F.col("pi_class") == POS, F.col("frame"))).over(Window.partitionBy(*by))
    locked = (F.col("trackid") != -1) & (F.col("frame") > first)
    return df.withColumn("pi_class", F.when(locked, POS).otherwise(F.col("pi_class")))


def lock_in_stats(df: DataFrame, keys: Sequence[str] = ("movie", "trackid")) -> DataFrame:
    """piPOS before and after lock-in, rows overridden, and tracks they are on."""
    after = lock_in(df.withColumn("before", F.col("pi_class")), keys)
    changed = F.coalesce(F.col("before"), F.lit("")) != F.coalesce(F.col("pi_class"), F.lit(""))
    by = [k for k in keys if k in df.columns]
    return after.agg(F.count_if(F.col("before") == POS).alias("before"), F.count_if(F.col("pi_class") == POS).alias("after"), F.count_if(changed).alias("overridden"), F.countDistinct(F.when(changed, F.struct(*by))).alias("tracks"))


def label_offsets(counts: DataFrame, key: str = "movie", n: str = "n") -> DataFrame:
    """``offset``: objects in earlier frames, which makes labels unique over a movie."""
    before = Window.partitionBy(key).orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("offset", F.coalesce(F.sum(n).over(before), F.lit(0)))


def offset_labels(labelled: DataFrame, offsets: DataFrame, key: str = "movie") -> DataFrame:
    """Add each frame's offset to its labels above 0."""
    joined = labelled.join(offsets.select(key, "frame", "offset"), [key, "frame"], "left")
    return joined.withColumn("label", F.when(F.col("label") > 0, F.col("label") + F.coalesce("offset", F.lit(0))).otherwise(F.col("label"))).drop("offset")


def time_table(frames: DataFrame, start: Column, key: str = "movie", lag_ms: str = "lag_ms") -> DataFrame:
    """date_time, timestep (hours since frame 0) and abslag_in_s of each frame.

    Absolute time counts from the lag of the earliest frame. Without a frame 0 timestep is null.
    """
    w = Window.partitionBy(key)
    zero = F.max(F.when(F.col("frame") == 0, F.col(lag_ms))).over(w)
    base = F.min_by(lag_ms, "frame").over(w)
    from ..functions.scalar import absolute_time

    return frames.select(key, "frame", absolute_time(start, F.col(lag_ms) - base).alias("date_time"), ((F.col(lag_ms) - zero) / 3_600_000).alias("timestep"), (F.col(lag_ms) / 1000).alias("abslag_in_s"))


def track_extents(df: DataFrame, keys: Sequence[str] = ("movie", "trackid")) -> DataFrame:
    """First and last frame and place of each track, and the set of its frames."""
    at = F.struct("centroid_0", "centroid_1")
    return (
        df.where("trackid != -1").groupBy(*keys)
        .agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), F.min_by(at, "frame").alias("a"), F.max_by(at, "frame").alias("b"), F.array_sort(F.collect_set("frame")).alias("frames"))
        .select(*keys, "first_frame", "last_frame", F.col("a.centroid_0").alias("first_y"), F.col("a.centroid_1").alias("first_x"), F.col("b.centroid_0").alias("last_y"), F.col("b.centroid_1").alias("last_x"), "frames")
    )


def track_stats(df: DataFrame, keys: Sequence[str] = ("movie", "trackid")) -> DataFrame:
    """Tracks, their lengths, full-length and single-frame ones, and distances of their links."""
    rows = df.where("trackid != -1")
    w = Window.partitionBy(*keys).orderBy("frame")
    step = F.hypot(F.col("centroid_0") - F.lag("centroid_0").over(w), F.col("centroid_1") - F.lag("centroid_1").over(w))
    lengths = rows.groupBy(*keys).agg(F.countDistinct("frame").alias("n"))
    total = rows.agg(F.countDistinct("frame").alias("frames"))
    of_tracks = lengths.crossJoin(F.broadcast(total)).agg(F.count(F.lit(1)).alias("tracks"), F.count_if(F.col("n") == F.col("frames")).alias("full_length"), F.count_if(F.col("n") == 1).alias("single_frame"), F.percentile("n", F.lit(0.5)).alias("median_length"))
    links = rows.select(step.alias("d")).where("d IS NOT NULL").agg(F.avg("d").alias("mean_link"), F.percentile("d", F.lit(0.95)).alias("p95_link"), F.max("d").alias("max_link"))
    return of_tracks.crossJoin(links)


def stitch_candidates(extents: DataFrame, most: float, key: str = "movie") -> DataFrame:
    """Pairs (a, b) of one movie's tracks where a ends before b begins, within ``most``, on no common frame.

    Places fall in cells as wide as ``most``; b meets the nine cells around it, so the join is an
    equi-join on cells, not a comparison of all tracks.
    """
    cell = lambda c: F.floor(F.col(c) / most).cast("long")
    a = extents.select(key, F.col("trackid").alias("a"), F.col("last_frame"), F.col("last_y"), F.col("last_x"), F.col("frames").alias("a_frames"), cell("last_y").alias("cy"), cell("last_x").alias("cx"))
    near = F.array(*(F.lit(d) for d in (-1, 0, 1)))
    b = extents.select(key, F.col("trackid").alias("b"), "first_frame", "first_y", "first_x", F.col("frames").alias("b_frames"), F.explode(F.transform(near, lambda d: F.floor(F.col("first_y") / most).cast("long") + d)).alias("cy"))
    b = b.select("*", F.explode(F.transform(near, lambda d: F.floor(F.col("first_x") / most).cast("long") + d)).alias("cx"))
    d = F.hypot(F.col("first_y") - F.col("last_y"), F.col("first_x") - F.col("last_x"))
    met = a.join(b, [key, "cy", "cx"]).where("last_frame < first_frame AND a != b").withColumn("distance", d)
    return met.where((F.col("distance") <= most) & ~F.arrays_overlap("a_frames", "b_frames")).select(key, "a", "b", "distance")


def overlapping_boxes(boxes: DataFrame, least: float, cell: float, key: str = "movie") -> DataFrame:
    """Pairs (a, b), a < b, of one frame's boxes whose overlap has at least ``least`` area.

    Each box goes to the grid cells it touches; pairs meet in the cell that holds the corner of
    their overlap, hence once.
    """
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell).cast("long"), F.floor(F.col(hi) / cell).cast("long"))
    cells = boxes.select("*", F.explode(span("y1", "y2")).alias("cy")).select("*", F.explode(span("x1", "x2")).alias("cx"))
    a, b = (cells.select(key, "frame", "cy", "cx", *(F.col(c).alias(f"{s}_{c}") for c in ("box", "x1", "y1", "x2", "y2"))) for s in "ab")
    x1, y1 = F.greatest("a_x1", "b_x1"), F.greatest("a_y1", "b_y1")
    w, h = F.least("a_x2", "b_x2") - x1, F.least("a_y2", "b_y2") - y1
    met = a.join(b, [key, "frame", "cy", "cx"]).where("a_box < b_box").withColumns({"w": w, "h": h, "overlap": w * h})
    once = (F.floor(x1 / cell) == F.col("cx")) & (F.floor(y1 / cell) == F.col("cy"))
    return met.where((F.col("w") > 0) & (F.col("h") > 0) & (F.col("overlap") >= least) & once).select(key, "frame", F.col("a_box").alias("a"), F.col("b_box").alias("b"), "overlap")


def nearest_reference(found: DataFrame, reference: DataFrame, most: float, key: str = "movie") -> DataFrame:
    """Shift (dx, dy) of each found block from the reference block nearest by x, within ``most`` both ways.

    Of two equally near ones the lesser x counts, and of references at one x the lesser y. The nearest is
    found once for each different x, between its neighbours in cells as wide as ``most``; no pairs are made.
    """
    width = max(most, 1e-9)
    known = reference.where(F.col("x").isNotNull()).groupBy(key, "x").agg(F.min("y").alias("y")).select(key, "x", F.struct("x", "y").alias("r"))
    asked = found.where(F.col("x").isNotNull()).select(key, "x").distinct().withColumn("r", F.lit(None).cast(known.schema["r"].dataType))
    both = known.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True))).withColumn("cell", F.floor(F.col("x") / width))
    ends = both.where("NOT asks").groupBy(key, "cell").agg(F.min("r").alias("low"), F.max("r").alias("high"))
    w = Window.partitionBy(key, "cell").orderBy("x")
    near = both.select(key, "x", "asks", "cell", F.last("r", True).over(w.rangeBetween(Window.unboundedPreceding, 0)).alias("before"), F.first("r", True).over(w.rangeBetween(0, Window.unboundedFollowing)).alias("after")).where("asks")
    near = near.join(ends.select(key, (F.col("cell") + 1).alias("cell"), "high"), [key, "cell"], "left").join(ends.select(key, (F.col("cell") - 1).alias("cell"), "low"), [key, "cell"], "left")
    b, a = F.coalesce("before", "high"), F.coalesce("after", "low")
    r = F.when(a.isNull() | (F.abs(F.col("x") - b["x"]) <= F.abs(F.col("x") - a["x"])), b).otherwise(a)
    out = found.join(near.select(key, "x", r.alias("r")), [key, "x"]).select(key, "frame", "x", "y", (F.col("x") - F.col("r.x")).alias("dx"), (F.col("y") - F.col("r.y")).alias("dy"))
    return out.where((F.abs("dx") <= most) & (F.abs("dy") <= most))


def frame_drift(shifts: DataFrame, key: str = "movie") -> DataFrame:
    """Median shift of each frame."""
    return shifts.groupBy(key, "frame").agg(F.percentile("dx", F.lit(0.5)).alias("dx"), F.percentile("dy", F.lit(0.5)).alias("dy"))


def confusion_matrix(df: DataFrame, true: str, predicted: str, classes: Sequence) -> DataFrame:
    """Share of each true class's rows by predicted class, one column ``p_<class>`` each."""
    counts = df.groupBy(true).pivot(predicted, list(classes)).agg(F.count(F.lit(1))).fillna(0)
    total = sum((F.col(f"`{c}`") for c in classes), F.lit(0))
    return counts.select(true, *(F.try_divide(F.col(f"`{c}`"), total).alias(f"p_{c}") for c in classes))


def grouped_histogram(df: DataFrame, group: str, value: str, bins: int = 30) -> DataFrame:
    """Rows in each of ``bins`` equal bins of the whole range, by group."""
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.least(F.lit(bins - 1), F.floor(F.try_divide(F.col(value) - F.col("lo"), width)).cast("int"))
    rows = df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(ends))
    return rows.withColumn("bin", F.coalesce(place, F.lit(0))).groupBy(group, "bin").agg(F.count(F.lit(1)).alias("n"))


def bind_clusters(df: DataFrame, groups: DataFrame, column: str) -> DataFrame:
    """``cluster``: the first key (least ``position``) whose values have ``column``'s; else null."""
    best = groups.groupBy("value").agg(F.min_by("key", "position").alias("cluster"))
    return df.join(best, df[column] == best["value"], "left").drop("value")


def unfinished(files: DataFrame, outputs: DataFrame, endings: Sequence[str] = ("_summary.csv", "_fl.csv")) -> DataFrame:
    """Files (name, stem) for which not all outputs exist."""
    done = outputs.where(F.col("ending").isin(*endings)).groupBy("stem").agg(F.countDistinct("ending").alias("n")).where(F.col("n") == len(set(endings)))
    return files.join(done, "stem", "left_anti")


def numbered(rows: DataFrame, order: Sequence[str], number: str = "number") -> DataFrame:
    """``number`` of each row from 0 in the order of ``order``, which must tell all rows apart.

    Rows are dealt out by ranges, which come from a sample: so they are written once, and then counted
    and numbered range by range, after the sum over the ranges before, one row for each of them.
    """
    from ..sources.files import work_folder

    spark = rows.sparkSession
    ranged = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    path = f"{work_folder(spark, 'numbered')}/rows"
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn("_own", own).join(starts, "_part").withColumn(number, F.col("_start") + F.col("_own")).drop("_part", "_own", "_start")


def split_blocks(files: DataFrame, blocks: int, order: str = "name") -> DataFrame:
    """``block`` of each file: consecutive runs of ceil(n / blocks) files by name, then by all columns."""
    n = files.agg(F.ceil(F.count(F.lit(1)) / blocks).alias("size"))
    at = numbered(files, [order, *(c for c in files.columns if c != order)], "at")
    return at.crossJoin(F.broadcast(n)).select(*files.columns, F.floor(F.col("at") / F.col("size")).cast("int").alias("block"))


def split_worklists(spark, folder: str, blocks: int, pattern: str = "", extension: str = "") -> list[list[str]]:
    """File names of a folder in worklists, for schedulers that take them; a driver-side listing."""
    from ..sources.files import list_names

    names = sorted(n for n in list_names(spark, folder) if pattern in n and n.endswith(extension))
    size = -(-len(names) // blocks) or 1
    return [names[i : i + size] for i in range(0, len(names), size)]
