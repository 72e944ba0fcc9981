"""Operators on the pixel relation (movie, frame, y, x, value), as SQL aggregations and windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLANE = ("movie", "frame")


def threshold(pixels: DataFrame, t: float = 0.5) -> DataFrame:
    """``on``: strictly above ``t``."""
    return pixels.withColumn("on", F.col("value") > t)


def size_filter(labelled: DataFrame, least: int = 20, keys: Sequence[str] = ("movie",)) -> DataFrame:
    """Drop objects (label > 0) of fewer than ``least`` pixels and number the others from 1."""
    on = labelled.where("label > 0")
    kept = on.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    new = kept.select(*keys, "label", F.dense_rank().over(Window.partitionBy(*keys).orderBy("label")).alias("new"))
    return on.join(new, [*keys, "label"]).drop("label").withColumnRenamed("new", "label")


def label_boxes(labelled: DataFrame, least: int = 5, keys: Sequence[str] = PLANE) -> DataFrame:
    """Box (ends exclusive) and area of each object of at least ``least`` pixels."""
    box = [F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") + 1).alias("x1"), (F.max("y") + 1).alias("y1"), F.count(F.lit(1)).alias("area")]
    return labelled.where("label > 0").groupBy(*keys, "label").agg(*box).where(F.col("area") >= least)


def label_overlaps(labelled: DataFrame, other: DataFrame, keys: Sequence[str] = PLANE) -> DataFrame:
    """Pixels that each pair (label, other) of objects of two masks has in common."""
    o = other.where("label > 0").select(*keys, "y", "x", F.col("label").alias("other"))
    return labelled.where("label > 0").join(o, [*keys, "y", "x"]).groupBy(*keys, "label", "other").agg(F.count(F.lit(1)).alias("n"))


def map_values(labelled: DataFrame, codes: DataFrame, keys: Sequence[str] = ("movie", "frame", "label"), background: int = 0) -> DataFrame:
    """``code`` of each pixel's object; background and unknown objects get ``background``."""
    return labelled.join(codes.select(*keys, "code"), list(keys), "left").fillna({"code": background})


def background_quantile(pixels: DataFrame, q: float = 0.10, keys: Sequence[str] = PLANE) -> DataFrame:
    """``background``: q-quantile of the pixels with label 0; null for a frame without any."""
    v = F.when(F.coalesce("label", F.lit(0)) == 0, F.col("value"))
    return pixels.groupBy(*keys).agg(F.percentile(v, F.lit(q)).alias("background"))


def plane_means(pixels: DataFrame, keys: Sequence[str] = PLANE, digits: int | None = None) -> DataFrame:
    """Mean pixel of each plane, rounded half to even if asked."""
    mean = F.avg("value")
    return pixels.groupBy(*keys).agg((mean if digits is None else F.bround(mean, digits)).alias("mean"))


def min_projection(pixels: DataFrame, keys: Sequence[str] = ("movie",)) -> DataFrame:
    """Least value of each place over time."""
    return pixels.groupBy(*keys, "y", "x").agg(F.min("value").alias("value"))


def max_projection(pixels: DataFrame, keys: Sequence[str] = PLANE) -> DataFrame:
    """Largest value of each place over the channels."""
    return pixels.groupBy(*keys, "y", "x").agg(F.max("value").alias("value"))


def crop_box(pixels: DataFrame, keys: Sequence[str] = ("movie",)) -> DataFrame:
    """Box (y0, y1, x0, x1; ends exclusive) around the pixels that are not 0."""
    on = pixels.where("value != 0")
    return on.groupBy(*keys).agg(F.min("y").alias("y0"), (F.max("y") + 1).alias("y1"), F.min("x").alias("x0"), (F.max("x") + 1).alias("x1"))


_SCALE_KEYS = {"global": ("movie",), "channel": ("movie", "channel"), "frame": ("movie", "frame"), "channel_frame": ("movie", "channel", "frame")}
#: Largest value of the types that a stack can be converted to. Fixed values.
_TOP = {"uint8": 255, "uint16": 65535, "float16": 1, "float32": 1}


def convert_scale(pixels: DataFrame, dtype: str = "uint8", mode: str = "global") -> DataFrame:
    """``scaled``: min-max scaled over the mode's scope, to the type's range; flat scopes give 0.

    Extents are aggregated before their shuffle and joined back, so no scope is gathered.
    """
    if mode not in _SCALE_KEYS or dtype not in _TOP:
        raise ValueError(f"unknown mode or dtype: {mode}, {dtype}")
    keys = [k for k in _SCALE_KEYS[mode] if k in pixels.columns]
    ends = pixels.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    unit = F.coalesce(F.try_divide(F.col("value") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0))
    scaled = unit if _TOP[dtype] == 1 else F.floor(unit * _TOP[dtype]).cast("int")
    return pixels.join(ends, keys).withColumn("scaled", scaled).drop("lo", "hi")


def to_uint8(pixels: DataFrame, keys: Sequence[str] = PLANE) -> DataFrame:
    """``scaled`` from 0 to 255 in each plane; a plane without variance raises."""
    ends = pixels.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.when(F.col("hi") == F.col("lo"), F.raise_error(F.lit("image has zero variance")).cast("double")).otherwise((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")))
    return pixels.join(ends, list(keys)).withColumn("scaled", F.floor(flat * 255).cast("int")).drop("lo", "hi")


def zscore(pixels: DataFrame, keys: Sequence[str] = PLANE) -> DataFrame:
    """``z``: centred and divided by the population deviation of the plane; 0 where that is 0."""
    s = pixels.groupBy(*keys).agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    return pixels.join(s, list(keys)).withColumn("z", F.coalesce(F.try_divide(F.col("value") - F.col("m"), F.col("s")), F.lit(0.0))).drop("m", "s")


def equalise(pixels: DataFrame, keys: Sequence[str] = PLANE) -> DataFrame:
    """Histogram equalisation of ``scaled`` (0 to 255), then z-score: the cumulative histogram as a window."""
    hist = pixels.groupBy(*keys, "scaled").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)
    cdf = F.sum("n").over(w.orderBy("scaled"))
    first, total = F.min_by("n", "scaled").over(w), F.sum("n").over(w)
    mapped = F.coalesce(F.rint(F.try_divide((cdf - first) * 255.0, total - first)), F.lit(0.0))
    return zscore(pixels.drop("value").join(hist.select(*keys, "scaled", mapped.alias("value")), [*keys, "scaled"]), keys)


def laplacian(pixels: DataFrame, keys: Sequence[str] = PLANE) -> DataFrame:
    """Sum of the four neighbours minus four times the pixel; only where all four are there.

    Neighbours come from windows along rows and columns: a pixel is shuffled twice, never copied.
    """
    row, column = Window.partitionBy(*keys, "y").orderBy("x").rangeBetween(-1, 1), Window.partitionBy(*keys, "x").orderBy("y").rangeBetween(-1, 1)
    one = lambda w: (F.sum("value").over(w) - F.col("value"), F.count(F.lit(1)).over(w))
    (across, nx), (down, ny) = one(row), one(column)
    rows = pixels.withColumns({"_across": across, "_nx": nx}).withColumns({"_down": down, "_ny": ny})
    return rows.where("_nx = 3 AND _ny = 3").select(*keys, "y", "x", (F.col("_across") + F.col("_down") - 4 * F.col("value")).alias("value"))


def variance_filter(pixels: DataFrame, k: int = 3, keys: Sequence[str] = PLANE) -> DataFrame:
    """E[v²] - E[v]² in the k×k box around each inner pixel: sums along rows, then along columns."""
    r = k // 2
    row, column = Window.partitionBy(*keys, "y").orderBy("x").rangeBetween(-r, r), Window.partitionBy(*keys, "x").orderBy("y").rangeBetween(-r, r)
    v = F.col("value")
    along = pixels.select(*keys, "y", "x", F.sum(v).over(row).alias("s"), F.sum(v * v).over(row).alias("q"), F.count(v).over(row).alias("n"))
    box = along.select(*keys, "y", "x", *(F.sum(c).over(column).alias(c) for c in ("s", "q", "n"))).where(F.col("n") == k * k)
    mean = F.col("s") / F.col("n")
    return box.select(*keys, "y", "x", (F.col("q") / F.col("n") - mean * mean).alias("value"))


def moving_median(series: DataFrame, value: str, window: int, keys: Sequence[str] = ("movie",), order: str = "frame") -> DataFrame:
    """Centred median, truncated at the ends; a window of 1 or less changes nothing."""
    if window <= 1:
        return series
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(window // 2), window // 2)
    return series.withColumn(value, F.percentile(value, F.lit(0.5)).over(w))


def interpolate(series: DataFrame, value: str, keys: Sequence[str] = ("movie",), order: str = "frame") -> DataFrame:
    """Fill gaps linearly over ``order``; ends take the nearest value, and a series of none is 0."""
    w = Window.partitionBy(*keys).orderBy(order)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    v = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    at = F.when(v.isNotNull(), F.col(order))
    a, ta = F.last(v, True).over(back), F.last(at, True).over(back)
    b, tb = F.first(v, True).over(ahead), F.first(at, True).over(ahead)
    line = a + (b - a) * F.try_divide((F.col(order) - ta).cast("double"), (tb - ta).cast("double"))
    return series.withColumn(value, F.coalesce(v, line, a, b, F.lit(0.0)))


def box_smooth(series: DataFrame, value: str, n: int = 31, keys: Sequence[str] = ("movie",), order: str = "pos") -> DataFrame:
    """Mean over n places, zeros beyond the ends."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n // 2), n // 2)
    return series.withColumn(value, F.sum(value).over(w) / float(n))


def local_dips(series: DataFrame, value: str, reach: int = 80, prominence: float = 0.0, keys: Sequence[str] = ("movie",), order: str = "pos") -> DataFrame:
    """Local minima with the lower of their shoulders (maxima within ``reach``) above by ``prominence``."""
    w = Window.partitionBy(*keys).orderBy(order)
    left = F.max(value).over(w.rowsBetween(-reach, -1))
    right = F.max(value).over(w.rowsBetween(1, reach))
    dip = series.withColumns({"before": F.lag(value).over(w), "after": F.lead(value).over(w), "depth": F.least(left, right) - F.col(value)})
    return dip.where((F.col(value) <= F.col("before")) & (F.col(value) < F.col("after")) & (F.col("depth") >= prominence)).drop("before", "after")


def region_measures(labelled: DataFrame, keys: Sequence[str] = PLANE) -> DataFrame:
    """Region properties of each object (label > 0) as one aggregation over its pixels.

    Only the columns that are read later are computed. Axes are those of the ellipse with equal
    second moments; an object's orientation is its major axis's angle to the rows. Moments are summed
    as whole numbers, so that equal axes do not differ by rounding.
    """
    on = labelled.where("label > 0")
    y, x, v = F.col("y").cast("long"), F.col("x").cast("long"), F.col("value")
    whole = {"sy": y, "sx": x, "syy": y * y, "sxx": x * x, "sxy": y * x}
    agg = on.groupBy(*keys, "label").agg(
        F.count(F.lit(1)).cast("double").alias("area"), F.avg(y).alias("centroid_0"), F.avg(x).alias("centroid_1"), F.max(v).alias("max_intensity"), F.min(v).alias("min_intensity"), F.avg(v).alias("mean_intensity"),
        *(F.sum(c).alias(n) for n, c in whole.items()), F.stddev_pop(v).alias("roi_std_dev"), skewness(v).alias("roi_skewness"),
        F.min("y").alias("bbox_y0"), F.min("x").alias("bbox_x0"), (F.max("y") + 1).alias("bbox_y1"), (F.max("x") + 1).alias("bbox_x1"),
    )
    n, sy, sx, syy, sxx, sxy = (F.col(s).cast("decimal(19,0)") for s in ("area", *whole))
    wide, cross = (n * syy - sy * sy) - (n * sxx - sx * sx), n * sxy - sy * sx
    a, c, b = (m.cast("double") / (F.col("area") * F.col("area")) for m in (n * sxx - sx * sx, n * syy - sy * sy, cross))
    root = F.sqrt(F.pow((a - c) / 2, F.lit(2)) + b * b)
    major, minor = 4 * F.sqrt(F.greatest((a + c) / 2 + root, F.lit(0.0))), 4 * F.sqrt(F.greatest((a + c) / 2 - root, F.lit(0.0)))
    quarter = F.lit(0.7853981633974483)
    angle = F.when(wide == 0, F.when(cross > 0, quarter).otherwise(-quarter)).otherwise(0.5 * F.atan2(2 * cross.cast("double"), wide.cast("double")))
    return agg.withColumns({"major_axis_length": major, "minor_axis_length": minor, "orientation": angle}).drop(*whole)


def skewness(v: Column) -> Column:
    """Bias-corrected skewness; 0 for fewer than ten different values."""
    n = F.count(v).cast("double")
    return F.when(F.count_distinct(v) < 10, F.lit(0.0)).otherwise(F.skewness(v) * F.sqrt(n * (n - 1)) / (n - 2))


def quartiles(pixels: DataFrame, keys: Sequence[str] = (*PLANE, "label")) -> DataFrame:
    """25, 50 and 75 % quantiles of each object's pixels."""
    return pixels.groupBy(*keys).agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")).select(*keys, *(F.col("q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))))


def line_fit(points: DataFrame, keys: Sequence[str] = PLANE) -> DataFrame:
    """slope, intercept and tilt in degrees of y over x; 0 for fewer than two points or places."""
    fit = points.groupBy(*keys).agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"), F.count(F.lit(1)).alias("n"), F.avg("y").alias("m"))
    ok = (F.col("n") >= 2) & F.col("slope").isNotNull()
    return fit.select(*keys, F.when(ok, F.col("slope")).otherwise(0.0).alias("slope"), F.when(ok, F.col("intercept")).otherwise(0.0).alias("intercept"), F.when(ok, F.degrees(F.atan("slope"))).otherwise(0.0).alias("tilt"))


def extrapolated_positions(blocks: DataFrame, low: float, high: float, least_spacing: float = 50.0, keys: Sequence[str] = PLANE) -> DataFrame:
    """Places along the row at the median spacing of found blocks, over [low, high]; found ones kept."""
    w = Window.partitionBy(*keys).orderBy("x")
    gaps = blocks.select(*keys, "x", "y", (F.col("x") - F.lag("x").over(w)).alias("gap"))
    s = gaps.groupBy(*keys).agg(F.percentile("gap", F.lit(0.5)).alias("step"), F.percentile("y", F.lit(0.5)).alias("y"), F.min("x").alias("x0"))
    s = s.where(F.col("step") >= least_spacing)
    k = F.sequence(F.ceil((F.lit(low) - F.col("x0")) / F.col("step")).cast("int"), F.floor((F.lit(high) - F.col("x0")) / F.col("step")).cast("int"))
    made = s.select(*keys, "step", "y", "x0", F.explode(k).alias("k")).select(*keys, (F.col("x0") + F.col("k") * F.col("step")).alias("x"), "y", F.col("step"))
    near = made.join(blocks.select(*keys, F.col("x").alias("bx")), list(keys)).where(F.abs(F.col("x") - F.col("bx")) < F.col("step") / 2)
    new = made.join(near.select(*keys, "x").distinct(), [*keys, "x"], "left_anti").select(*keys, "x", "y", F.lit(False).alias("found"))
    return blocks.select(*keys, "x", "y", F.lit(True).alias("found")).unionByName(new)


def x_band(blocks: DataFrame, width: int, left: dict | None, right: dict | None, keys: Sequence[str] = PLANE) -> DataFrame:
    """x0, x1 and case of the crop from the outermost found blocks (x in the rotated frame).

    ``left`` and ``right`` calibrate a wall: ``threshold`` and ``offset`` for two blocks or more,
    ``single_threshold`` and ``spacing`` for the one that a lone block is taken to lack. A left wall
    is seen where the leftmost block lies beyond its threshold; a right wall, where the rightmost
    lies before it. Cases: centre, LEFT, RIGHT, BOTH, and ``_n1`` of each for a lone block.
    """
    s = blocks.groupBy(*keys).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"))
    many = F.col("n") >= 2

    def wall(cal: dict | None, end: str, beyond, sign: int):
        if cal is None:
            return F.lit(False), F.lit(None).cast("double")
        lone = beyond(F.col(end), F.lit(float(cal["single_threshold"]))) if "single_threshold" in cal else F.lit(False)
        seen = F.when(many, beyond(F.col(end), F.lit(float(cal["threshold"])))).otherwise(lone)
        return seen, F.col(end) + F.when(many, 0.0).otherwise(sign * float(cal.get("spacing", 1033))) + float(cal["offset"])

    is_left, at_left = wall(left, "lo", lambda v, t: v > t, -1)
    is_right, at_right = wall(right, "hi", lambda v, t: v < t, 1)
    side = F.when(is_left & is_right, "BOTH").when(is_left, "LEFT").when(is_right, "RIGHT")
    case = F.when(side.isNull(), "centre").when(many, side).otherwise(F.concat(side, F.lit("_n1")))
    x0 = F.when(is_left, F.greatest(F.lit(0), F.rint(at_left).cast("int"))).otherwise(0)
    x1 = F.when(is_right, F.least(F.lit(width), F.rint(at_right).cast("int"))).otherwise(width)
    return s.select(*keys, case.alias("case"), x0.alias("x0"), x1.alias("x1"))
