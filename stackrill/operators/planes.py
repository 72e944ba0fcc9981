"""Array operators over plane relations: one row per 2-D plane, kernels by Arrow batch.

Planes are large, so batches are short, and nothing gathers a stack: what needs several planes joins
them two by two, or sums them as they pass.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import PLANE
from . import kernels as k

#: Bytes of planes in an Arrow batch, about; a larger plane is a batch of its own.
BATCH_BYTES = 64 << 20
_KEYS = ("movie", "frame", "slice", "channel")


def decode(row) -> np.ndarray:
    return np.frombuffer(row.pixels, row.dtype).reshape(row.height, row.width)


def encode(keys: dict, img: np.ndarray, dtype: str = "float32") -> dict:
    img = np.ascontiguousarray(img, dtype)
    return keys | {"height": img.shape[0], "width": img.shape[1], "dtype": str(img.dtype), "pixels": img.tobytes()}


def _keys(row) -> dict:
    return {c: getattr(row, c) for c in _KEYS}


def _large_batches(planes: DataFrame) -> DataFrame:
    planes.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return planes


def map_planes(planes: DataFrame, f: Callable[[np.ndarray], np.ndarray], dtype: str | None = None) -> DataFrame:
    """Each plane under ``f``; the result has its own size, and its type unless one is given."""
    planes.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    names = [x.name for x in PLANE]

    def run(batches):
        for df in batches:
            yield pd.DataFrame([encode(_keys(r), f(decode(r)), dtype or r.dtype) for r in df.itertuples()], columns=names)

    return planes.select(*names).mapInPandas(run, PLANE)


def clear_background(planes: DataFrame, sigma_r: float = 20.0, unit: str = "um", method: str = "divide", pixel_size: float = 1.0) -> DataFrame:
    """Blurred background divided out or subtracted."""
    return map_planes(planes, lambda img: k.clear_background(img, sigma_r, unit, method, pixel_size), "float32")


def fix_well(planes: DataFrame, factor: float = 0.4) -> DataFrame:
    """Dark regions at the border filled with the mean of the rest."""
    return map_planes(planes, lambda img: k.fix_dark_border(img, factor)[0])


def equalise(planes: DataFrame) -> DataFrame:
    return map_planes(planes, k.equalise_z, "float32")


def scale(planes: DataFrame, mode: str = "range01") -> DataFrame:
    """As a model wants it (see :func:`kernels.scale_image`)."""
    return map_planes(planes, lambda img: k.scale_image(img, mode)[0], "float32")


def sobel(planes: DataFrame, smooth: int = 0) -> DataFrame:
    return map_planes(planes, lambda img: k.sobel(img, smooth), "uint8")


def tiles(planes: DataFrame, tile: int = 256, overlap: float = 0.33, fill: float | None = None) -> DataFrame:
    """(keys, height, width, off_y, off_x, valid_h, valid_w, pixels): tiles in rows, min-max scaled."""
    planes.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    names = [*_KEYS, "height", "width", "off_y", "off_x", "valid_h", "valid_w", "pixels"]

    def run(batches):
        for df in batches:
            for r in df.itertuples():
                img = decode(r).astype(float)
                wide = k.pad_to_tiles(img, tile, overlap, fill)
                rows = []
                for y in k.tile_positions(wide.shape[0], tile, overlap):
                    for x in k.tile_positions(wide.shape[1], tile, overlap):
                        t = wide[y : y + tile, x : x + tile]
                        t = (t - t.min()) / (t.max() - t.min() + 1e-6)
                        rows.append((*_keys(r).values(), r.height, r.width, y, x, max(0, min(tile, r.height - y)), max(0, min(tile, r.width - x)), t.astype(np.float32).tobytes()))
                yield pd.DataFrame(rows, columns=names)

    return planes.mapInPandas(run, "movie string, frame int, slice int, channel int, height int, width int, off_y int, off_x int, valid_h int, valid_w int, pixels binary")


def label_planes(planes: DataFrame, t: float = 0.5, least: int = 20, diagonal: bool = False) -> DataFrame:
    """Label planes (int32) of each plane's pixels above ``t``, without objects below ``least`` pixels."""

    return map_planes(planes, lambda img: _components(img, t, least, diagonal), "int32")


def _components(img: np.ndarray, t: float, least: int, diagonal: bool) -> np.ndarray:
    """Components of the pixels above ``t``, numbered in raster order, without those below ``least``."""
    parts, n = k.label(img > t, diagonal)
    keep = np.bincount(parts.ravel(), minlength=n + 1) >= least
    keep[0] = False
    return (np.cumsum(keep) * keep)[parts]


def labelled_pixels(planes: DataFrame, t: float = 0.5, least: int = 1, diagonal: bool = False) -> DataFrame:
    """(movie, frame, y, x, value, label) of the labelled pixels of each plane.

    A plane is labelled where it is read: only pixels of objects become rows, and nothing is shuffled.
    """

    def run(batches):
        for df in batches:
            for r in df.itertuples():
                img = decode(r)
                parts = _components(img, t, least, diagonal)
                y, x = np.nonzero(parts)
                yield pd.DataFrame({"movie": r.movie, "frame": r.frame, "y": y.astype(np.int32), "x": x.astype(np.int32), "value": img[y, x].astype(float), "label": parts[y, x].astype(np.int32)})

    return _large_batches(planes).mapInPandas(run, "movie string, frame int, y int, x int, value double, label int")


def measure_components(planes: DataFrame, t: float = 0.5, least: int = 1, diagonal: bool = False) -> DataFrame:
    """Region properties of the components of each plane: labelled and measured in one map."""
    whole = {c for c in k.REGION if c.startswith("bbox")}
    names = [*_KEYS, "label", *k.REGION]

    def run(batches):
        for df in batches:
            for r in df.itertuples():
                img = decode(r)
                yield pd.DataFrame(_keys(r) | k.region_table(_components(img, t, least, diagonal), img))[names]

    return _large_batches(planes).mapInPandas(run, ", ".join(["movie string, frame int, slice int, channel int, label int", *(f"{c} {'int' if c in whole else 'double'}" for c in k.REGION)]))


def measure_planes(stack: DataFrame, labels: DataFrame, channel: int, q: float = 0.10, extra: Mapping[str, Callable[[np.ndarray, np.ndarray], float]] | None = None) -> DataFrame:
    """Region properties and background of one channel, a row for each object of the label planes.

    Equal to :func:`pixels.region_measures` over the pixel relation, but a plane stays a plane: no
    pixel becomes a row, and only the two planes of a frame meet. ``extra`` adds measures of one's own:
    functions of an object's mask and of its pixels, both cut to its box, each a column of doubles.
    """
    one = stack.where(F.col("channel") == channel)
    both = one.join(labels.select("movie", "frame", F.col("pixels").alias("mask")), ["movie", "frame"])
    extra = dict(extra or {})
    names = ["movie", "frame", "slice", "channel", "label", *k.REGION, "background", *extra]
    whole = {c for c in k.REGION if c.startswith("bbox")}
    kinds = ", ".join(["movie string, frame int, slice int, channel int, label int", *(f"{c} {'int' if c in whole else 'double'}" for c in k.REGION), "background double", *(f"`{c}` double" for c in extra)])

    def run(batches):
        for df in batches:
            for r in df.itertuples():
                img, parts = decode(r), np.frombuffer(r.mask, np.int32).reshape(r.height, r.width)
                rest = img[parts == 0]
                out = pd.DataFrame(_keys(r) | k.region_table(parts, img))
                cuts = [np.s_[o.bbox_y0 : o.bbox_y1, o.bbox_x0 : o.bbox_x1] for o in out.astype({c: int for c in whole}).itertuples()] if extra else []
                for name, f in extra.items():
                    out[name] = [float(f(parts[cut] == n, img[cut])) for n, cut in zip(out["label"], cuts)]
                yield out.assign(background=float(np.quantile(rest.astype(float), q)) if rest.size else None)[names]

    return both.mapInPandas(run, kinds)


def shape_measures(labels: DataFrame) -> DataFrame:
    """solidity, border_complexity and rod_shape_coef of each object of label planes."""
    names = ["movie", "frame", "label", "solidity", "border_complexity", "rod_shape_coef"]

    def run(batches):
        for df in batches:
            rows = []
            for r in df.itertuples():
                parts = np.frombuffer(r.pixels, np.int32).reshape(r.height, r.width)
                ys, xs = np.nonzero(parts)
                n = parts[ys, xs]
                order = np.argsort(n, kind="stable")
                for own in np.split(order, np.flatnonzero(np.diff(n[order])) + 1) if len(n) else []:
                    y, x = ys[own], xs[own]
                    mask = np.zeros((y.max() - y.min() + 1, x.max() - x.min() + 1), bool)
                    mask[y - y.min(), x - x.min()] = True
                    rows.append((r.movie, r.frame, int(n[own[0]]), len(y) / k.convex_area(y, x), k.border_complexity(mask), k.rod_shape(mask)))
            yield pd.DataFrame(rows, columns=names)

    return _large_batches(labels).mapInPandas(run, "movie string, frame int, label int, solidity double, border_complexity double, rod_shape_coef double")


def dilated_measures(labelled: DataFrame, pixels: DataFrame, times: int = 1, keys: Sequence[str] = ("movie", "frame")) -> DataFrame:
    """std, mean, min, max and area over each object dilated by 5×5: a stencil join on the pixels."""
    r = 2 * times
    near = F.explode(F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in range(-r, r + 1) for dx in range(-r, r + 1))))
    grown = labelled.select(*keys, "label", "y", "x", near.alias("d")).select(*keys, "label", (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x")).distinct()
    return grown.join(pixels, [*keys, "y", "x"]).groupBy(*keys, "label").agg(F.stddev_pop("value").alias("dilated_std"), F.avg("value").alias("dilated_mean"), F.min("value").alias("dilated_min"), F.max("value").alias("dilated_max"), F.count(F.lit(1)).alias("dilated_area"))


def roi_crops(planes: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(movie, frame, label, pixels): each object cut out, 0 around it, fitted into size×size."""
    both = planes.join(labels.select("movie", "frame", F.col("pixels").alias("mask")), ["movie", "frame"])

    def run(batches):
        for df in batches:
            rows = []
            for r in df.itertuples():
                img, parts = decode(r), np.frombuffer(r.mask, np.int32).reshape(r.height, r.width)
                for n in range(1, int(parts.max()) + 1):
                    y, x = np.nonzero(parts == n)
                    if len(y):
                        box = np.s_[y.min() : y.max() + 1, x.min() : x.max() + 1]
                        rows.append((r.movie, r.frame, n, k.fit_roi(np.where(parts[box] == n, img[box], 0), size).astype(np.float32).tobytes()))
            yield pd.DataFrame(rows, columns=["movie", "frame", "label", "pixels"])

    return both.mapInPandas(run, "movie string, frame int, label int, pixels binary")


def to_pixels(planes: DataFrame) -> DataFrame:
    """The pixel relation of planes: (movie, frame, slice, channel, y, x, value)."""

    def run(batches):
        for df in batches:
            for r in df.itertuples():
                y, x = np.mgrid[: r.height, : r.width]
                yield pd.DataFrame(_keys(r) | {"y": y.ravel().astype(np.int32), "x": x.ravel().astype(np.int32), "value": decode(r).ravel().astype(float)})

    return planes.mapInPandas(run, "movie string, frame int, slice int, channel int, y int, x int, value double")


def paint(points: DataFrame, height: int, width: int, keys: Sequence[str] = ("movie", "frame"), one_hot: int | None = None) -> DataFrame:
    """Planes of points (y, x, code), 0 elsewhere; with ``one_hot`` one plane for each of n codes.

    The type is the smallest unsigned one that holds the codes.
    """
    names = [x.name for x in PLANE]

    def run(df: pd.DataFrame) -> pd.DataFrame:
        img = np.zeros((height, width), np.int64)
        img[df["y"], df["x"]] = df["code"]
        kind = np.uint8 if img.max() < 256 else np.uint16 if img.max() < 65536 else np.uint32
        base = {"movie": str(df[keys[0]].iloc[0]), "frame": int(df[keys[1]].iloc[0]), "slice": 0}
        layers = [(c, img == c) for c in range(one_hot)] if one_hot else [(0, img)]
        return pd.DataFrame([encode(base | {"channel": c}, a, kind) for c, a in layers], columns=names)

    return points.groupBy(*keys).applyInPandas(run, PLANE)


def align_shifts(planes: DataFrame, channel: int = 0, slice_: int = 0, reference: str = "first") -> DataFrame:
    """(movie, frame, dy, dx) that aligns each frame to the first, or to the one before it.

    Each plane is joined with the one plane that it is compared to; no task holds a movie.
    """
    one = planes.where((F.col("channel") == channel) & (F.col("slice") == slice_))
    frames = one.select("movie", "frame")
    if reference == "previous":
        before = frames.withColumn("ref", F.lag("frame").over(Window.partitionBy("movie").orderBy("frame")))
    else:
        before = frames.join(frames.groupBy("movie").agg(F.min("frame").alias("ref")), "movie")
    refs = one.select("movie", F.col("frame").alias("ref"), F.col("pixels").alias("base"))
    both = one.join(before, ["movie", "frame"]).join(refs, ["movie", "ref"], "left")

    def run(batches):
        for df in batches:
            rows = []
            for r in df.itertuples():
                shift = (0, 0)
                if r.base is not None and r.ref != r.frame:
                    shift = k.shift_between(np.frombuffer(r.base, r.dtype).reshape(r.height, r.width).astype(float), decode(r).astype(float))
                rows.append((r.movie, r.frame, *map(int, shift)))
            yield pd.DataFrame(rows, columns=["movie", "frame", "dy", "dx"])

    found = _large_batches(both).mapInPandas(run, "movie string, frame int, dy int, dx int")
    if reference != "previous":
        return found
    so_far = Window.partitionBy("movie").orderBy("frame")
    return found.select("movie", "frame", *(F.sum(c).over(so_far).cast("int").alias(c) for c in ("dy", "dx")))


def align(planes: DataFrame, shifts: DataFrame) -> DataFrame:
    """Planes moved by their frame's shift and cropped to what all frames of the movie have.

    The common box follows from the shifts' extents, the same as from the least value over time.
    """
    ends = shifts.groupBy("movie").agg(*(f(c).alias(f"{c}_{n}") for c in ("dy", "dx") for n, f in (("lo", F.min), ("hi", F.max))))
    rows = planes.join(shifts, ["movie", "frame"]).join(ends, "movie")
    names = [x.name for x in PLANE]

    def run(batches):
        for df in batches:
            out = []
            for r in df.itertuples():
                img = k.shifted(decode(r), int(r.dy), int(r.dx))
                img = img[max(0, r.dy_hi) : r.height + min(0, r.dy_lo), max(0, r.dx_hi) : r.width + min(0, r.dx_lo)]
                out.append(encode(_keys(r), img, r.dtype))
            yield pd.DataFrame(out, columns=names)

    return rows.mapInPandas(run, PLANE)


def plane_sums(planes: DataFrame) -> DataFrame:
    """(movie, channel, n, total): planes of each channel summed by pixel, float64.

    Each task sums what it reads, so a movie leaves it as one plane a channel; those few are summed
    two by two, and at most two planes are held.
    """
    schema = "movie string, channel int, n long, total binary"

    def partial(batches):
        sums: dict = {}
        for df in batches:
            for r in df.itertuples():
                n, total = sums.get((r.movie, r.channel), (0, 0.0))
                sums[r.movie, r.channel] = n + 1, total + decode(r).astype(float)
        yield pd.DataFrame([(*key, n, total.tobytes()) for key, (n, total) in sums.items()], columns=["movie", "channel", "n", "total"])

    def whole(batches):
        key, n, total = None, 0, None
        for df in batches:
            for r in df.itertuples():
                if key != (r.movie, r.channel):
                    if key:
                        yield pd.DataFrame([(*key, n, total.tobytes())], columns=df.columns)
                    key, n, total = (r.movie, r.channel), 0, 0.0
                n, total = n + r.n, total + np.frombuffer(r.total, float)
        if key:
            yield pd.DataFrame([(*key, n, total.tobytes())], columns=["movie", "channel", "n", "total"])

    parts = _large_batches(planes).mapInPandas(partial, schema)
    return parts.repartition("movie", "channel").sortWithinPartitions("movie", "channel").mapInPandas(whole, schema)


def mean_fields(planes: DataFrame, smooth: int = 101) -> DataFrame:
    """(movie, channel, field_h, field_w, field): each channel's blurred mean over time, scaled to mean 1."""
    one = planes.groupBy("movie", "channel").agg(F.min("height").alias("field_h"), F.min("width").alias("field_w"))

    def run(batches):
        for df in batches:
            rows = []
            for r in df.itertuples():
                field = k.gaussian_blur(np.frombuffer(r.total, float).reshape(r.field_h, r.field_w) / r.n, smooth)
                rows.append((r.movie, r.channel, r.field_h, r.field_w, (field / field.mean()).astype(np.float32).tobytes()))
            yield pd.DataFrame(rows, columns=["movie", "channel", "field_h", "field_w", "field"])

    return plane_sums(planes).join(one, ["movie", "channel"]).mapInPandas(run, _FIELD)


_FIELD = "movie string, channel int, field_h int, field_w int, field binary"
#: Side of the grids to which planes are reduced for a low-rank fit.
GRID = 64


def low_rank_fields(planes: DataFrame, smooth: float = 0.1, grid: int = GRID) -> DataFrame:
    """(movie, channel, field_h, field_w, field): the field that a channel's planes share, on a grid.

    Planes are reduced where they are read; a group is one channel's grids, 32 KB a frame.
    """

    def reduce(batches):
        for df in batches:
            rows = [(r.movie, r.channel, k.resize(decode(r).astype(float), grid, grid).astype(np.float64).tobytes()) for r in df.itertuples()]
            yield pd.DataFrame(rows, columns=["movie", "channel", "grid"])

    def fit(df: pd.DataFrame) -> pd.DataFrame:
        field = k.low_rank_field(np.stack([np.frombuffer(g, float).reshape(grid, grid) for g in df["grid"]]), smooth)
        return pd.DataFrame([(df["movie"].iloc[0], df["channel"].iloc[0], grid, grid, field.astype(np.float32).tobytes())], columns=["movie", "channel", "field_h", "field_w", "field"])

    return _large_batches(planes).mapInPandas(reduce, "movie string, channel int, grid binary").groupBy("movie", "channel").applyInPandas(fit, _FIELD)


def flat_field(planes: DataFrame, smooth: float = 101, method: str = "mean") -> DataFrame:
    """Each channel over its field, fitted per movie and channel: the blurred ``mean`` over time with
    ``smooth`` taps, or the ``low_rank`` fit with its cosines shrunk by ``smooth``."""
    if method not in ("mean", "low_rank"):
        raise ValueError(f"unknown method: {method}")
    names = [x.name for x in PLANE]
    fields = mean_fields(planes, int(smooth)) if method == "mean" else low_rank_fields(planes, smooth)

    def run(batches):
        last, field = None, None
        for df in batches:
            rows = []
            for r in df.itertuples():
                if last != (r.movie, r.channel):
                    last, field = (r.movie, r.channel), np.frombuffer(r.field, np.float32).reshape(r.field_h, r.field_w)
                    if field.shape != (r.height, r.width):
                        field = k.resize(field, r.height, r.width)
                    field = np.maximum(field, np.float32(1e-6))
                rows.append(encode(_keys(r), decode(r) / field))
            yield pd.DataFrame(rows, columns=names)

    rows = planes.join(fields, ["movie", "channel"]).select(*names, "field_h", "field_w", "field")
    return _large_batches(rows).mapInPandas(run, PLANE)


def background_by_plane(planes: DataFrame, labels: DataFrame, q: float = 0.10) -> DataFrame:
    """(movie, frame, background): q-quantile of unlabelled pixels, plane by plane; null if none."""
    both = planes.join(labels.select("movie", "frame", F.col("pixels").alias("mask")), ["movie", "frame"], "left")

    def run(batches):
        for df in batches:
            rows = []
            for r in df.itertuples():
                v = decode(r).astype(float).ravel()
                if r.mask is not None:
                    v = v[np.frombuffer(r.mask, np.int32) == 0]
                rows.append((r.movie, r.frame, float(np.quantile(v, q)) if len(v) else None))
            yield pd.DataFrame(rows, columns=["movie", "frame", "background"])

    return both.mapInPandas(run, "movie string, frame int, background double")
