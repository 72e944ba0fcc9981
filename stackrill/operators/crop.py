"""Cropping a movie to its target line: detect blocks, follow their drift, rotate and crop.

Detection is a kernel on each frame; tilt, drift, gap filling and smoothing are SQL on the detected
blocks; the crop is a kernel on each plane with its frame's transform.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clamp_tilt
from ..schema import PLANE
from . import kernels as k
from . import pixels as px
from . import relational as rel
from .planes import _keys, decode, encode


class NoBlockDetected(ValueError):
    """No frame of a movie has a block."""


@dataclass(frozen=True)
class Calibration:
    """Band around the blocks' row, tilt bound and drift bound. Fixed values."""

    top: float = -800.0
    bottom: float = 775.0
    tilt: float = 1.0
    drift: float = 300.0
    window: int = 7
    left: dict | None = None
    right: dict | None = None


def detect_blocks(planes: DataFrame, template: np.ndarray, channel: int = 0, most: int = 10, separation: int = 100, least: float = 0.5) -> DataFrame:
    """(movie, frame, y, x, score) of template matches on one row of each frame."""
    one = planes.where((F.col("channel") == channel) & (F.col("slice") == 0))

    def run(batches):
        for df in batches:
            rows = [(r.movie, r.frame, *b) for r in df.itertuples() for b in k.id_blocks(decode(r), template, most, separation, least)]
            yield pd.DataFrame(rows, columns=["movie", "frame", "y", "x", "score"])

    return one.mapInPandas(run, "movie string, frame int, y double, x double, score double")


def frame_transforms(frames: DataFrame, blocks: DataFrame, height: int, width: int, cal: Calibration = Calibration()) -> DataFrame:
    """(movie, frame, tilt, y0, y1, x0, x1, dy, dx, found): one box size per movie, moved by drift.

    The reference is frame 0, or the first with blocks. Tilt is the median of the frames' line fits
    over two blocks or more, clamped. Frames without blocks are interpolated; drift is then smoothed
    by a moving median.
    """
    first = blocks.groupBy("movie").agg(F.min("frame").alias("frame"))
    ref = blocks.join(first, ["movie", "frame"])
    fits = px.line_fit(blocks).join(blocks.groupBy("movie", "frame").agg(F.count(F.lit(1)).alias("n")), ["movie", "frame"]).where("n >= 2")
    tilt = fits.groupBy("movie").agg(F.percentile("tilt", F.lit(0.5)).alias("t"))
    tilt = first.select("movie").join(tilt, "movie", "left").select("movie", clamp_tilt(F.coalesce("t", F.lit(0.0)), cal.tilt)["angle"].alias("tilt"))
    row = ref.groupBy("movie").agg(F.percentile("y", F.lit(0.5)).alias("cy"))
    band = row.select("movie", F.greatest(F.lit(0), F.rint(F.col("cy") + cal.top).cast("int")).alias("y0"), F.least(F.lit(height), F.rint(F.col("cy") + cal.bottom).cast("int")).alias("y1"), "cy")
    across = px.x_band(ref, width, cal.left, cal.right, ("movie",)).drop("case")
    drift = rel.frame_drift(rel.nearest_reference(blocks, ref, cal.drift))
    path = frames.select("movie", "frame").join(drift, ["movie", "frame"], "left").withColumn("found", F.col("dx").isNotNull())
    for c in ("dx", "dy"):
        path = px.moving_median(px.interpolate(path, c), c, cal.window)
    out = path.join(tilt.join(band, "movie").join(across, "movie"), "movie")
    dy = F.rint("dy").cast("int")
    dx = F.rint("dx").cast("int")
    y0 = F.greatest(F.lit(0), F.least(F.lit(height) - (F.col("y1") - F.col("y0")), F.col("y0") + dy))
    x0 = F.greatest(F.lit(0), F.least(F.lit(width) - (F.col("x1") - F.col("x0")), F.col("x0") + dx))
    return out.select("movie", "frame", "tilt", "found", "cy", "dy", "dx", y0.alias("y0"), (y0 + F.col("y1") - F.col("y0")).alias("y1"), x0.alias("x0"), (x0 + F.col("x1") - F.col("x0")).alias("x1"))


def crop_planes(planes: DataFrame, transforms: DataFrame) -> DataFrame:
    """Each plane turned about its drifted centre and cut to its box."""
    names = [x.name for x in PLANE]
    rows = planes.join(transforms, ["movie", "frame"])

    def run(batches):
        for df in batches:
            out = []
            for r in df.itertuples():
                img = decode(r)
                if r.tilt:
                    img = k.warp(img, k.rotation(r.tilt, (r.cy + r.dy, r.width / 2 + r.dx)))
                out.append(encode(_keys(r), img[r.y0 : r.y1, r.x0 : r.x1], r.dtype))
            yield pd.DataFrame(out, columns=names)

    return rows.mapInPandas(run, PLANE)


def crop_to_target_line(planes: DataFrame, template: np.ndarray, height: int, width: int, channel: int = 0, cal: Calibration = Calibration(), per_frame: bool = True, least: float = 0.5) -> DataFrame:
    """Detect, follow and crop. A movie without any block raises :class:`NoBlockDetected`."""
    blocks = detect_blocks(planes, template, channel, least=least)
    frames = planes.select("movie", "frame").distinct()
    empty = frames.select("movie").distinct().join(blocks.select("movie").distinct(), "movie", "left_anti").head()
    if empty:
        raise NoBlockDetected(empty[0])
    t = frame_transforms(frames, blocks, height, width, cal)
    if not per_frame:  # frame 0's box for all
        first = t.join(blocks.groupBy("movie").agg(F.min("frame").alias("frame")), ["movie", "frame"]).drop("frame")
        t = frames.join(first, "movie")
    return crop_planes(planes, t)


@dataclass(frozen=True)
class WallSearch:
    """Where walls are looked for, from the blocks' centre, and how deep they are. Fixed values."""

    above: tuple[int, int] = (600, 1200)
    below: tuple[int, int] = (700, 1100)
    beside: tuple[int, int] = (250, 1400)
    smooth: int = 31
    reach: int = 80
    central: float = 0.6
    depth: float = 0.10
    side_depth: float = 0.40
    inset: tuple[int, int, int] = (30, 20, 15)
    block: int = 250
    fixed: tuple[int, int] = (946, 754)


def wall_dips(profile: np.ndarray, lo: int, hi: int, reach: int, least: float) -> list[tuple[int, float]]:
    """(place, depth) of local minima in [lo, hi) that lie below the higher shoulder by ``least`` of the range."""
    part = profile[lo:hi]
    if len(part) < 10 or np.ptp(part) < 1e-6:
        return []
    inner = np.flatnonzero((part[1:-1] <= part[:-2]) & (part[1:-1] <= part[2:])) + 1
    depth = np.array([part[max(0, i - reach) : i + reach + 1].max() - part[i] for i in inner])
    return [(lo + int(i), float(d)) for i, d in zip(inner, depth) if d >= least * np.ptp(part)]


def wall_box(img: np.ndarray, blocks: list[tuple[float, float]], search: WallSearch = WallSearch(), strongest: bool = False, sides: bool = False) -> tuple[int, int, int, int]:
    """(y0, y1, x0, x1) between the walls of a levelled plane whose blocks are at (y, x).

    The wall above is the deepest dip of the rows' medians, that below the first one, or the deepest if
    ``strongest``. Without one of them the rows are at fixed distances from the blocks. With ``sides``
    and both, the deepest dips of the columns' medians, blocks left out, are the walls beside.
    """
    height, width = img.shape
    cy, cx = (round(float(np.median([b[i] for b in blocks]))) for i in (0, 1))
    level = lambda line: np.convolve(line, np.ones(search.smooth) / search.smooth, mode="same")
    edge = int(width * (1 - search.central) / 2)
    rows = level(np.median(img[:, edge : width - edge].astype(float), axis=1))
    top = wall_dips(rows, max(0, cy - search.above[1]), max(0, cy - search.above[0]), search.reach, search.depth)
    low = wall_dips(rows, min(height, cy + search.below[0]), min(height, cy + search.below[1]), search.reach, search.depth)
    deepest = lambda found: max(found, key=lambda d: d[1])[0]
    if not top or not low:
        return max(0, cy - search.fixed[0]), min(height, cy + search.fixed[1]), 0, width
    y0, y1 = deepest(top) + search.inset[0], (deepest(low) if strongest else low[0][0]) - search.inset[1]
    if not sides or y1 - y0 < 20:
        return y0, y1, 0, width
    band = img[y0:y1].astype(float)
    hidden = np.zeros(band.shape, bool)
    for y, x in blocks:
        a, b = round(y) - y0, round(x)
        hidden[max(0, a - search.block) : max(0, a + search.block), max(0, b - search.block) : max(0, b + search.block)] = True
    line = np.ma.median(np.ma.array(band, mask=hidden), axis=0).filled(np.median(band))
    columns, clear = level(line), lambda found: [d for d in found if all(abs(d[0] - x) >= search.block for _, x in blocks)]
    left = clear(wall_dips(columns, max(0, cx - search.beside[1]), max(0, cx - search.beside[0]), search.reach, search.side_depth))
    right = clear(wall_dips(columns, min(width, cx + search.beside[0]), min(width, cx + search.beside[1]), search.reach, search.side_depth))
    return y0, y1, max(0, deepest(left) + search.inset[2]) if left else 0, min(width, deepest(right) - search.inset[2]) if right else width


def crop_to_walls(planes: DataFrame, template: np.ndarray, height: int, width: int, channel: int = 0, search: WallSearch = WallSearch(), strongest: bool = False, sides: bool = False, least: float = 0.25) -> DataFrame:
    """Level each movie by the blocks of its first frame and cut it to the walls seen there.

    One box and tilt for all frames. A movie without any block raises :class:`NoBlockDetected`.
    """
    first = planes.where(F.col("channel") == channel).join(planes.groupBy("movie").agg(F.min("frame").alias("frame")), ["movie", "frame"])
    blocks = detect_blocks(first, template, channel, least=least)
    empty = first.select("movie").join(blocks.select("movie").distinct(), "movie", "left_anti").head()
    if empty:
        raise NoBlockDetected(empty[0])
    t = frame_transforms(first.select("movie", "frame"), blocks, height, width).select("movie", "tilt", "cy")
    at = blocks.groupBy("movie").agg(F.collect_list("y").alias("ys"), F.collect_list("x").alias("xs"))
    out = "movie string, tilt double, cy double, dy int, dx int, y0 int, y1 int, x0 int, x1 int"

    def run(batches):
        for df in batches:
            rows = []
            for r in df.itertuples():
                turn = k.rotation(r.tilt, (r.cy, r.width / 2))
                img = decode(r).astype(float)
                img = (img - img.min()) / max(np.ptp(img), 1e-12) * 255
                turned = [(float(turn[1] @ (x, y, 1)), float(turn[0] @ (x, y, 1))) for y, x in zip(r.ys, r.xs)]
                box = wall_box(k.warp(img, turn) if r.tilt else img, turned, search, strongest, sides)
                rows.append((r.movie, r.tilt, r.cy, 0, 0, *map(int, box)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in out.split(", ")])

    boxes = first.join(t, "movie").join(at, "movie").mapInPandas(run, out)
    return crop_planes(planes, planes.select("movie", "frame").distinct().join(boxes, "movie"))
