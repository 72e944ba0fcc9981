"""Object tracking: optimal assignment from frame to frame, divisions, re-identification, stitching.

A movie is tracked in one group: the state after each frame decides the next. Groups are movies, so
work spreads over them; everything before and after (extents, statistics, lock-in) is SQL.
"""

from __future__ import annotations

import importlib
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, fields

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import require

_FAR = 1e9


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of least total cost that use all of the shorter side.

    Shortest augmenting paths over reduced costs, one row at a time; each step relaxes all columns
    at once. Ties go to the lower column.
    """
    cost = np.asarray(cost, float)
    if cost.size == 0:
        return []
    if cost.shape[0] > cost.shape[1]:
        return sorted((r, c) for c, r in assign(cost.T))
    n, m = cost.shape
    row_price, col_price = np.zeros(n), np.zeros(m)
    owner = np.full(m, -1)
    for row in range(n):
        dist, prev, open_ = np.full(m, np.inf), np.full(m, -1), np.ones(m, bool)
        at, reached, col = row, 0.0, -1
        while True:
            step = reached + cost[at] - row_price[at] - col_price
            better = open_ & (step < dist)
            dist[better], prev[better] = step[better], col
            col = int(np.where(open_, dist, np.inf).argmin())
            reached = dist[col]
            open_[col] = False
            if owner[col] < 0:
                break
            at = owner[col]
        seen = np.flatnonzero(~open_)
        used = seen[seen != col]
        row_price[owner[used]] += reached - dist[used]
        col_price[used] -= reached - dist[used]
        row_price[row] += reached
        while prev[col] >= 0:
            owner[col] = owner[prev[col]]
            col = prev[col]
        owner[col] = row
    return sorted((int(r), c) for c, r in enumerate(owner) if r >= 0)


def _relative(a, b, floor: float):
    return np.abs(a - b) / np.maximum(np.minimum(a, b), floor)


@dataclass
class GapTracker:
    """Assignment by distance, with gaps of up to ``gap`` frames bridged.

    All eligible tracks and all objects of a frame are assigned together, and only then are links
    longer than ``max_distance`` rejected.
    """

    max_distance: float = 25.0
    gap: int = 2

    def track(self, df: pd.DataFrame) -> pd.DataFrame:
        out = np.full(len(df), -1)
        last: dict[int, tuple[np.ndarray, int]] = {}
        fresh = 0
        at = df[["centroid_0", "centroid_1"]].to_numpy(float)
        for frame, rows in _frames(df):
            eligible = [t for t, (_, f) in last.items() if frame - f <= self.gap]
            linked = set()
            if eligible:
                d = _distances(np.array([last[t][0] for t in eligible]), at[rows])
                for i, j in assign(d):
                    if d[i, j] <= self.max_distance:
                        out[rows[j]] = eligible[i]
                        linked.add(j)
            for j, row in enumerate(rows):
                if j not in linked:
                    out[row] = fresh
                    fresh += 1
            for row in rows:
                last[out[row]] = (at[row], frame)
            last = {t: v for t, v in last.items() if v[1] >= frame - self.gap}
        return df.assign(trackid=out.astype(np.int32))


@dataclass
class _State:
    at: np.ndarray
    frame: int
    area: float
    major: float
    minor: float
    before: np.ndarray | None = None
    area_before: float = math.nan


@dataclass
class DivisionTracker:
    """As :class:`GapTracker`, with size and shape in the cost, divisions, re-identification, stitching."""

    max_distance: float = 10.0
    gap: int = 5
    area_weight: float = 0.3
    shape_weight: float = 0.0
    detect_divisions: bool = True
    division_min_ratio: float = 0.30
    division_max_ratio: float = 0.70
    division_radius: float = 15.0
    reid_max_gap: int = 16
    reid_distance: float = 10.0
    reid_area_tolerance: float = 0.30
    reid_shape_tolerance: float = 1.0
    stitch_max_distance: float = 8.0
    _parents: dict[int, int] = field(default_factory=dict, repr=False)

    def track(self, df: pd.DataFrame) -> pd.DataFrame:
        at = df[["centroid_0", "centroid_1"]].to_numpy(float)
        size = df["area"].to_numpy(float) if "area" in df else np.full(len(df), np.nan)
        has_shape = {"major_axis_length", "minor_axis_length"} <= set(df.columns)
        major, minor = (df[c].to_numpy(float) if has_shape else np.full(len(df), np.nan) for c in ("major_axis_length", "minor_axis_length"))
        out = np.full(len(df), -1)
        active: dict[int, _State] = {}
        retired: dict[int, _State] = {}
        parents: dict[int, int] = {}
        self._fresh = 0

        def new_id() -> int:
            self._fresh += 1
            return self._fresh - 1

        def move(track: int, row: int, frame: int) -> None:
            old = active.get(track)
            active[track] = _State(at[row], frame, size[row], major[row], minor[row], old.at if old else None, old.area if old else math.nan)

        for frame, rows in _frames(df):
            eligible = [t for t, s in active.items() if frame - s.frame <= self.gap]
            free = list(rows)
            links: list[tuple[int, int]] = []
            if eligible:
                states = [active[t] for t in eligible]
                d = _distances(np.array([s.at for s in states]), at[rows])
                cost = d.copy()
                column = lambda name: np.array([[getattr(s, name)] for s in states])
                if "area" in df:
                    cost += self.area_weight * self.max_distance * _relative(column("area"), size[rows][None], 1.0)
                if has_shape and self.shape_weight:
                    cost += self.shape_weight * self.max_distance * 0.5 * (_relative(column("major"), major[rows][None], 0.5) + _relative(column("minor"), minor[rows][None], 0.5))
                for i, j in assign(np.nan_to_num(cost, nan=_FAR)):
                    if d[i, j] <= self.max_distance:
                        links.append((eligible[i], rows[j]))
                        out[rows[j]] = eligible[i]
                        free.remove(rows[j])
                for t, row in links:
                    move(t, row, frame)
            if self.detect_divisions and "area" in df:
                self._divide(links, free, at, size, out, active, parents, frame, new_id, move)
            if retired and free:
                self._reidentify(free, retired, at, size, major, minor, has_shape, out, frame, move)
            for row in list(free):
                out[row] = new_id()
                move(out[row], row, frame)
            for t in [t for t, s in active.items() if s.frame < frame - self.gap]:
                retired[t] = active.pop(t)
            retired = {t: s for t, s in retired.items() if frame - s.frame <= self.reid_max_gap}
        df = df.assign(trackid=out.astype(np.int32), parent_track_id=np.array([parents.get(t, -1) for t in out], np.int32))
        return stitch(df, self.stitch_max_distance) if self.stitch_max_distance > 0 else df

    def _divide(self, links, free, at, size, out, active, parents, frame, new_id: Callable[[], int], move) -> None:
        """A linked object much smaller than its track was, with a near free one like it, is a daughter."""
        for track, row in links:
            mother = active[track]
            before = mother.area_before
            if not before > 0 or size[row] / before > self.division_max_ratio or not free:
                continue
            ratio = size[free] / before
            d = _distances(at[[row]], at[free])[0]
            d[(ratio < self.division_min_ratio) | (ratio > self.division_max_ratio) | (d >= self.division_radius)] = np.inf
            k = int(d.argmin())
            if not np.isfinite(d[k]):
                continue
            other, child = free[k], new_id()
            parents[child] = track
            free.remove(other)
            # The mother's id stays with the daughter nearer to where it was.
            keep, gone = (other, row) if np.hypot(*(at[other] - mother.before)) < np.hypot(*(at[row] - mother.before)) else (row, other)
            out[keep], out[gone] = track, child
            move(track, keep, frame)
            move(child, gone, frame)

    def _reidentify(self, free, retired, at, size, major, minor, has_shape, out, frame, move) -> None:
        ids = [t for t, s in retired.items() if frame - s.frame <= self.reid_max_gap]
        if not ids:
            return
        states = [retired[t] for t in ids]
        column = lambda name: np.array([[getattr(s, name)] for s in states])
        d = _distances(np.array([s.at for s in states]), at[free])
        bad = d > self.reid_distance
        if np.isfinite(size).any():
            bad |= _relative(column("area"), size[free][None], 1.0) > self.reid_area_tolerance
        if has_shape:
            bad |= (_relative(column("major"), major[free][None], 0.5) > self.reid_shape_tolerance) | (_relative(column("minor"), minor[free][None], 0.5) > self.reid_shape_tolerance)
        cost = np.where(bad, _FAR, d)
        rows = list(free)
        for i, j in assign(cost):
            if cost[i, j] < _FAR:
                out[rows[j]] = ids[i]
                free.remove(rows[j])
                del retired[ids[i]]
                move(ids[i], rows[j], frame)


def _frames(df: pd.DataFrame):
    frames = df["frame"].to_numpy()
    for f in np.unique(frames):
        yield int(f), np.flatnonzero(frames == f)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))


def stitch(df: pd.DataFrame, most: float = 8.0) -> pd.DataFrame:
    """Join tracks that begin where an earlier one ended.

    By first frame, each track looks at earlier ones, the latest start first, for the nearest end
    before its start, within ``most``, whose joined track has none of its frames. Places are those
    of the tracks themselves, not of what they are joined to. ``trackid`` only is changed.
    """
    tracks = []
    for t, g in df[df["trackid"] >= 0].sort_values("frame", kind="stable").groupby("trackid"):
        ends = g[["centroid_0", "centroid_1"]].to_numpy(float)
        tracks.append((int(g["frame"].iloc[0]), int(g["frame"].iloc[-1]), int(t), ends[0], ends[-1], set(g["frame"])))
    tracks.sort(key=lambda x: x[0])
    joined: dict[int, int] = {}
    frames = {t: set(f) for _, _, t, _, _, f in tracks}

    def head(t: int) -> int:
        while t in joined:
            t = joined[t]
        return t

    ends = np.array([end for _, end, *_ in tracks])
    places = np.array([last for *_, last, _ in tracks]).reshape(-1, 2)
    for k, (start, _, t, first, _, own) in enumerate(tracks):
        d = np.hypot(*(places[:k] - first).T)
        near = np.flatnonzero((ends[:k] < start) & (d <= most))
        for i in sorted(near, key=lambda i: (d[i], -i)):
            into = head(tracks[i][2])
            if not frames[into] & own:
                joined[t] = into
                frames[into] |= frames[t]
                break
    return df.assign(trackid=np.array([head(t) if t >= 0 else t for t in df["trackid"]], np.int32))


#: Sections that a Bayesian tracker's configuration must have. Fixed values.
BAYESIAN_SECTIONS = ("motion_model", "hypothesis_model")


@dataclass
class ExternalTracker:
    """Adapter of a tracking library: ``load(config)`` gives, in each task, a function from an array of
    (frame, y, x, area) to (track id, parent id) for each object, in the same order."""

    load: Callable[[dict], Callable[[np.ndarray], Sequence[tuple[int, int]]]]
    config: dict

    def __post_init__(self):
        if lacking := [x for x in BAYESIAN_SECTIONS if x not in self.config]:
            raise ValueError(f"the tracker's configuration lacks {', '.join(lacking)}")

    def track(self, df: pd.DataFrame) -> pd.DataFrame:
        area = df["area"] if "area" in df else 1.0
        rows = np.column_stack([df["frame"], df["centroid_0"], df["centroid_1"], np.broadcast_to(area, len(df))]).astype(float)
        ids = np.array(list(self.load(self.config)(rows)), np.int32).reshape(-1, 2)
        if len(ids) != len(df):
            raise ValueError(f"the tracker gave {len(ids)} rows for {len(df)} objects")
        return df.assign(trackid=ids[:, 0], parent_track_id=ids[:, 1])


#: Trackers by version. v1, v2 and legacy are one tracker.
TRACKERS = {"v1": GapTracker, "v2": GapTracker, "legacy": GapTracker, "v5": DivisionTracker}


def make_tracker(backend: str = "hungarian", version: str = "v2", overrides: dict | None = None, load: str | Callable | None = None):
    """A tracker by backend and version; ``overrides`` replace its parameters. Unknown ones raise.

    ``btrack`` is the Bayesian tracker: ``load``, a function or the ``module:name`` of one, adapts the
    library that does it (see :class:`ExternalTracker`), and ``overrides`` is its configuration.
    """
    if backend == "btrack":
        if isinstance(load, str):
            module, _, name = load.partition(":")
            load = getattr(importlib.import_module(module), name)
        if load is None:
            raise ValueError("the Bayesian tracker needs a loader of its library")
        return ExternalTracker(load, dict(overrides or {}))
    if backend != "hungarian" or version not in TRACKERS:
        raise ValueError(f"unknown tracker: {backend} {version}")
    kind = TRACKERS[version]
    known = {f.name for f in fields(kind) if not f.name.startswith("_")}
    if unknown := set(overrides or {}) - known:
        raise ValueError(f"unknown tracker parameters: {sorted(unknown)}")
    return kind(**(overrides or {}))


def track_objects(objects: DataFrame, tracker=None, key: str = "movie") -> DataFrame:
    """``objects`` with trackid and parent_track_id (-1: none), tracked movie by movie.

    Rows are taken in the order of frame and label; movies are independent, so they are the unit of
    parallel work. Negative or null frames raise. An empty table gives an empty one.
    """
    require(objects, key, "frame", "label", "centroid_0", "centroid_1")
    tracker = tracker or GapTracker()
    checked = objects.withColumn("frame", F.when(F.col("frame") >= 0, F.col("frame")).otherwise(F.raise_error(F.lit("frames must be 0 or more")).cast("int")))
    plain = checked.drop("trackid", "parent_track_id")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema) + ", trackid int, parent_track_id int"
    columns = [f.name for f in plain.schema] + ["trackid", "parent_track_id"]

    def run(df: pd.DataFrame) -> pd.DataFrame:
        done = tracker.track(df.sort_values(["frame", "label"], kind="stable").reset_index(drop=True))
        if "parent_track_id" not in done:
            done = done.assign(parent_track_id=np.int32(-1))
        return done[columns]

    return plain.groupBy(key).applyInPandas(run, schema)
