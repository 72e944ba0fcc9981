"""Merging of tile detections: non-maximum suppression, clump union, priority stitching."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Classes of the instance segmenter, and which of two overlapping objects stays. Fixed values.
CELL, CLUMP, DEBRIS = 0, 1, 2
PRIORITY = {CELL: 1, DEBRIS: 2, CLUMP: 3}


@dataclass(frozen=True)
class Settings:
    """Defaults of the instance segmenter. Fixed values."""

    tile: int = 256
    overlap: float = 0.33
    score: float = 0.4
    nms_iou: float = 0.4
    clump_overlap: int = 250
    priority_fraction: float = 0.5
    temporal_buffer: int = 8
    batch: int = 128
    mask_threshold: float = 0.5
    min_mask_area: int = 5


def box_area(b: np.ndarray) -> np.ndarray:
    return np.clip(b[:, 2] - b[:, 0], 0, None) * np.clip(b[:, 3] - b[:, 1], 0, None)


def iou(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    return _ious(one[None], many)


def _ious(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w = np.clip(np.minimum(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0]), 0, None)
    h = np.clip(np.minimum(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1]), 0, None)
    both = w * h
    whole = box_area(a) + box_area(b) - both
    return np.divide(both, whole, out=np.zeros(len(both)), where=whole > 0)


def met(one: np.ndarray, many: np.ndarray, most: float, block: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the boxes one[i] and many[j] that overlap by more than ``most`` (>= 0); all have an area.

    Such an overlap spans more than ``most`` of either's width and height. So the corner of many[j] lies within
    ``1 - most`` of one[i]'s width after its own and within ``1 / most - 1`` of it before, and only the
    grid cells of that window are looked at, ``block`` pairs at a time, so that they stay in the processor's cache.
    Cells are narrower than high, as those of a row are read in one go.
    """
    none = np.zeros(0, np.int64)
    if not len(one) or not len(many):
        return none, none
    first, last, cells = [], [], []
    width = np.zeros(2, np.int64)
    for axis in (0, 1):
        at, size, own = one[:, axis], one[:, axis + 2] - one[:, axis], many[:, axis]
        base, extent = own.min(), own.max() - own.min()
        step = max(float(np.median(many[:, axis + 2] - own)) / (8, 3)[axis], extent / 256)
        width[axis] = int(extent / step) + 1
        place = lambda c: np.clip(np.floor((c - base) / step), -1, width[axis]).astype(np.int64)  # noqa: B023, E731
        slack = 1e-9 * (size + np.abs(at))
        with np.errstate(divide="ignore"):
            low, high = place(at - (np.divide(1.0, most) - 1) * size - slack), place(at + (1 - most) * size + slack)
        first.append(np.maximum(low, 0))
        last.append(np.minimum(high, width[axis] - 1))
        cells.append(np.clip(place(own), 0, width[axis] - 1))
    cell = cells[1] * width[0] + cells[0]
    by_cell = np.argsort(cell, kind="stable")
    start = np.concatenate(([0], np.cumsum(np.bincount(cell, minlength=width[0] * width[1]))))
    strips = np.where((last[0] < first[0]), 0, np.maximum(last[1] - first[1] + 1, 0))
    lefts, rights = np.ascontiguousarray(one[:, 0]), np.ascontiguousarray(one[:, 2])
    other_lefts, other_rights = many[by_cell, 0], many[by_cell, 2]
    wide = most * (rights - lefts) * (1 - 1e-9)
    found = [(none, none)]
    for rows in _blocks(strips, block):
        i, k = _spread(rows, strips[rows])
        row = (first[1][i] + k) * width[0]
        begin, end = start[row + first[0][i]], start[row + last[0][i] + 1]
        for part in _blocks(end - begin, block):
            n, who = (end - begin)[part], i[part]
            j = np.arange(n.sum()) + np.repeat(begin[part] + n - np.cumsum(n), n)
            spans = np.minimum(np.repeat(rights[who], n), other_rights[j]) - np.maximum(np.repeat(lefts[who], n), other_lefts[j])
            near = np.flatnonzero(spans > np.repeat(wide[who], n))
            left, right = np.repeat(who, n)[near], by_cell[j[near]]
            over = _ious(one[left], many[right]) > most
            found.append((left[over], right[over]))
    left, right = (np.concatenate(x) for x in zip(*found))
    return left, right


def _blocks(counts: np.ndarray, most: int):
    """Places of ``counts`` in turn, each block with a sum of about ``most``."""
    total = np.cumsum(counts)
    cuts = np.searchsorted(total, np.arange(most, total[-1] if len(total) else 0, most)) + 1
    return (x for x in np.split(np.arange(len(counts)), cuts) if len(x))


def _spread(places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place ``counts`` times, and the numbers from 0 of its copies."""
    return np.repeat(places, counts), np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _greedy(boxes: np.ndarray, most: float) -> np.ndarray:
    """Which boxes, best first, no better kept box overlaps by more than ``most``.

    They are taken in growing runs: the kept ones strike out a run's boxes, and those left compete in order.
    """
    alive, kept, done = np.ones(len(boxes), bool), np.zeros(0, np.int64), 0
    while done < len(boxes):
        run = np.arange(done, min(len(boxes), done + max(256, done // 2)))
        alive[run[met(boxes[run], boxes[kept], most)[0]]] = False
        run = run[alive[run]]
        better, worse = met(boxes[run], boxes[run], most)
        order = np.argsort(better, kind="stable")
        order = order[better[order] < worse[order]]
        better, worse = better[order], run[worse[order]]
        firsts, begins = np.unique(better, return_index=True)
        for i, lo, hi in zip(run[firsts].tolist(), begins.tolist(), [*begins[1:].tolist(), len(better)]):
            if alive[i]:
                alive[worse[lo:hi]] = False
        kept = np.concatenate((kept, run[alive[run]]))
        done = min(len(boxes), done + max(256, done // 2))
    return alive


def nms(boxes: np.ndarray, scores: np.ndarray, most: float, areas: np.ndarray | None = None, classes: np.ndarray | None = None) -> list[int]:
    """Boxes kept, best first: none overlaps a better one by more than ``most``.

    Equal scores go to the larger area (a tiebreak of 1e-7 at most). With ``classes`` only boxes of
    one class compete. Boxes without an area, or without a finite one, overlap none.
    """
    if not len(boxes):
        return []
    boxes = np.asarray(boxes, float)
    areas = box_area(boxes) if areas is None else np.asarray(areas, float)
    rank = np.asarray(scores, float) + 1e-7 * areas / max(areas.max(), 1e-12)
    order = np.argsort(-rank, kind="stable")
    codes = np.zeros(len(boxes), np.int64) if classes is None else pd.factorize(np.asarray(classes))[0]
    kept = np.ones(len(boxes), bool)  # by rank
    able = (codes >= 0) if most < 0 else (codes >= 0) & np.isfinite(boxes).all(axis=1) & (boxes[:, 2] > boxes[:, 0]) & (boxes[:, 3] > boxes[:, 1])
    for code in np.unique(codes[able]):
        own = np.flatnonzero((able & (codes == code))[order])
        kept[own] = np.arange(len(own)) == 0 if most < 0 else _greedy(boxes[order[own]], most)
    return order[kept].tolist()


def merge_clumps(boxes: np.ndarray, scores: np.ndarray, masks: list[np.ndarray], offsets: np.ndarray, least: int) -> list[tuple[np.ndarray, float, np.ndarray]]:
    """Clumps of tiles that overlap by ``least`` pixels become one: (box, mean score, mask in its box).

    ``masks`` are boolean crops at ``offsets`` (y, x). Best scores come first.
    """
    n = len(boxes)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    at = np.asarray(offsets, int).reshape(-1, 2)
    ends = at + np.array([m.shape for m in masks], int).reshape(-1, 2)
    order = np.argsort(at[:, 0], kind="stable")  # from the top: a mask meets those that begin above its end
    for k, i in enumerate(order):
        later = order[k + 1 : np.searchsorted(at[order, 0], ends[i, 0])]
        size = np.minimum(ends[i], ends[later]) - np.maximum(at[i], at[later])
        for j, (h, w) in zip(later, size):
            if h <= 0 or w <= 0 or h * w < least:
                continue
            (y0, x0), (y1, x1) = np.maximum(at[i], at[j]), np.minimum(ends[i], ends[j])
            a, b = (masks[m][y0 - at[m][0] : y1 - at[m][0], x0 - at[m][1] : x1 - at[m][1]] for m in (i, j))
            if (a & b).sum() >= least:
                r, s = root(int(i)), root(int(j))
                parent[max(r, s)] = min(r, s)
    groups: dict[int, list[int]] = {}
    for i in range(n):
        groups.setdefault(root(i), []).append(i)
    out = []
    for members in groups.values():
        y0, x0 = (min(int(offsets[i][k]) for i in members) for k in (0, 1))
        y1, x1 = (max(int(offsets[i][k]) + masks[i].shape[k] for i in members) for k in (0, 1))
        mask = np.zeros((y1 - y0, x1 - x0), bool)
        for i in members:
            y, x = int(offsets[i][0]) - y0, int(offsets[i][1]) - x0
            mask[y : y + masks[i].shape[0], x : x + masks[i].shape[1]] |= masks[i]
        b = boxes[members]
        box = np.array([math.floor(b[:, 0].min()), math.floor(b[:, 1].min()), math.ceil(b[:, 2].max()), math.ceil(b[:, 3].max())], float)
        out.append((box, float(np.mean(scores[members])), mask, (y0, x0)))
    return sorted(out, key=lambda g: -g[1])


def stitch_masks(shape: tuple[int, int], masks: list[np.ndarray], offsets: list[tuple[int, int]], classes: list[int], fraction: float = 0.5) -> tuple[np.ndarray, list[int]]:
    """Paint masks by rising class priority; (labels from 1, the mask each label came from).

    Where a mask meets a label of lower priority and covers ``fraction`` of it, that label goes
    altogether; otherwise the label keeps its pixels.
    """
    canvas = np.zeros(shape, np.int32)
    area: dict[int, int] = {}
    source: dict[int, int] = {}
    order = sorted(range(len(masks)), key=lambda i: PRIORITY.get(classes[i], 0))
    for number, i in enumerate(order, 1):
        y, x = offsets[i]
        y0, x0 = max(0, y), max(0, x)
        y1, x1 = min(shape[0], y + masks[i].shape[0]), min(shape[1], x + masks[i].shape[1])
        if y1 <= y0 or x1 <= x0:
            continue
        own = masks[i][y0 - y : y1 - y, x0 - x : x1 - x]
        view = canvas[y0:y1, x0:x1]
        met = np.bincount(view[own]) if own.any() else np.zeros(1, int)
        for other in np.flatnonzero(met[1:]) + 1:
            if PRIORITY.get(classes[i], 0) > PRIORITY.get(classes[source[other]], 0) and met[other] / area[other] >= fraction:
                canvas[canvas == other] = 0
                del area[other], source[other]
        take = own & (view == 0)
        if take.any():
            view[take] = number
            area[number], source[number] = int(take.sum()), i
    alive = sorted(source)
    lookup = np.zeros(len(order) + 1, np.int32)
    lookup[alive] = np.arange(1, len(alive) + 1)
    return lookup[canvas], [source[a] for a in alive]


def mask_boxes(labels: np.ndarray, least: int = 5) -> list[tuple[int, int, int, int, int, int]]:
    """(label, x0, y0, x1, y1, area) of each label of at least ``least`` pixels; ends exclusive."""
    out = []
    for n in np.unique(labels):
        if n:
            y, x = np.nonzero(labels == n)
            if len(y) >= least:
                out.append((int(n), int(x.min()), int(y.min()), int(x.max()) + 1, int(y.max()) + 1, len(y)))
    return out


def merge_frame(shape: tuple[int, int], boxes: np.ndarray, scores: np.ndarray, classes: np.ndarray, masks: list[np.ndarray], offsets: list[tuple[int, int]], settings: Settings = Settings()) -> tuple[np.ndarray, pd.DataFrame]:
    """All detections of a frame's tiles -> (labels, one row per object)."""
    boxes = np.asarray(boxes, float).reshape(-1, 4)
    clump = np.flatnonzero(classes == CLUMP)
    merged = merge_clumps(boxes[clump], scores[clump], [masks[i] for i in clump], np.array([offsets[i] for i in clump]).reshape(-1, 2), settings.clump_overlap) if len(clump) else []
    rest = np.flatnonzero(classes != CLUMP)
    areas = np.array([masks[i].sum() or box_area(boxes[[i]])[0] for i in rest], float)
    kept = [int(rest[k]) for k in nms(boxes[rest], scores[rest], settings.nms_iou, areas)]
    all_masks = [m for _, _, m, _ in merged] + [masks[i] for i in kept]
    all_at = [at for *_, at in merged] + [tuple(map(int, offsets[i])) for i in kept]
    all_classes = [CLUMP] * len(merged) + [int(classes[i]) for i in kept]
    all_scores = [s for _, s, *_ in merged] + [float(scores[i]) for i in kept]
    labels, source = stitch_masks(shape, all_masks, all_at, all_classes, settings.priority_fraction)
    found = mask_boxes(labels, settings.min_mask_area)
    lookup = np.zeros(len(source) + 1, np.int32)
    rows = []
    for k, (n, x0, y0, x1, y1, area) in enumerate(found, 1):
        lookup[n] = k
        rows.append((k, all_classes[source[n - 1]], all_scores[source[n - 1]], x0, y0, x1, y1, area))
    return lookup[labels], pd.DataFrame(rows, columns=["label", "class_id", "score", "x1", "y1", "x2", "y2", "area"])


def suppress(detections: DataFrame, most: float = 0.4, keys: tuple[str, ...] = ("movie", "frame"), per_class: bool = False) -> DataFrame:
    """Non-maximum suppression of each frame's boxes; all columns of the kept ones.

    A task has one frame at a time. Frames come together by one long, a hash of their keys, as Spark sorts
    whole numbers in linear time; frames of one hash are told apart by their keys. Partitions are as many as
    the session says: merged by their bytes they would be too few and uneven for the work on them.
    """
    names = detections.columns
    columns = [c for c in names if c not in keys]
    plain = all(t in ("double", "float", "int", "bigint", "smallint", "tinyint") for c, t in detections.dtypes if c in columns)
    mark = "_sr_frame"

    def kept(frame: pa.Table) -> pa.Table:
        if plain:
            df = {c: frame.column(c).to_numpy() for c in columns}
            order = np.lexsort([df[c] for c in columns[::-1]])
        else:
            df = frame.select(columns).to_pandas()
            order = df.sort_values(columns, kind="stable").index.to_numpy()
        own = {c: np.asarray(df[c])[order] for c in ("x1", "y1", "x2", "y2", "score", *["class_id"] * per_class)}
        boxes = np.stack([own[c].astype(float) for c in ("x1", "y1", "x2", "y2")], axis=1)
        return frame.take(np.sort(order[nms(boxes, own["score"].astype(float), most, None, own.get("class_id"))]))

    def frames(held: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(held).combine_chunks()
        code = np.zeros(len(rows), np.int64)
        for c in keys:
            own = rows.column(c).combine_chunks()
            own = (pc.add(own, 0.0) if pa.types.is_floating(own.type) else own).dictionary_encode("encode")
            if len(own.dictionary) > 1:
                code = np.unique(code * len(own.dictionary) + own.indices.to_numpy(), return_inverse=True)[1]
        rows = rows.select(names)
        for k in range(int(code.max()) + 1):
            yield from kept(rows.take(np.flatnonzero(code == k)) if code.any() else rows).to_batches()

    def run(batches):
        held, now = [], None
        for batch in batches:
            marks = batch.column(mark).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for a, z in zip(cuts, cuts[1:]):
                if a < z and marks[a] != now:
                    if held:
                        yield from frames(held)
                    held, now = [], marks[a]
                held.append(batch.slice(a, z - a))
        if held:
            yield from frames(held)

    parts = [F.col(f"`{c}`") for c in keys]
    marked = detections.withColumn(mark, F.xxhash64(*(F.when(p == 0, F.lit(0.0)).otherwise(p) if t in ("double", "float") else p for p, t in zip(parts, (dict(detections.dtypes)[c] for c in keys)))))
    count = int(detections.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return marked.repartition(count, mark).sortWithinPartitions(mark).mapInArrow(run, detections.schema)


_OBJECT = "struct<label:int,class_id:int,score:double,x1:int,y1:int,x2:int,y2:int,area:int>"


def merge_frames(tiles: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per frame: its label plane (int32) and ``objects``, merged from its tile detections.

    ``tiles``: movie, frame, height, width, class_id, score, x1, y1, x2, y2 (in the image), off_y,
    off_x, mask_h, mask_w, mask (float32 bytes). One group is one frame.
    """
    out = f"movie string, frame int, slice int, channel int, height int, width int, dtype string, pixels binary, objects array<{_OBJECT}>"

    def run(df: pd.DataFrame) -> pd.DataFrame:
        shape = (int(df["height"].iloc[0]), int(df["width"].iloc[0]))
        key = (df["movie"].iloc[0], df["frame"].iloc[0])
        df = df[df["score"] >= settings.score].sort_values(["off_y", "off_x", "score", "x1", "y1"], kind="stable").reset_index(drop=True)
        labels, rows = np.zeros(shape, np.int32), []
        if len(df):
            masks = [np.frombuffer(m, np.float32).reshape(h, w) > settings.mask_threshold for m, h, w in zip(df["mask"], df["mask_h"], df["mask_w"])]
            labels, found = merge_frame(shape, df[["x1", "y1", "x2", "y2"]].to_numpy(), df["score"].to_numpy(), df["class_id"].to_numpy(), masks, list(zip(df["off_y"], df["off_x"])), settings)
            rows = found.to_dict("records")
        return pd.DataFrame([(*key, 0, 0, *shape, "int32", labels.astype(np.int32).tobytes(), rows)], columns=["movie", "frame", "slice", "channel", "height", "width", "dtype", "pixels", "objects"])

    return tiles.groupBy("movie", "frame").applyInPandas(run, out)


def merge_detections(tiles: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The objects of :func:`merge_frames`, one row each."""
    return merge_frames(tiles, settings).selectExpr("movie", "frame", "inline(objects)")
