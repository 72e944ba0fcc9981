"""Predictors: the plug-in protocol, stand-ins without weights, and tabular state classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.planes import map_planes
from ..operators.relational import NEG, POS

#: Kinds of models that a pipeline can ask for. Fixed values.
KINDS = ("bf_focus", "fl_focus", "segmentation", "cell_classifier", "pi_classification", "sc_segmenter", "oof_detector")


class PlanePredictor(Protocol):
    """Maps one plane to one plane: focus restoration, probability maps."""

    def predict(self, img: np.ndarray) -> np.ndarray: ...


class Detector(Protocol):
    """Maps a tile to detections: rows of (class_id, score, x1, y1, x2, y2, mask), in the tile."""

    def detect(self, tile: np.ndarray) -> list[tuple[int, float, float, float, float, float, np.ndarray]]: ...


class Identity:
    """A plane predictor without weights."""

    def predict(self, img: np.ndarray) -> np.ndarray:
        return img


def predict_planes(planes: DataFrame, load: Callable[[], PlanePredictor], window: int | None = None, overlap: float = 0.25, normalise: bool = False) -> DataFrame:
    """Each plane under a model that every task loads and checks once.

    With a ``window``, larger planes go through it in overlapping windows. With ``normalise`` the model
    sees planes from 0 to 1, and what it returns is scaled back.
    """
    held: list[PlanePredictor] = []

    def f(img: np.ndarray) -> np.ndarray:
        if not held:
            held.append(checked(load()))
        img = np.asarray(img, np.float32)
        low, span = (float(img.min()), float(np.ptp(img)) or 1.0) if normalise else (0.0, 1.0)
        unit = (img - low) / span
        out = predict_windows(unit, held[0].predict, window, overlap) if window and max(img.shape) > window else held[0].predict(unit)
        return np.asarray(out) * span + low

    return map_planes(planes, f, "float32")


def blend_weights(window: int) -> np.ndarray:
    """Gaussian weights of a window, highest in its middle."""
    at = (np.arange(window) - (window - 1) / 2) / (window / 4)
    line = np.exp(-0.5 * at * at)
    return np.maximum(np.outer(line, line), 1e-6)


def predict_windows(img: np.ndarray, predict: Callable[[np.ndarray], np.ndarray], window: int = 256, overlap: float = 0.25) -> np.ndarray:
    """A plane larger than a model's window: overlapping windows of the mirrored plane, blended by weight."""
    step = max(1, int(window * (1 - overlap)))
    sides = [(max(0, window - n) if n <= window else -(n - window) % step) for n in img.shape]
    wide = img
    for axis, more in enumerate(sides):  # a border wider than the plane is mirrored more than once
        while more:
            part = min(more, max(1, wide.shape[axis] - 1))
            wide = np.pad(wide, [(0, part if a == axis else 0) for a in (0, 1)], mode="reflect" if wide.shape[axis] > 1 else "edge")
            more -= part
    weights, total, sum_ = blend_weights(window), np.zeros(wide.shape), np.zeros(wide.shape)
    for y in range(0, wide.shape[0] - window + 1, step):
        for x in range(0, wide.shape[1] - window + 1, step):
            at = np.s_[y : y + window, x : x + window]
            sum_[at] += predict(wide[at]) * weights
            total[at] += weights
    return (sum_ / total)[: img.shape[0], : img.shape[1]].astype(np.float32)


def checked(model: PlanePredictor, size: int = 32) -> PlanePredictor:
    """``model``, if it maps a small plane to a finite one of the same size; else ValueError."""
    img = np.linspace(0, 1, size * size, dtype=np.float32).reshape(size, size)
    try:
        out = np.asarray(model.predict(img))
    except Exception as e:
        raise ValueError(f"the model fails on a {size}x{size} plane: {e}") from e
    if out.shape != img.shape or not np.isfinite(out).all():
        raise ValueError(f"the model maps {img.shape} to {out.shape}, or to values that are not finite")
    return model


def to_rgb(img: np.ndarray, low: float = 1.0, high: float = 99.0) -> np.ndarray:
    """A grey plane between two percentiles as three equal channels from 0 to 1 (height, width, 3)."""
    lo, hi = np.percentile(img, (low, high))
    unit = np.clip((img - lo) / max(hi - lo, 1e-12), 0, 1).astype(np.float32)
    return np.repeat(unit[:, :, None], 3, axis=2)


def detect_tiles(tiles: DataFrame, load: Callable[[], Detector], tile: int, batch: int = 128, buffer: int = 8) -> DataFrame:
    """Detections of each tile, boxes moved to the image and held within the tile's valid part.

    A model with ``detect_many`` gets up to ``batch`` tiles at a time, of ``buffer`` frames at most.
    """
    out = "movie string, frame int, height int, width int, class_id int, score double, x1 double, y1 double, x2 double, y2 double, off_y int, off_x int, mask_h int, mask_w int, mask binary"
    names = [x.split()[0] for x in out.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for df in batches:
            rows = []
            images = [np.frombuffer(p, np.float32).reshape(tile, tile) for p in df["pixels"]]
            if hasattr(model, "detect_many"):
                frame = (df[["movie", "frame"]] != df[["movie", "frame"]].shift()).any(axis=1).cumsum().to_numpy() - 1
                part = frame // buffer
                found = [d for own in np.split(np.arange(len(df)), np.flatnonzero(np.diff(part)) + 1) for k in range(0, len(own), batch) for d in model.detect_many([images[i] for i in own[k : k + batch]])]
            else:
                found = map(model.detect, images)
            for r, detections in zip(df.itertuples(), found):
                for class_id, score, x1, y1, x2, y2, mask in detections:
                    x2, y2 = min(x2, r.valid_w), min(y2, r.valid_h)
                    mask = np.ascontiguousarray(mask[: r.valid_h, : r.valid_w], np.float32)
                    rows.append((r.movie, r.frame, r.height, r.width, class_id, score, r.off_x + x1, r.off_y + y1, r.off_x + x2, r.off_y + y2, r.off_y, r.off_x, *mask.shape, mask.tobytes()))
            yield pd.DataFrame(rows, columns=names)

    return tiles.mapInPandas(run, out)


def classify_crops(crops: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]], size: int) -> DataFrame:
    """``class_id`` and ``score`` of each object: the largest softmax output of a model over crops."""

    def run(batches):
        model = load()
        for df in batches:
            if df.empty:
                continue
            x = np.stack([np.frombuffer(p, np.float32).reshape(size, size) for p in df["pixels"]])
            z = np.asarray(model(x), float)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            yield df[["movie", "frame", "label"]].assign(class_id=p.argmax(axis=1).astype(np.int32), score=p.max(axis=1))

    return crops.mapInPandas(run, "movie string, frame int, label int, class_id int, score double")


def state_by_threshold(objects: DataFrame, column: str, bar: float) -> DataFrame:
    """``pi_class`` from one measurement: piPOS above the bar; null stays null."""
    return objects.withColumn("pi_class", F.when(F.col(column) > bar, POS).when(F.col(column).isNotNull(), NEG))


def state_by_model(objects: DataFrame, load: Callable[[], Callable[[np.ndarray], Sequence]], features: Sequence[str]) -> DataFrame:
    """``pi_class`` by a tabular model, loaded once in each task; outputs 0 and 1 are named."""

    @F.pandas_udf("string")
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = load()
        for cols in batches:
            y = pd.Series(list(model(np.column_stack([c.to_numpy(float) for c in cols]))))
            yield y.map(lambda v: POS if v in (1, "1", POS) else NEG)

    return objects.withColumn("pi_class", predict(*features))


def onnx_classifier(path: str) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """Loader of an ONNX classifier with one matrix input and labels as its first output."""

    def load():
        import onnxruntime

        session = onnxruntime.InferenceSession(path, providers=["CPUExecutionProvider"])
        name = session.get_inputs()[0].name
        return lambda x: session.run(None, {name: x.astype(np.float32)})[0]

    return load


def clusters(objects: DataFrame, features: Sequence[str], k: int = 3, seed: int = 1) -> DataFrame:
    """``cluster`` of each object by k-means over its standardised features."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    rows = VectorAssembler(inputCols=list(features), outputCol="sr_raw", handleInvalid="skip").transform(objects)
    rows = StandardScaler(inputCol="sr_raw", outputCol="sr_x", withMean=True).fit(rows).transform(rows)
    model = KMeans(k=k, seed=seed, featuresCol="sr_x", predictionCol="cluster").fit(rows)
    return model.transform(rows).drop("sr_raw", "sr_x")


def dense_clusters(objects: DataFrame, features: Sequence[str], eps: float, least: int, key: str = "movie") -> DataFrame:
    """``cluster`` by density within each movie (-1: noise); numbered by first member."""
    schema = objects.schema.add("cluster", "int")

    def run(df: pd.DataFrame) -> pd.DataFrame:
        x = df[list(features)].to_numpy(float)
        near = [np.flatnonzero(((x - p) ** 2).sum(axis=1) <= eps * eps) for p in x]
        out, n = np.full(len(x), -1, np.int32), 0
        for i in range(len(x)):
            if out[i] >= 0 or len(near[i]) < least:
                continue
            todo = [i]
            out[i] = n
            while todo:
                j = todo.pop()
                if len(near[j]) >= least:
                    for m in near[j]:
                        if out[m] < 0:
                            out[m] = n
                            todo.append(m)
            n += 1
        return df.assign(cluster=out)

    return objects.groupBy(key).applyInPandas(run, schema)
