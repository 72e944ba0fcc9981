"""Composite pipelines over all movies at once: planes -> objects -> tracks -> summary.

A pipeline is a chain of lazy stages. The loop over image files of a batch tool is the ``movie``
column here; a file that can't be read is a row with ``error`` and ends nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import class_name
from ..operators import crop, detect, planes, relational, tracks
from . import models


@dataclass
class Settings:
    """What a run needs beside its planes. Models are loaders; those left out are stand-ins."""

    reference_channel: int = 0
    state_channel: int | None = 1
    gfp_channel: int | None = None
    pixel_size: float = 1.0
    background: str = "blur"  # or "flat_field" or "low_rank" for the fluorescent channels
    threshold: float = 0.5
    least_pixels: int = 20
    align: bool = True
    tracker: object | None = field(default_factory=tracks.GapTracker)
    lock_in: bool = True
    classes: dict[int, str] = field(default_factory=lambda: {0: "single-cell", 1: "clump", 2: "debris"})
    focus: Callable | None = None
    segment: Callable | None = None
    detector: Callable | None = None
    second_detector: Callable | None = None
    classify: Callable | None = None
    state: Callable[[DataFrame], DataFrame] | None = None
    template: np.ndarray | None = None
    calibration: crop.Calibration = field(default_factory=crop.Calibration)
    shape: tuple[int, int] | None = None
    tile: int = 256
    times: DataFrame | None = None  # movie, frame, date_time, timestep, abslag_in_s
    extra: dict[str, Callable[[np.ndarray, np.ndarray], float]] = field(default_factory=dict)  # measures of one's own
    window: int | None = None  # of the plane models; larger planes go through it in overlapping windows


@dataclass
class Result:
    objects: DataFrame
    summary: DataFrame | None = None
    labels: DataFrame | None = None
    planes: DataFrame | None = None


def preprocess(stack: DataFrame, s: Settings, time_lapse: bool = True) -> DataFrame:
    """Align, fix dark borders, clear background and restore focus of the reference channel."""
    if time_lapse and s.align:
        stack = planes.align(stack, planes.align_shifts(stack, s.reference_channel))
    reference = stack.where(F.col("channel") == s.reference_channel)
    others = stack.where(F.col("channel") != s.reference_channel)
    reference = planes.clear_background(planes.fix_well(reference), 20.0, "um", "divide", s.pixel_size)
    if s.background == "low_rank":
        others = planes.flat_field(others, 0.1, "low_rank")
    else:
        others = planes.flat_field(others) if s.background == "flat_field" else planes.clear_background(others, 20.0, "um", "subtract", s.pixel_size)
    if s.focus:
        reference = models.predict_planes(reference, s.focus, s.window)
    return reference.unionByName(others)


def finish(rows: DataFrame, s: Settings, time_lapse: bool = True) -> Result:
    """Times, relative intensities, tracks, states, lock-in and the summary."""
    if s.times is not None and time_lapse:
        rows = relational.join_per_frame(rows, s.times)
    rows = relational.relative_intensity(rows)
    tracked = time_lapse and s.tracker is not None
    if tracked:
        rows = tracks.track_objects(rows, s.tracker)
    rows = rows.withColumn("file", F.col("movie"))
    summary = None
    if s.state:
        rows = s.state(rows)
        if tracked and s.lock_in:
            rows = relational.lock_in(rows)
        keys = [k for k in relational.SUMMARY_KEYS if k in rows.columns]
        summary = relational.pi_summary(rows, keys)
    return Result(relational.lead_columns(rows), summary)


def _connected(stack: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Labels by threshold and components, classes by a model over crops; joined by key."""
    reference = stack.where(F.col("channel") == s.reference_channel)
    proba = models.predict_planes(reference, s.segment, s.window) if s.segment else planes.scale(reference)
    labels = planes.label_planes(proba, s.threshold, s.least_pixels)
    rows = planes.measure_planes(stack, labels, s.reference_channel if s.state_channel is None else s.state_channel, extra=s.extra)
    if s.classify:
        found = models.classify_crops(planes.roi_crops(reference, labels, 64), s.classify, 64)
        found = found.select("movie", "frame", "label", class_name(F.col("class_id"), s.classes).alias("object_class"), F.col("score").alias("detection_score"))
        rows = relational.join_classes(rows, found)
    else:
        rows = rows.withColumns({"object_class": F.lit("unknown"), "detection_score": F.lit(0.0)})
    return labels, rows


def _segmented(stack: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Objects of the instance segmenter, measured under its label planes."""
    reference = stack.where(F.col("channel") == s.reference_channel)
    merged = detect.merge_frames(models.detect_tiles(planes.tiles(reference, s.tile), s.detector, s.tile))
    labels, found = merged.drop("objects"), merged.selectExpr("movie", "frame", "inline(objects)")
    rows = planes.measure_planes(stack, labels, s.reference_channel if s.state_channel is None else s.state_channel, extra=s.extra)
    classes = found.select("movie", "frame", "label", class_name(F.col("class_id"), s.classes).alias("object_class"), F.col("score").alias("detection_score"))
    return labels, relational.join_classes(rows, classes)


def _run(stack: DataFrame, s: Settings, time_lapse: bool = True) -> Result:
    stack = preprocess(stack, s, time_lapse)
    labels, rows = (_segmented if s.detector else _connected)(stack, s)
    if s.gfp_channel is not None:
        rows = relational.join_second_channel(rows, planes.measure_planes(stack, labels, s.gfp_channel))
    out = finish(rows, s, time_lapse)
    out.labels, out.planes = labels, stack
    return out


def focus_restoration(stack: DataFrame, s: Settings) -> Result:
    """Connected components with crop classification; no lock-in."""
    s.lock_in = False
    return _run(stack, s)


def segmenter(stack: DataFrame, s: Settings) -> Result:
    """Instance segmentation, keyed class join, lock-in."""
    return _run(stack, s)


def chambers(stack: DataFrame, s: Settings) -> Result:
    """As :func:`segmenter`, on planes cropped to the target line."""
    if s.template is None or s.shape is None:
        raise ValueError("a template and the planes' shape are needed")
    cropped = crop.crop_to_target_line(stack, s.template, *s.shape, s.reference_channel, s.calibration)
    return _run(cropped, s)


def three_channels(stack: DataFrame, s: Settings) -> Result:
    """As :func:`segmenter` or with connected components, with a third channel measured."""
    if s.gfp_channel is None:
        s.gfp_channel = 2
    s.lock_in = False
    return _run(stack, s)


def single_frame(stack: DataFrame, s: Settings) -> Result:
    """One frame of each movie: no alignment, times or tracks."""
    return _run(stack.where(F.col("frame") == 0), s, time_lapse=False)


def out_of_focus(stack: DataFrame, s: Settings) -> Result:
    """Points of two detectors on the first frame, with their source."""
    one = stack.where((F.col("frame") == 0) & (F.col("channel") == s.reference_channel))
    parts = []
    for load, source, prefix in ((s.detector, "standard", "class_"), (s.second_detector, "oof", "oof_")):
        if load:
            boxes = models.detect_tiles(planes.tiles(one, s.tile, fill=0.0 if source == "oof" else None), load, s.tile)
            kept = detect.suppress(boxes.select("movie", "frame", "class_id", "score", "x1", "y1", "x2", "y2"), per_class=source == "oof")
            parts.append(relational.box_centres(kept, s.classes if source == "standard" else None, source, 0.5, prefix))
    if not parts:
        raise ValueError("a detector is needed")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return Result(out)


#: Pipelines by name, and the models that each takes. Fixed values.
PIPELINES: dict[str, tuple[Callable[[DataFrame, Settings], Result], tuple[str, ...]]] = {
    "focus_restoration": (focus_restoration, ("bf_focus", "fl_focus", "segmentation", "cell_classifier", "pi_classification")),
    "segmenter": (segmenter, ("bf_focus", "fl_focus", "sc_segmenter", "pi_classification")),
    "chambers": (chambers, ("bf_focus", "fl_focus", "sc_segmenter", "pi_classification")),
    "three_channels": (three_channels, ("bf_focus", "fl_focus", "sc_segmenter", "segmentation", "cell_classifier", "pi_classification")),
    "single_frame": (single_frame, ("segmentation", "cell_classifier", "pi_classification")),
    "out_of_focus": (out_of_focus, ("sc_segmenter", "oof_detector")),
}


def run_report(result: Result) -> DataFrame:
    """(movie, frames, objects, tracks): what a run found in each movie, for its log."""
    rows = result.objects
    found = [F.countDistinct("frame").alias("frames"), F.count(F.lit(1)).alias("objects")]
    tracks_ = F.countDistinct(F.when(F.col("trackid") >= 0, F.col("trackid"))) if "trackid" in rows.columns else F.lit(0).cast("long")
    return rows.groupBy("movie").agg(*found, tracks_.alias("tracks"))


def get_pipeline(name: str) -> tuple[Callable[[DataFrame, Settings], Result], tuple[str, ...]]:
    """A pipeline by name in any case; unknown names raise with the known ones."""
    for known, value in PIPELINES.items():
        if known.lower() == name.lower():
            return value
    raise ValueError(f"unknown pipeline {name!r}; known: {', '.join(sorted(PIPELINES))}")


def list_pipelines() -> list[str]:
    return sorted(PIPELINES)
