"""Scalar functions: names, units, times, angles, boxes and calibrations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Image file endings, longest first. Fixed values.
EXTENSIONS = ("nd2", "ome.p.tiff", "p.tiff", "ome.tiff", "tiff")
#: Bits of each pixel type. Fixed values.
BIT_DEPTH = {"int8": 8, "uint8": 8, "int16": 16, "uint16": 16, "int32": 32, "uint32": 32, "float32": 32, "int64": 64, "uint64": 64, "float64": 64}


def strip_extension(name: Column) -> Column:
    """A file name without its image ending; other endings stay."""
    return F.regexp_replace(name, r"\.(" + "|".join(e.replace(".", r"\.") for e in EXTENSIONS) + ")$", "")


def convert_unit(value: Column, factor: float | Column, to: str) -> Column:
    """Pixels to micrometres (``um``) or back (``pixel``), ``factor`` micrometres to the pixel."""
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    if to == "um":
        return value * factor
    if to == "pixel":
        return value / factor
    raise ValueError(f"unknown unit: {to}")


def round_to_odd(value: Column) -> Column:
    """The whole part of an odd number, else one more: 4.0 and 4.9 give 5, 3.0 gives 3, 3.5 gives 4."""
    whole = value.cast("long")
    return F.when(F.pmod(value, F.lit(2)) == 1, whole).otherwise(whole + 1)


def bit_depth(dtype: str) -> int:
    """Bits of a pixel type; KeyError for types that hold no pixels."""
    return BIT_DEPTH[dtype]


def absolute_time(start: Column, lag_ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a start time and a lag in milliseconds."""
    return F.date_format(F.timestamp_micros(F.unix_micros(start.cast("timestamp")) + (lag_ms * 1000).cast("long")), "yyyy-MM-dd HH:mm:ss")


def coords_json(coords: Column) -> Column:
    """Sorted points (y, x) as JSON pairs."""
    return F.to_json(F.transform(F.array_sort(coords), lambda p: F.array(p["y"], p["x"])))


def coords_centroid(coords: Column) -> Column:
    """Mean (y, x) of an array of points; null when empty."""
    n = F.size(coords)
    mean = lambda f: F.aggregate(coords, F.lit(0.0), lambda a, p: a + p[f]) / n
    return F.when(n > 0, F.struct(mean("y").alias("y"), mean("x").alias("x")))


def relative_difference(a: Column, b: Column, floor: float) -> Column:
    """``abs(a - b)`` over the smaller of both, which counts as ``floor`` at least."""
    return F.abs(a - b) / F.greatest(F.least(a, b), F.lit(floor))


def clamp_tilt(angle: Column, most: float) -> Column:
    """(angle within ±most, whether it was clamped)."""
    held = F.greatest(F.lit(-most), F.least(F.lit(most), angle))
    return F.struct(held.alias("angle"), (held != angle).alias("clamped"))


def y_band(centre: Column, top: Column | float, bottom: Column | float, height: Column | int) -> Column:
    """(y0, y1) of a band around ``centre``, rounded half to even and held within the image."""
    c = lambda v: v if isinstance(v, Column) else F.lit(v)
    y0 = F.greatest(F.lit(0), F.rint(centre + c(top)).cast("int"))
    y1 = F.least(c(height).cast("int"), F.rint(centre + c(bottom)).cast("int"))
    return F.struct(y0.alias("y0"), y1.alias("y1"))


def one_hot(value: Column, n: int) -> Column:
    """Array of n zeros with a one at ``value``."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == value).cast("int"))


def class_name(class_id: Column, names: Mapping[int, str] | None, prefix: str = "class_") -> Column:
    """Name of a class id; without one, ``prefix`` and the id."""
    default = F.concat(F.lit(prefix), class_id.cast("string"))
    if not names:
        return default
    known = F.create_map(*(F.lit(x) for k, v in names.items() for x in (int(k), v)))
    return F.coalesce(F.try_element_at(known, class_id), default)


def bound_key(groups: Mapping[str, Sequence], value: Column) -> Column:
    """The first key whose list has ``value``; null if none has."""
    out = F.lit(None).cast("string")
    for key, values in reversed(list(groups.items())):
        out = F.when(value.isin(*values), F.lit(key)).otherwise(out)
    return out
