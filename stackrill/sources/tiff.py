"""TIFF stacks of grey pages, read to planes and written from them.

Strips and tiles, plain and big files, uncompressed, deflate and LZW, with or without differences. Other
containers are left to decoders.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import strip_extension
from ..schema import PLANE

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
_KINDS = {1: "u", 2: "i", 3: "f"}
#: Micrometres to a pixel where a file does not say. Fixed value; the out-of-focus pipeline takes 0.65.
PIXEL_SIZE, FOCUS_PIXEL_SIZE = 1.0, 0.65
#: Decoders of other containers by ending: bytes -> (planes with their (frame, slice, channel), pixel size).
DECODERS: dict[str, Callable[[bytes], tuple[list[tuple[tuple[int, int, int], np.ndarray]], float]]] = {}


def lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes from the highest bit on, 9 to 12 bits wide, growing one code early."""
    out, table, bits, n, width, last = bytearray(), [], 0, 0, 9, b""
    for byte in data:
        bits, n = bits << 8 | byte, n + 8
        if n < width:
            continue
        n -= width
        code = bits >> n
        bits &= (1 << n) - 1
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        if code == 257:
            break
        if code < len(table):
            entry = table[code]
        elif last and code == len(table):
            entry = last + last[:1]
        else:
            raise ValueError("broken LZW data")
        out += entry
        if last:
            table.append(last + entry[:1])
        last = entry
        width = 12 if len(table) >= 2047 else 11 if len(table) >= 1023 else 10 if len(table) >= 511 else 9
    return bytes(out)


def _unpacked(raw: bytes, compression: int) -> bytes:
    if compression == 1:
        return raw
    if compression in (8, 32946):
        return zlib.decompress(raw)
    if compression == 5:
        return lzw(raw)
    raise ValueError(f"compression {compression} is not read")


def _directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    """(byte order, tags) of each page, of plain and of big files."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    version = struct.unpack(order + "H", data[2:4])[0] if order and len(data) >= 8 else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    count_, offset, entry, inline = ("Q", "Q", 20, 8) if big else ("H", "I", 12, 4)
    head = struct.calcsize("<" + count_)
    at, seen = struct.unpack_from(order + offset, data, 8 if big else 4)[0], set()
    while at:
        if at in seen:
            raise ValueError("the pages go in a circle")
        seen.add(at)
        n, tags = struct.unpack_from(order + count_, data, at)[0], {}
        for i in range(n):
            where = at + head + entry * i
            tag, kind, count = struct.unpack_from(order + "HH" + offset, data, where)
            width, place = _SIZES.get(kind, 1) * count, where + entry - inline
            if width > inline:
                place = struct.unpack_from(order + offset, data, place)[0]
            if kind == 5:
                tags[tag] = struct.unpack_from(f"{order}{2 * count}I", data, place)
            elif kind in _CODES:
                tags[tag] = struct.unpack_from(f"{order}{count}{_CODES[kind]}", data, place)
            else:
                tags[tag] = (data[place : place + width],)
        yield order, tags
        at = struct.unpack_from(order + offset, data, at + head + entry * n)[0]


def _image(data: bytes, order: str, tags: dict[int, tuple]) -> np.ndarray:
    """One grey page, of strips or of tiles."""
    one = lambda tag, default: tags.get(tag, (default,))[0]
    if one(277, 1) != 1:
        raise ValueError("only grey pages are read")
    height, width, bits = tags[257][0], tags[256][0], one(258, 1)
    kind = np.dtype(f"{order}{_KINDS[one(339, 1)]}{bits // 8}")
    tiled = 324 in tags
    h, w = (tags[323][0], tags[322][0]) if tiled else (min(height, one(278, height)), width)
    across = -(-width // w)
    out = np.zeros((height, width), kind.newbyteorder("="))
    for k, (place, size) in enumerate(zip(*((tags[324], tags[325]) if tiled else (tags[273], tags[279])))):
        y, x = k // across * h, k % across * w
        rows = h if tiled else min(h, height - y)
        raw = _unpacked(data[place : place + size], one(259, 1))
        block = np.frombuffer(raw, kind, rows * w).reshape(rows, w).astype(kind.newbyteorder("="))
        if one(317, 1) == 2:  # differences along the row
            block = np.cumsum(block, axis=1, dtype=block.dtype)
        elif one(317, 1) != 1:
            raise ValueError("only differences of whole numbers are undone")
        part = block[: height - y, : width - x]
        out[y : y + part.shape[0], x : x + part.shape[1]] = part
    return out


def _axes(description: bytes, n: int) -> tuple[int, int, str] | None:
    """(channels, slices, order of the page axes, fastest first) as the first page's description says."""
    text = description.rstrip(b"\0").decode("utf-8", "replace")
    if "<OME" in text:
        found = {k: v for k, v in re.findall(r'\b(SizeC|SizeZ|SizeT|DimensionOrder)="(\w+)"', text)}
        c, z, t = (int(found.get(f"Size{a}", 1)) for a in "CZT")
        return (c, z, found.get("DimensionOrder", "XYCZT")[2:]) if c * z * t == n else None
    if text.startswith("ImageJ="):
        found = {k: int(v) for k, v in re.findall(r"^(channels|slices|frames)=(\d+)", text, re.M)}
        c, z, t = (found.get(a, 1) for a in ("channels", "slices", "frames"))
        return (c, z, "CZT") if c * z * t == n else None
    return None


def _pixel_size(tags: dict[int, tuple], default: float) -> float:
    """Micrometres to a pixel: of the description, of the resolution and its unit, or the default."""
    text = tags.get(270, (b"",))[0]
    text = text.decode("utf-8", "replace") if isinstance(text, bytes) else ""
    if found := re.search(r'PhysicalSizeX="([\d.eE+-]+)"', text):
        return float(found[1])
    if 282 in tags and tags[282][0]:
        per = tags[282][0] / max(1, tags[282][1])
        micron = re.search(r"^unit=(?:um|micron|\\u00B5m|µm)\s*$", text, re.M)
        return {2: 25400.0, 3: 10000.0}.get(1 if micron else tags.get(296, (1,))[0], 1.0) / per
    return default


def read_pages(data: bytes, pixel_size: float = PIXEL_SIZE) -> tuple[list[np.ndarray], float]:
    """Pages of a file, and its pixel size in micrometres (``pixel_size`` if it does not say)."""
    pages, size = [], pixel_size
    for order, tags in _directories(data):
        pages.append(_image(data, order, tags))
        if len(pages) == 1:
            size = _pixel_size(tags, pixel_size)
    return pages, size


def read_stack(data: bytes, channels: int = 1, slices: int = 1, pixel_size: float = PIXEL_SIZE) -> tuple[list[tuple[tuple[int, int, int], np.ndarray]], float]:
    """((frame, slice, channel), page) of a file, and its pixel size.

    Axes are those of the file's description, if it has one that fits its pages; else pages go by
    time, slice and channel, the last one fastest, with as many of them as given.
    """
    pages, size = read_pages(data, pixel_size)
    first = next(_directories(data))[1].get(270, (b"",))[0]
    said = _axes(first, len(pages)) if isinstance(first, bytes) else None
    channels, slices, order = said or (channels, slices, "CZT")
    frames = -(-len(pages) // (channels * slices))
    out, count = [], {"C": channels, "Z": slices, "T": frames}
    for i, img in enumerate(pages):
        at, left = {}, i
        for axis in order:
            at[axis], left = left % count[axis], left // count[axis]
        out.append(((at["T"], at["Z"], at["C"]), img))
    return out, size


def write_pages(pages: list[np.ndarray]) -> bytes:
    """A TIFF file of the pages, little-endian."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for img in pages:
        img = np.ascontiguousarray(img.astype(img.dtype.newbyteorder("<")))
        pixels = len(out)
        out += img.tobytes() + b"\0" * (img.nbytes % 2)
        struct.pack_into("<I", out, link, len(out))
        kind = {"u": 1, "i": 2, "f": 3}[img.dtype.kind]
        tags = ((256, 4, img.shape[1]), (257, 4, img.shape[0]), (258, 3, 8 * img.dtype.itemsize), (259, 3, 1), (262, 3, 1), (273, 4, pixels), (277, 3, 1), (278, 4, img.shape[0]), (279, 4, img.nbytes), (339, 3, kind))
        out += struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, k, 1, v) for t, k, v in tags)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def stack_index(axes: str, shape: tuple[int, ...]) -> list[tuple[int, int, int, tuple[int, ...]]]:
    """(frame, slice, channel, index) of each plane of a stack with these axes, in order.

    Axes are letters of T, S, C, X and Y, each at most once, the last two X and Y in either order.
    """
    if len(set(axes)) != len(axes) or set(axes) - set("TSCXY") or not {"X", "Y"} <= set(axes) or len(axes) != len(shape):
        raise ValueError(f"bad axes: {axes}")
    lead = [a for a in axes if a not in "XY"]
    out = []
    for at in np.ndindex(*(shape[axes.index(a)] for a in lead)):
        d = dict(zip(lead, at))
        out.append((d.get("T", 0), d.get("S", 0), d.get("C", 0), tuple(at)))
    return out


def read_planes(spark: SparkSession, path: str, channels: int = 1, slices: int = 1, glob: str = "*.tif*", pixel_size: float = PIXEL_SIZE) -> DataFrame:
    """Planes of image files; a bad file gives one row with ``error``.

    Columns of the plane relation, ``pixel_size`` and ``error``. TIFF files are read by
    :func:`read_stack`, other endings by the decoder that :data:`DECODERS` has for them.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    names, decoders = [*(f.name for f in PLANE), "pixel_size", "error"], dict(DECODERS)

    def run(batches):
        for df in batches:
            for file, data in zip(df["path"], df["content"]):
                name = file.rsplit("/", 1)[-1]
                try:
                    own = next((f for ending, f in decoders.items() if name.endswith(ending)), None)
                    pages, size = own(bytes(data)) if own else read_stack(bytes(data), channels, slices, pixel_size)
                except Exception as e:  # one bad file does not end the batch
                    yield pd.DataFrame([(name, None, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}")], columns=names)
                    continue
                for (t, s, c), img in pages:
                    yield pd.DataFrame([(name, t, s, c, *img.shape, str(img.dtype), img.tobytes(), size, None)], columns=names)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PLANE) + ", pixel_size double, error string"
    planes = files.mapInPandas(run, kinds)
    return planes.withColumn("movie", strip_extension(F.col("movie")))


def save_tiffs(planes: DataFrame, folder: str, ending: str, dtype: str | None = None) -> DataFrame:
    """Write each movie's planes, by frame, slice and channel, to ``<movie><ending>`` in a folder that all
    executors see; (movie, path, pages). A page is written as it passes, so no movie is held."""
    os.makedirs(folder, exist_ok=True)
    ordered = planes.repartition("movie").sortWithinPartitions("movie", "frame", "slice", "channel")

    def run(batches):
        movie, n, path, link, file = None, 0, None, 4, None
        done = []
        for df in batches:
            for r in df.itertuples():
                if r.movie != movie:
                    if file:
                        file.close()
                        done.append((movie, path, n))
                    movie, n, link = r.movie, 0, 4
                    path = f"{folder}/{movie}{ending}"
                    file = open(path, "w+b")  # noqa: SIM115  open over many batches
                    file.write(b"II*\0\0\0\0\0")
                img = np.frombuffer(r.pixels, r.dtype).reshape(r.height, r.width)
                link, n = _append(file, img.astype(dtype) if dtype else img, link), n + 1
        if file:
            file.close()
            done.append((movie, path, n))
        yield pd.DataFrame(done, columns=["movie", "path", "pages"])

    return ordered.mapInPandas(run, "movie string, path string, pages int")


def _append(file, img: np.ndarray, link: int) -> int:
    """Append a page; where the next one's place has to be written."""
    page = bytearray(write_pages([img])[8:])
    start = file.seek(0, os.SEEK_END)
    directory = start + img.nbytes + img.nbytes % 2
    n = struct.unpack_from("<H", page, directory - start)[0]
    for i in range(n):  # places in a file of one page count from 8
        at = directory - start + 2 + 12 * i
        if struct.unpack_from("<H", page, at)[0] == 273:
            struct.pack_into("<I", page, at + 8, start)
    file.write(page)
    file.seek(link)
    file.write(struct.pack("<I", directory))
    return directory + 2 + 12 * n


def tiff_files(planes: DataFrame) -> DataFrame:
    """(movie, tiff): each movie's planes as one file, by frame, slice and channel."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["frame", "slice", "channel"])
        pages = [np.frombuffer(r.pixels, r.dtype).reshape(r.height, r.width) for r in df.itertuples()]
        return pd.DataFrame([(df["movie"].iloc[0], write_pages(pages))], columns=["movie", "tiff"])

    return planes.groupBy("movie").applyInPandas(run, "movie string, tiff binary")


def planes_from_array(spark: SparkSession, movie: str, array: np.ndarray, axes: str) -> DataFrame:
    """The plane relation of an array in memory, for tests and notebooks."""
    index = stack_index(axes, array.shape)
    swap = axes.index("X") < axes.index("Y")
    lead = [a for a in axes if a not in "XY"]
    moved = np.moveaxis(array, [axes.index(a) for a in lead], range(len(lead)))
    rows = []
    for t, s, c, at in index:
        img = np.ascontiguousarray(moved[at].T if swap else moved[at])
        rows.append((movie, t, s, c, *img.shape, str(img.dtype), img.tobytes()))
    return spark.createDataFrame(rows, PLANE)
