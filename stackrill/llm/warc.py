"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Writing: equal payloads of at least ``min_revisit`` bytes are stored once, in the record with the
largest id; the others are revisit records that name it. Archives are uncompressed WARC/1.1 files
from Spark's text writer, so they go wherever Spark can write.

Reading: each task takes a byte range of an archive and splits it at every place where a record
could begin (an empty line and the magic), also inside payloads. A candidate is two numbers, its offset
and that of its successor. Candidates in a range are contracted to the offset at which their chain
leaves the range; pointer jumping over those, from the file's start, finds the one candidate at which
the true chain enters each range. A second scan follows the chain from there, and only the records on
it are read and their payloads digested, in parts; magic inside a payload is on no chain.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, Scratch, as_bytes, file_number, located, scratch, small, spread_join, stored, text_batches

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Payloads below this many bytes are never replaced by a revisit. Fixed value.
MIN_REVISIT = 1000
_LEAD = (END + MAGIC).encode()
_GAP = len(_LEAD)
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@F.arrow_udf(T.StringType())
def sha1_hex(payloads: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha1(p or b"").hexdigest() for p in as_bytes(payloads)], pa.string())


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))


def _uri(value: Column) -> Column:
    """A target URI that fits on a header line; null stays out of the record."""
    return F.regexp_replace(value, r"[\x00-\x20\x7f]", "%20")


def revisits(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``pages`` (id, url, html) with digest, bytes and the group's keep: (id, row), null if alone.

    The payload key is SHA-1, SHA-256 and length. Groups are pre-aggregated before their shuffle.
    """
    text_batches(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("id", "url", payload.alias("html"), "at").select("*", sha1_hex("html").alias("digest"), F.octet_length("html").cast("long").alias("bytes"))
    key = ["digest", "bytes", "sha256"]
    rows = rows.withColumn("sha256", F.sha2(F.col("html").cast("binary"), 256))
    groups = rows.where(F.col("bytes") >= min_revisit).groupBy(*key).agg(F.max(F.struct("id", "at")).alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").select(*key, "keep", "n")
    groups = stored(groups, "warc-groups")
    return spread_join(rows, groups, key, "n", 160, "left").drop("sha256")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT) -> None:
    """Write one record per row of ``pages`` into archives under ``path``.

    Null html is an empty payload; a null url leaves out the target URI. Of repeated rows with the
    largest id, one is the response. A null id is below all others; its revisits name no id.
    Other columns are not read. An empty table writes no records.
    """
    rows = located(pages, id=F.col(id_col), url=F.col(url_col).cast("string"), html=F.col(html_col)).withColumnRenamed("_sr_at", "at")
    rows = revisits(rows, min_revisit)
    revisit = F.col("keep").isNotNull() & (F.col("keep.at") != F.col("at"))
    name = lambda c: F.when(c.isNotNull(), c.cast("string")).otherwise("")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    header = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:sha1:"), F.sha1(F.concat_ws(":", name(F.col("id")), F.col("at.file").cast("string"), F.col("at.row").cast("string")).cast("binary")), F.lit(">"))),
        _line("WARC-Date", _DATE),
        F.coalesce(_line("WARC-Target-URI", _uri(F.col("url"))), F.lit("")),
        _line("X-Page-ID", name(F.col("id"))),
        F.when(revisit, F.concat(_line("WARC-Profile", _PROFILE), _line("X-Refers-To-Page-ID", name(F.col("keep.id"))))).otherwise(""),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("X-Payload-Length", F.col("bytes").cast("string")),
        _line("Content-Type", "application/http; msgtype=response"),
        F.lit("Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
    )
    rows.select(F.concat(header, block)).write.option("lineSep", END).text(path)


def _header(chunk: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """Header fields and the place of the block; None if it is not a header with a length."""
    end = chunk.find(b"\r\n\r\n")
    lines = (chunk if end < 0 else chunk[:end]).split(b"\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    if not fields.get(b"content-length", b"").isdigit() or b"warc-type" not in fields:
        return None
    return fields, (len(chunk) if end < 0 else end) + 4


def _number(value: bytes | None) -> int | None:
    return int(value) if value and value.isdigit() and len(value) < 19 else None


class _Places:
    """Where the chunks of one byte range begin; offsets count from its first chunk."""

    def __init__(self, start: int):
        self.start, self.at = start, 0

    def chunk(self, value: bytes) -> tuple[int, bytes | None, int]:
        """(offset of a record that begins with this chunk, what follows its magic, raw offset)."""
        if self.start == 0 and self.at == 0:  # the file's first record has no empty line before it
            body = value[len(MAGIC) :] if value.startswith(MAGIC.encode()) else None
            out = 0, body, 0
        else:  # the separator was before this chunk
            out = self.at - len(MAGIC), value, self.at - _GAP
        self.at += len(value) + _GAP
        return out


_DOORS = pa.schema([("file", pa.int64()), ("range", pa.int64()), ("off", pa.int64()), ("leaves", pa.int64())])


def _doors(batches):
    """(file, range, off, leaves) of the candidates of each range: the offset at which a chain from
    there leaves the range; and a row without ``leaves`` that has the range's length."""
    key, places, offs, nexts = None, None, array("q"), array("q")

    def done():
        off, to = np.array(offs, np.int64), np.array(nexts, np.int64)
        at = np.minimum(np.searchsorted(off, to), max(0, len(off) - 1))
        jump = np.where((off[at] == to) if len(off) else to < 0, at, np.arange(len(off)))
        while not np.array_equal(far := jump[jump], jump):
            jump = far
        n = len(off)
        cols = [np.full(n + 1, key[0]), np.full(n + 1, key[1]), np.append(off, places.at), np.append(to[jump], 0)]
        mask = np.arange(n + 1) == n
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.int64(), mask=mask)], schema=_DOORS)

    for batch in batches:
        for file, start, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if key != (file, start):
                if key:
                    yield done()
                key, places, offs, nexts = (file, start), _Places(start), array("q"), array("q")
            off, body, _ = places.chunk(value)
            found = _header(body) if body is not None else None
            if found and (length := _number(found[0][b"content-length"])) is not None:
                offs.append(off)
                nexts.append(off + len(MAGIC) + found[1] + length + 4)
    if key:
        yield done()


class _Payload:
    """Digest and length of the payload of a block that arrives in parts: what is behind the HTTP header."""

    def __init__(self):
        self.sha1, self.length, self.tail = hashlib.sha1(), 0, b""

    def feed(self, part: bytes) -> None:
        if self.tail is not None:  # the HTTP header has not ended yet
            part = self.tail + part
            end = part.find(b"\r\n\r\n")
            if end < 0:
                self.tail = part[-3:]
                return
            self.tail, part = None, part[end + 4 :]
        self.sha1.update(part)
        self.length += len(part)

    def found(self) -> str:
        return f"{self.sha1.hexdigest()}:{self.length}"


_RECORD = pa.schema([("path", pa.string()), ("file", pa.int64()), ("off", pa.int64()), ("block", pa.int64()), ("next", pa.int64()), ("type", pa.string()), ("id", pa.string()), ("refers", pa.string()), ("digest", pa.string()), ("bytes", pa.int64()), ("found", pa.string())])
_RECORD_DDL = "path string, file long, off long, block long, next long, type string, id string, refers string, digest string, bytes long, found string"


def _records(batches):
    """Records on the chain from each range's entry, in order; one payload is open at a time."""
    key, places, entry, base, row, payload, missing, skip = None, None, 0, 0, None, None, 0, 0

    def text(fields, name):
        return fields.get(name, b"").decode("ascii", "replace")

    for batch in batches:
        out = []
        for path, file, start, value, rel, before in zip(*(batch.column(c).to_pylist() for c in ("path", "file", "range", "value", "entry", "base"))):
            if key != (file, start):
                if row:
                    out.append(row)
                key, places, entry, base, row = (file, start), _Places(start), rel, before, None
            off, body, raw = places.chunk(value)
            if row:
                part = (_LEAD + value)[skip:][:missing]
                skip = 0
                payload.feed(part)
                missing -= len(part)
            elif off == entry and body is not None and (head := _header(body)) and (length := _number(head[0][b"content-length"])) is not None:
                fields, place = head
                entry = off + len(MAGIC) + place + length + 4
                row = {"path": path, "file": file, "off": base + off, "block": base + off + len(MAGIC) + place, "next": base + entry, "type": text(fields, b"warc-type"), "id": text(fields, b"x-page-id"), "refers": text(fields, b"x-refers-to-page-id"), "digest": text(fields, b"warc-payload-digest").removeprefix("sha1:"), "bytes": _number(fields.get(b"x-payload-length")), "found": None}
                payload, missing, skip = _Payload(), length, max(0, place - len(body))
                part = body[place:][:length]
                payload.feed(part)
                missing -= len(part)
            if row and not missing:
                out.append(row | {"found": payload.found()})
                row = None
        yield pa.RecordBatch.from_pylist(out, _RECORD)
    if row:
        yield pa.RecordBatch.from_pylist([row], _RECORD)


def _entries(chunks: DataFrame, temp: Scratch) -> DataFrame:
    """(file, range, base, entry, rows) of each range that the chain of records enters: its place in the
    file, and the offset in it of the first record that begins there."""
    stored = temp.stored
    every = stored(chunks.select("file", "range", "value").mapInArrow(_doors, "file long, range long, off long, leaves long"), "warc-candidates")
    before = F.coalesce(F.sum("off").over(Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = stored(every.where("leaves IS NULL").select("file", "range", before.alias("base")), "warc-ranges")
    found = every.where("leaves IS NOT NULL").join(small(bases, 32), ["file", "range"])
    found = stored(found.select("file", "range", "base", (F.col("off") + F.col("base")).alias("off"), (F.col("leaves") + F.col("base")).alias("to")), "warc-doors")
    # Pointer jumping over the candidates at which a chain can enter a range.
    first = found.where("off = 0").select("file", "off", "to")
    jump = found.join(found.select("file", F.col("to").alias("off")).distinct(), ["file", "off"], "left_semi").select("file", "off", "to")
    jump = stored(jump.unionByName(first).distinct(), "warc-jump")
    reached, n = stored(first.select("file", "off"), "warc-reached"), 0
    while True:
        more = reached.join(jump, ["file", "off"]).select("file", F.col("to").alias("off"))
        reached = stored(reached.unionByName(more.join(jump.select("file", "off"), ["file", "off"], "left_semi")).distinct(), "warc-reached")
        if (now := reached.count()) == n:
            break
        n = now
        step = jump.select("file", F.col("off").alias("from"), F.col("to").alias("off"))
        far = jump.select("file", "off", F.col("to").alias("further"))
        jump = stored(step.join(far, ["file", "off"], "left").select("file", F.col("from").alias("off"), F.coalesce("further", "off").alias("to")), "warc-jump")
    entries = found.join(reached, ["file", "off"], "left_semi").groupBy("file", "range", "base").agg((F.min("off") - F.col("base")).alias("entry"))
    return stored(entries, "warc-entries")


def read_warc(spark: SparkSession, path: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Records of the archives under ``path``: path, file, off, type, id, refers, digest, bytes, found, intact.

    ``digest`` and ``bytes`` are as the header says, ``found`` is "digest:bytes" of the payload in the
    file, and ``intact`` whether a response's payload is as stated. The first scan finds candidates and
    verifies chains; only the second one, from each range's entry, reads headers and digests payloads,
    one at a time. Payloads that go over the end of a range are digested from all its chunks.
    """
    text_batches(spark)
    chunks = _chunks(spark, path)
    with Scratch(spark) as temp:
        entries = _entries(chunks, temp)
        if entries.count() * 40 <= broadcast_bytes:
            own = chunks.join(F.broadcast(entries), ["file", "range"])
        else:  # chunks keep their order by number
            numbered = chunks.mapInArrow(_numbered, f"{_CHUNK}, rel long")
            own = numbered.join(entries.hint("merge"), ["file", "range"]).sortWithinPartitions("file", "range", "rel")
        records = stored(own.select("path", "file", "range", "value", "entry", "base").mapInArrow(_records, _RECORD_DDL), "warc-read")
        open_ = records.where("type = 'response' AND found IS NULL")
        if open_.count():
            whole = stored(_stitched(chunks, open_, temp), "warc-stitched")
            records = records.where("NOT (type = 'response' AND found IS NULL)").unionByName(whole)
    same = F.col("found") == F.concat_ws(":", "digest", F.col("bytes").cast("string"))
    return records.withColumn("intact", F.when(F.col("type") == "response", F.coalesce(same, F.lit(False))))


_CHUNK = "path string, file long, range long, value binary"


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", END + MAGIC).text(path)
    name = F.col("_metadata.file_path")
    return lines.select(name.alias("path"), file_number(lines, name).alias("file"), F.col("_metadata.file_block_start").alias("range"), F.col("value").cast("binary").alias("value"))


def _numbered(batches):
    """Chunks with ``rel``, their raw offset in their range."""
    key, places = None, None
    for batch in batches:
        rel = []
        for file, start, value in zip(*(batch.column(c).to_pylist() for c in ("file", "range", "value"))):
            if key != (file, start):
                key, places = (file, start), _Places(start)
            rel.append(places.chunk(value)[2])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rel, pa.int64())], [*batch.schema.names, "rel"])


def _stitched(chunks: DataFrame, open_: DataFrame, temp: Scratch) -> DataFrame:
    """Records whose payload goes over several ranges, digested from all chunks that they overlap."""
    placed = chunks.mapInArrow(_numbered, f"{_CHUNK}, rel long")
    raw = F.when((F.col("range") == 0) & (F.col("rel") == 0), F.col("value")).otherwise(F.concat(F.lit(_LEAD), "value"))
    sizes = placed.groupBy("file", "range").agg(F.max(F.col("rel") + F.octet_length("value") + F.when((F.col("range") == 0) & (F.col("rel") == 0), _GAP).otherwise(2 * _GAP)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = temp.stored(sizes.select("file", "range", before.alias("base"), "size"), "warc-places")
    spans = open_.select("file", "off", "block", F.col("next") - len(END)).toDF("file", "off", "block", "end").join(bases, "file").where("base < end AND base + size > block")
    spans = temp.stored(spans.select("file", "range", "base", "off", "block", "end"), "warc-spans")
    parts = placed.withColumn("raw", raw).join(small(spans, 64), ["file", "range"]).withColumn("begin", F.col("base") + F.col("rel"))
    parts = parts.where((F.col("begin") < F.col("end")) & (F.col("begin") + F.octet_length("raw") > F.col("block")))
    clipped = F.expr("substring(raw, greatest(0, block - begin) + 1, end - greatest(block, begin))")
    parts = parts.select("file", "off", "begin", clipped.alias("part")).repartition("file", "off").sortWithinPartitions("file", "off", "begin")

    def digest(batches):
        key, payload, schema = None, None, pa.schema([("file", pa.int64()), ("off", pa.int64()), ("found", pa.string())])
        row = lambda: {"file": key[0], "off": key[1], "found": payload.found()}
        for batch in batches:
            out = []
            for file, off, part in zip(*(batch.column(c).to_pylist() for c in ("file", "off", "part"))):
                if key != (file, off):
                    if key:
                        out.append(row())
                    key, payload = (file, off), _Payload()
                payload.feed(part)
            yield pa.RecordBatch.from_pylist(out, schema)
        if key:
            yield pa.RecordBatch.from_pylist([row()], schema)

    digests = parts.mapInArrow(digest, "file long, off long, found string")
    return open_.drop("found").join(digests, ["file", "off"], "left").select(*open_.columns)


def op10_query(pages: DataFrame) -> DataFrame:
    """Write an archive of ``pages``, read it back, and give the digest of each record."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_warc(pages, path)
    read = read_warc(spark, path)
    kind = pages.schema["page_id"].dataType
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast(kind)
    digest = F.when((F.col("type") != "response") | F.col("intact"), F.col("digest"))
    return read.select(number("id").alias("page_id"), F.col("bytes").alias("payload_bytes"), digest.alias("payload_digest"), F.col("type").alias("record_type"), number("refers").alias("refers_to"))


#: DuckDB SQL for the rows of :func:`op10_query`.
OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT page_id, html, strlen(html) AS n, max(page_id) OVER (PARTITION BY html) AS keep FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM g
"""
