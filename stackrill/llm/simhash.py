"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two 64-bit fingerprints are linked at ``radius`` 3 or fewer differing bits. Half of that radius is
one and a half: a ball of one flip around each side leaves one bit over. So the bits are divided
into three fields, and each fingerprint emits, for each field, all variants of the *other* bits
within one flip (132 rows in all). Linked fingerprints meet in a variant at least once, whichever
field holds the bit that is left over: if x and y differ in i, j and k, with k in field f, x with i
flipped and y with j flipped agree outside f and differ by k within it.

Variants are shuffled and sorted; runs with one member cost nothing further. Within a run, members
are keyed by their value in field f (a member that used no flip may use it there), and only equal or
one-flip-apart values are joined: every such pair is a true link, so a run of m members costs m
times the field's width and yields at most m - 1 links, never all pairs. Equal fingerprints are one
member, however many documents share them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, as_bytes, located, small, spread_join, stored, text_batches
from .graph import components

SEED = 42
SHINGLE = 3
#: Low bit and width of the three fields of a fingerprint.
FIELDS = ((0, 22), (22, 21), (43, 21))
_ALL = (1 << 64) - 1
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> bytes:
    """SimHash of a text's word shingles, as 8 bytes, big-endian. No words: zero."""
    words = (text or b"").lower().split()
    if not words:
        return bytes(8)
    digest, joined = xxhash.xxh64_digest, b" ".join(words)
    if len(words) <= shingle:
        return digest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: len(words) - shingle + 1].tolist()
    raw = b"".join([digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist())])
    hashes = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        ones += np.unpackbits(hashes[i : i + _CHUNK], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


@F.arrow_udf(T.LongType())
def fingerprint_udf(texts: pa.Array) -> pa.Array:
    raw = b"".join(fingerprint(t) for t in as_bytes(texts))
    return pa.array(np.frombuffer(raw, ">i8").astype(np.int64), pa.int64())


def _mask(field: int) -> int:
    low, width = FIELDS[field]
    return ((1 << width) - 1) << low


def _variant(field: Column, outside: Column):
    return lambda flip: F.struct(field.alias("field"), outside.bitwiseXOR(flip).alias("variant"))


def variants(fingerprints: DataFrame) -> DataFrame:
    """(field, variant, fp): for each field, the fingerprint without it, within one flip."""
    parts = []
    for field, (low, width) in enumerate(FIELDS):
        flips = [0] + [1 << b for b in range(64) if not low <= b < low + width]
        signed = [f - (1 << 64) if f >> 63 else f for f in flips]
        keep = _ALL ^ _mask(field)
        keep = keep - (1 << 64) if keep >> 63 else keep
        outside, name = F.col("fp").bitwiseAND(F.lit(keep).cast("long")), F.lit(field).cast("byte")
        parts.append(F.transform(F.array(*(F.lit(f).cast("long") for f in signed)), _variant(name, outside)))
    return fingerprints.select("fp", F.inline(F.concat(*parts))).select("field", "variant", "fp")


def links_in_run(field: int, variant: int, members: list[int]) -> list[tuple[int, int]]:
    """Links (member, least member joined with it) of fingerprints that share a variant."""
    low, width = FIELDS[field]
    inside, bits = _mask(field), [1 << b for b in range(low, low + width)]
    parent: dict[int, int] = {m: m for m in members}

    def root(m: int) -> int:
        while parent[m] != m:
            parent[m] = m = parent[parent[m]]
        return m

    def join(a: int, b: int) -> None:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)

    owner: dict[int, int] = {}
    for m in members:
        x = m & inside
        own = [x] if m ^ x ^ variant else [x, *(x ^ b for b in bits)]
        for v in own:
            if v in owner:
                join(m, owner[v])
            else:
                owner[v] = m
    for v, m in owner.items():
        for b in bits:
            if v & b == 0 and (other := owner.get(v | b)) is not None:
                join(m, other)
    return [(m, r) for m in members if (r := root(m)) != m]


def _links(batches):
    """Links of sorted (field, variant, fp) rows; a run may go over several batches."""
    kept = None

    def flush(fields, keys, fps, starts, ends):
        out = []
        for s, e in zip(starts, ends):
            out += links_in_run(int(fields[s]), int(keys[s]), [int(f) for f in fps[s:e]])
        return out

    def emit(out):
        a = np.array(out, np.uint64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0].view(np.int64)), pa.array(a[:, 1].view(np.int64))], ["a", "b"])

    for batch in batches:
        cols = [batch.column(0).to_numpy(zero_copy_only=False).astype(np.int8), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64), batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)]
        if kept is not None:
            cols = [np.concatenate(x) for x in zip(kept, cols)]
        field, key, fp = cols
        new = np.flatnonzero((key[1:] != key[:-1]) | (field[1:] != field[:-1])) + 1
        bounds = np.concatenate(([0], new, [len(key)]))
        last = bounds[-2]  # the last run may go on in the next batch
        kept = [x[last:] for x in cols]
        s, e = bounds[:-2], bounds[1:-1]
        many = e - s > 1
        if many.any():
            yield emit(flush(field, key, fp, s[many], e[many]))
    if kept is not None and len(kept[0]) > 1:
        yield emit(flush(*kept, [0], [len(kept[0])]))


def grouped_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text, locator at) -> (id, at, fp, component_id, keep_at).

    ``keep_at`` is the locator of the row that stands for the component: that with the least id and
    locator, rows without an id last.
    """
    spark = rows.sparkSession
    text_batches(spark)
    rows = stored(rows.select("id", "at", fingerprint_udf(F.col("text").cast("string")).alias("fp")), "simhash-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at")).alias("least")
    with Scratch(spark) as temp:
        prints = temp.stored(rows.groupBy("fp").agg(first, F.count(F.lit(1)).alias("n")), "simhash-prints")
        met = variants(prints.select("fp")).repartition("field", "variant").sortWithinPartitions("field", "variant")
        roots = temp.stored(components(met.mapInArrow(_links, "a long, b long"), temp), "simhash-roots")
        joined = roots.join(prints, roots["node"] == prints["fp"]).select("node", "root", "least")
        least = temp.stored(joined.groupBy("root").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-least")
        named = temp.stored(spread_join(joined.select("root", F.col("node").alias("fp")), least, ["root"], "n", 64).select("fp", F.col("least").alias("all")), "simhash-named")
        ids = stored(prints.join(small(named, 64), "fp", "left").select("fp", F.coalesce("all", "least").alias("least"), "n"), "simhash-ids")
    joined = spread_join(rows, ids, ["fp"], "n", 64)
    return joined.select("id", "at", "fp", F.col("least.id").alias("component_id"), F.col("least.at").alias("keep_at"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, fp (long), component_id.

    ``component_id`` is the least id reachable over links, null ids aside (null if all are).
    Texts without words, null ones included, have fingerprint 0 and are linked like any other;
    repeated rows get equal results; other columns are not read; an empty table gives an empty one.
    """
    rows = located(docs, id=F.col(id_col), text=F.col(text_col)).withColumnRenamed("_sr_at", "at")
    return grouped_rows(rows).select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group; all columns stay.

    The row with the least id stays, and of several with that id the first by file and row; a row
    without an id only if none has one. Texts without words, null ones included, are one group.
    """
    docs = located(docs)
    groups = grouped_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col("_sr_at").alias("at")))
    lost = stored(groups.where(F.col("at") != F.col("keep_at")).select(F.col("at").alias("_sr_lost")), "simhash-lost")
    return docs.join(small(lost, 32), docs["_sr_at"] == lost["_sr_lost"], "left_anti").drop("_sr_at")


def op3_query(docs: DataFrame) -> DataFrame:
    """The digest of :func:`near_groups` for each document."""
    return near_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
