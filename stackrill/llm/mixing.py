"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a fixed pseudo-random order, repeated up to ``cap``
times. A copy's virtual finish time is the number of source words up to and with it, divided by the
source's target; all queues are merged by that time, in fixed ranges of it, and the merged order is
cut at the total budget.

Prefix sums run level by level over fixed hash ranges, so a source with a third of all rows is
spread over as many tasks as its size asks for, no window grows with the data, and a lost task is
recomputed to the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, located, small, spread_join, stored

#: Rows in a range of a prefix sum, about.
RANGE_ROWS = 4096
#: Bits of a place in a hash range or of a finish time that one window sums up.
LEVEL = 10
_BITS = 60


def word_count(text: Column) -> Column:
    r"""Number of words ``[^\x20\x09-\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sums_before(parts: DataFrame, by: list[str], at: str, value: str, bits: int, temp: Scratch) -> DataFrame:
    """``parts`` (by, at, value), a stored table with one row per ``at`` of ``bits`` bits -> (by, at, base).

    ``base`` sums ``value`` over all smaller ``at``, level by level: no window has more than
    2 ** :data:`LEVEL` rows, however many parts there are.
    """
    high = f"{at}_high"
    coarse = [*by, high]
    split = parts.withColumn(high, F.shiftright(at, LEVEL))
    window = Window.partitionBy(*coarse).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    inside = split.withColumn("inside", F.coalesce(F.sum(value).over(window), F.lit(0)))
    if bits <= LEVEL:
        return temp.stored(inside.select(*by, at, F.col("inside").alias("base")), "mix-base")
    above = temp.stored(split.groupBy(*coarse).agg(F.sum(value).alias(value)), "mix-level")
    above = sums_before(above, by, high, value, bits - LEVEL, temp)
    return temp.stored(inside.join(small(above, 96), coarse).select(*by, at, (F.col("base") + F.col("inside")).alias("base")), "mix-base")


def numbered(rows: DataFrame, key: str, temp: Scratch) -> DataFrame:
    """``rows`` with ``number``, from 0 in the order of ``key``: sorted by ranges, each counted on its own."""
    parts = temp.stored(rows.repartitionByRange(key).withColumn("part", F.spark_partition_id()), "mix-parts")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", before.alias("base"))  # a row per partition
    own = F.row_number().over(Window.partitionBy("part").orderBy(key)) - 1
    return parts.withColumn("own", own).join(F.broadcast(bases), "part").withColumn("number", F.col("base") + F.col("own")).drop("part", "own", "base")


def source_targets(sizes: DataFrame, weights: Sequence[int], cap: int, temp: Scratch) -> DataFrame:
    """``sizes`` (key, source_size, n), one row per source, with ``total`` and ``target``.

    Sources in key order get ``weights`` in turn and share the sum of all sizes; a target stops at
    ``cap`` times its source, and what is over is shared by weight until none is above. Each turn of
    the loop caps what the share left by the capped sources takes to its cap; only sums reach the driver.
    """
    turn = (F.col("number") % len(weights) + 1).cast("int")
    s = numbered(sizes, "key", temp).withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), turn))
    s = temp.stored(s.withColumn("cap_words", F.lit(cap) * F.col("source_size")), "mix-sources")
    zero = F.lit(0).cast("long")
    total, every = s.agg(F.coalesce(F.sum("source_size"), zero), F.coalesce(F.sum("weight").cast("long"), zero)).head()
    taken, gone = 0, 0
    while True:
        share = F.lit(total - taken) / F.lit(every - gone) if every > gone else F.lit(0.0)
        capped = share >= F.col("cap_words") / F.col("weight")
        now = s.where(capped).agg(F.coalesce(F.sum("cap_words"), zero), F.coalesce(F.sum("weight").cast("long"), zero)).head()
        if tuple(now) == (taken, gone) or every == gone:
            break
        taken, gone = now
    return s.select("key", "source_size", "n", F.lit(total).cast("long").alias("total"), F.when(capped, F.col("cap_words").cast("double")).otherwise(share * F.col("weight")).alias("target"))


def range_bits(rows: int) -> int:
    """Bits of a hash whose ranges hold about :data:`RANGE_ROWS` of ``rows`` each."""
    return max(0, min(_BITS, (max(1, rows) // RANGE_ROWS).bit_length()))


def _finish(epoch: Column) -> Column:
    return (epoch * F.col("source_size") + F.col("upto")).cast("double") / F.col("target")


#: Columns that order copies: virtual finish time, then what makes them distinct.
_ORDER = ("finish", "key", "h", "id", "size", "at", "epoch")


def _range_of_budget(ranges: DataFrame, total: int) -> tuple[int, int] | None:
    """(range, words before it) of the range in which the sum of words goes over ``total``, found level
    by level in windows of 2 ** :data:`LEVEL` rows; None if it never does. ``ranges`` is stored."""
    top = ranges.agg(F.max("range")).head()[0]
    if top is None:
        return None
    start, shift = 0, LEVEL * (max(0, top.bit_length() - 1) // LEVEL)
    while True:
        level = ranges.groupBy(F.shiftright("range", shift).alias("r")).agg(F.sum("words").alias("words"))
        upto = F.sum("words").over(Window.orderBy("r")) + F.lit(start)
        hit = level.withColumn("upto", upto).where(F.col("upto") > total).orderBy("r").select("r", F.col("upto") - F.col("words")).head()
        if hit is None:
            return None
        at, start = hit
        if not shift:
            return at, start
        ranges, shift = ranges.where(F.shiftright("range", shift) == at), shift - LEVEL


def queued_copies(docs: DataFrame, weights: Sequence[int], cap: int) -> tuple[DataFrame, Callable[[int], Column]]:
    """Rows (id, source, key, h, at, size, source_size, target, upto), a stored table, and whether the
    mix takes a row's copy number ``e``. ``docs`` has id, source, size and the locator ``_sr_at``."""
    spark = docs.sparkSession
    key = F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source")))
    h = F.conv(F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), 1, _BITS // 4), 16, 10).cast("long")
    with Scratch(spark) as temp:
        rows = temp.stored(docs.select("id", "source", "size", F.col("_sr_at").alias("at"), key.alias("key"), h.alias("h")), "mix-rows")
        n = rows.count()
        sizes = rows.groupBy("key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
        targets = temp.stored(source_targets(sizes, weights, cap, temp), "mix-targets")
        # Words of the source up to and with each document, in the shuffled order.
        bits = range_bits(n)
        rows = rows.withColumn("bucket", F.shiftright("h", _BITS - bits))
        parts = temp.stored(rows.groupBy("key", "bucket").agg(F.sum("size").alias("words")), "mix-words")
        bases = sums_before(parts, ["key"], "bucket", "words", bits, temp)
        inside = F.sum("size").over(Window.partitionBy("key", "bucket").orderBy("h", "id", "size", "at").rowsBetween(Window.unboundedPreceding, 0))
        queued = rows.withColumn("inside", inside).join(small(bases, 64), ["key", "bucket"]).withColumn("upto", F.col("base") + F.col("inside"))
        queued = spread_join(queued, targets, ["key"], "n", 128, "left")
        queued = stored(queued.select("id", "source", "key", "h", "at", "size", "source_size", "target", "total", "upto"), "mix-queued")
        # All copies by virtual finish time, in fixed ranges of it; the one where the budget ends is sorted.
        epoch = F.explode(F.sequence(F.lit(0), F.lit(cap - 1)))
        copies = queued.where("size > 0").select("*", epoch.alias("epoch")).withColumn("finish", _finish(F.col("epoch")))
        width = float(1 << range_bits(cap * n))
        copies = copies.withColumn("range", F.floor(F.col("finish") * width))
        ranges = temp.stored(copies.groupBy("range").agg(F.sum("size").alias("words")), "mix-ranges")
        first = queued.select("total").head()
        total = first[0] if first else 0
        over = _range_of_budget(ranges, total)
        cut = None
        if over:  # the last copy that still fits
            at, start = over
            upto = F.sum("size").over(Window.orderBy(*_ORDER)) + F.lit(start)
            cut = copies.where(F.col("range") == at).withColumn("upto_all", upto).where(F.col("upto_all") <= total).orderBy(*(F.col(c).desc() for c in _ORDER)).select(*_ORDER).head()
    if not over:
        return queued, lambda e: F.lit(True)
    if cut is None:
        return queued, lambda e: F.floor(_finish(F.lit(e)) * width) < F.lit(at)
    last = F.struct(*(F.lit(v).cast(copies.schema[c].dataType).alias(c) if c != "at" else F.struct(F.lit(v[0]).alias("file"), F.lit(v[1]).alias("row")).alias("at") for c, v in zip(_ORDER, cut)))
    return queued, lambda e: F.struct(_finish(F.lit(e)).alias("finish"), "key", "h", "id", "size", "at", F.lit(e).alias("epoch")) <= last


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies, taken.

    Sources are ordered by code point, null last, as a source of its own. Null and empty texts have
    size 0 and are never taken (``copies`` 0). Ids order ties; rows that agree in id, source and
    size go by file and row. Other columns are not read. An empty table gives an empty one, and a
    table without words gives targets of 0.
    """
    rows = located(docs, id=F.col(id_col), source=F.col(source_col).cast("string"), size=word_count(F.col(text_col)))
    queued, taken = queued_copies(rows, weights, cap)
    n_taken = sum((F.when(taken(e), 1).otherwise(0) for e in range(cap)), F.lit(0))
    n_copies = F.when(F.col("size") > 0, n_taken).otherwise(0)
    return queued.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", n_copies.cast("int").alias("copies")).withColumn("taken", F.col("size") * F.col("copies"))


def take_mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it was taken, with all their columns.

    Copies are range-sorted by virtual finish time and cut at the total budget, so partitions, and
    the files written from them, follow the merged order. Texts are shuffled twice at every size, once to
    their copies and once into that order. Null and empty texts are never taken;
    see :func:`mix_sources` for null sources, ties and repeated rows.
    """
    docs = located(docs)
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), "_sr_at")
    queued, taken = queued_copies(rows, weights, cap)
    epochs = F.filter(F.array(*(F.when(taken(e), F.lit(e)) for e in range(cap))), lambda e: e.isNotNull())
    mix = queued.where("size > 0").select(F.col("at").alias("_sr_mixed"), "key", "h", F.explode(epochs).alias("epoch"), "source_size", "upto", "target")
    mix = stored(mix.select("_sr_mixed", F.struct(_finish(F.col("epoch")).alias("finish"), "key", "h", F.col("epoch").alias("epoch")).alias("_sr_place")), "mix-copies")
    found = docs.join(mix.hint("merge"), docs["_sr_at"] == F.col("_sr_mixed"))
    order = ["_sr_place.finish", "_sr_place.key", "_sr_place.h", "_sr_at", "_sr_place.epoch"]
    names = [c for c in docs.columns if c != "_sr_at"]
    return found.repartitionByRange(*order).sortWithinPartitions(*order).select(*names)


def op8_query(docs: DataFrame) -> DataFrame:
    """The digest of :func:`mix_sources` for each document."""
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


#: DuckDB SQL for the rows of :func:`op8_query`.
OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT key, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(sum(size)) OVER () AS BIGINT) AS total,
         CASE (row_number() OVER (ORDER BY key) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY key
), r AS (
  SELECT *, 3 * source_size / weight AS ratio, CAST(sum(weight) OVER () AS BIGINT) AS weights,
         CAST(coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cap_before,
         CAST(coalesce(sum(weight) OVER (ORDER BY 3 * source_size / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS w_before
  FROM s
), c AS (SELECT *, (total - cap_before) / (weights - w_before) >= ratio AS capped FROM r),
t AS (
  SELECT key, source_size, total,
         CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(total - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER () AS BIGINT)
                   / CAST(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS BIGINT) * weight END AS target
  FROM c
), q AS (
  SELECT rid, doc_id, size, h, key, source_size, target, total, CAST(sum(size) OVER (PARTITION BY key ORDER BY h, doc_id, size, rid) AS BIGINT) AS upto
  FROM d JOIN t USING (key)
), x AS (
  SELECT rid, size, total, sum(size) OVER (ORDER BY CAST(epoch * source_size + upto AS DOUBLE) / target, key, h, doc_id, size, rid, epoch) AS upto_all
  FROM q, (SELECT unnest([0, 1, 2]) AS epoch) WHERE size > 0
), n AS (SELECT rid, count(*) FILTER (upto_all <= total) AS copies FROM x GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(size * coalesce(copies, 0) AS BIGINT) AS taken FROM q LEFT JOIN n USING (rid)
"""
