"""Quality rules as a short-circuit cascade.

Each rule is a predicate over one whole text. :func:`plan_cascade` measures, on a sample, what a
rule costs and how often it rejects, and orders the rules by rejection per cost;
:func:`quality_cascade` then evaluates them in that order and stops at the first rejection. The
order changes the work, never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import operator
import time
from collections import Counter
from collections.abc import Callable, Sequence
from copy import copy
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch, text_batches

#: Characters that count as symbols. Fixed value.
SYMBOLS = b"#*$%&|<>"
#: Words in the windows that are searched for repeats. Fixed value.
WINDOW = 8
#: Documents on which :func:`plan_cascade` measures the rules, about.
SAMPLE_ROWS = 1000

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Text:
    """Counts over one whole text, each computed on first use. Null is the text without words."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    def _count(self, chars: bytes) -> int:
        return len(self.raw) - len(self.raw.translate(None, chars))

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - self._count(SPACE)

    @cached_property
    def n_symbols(self) -> int:
        return self._count(SYMBOLS)

    @cached_property
    def n_bars(self) -> int:
        """Words that are one bar, as between the cells of a table."""
        return self.words.count(b"|")

    @cached_property
    def n_upper(self) -> int:
        return self._count(_UPPER)

    @cached_property
    def n_lower(self) -> int:
        return self._count(_LOWER)

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines, split at \\n, that have a word."""
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_stutters(self) -> int:
        """Words that equal the word before them."""
        return sum(map(operator.eq, self.words, self.words[1:]))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a window that occurs at least twice in the text."""
        words = self.words
        windows = list(zip(*(words[i:] for i in range(WINDOW))))
        if len(set(windows)) == len(windows):
            return 0
        times, covered, end = Counter(windows), 0, 0
        for start, window in enumerate(windows):
            if times[window] > 1:
                covered += start + WINDOW - max(start, end)
                end = start + WINDOW
        return covered


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a text that has to go."""

    name: str
    rejects: Callable[[Text], bool]


#: Production rules. The first two are the base rules; each is a comparison of integers. The bars of
#: tables are no symbols of the third.
RULES = (
    Rule("few_words", lambda t: t.n_words < 20),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 30 * t.n_words),
    Rule("symbols", lambda t: 100 * (t.n_symbols - t.n_bars) > 5 * (t.word_chars - t.n_bars)),
    Rule("shouting", lambda t: t.n_upper > t.n_lower),
    Rule("repeated_lines", lambda t: 100 * t.n_dup_lines > 60 * len(t.lines)),
    Rule("stutters", lambda t: 100 * t.n_stutters > 30 * t.n_words),
)
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Measured:
    name: str
    cost_us: float
    rejection: float

    @property
    def rank(self) -> float:
        return self.rejection / max(self.cost_us, 1e-3)


def plan_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Measured]:
    """Cost and rejection rate of each rule on a random sample, best rejection per cost first.

    The order is found rule by rule: each turn measures the rules that are left on the sampled texts
    that those before it keep, with what those have counted already there, so a count that rules
    share is charged to the first one that needs it. About ``sample_rows`` rows are drawn from all of
    ``docs``; only sums for each rule reach the driver. Rules that tie keep their given order; so do
    all rules on an empty table.
    """
    n = docs.count()
    if not n:
        return [Measured(r.name, 0.0, 0.0) for r in rules]
    text_batches(docs.sparkSession)
    chosen, left = [], list(rules)
    with Scratch(docs.sparkSession) as temp:
        sample = temp.stored(docs.select(F.col(text_col).cast("string").alias("text")).sample(min(1.0, sample_rows / n), seed=7), "quality-sample")
        while left:
            sums = {r["rule"]: r for r in sample.mapInArrow(_measured([r for r, _ in chosen], left), "rule long, ns long, hits long, seen long").groupBy("rule").agg(F.sum("ns").alias("ns"), F.sum("hits").alias("hits"), F.sum("seen").alias("seen")).collect()}
            seen = lambda i: max(1, sums[i]["seen"])
            found = [(r, Measured(r.name, sums[i]["ns"] / 1e3 / seen(i), sums[i]["hits"] / seen(i)) if i in sums else Measured(r.name, 0.0, 0.0)) for i, r in enumerate(left)]
            best = max(found, key=lambda x: x[1].rank)
            chosen.append(best)
            left.remove(best[0])
    return [m for _, m in chosen]


def _measured(before: Sequence[Rule], rules: Sequence[Rule]) -> Callable:
    """Sums of each rule's time and rejections over the texts that the rules ``before`` keep."""

    def measure(batches):
        cost, hits, seen = [0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                text = Text(value)
                if any([r.rejects(text) for r in before]):
                    continue
                seen += 1
                for i, rule in enumerate(rules):
                    own = copy(text)  # with the counts that are there
                    began = time.perf_counter_ns()
                    hit = rule.rejects(own)
                    cost[i] += time.perf_counter_ns() - began
                    hits[i] += bool(hit)
        yield pa.RecordBatch.from_pydict({"rule": list(range(len(rules))), "ns": cost, "hits": hits, "seen": [seen] * len(rules)})

    return measure


def cascade_verdict(text: Column, order: Sequence[Rule], stats: bool = True) -> Column:
    """A struct: the counts of :data:`STATS` (null unless ``stats``), ``rejected_by``, ``kept``."""
    order = tuple(order)
    kind = "struct<" + ",".join(f"{s}:bigint" for s in STATS) + ",rejected_by:string,kept:boolean>"

    @F.arrow_udf(kind)
    def verdict(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts.to_pylist():
            text = Text(value)
            by = next((r.name for r in order if r.rejects(text)), None)
            rows.append({s: getattr(text, s) if stats else None for s in STATS} | {"rejected_by": by, "kept": by is None})
        return pa.array(rows, pa.struct([(s, pa.int64()) for s in STATS] + [("rejected_by", pa.string()), ("kept", pa.bool_())]))

    return verdict(text)


def quality_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", out: str = "quality", stats: bool = True, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with a struct column ``out``: counts, ``rejected_by`` and ``kept``.

    All rows stay, as do all columns but one already named ``out``, which is replaced. Null and
    empty texts have no words and fail ``few_words``. Repeated rows get equal verdicts; an empty
    table gives an empty one. ``rejected_by`` names the first rule in the measured order, so it can
    differ between runs where several rules reject; ``kept`` can't.
    """
    by_name = {r.name: r for r in rules}
    order = [by_name[m.name] for m in plan_cascade(docs, rules, text_col, sample_rows)]
    text_batches(docs.sparkSession)
    return docs.withColumn(out, cascade_verdict(F.col(text_col).cast("string"), order, stats))


def op1_query(docs: DataFrame) -> DataFrame:
    """The digest of :func:`quality_cascade` for each document."""
    q = quality_cascade(docs.select("doc_id", "text"), out="q")
    failed = (F.col("q.n_words") < 20) | (100 * F.col("q.n_repeat_words") > 30 * F.col("q.n_words"))
    return q.select("doc_id", *(F.col(f"q.{s}").alias(s) for s in STATS), failed.alias("base_failed"), F.col("q.kept").alias("kept"))


#: DuckDB SQL for the rows of :func:`op1_query`.
OP1_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), w AS (
  SELECT k, i, n, CASE WHEN i + 7 <= n THEN list_slice(words, i, i + 7) END AS g
  FROM (SELECT k, words, len(words) AS n, unnest(generate_series(1, len(words))) AS i FROM t)
), c AS (SELECT k, i, g IS NOT NULL AND count(*) OVER (PARTITION BY k, g) > 1 AS rep FROM w),
r AS (
  SELECT k, count(*) FILTER (inside) AS n_repeat_words
  FROM (SELECT k, bool_or(rep) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS inside FROM c)
  GROUP BY k
), s AS (
  SELECT t.k, doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         len(list_filter(words, lambda w: w = '|')) AS n_bars,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         len(list_filter(generate_series(2, len(words)), lambda i: words[i] = words[i - 1])) AS n_stutters,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower
  FROM t LEFT JOIN r ON t.k = r.k
), v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * (n_symbols - n_bars) > 5 * (word_chars - n_bars) OR n_upper > n_lower OR 100 * n_dup_lines > 60 * n_lines OR 100 * n_stutters > 30 * n_words) AS kept
FROM v
"""
