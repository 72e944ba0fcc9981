"""Secret scan in DataFrame functions only: pattern spans and sliding-window entropy.

Pattern kinds are leftmost, non-overlapping matches. Entropy spans come from candidate strings (long
runs of key characters): for the candidate's character class, a window slides over it and its
Shannon entropy follows from counts that change by one character in and one out; a candidate is
reported from its first window over the class's bar to the end of its last. Allow-listed candidates
and those inside a pattern span are left out; letters alone are a candidate like any other.

One projection of the table; nothing is shuffled and no text leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Pattern kinds in their order. Fixed values.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = "(" + "|".join(map(_either, KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
ASSIGN_VALUE = 12
#: Candidate strings, characters in a window, and the bar in bits for each character class.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
BARS = {"hex": 3.05, "alnum": 3.65, "base64": 3.85}
CLASSES = {"hex": "^[0-9A-Fa-f]+$", "alnum": "^[A-Za-z0-9]+$", "base64": "^[A-Za-z0-9+/_=-]+$"}
#: Allow-list: placeholders (where they are half of a candidate or more), UUIDs, a word and a number,
#: words joined by signs (no digit, and capitals only where a word begins or all through it), and
#: candidates without a letter. No pattern loops a group, so the length of a text doesn't matter.
PLACEHOLDERS = "|".join([*map(_either, ("example", "sample", "dummy", "placeholder")), "[Xx]{6,}", "0{8,}", "12345678", "abcdefgh", "ABCDEFGH"])
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
NUMBERED = "^[+/_=-]*[A-Z]?[a-z]+[0-9]{1,4}$"
DIGIT, SIGN, LETTER, MIXED = "[0-9]", "[+/_=-]", "[A-Za-z]", "[a-z][A-Z]|[A-Z][A-Z][a-z]"
KINDS = ("assign", "access", "hex", "entropy")

#: sum of c log2 c over a window's counts c, for each c up to the window; and its limit per class.
_CLOG = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
_LIMIT = {k: WINDOW * (math.log2(WINDOW) - bar) for k, bar in BARS.items()}


def _allowed(hit: str, has: str, every: str = "") -> str:
    """SQL of the allow-list; ``has`` is the dialect's search, ``every`` what makes it replace all."""
    words = f"NOT {has.format(hit, DIGIT)} AND {has.format(hit, SIGN)} AND NOT {has.format(hit, MIXED)}"
    left = f"length(regexp_replace({hit}, '{PLACEHOLDERS}', ''{every}))"
    return f"(2 * {left} <= length({hit}) OR {has.format(hit, UUID)} OR {has.format(hit, NUMBERED)} OR NOT {has.format(hit, LETTER)} OR ({words}))"


_SPAN = "start:int,kind:int,end:int,ok:boolean"
#: Elements that one fold of :func:`_scan` goes over.
FOLD = 256


def _scan(items: str, kind: str, step: str, out: str) -> str:
    """SQL of ``out`` (a ``struct<kind>``) for each element x of an array, after a running whole number
    ``at``, from 0, that ``step`` moves on.

    Folds append to arrays of :data:`FOLD` elements, and one fold over the parts finds where each begins,
    so very many elements cost no copies of the whole.
    """
    part = f"slice(p, c * {FOLD} + 1, {FOLD})"
    starts = f"""aggregate(sequence(0, size(p) div {FOLD}), named_struct('at', 0, 'list', CAST(array() AS array<int>)),
        (a, c) -> named_struct('at', aggregate({part}, a.at, (s, x) -> {step.format(at='s')}), 'list', array_append(a.list, a.at)), a -> a.list)"""
    inside = f"""aggregate({part}, named_struct('at', starts[CAST(c AS int)], 'out', CAST(array() AS array<struct<{kind}>>)),
        (a, x) -> named_struct('at', {step.format(at='a.at')}, 'out', array_append(a.out, {out.format(at='a.at')})), a -> a.out)"""
    return f"transform(array({items}), p -> transform(array({starts}), starts -> flatten(transform(sequence(0, size(p) div {FOLD}), c -> {inside})))[0])[0]"


def _matches(text: str, lit: str, group: int = 0) -> str:
    """SQL of (gap, n, hit, part) of the matches: code points before it, its own, it, and a group of it."""
    hits = f"regexp_extract_all({text}, '{lit}', 0)"
    gaps = f"slice(split({text}, '{lit}', -1), 1, size({hits}))"
    both = f"zip_with({gaps}, {hits}, (g, h) -> named_struct('gap', length(g), 'n', length(h), 'hit', h))"
    return f"zip_with({both}, regexp_extract_all({text}, '{lit}', {group}), (x, part) -> named_struct('gap', x.gap, 'n', x.n, 'hit', x.hit, 'part', part))"


def _spans(text: str, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans (code points) of the matches in column ``text`` whose ``group`` is long enough."""
    lit = pattern.replace("\\", "\\\\").replace("'", "\\'")
    out = f"named_struct('start', {{at}} + x.gap, 'kind', {kind}, 'end', {{at}} + x.gap + x.n, 'ok', length(x.part) >= {least})"
    spans = _scan(_matches(text, lit, group), _SPAN, "{at} + x.gap + x.n", out)
    return F.expr(f"CASE WHEN {text} RLIKE '{lit}' THEN filter({spans}, s -> s.ok) ELSE CAST(array() AS array<struct<{_SPAN}>>) END")


def _candidate_spans(text: str) -> Column:
    lit = CANDIDATE
    clog = "array(" + ", ".join(f"{x!r}D" for x in _CLOG) + ")"
    limit = "CASE " + " ".join(f"WHEN s.hit RLIKE '{CLASSES[k]}' THEN {_LIMIT[k]!r}D" for k in BARS) + " ELSE -1D END"
    # For each candidate that is not allow-listed: its place, limit, and characters as small numbers.
    places = _scan(_matches(text, lit), "start:int,hit:string", "{at} + x.gap + x.n", "named_struct('start', {at} + x.gap, 'hit', x.hit)")
    placed = f"""filter({places}, s -> NOT {_allowed('s.hit', "{0} RLIKE '{1}'")})"""
    coded = f"transform({placed}, s -> named_struct('start', s.start, 'limit', {limit}, 'kinds', array_distinct(regexp_extract_all(s.hit, '.', 0)), 'chars', regexp_extract_all(s.hit, '.', 0)))"
    coded = f"transform({coded}, s -> named_struct('start', s.start, 'limit', s.limit, 'n', size(s.kinds), 'ids', transform(s.chars, c -> CAST(array_position(s.kinds, c) AS int) - 1)))"
    # Slide: one character in, from the window's length on one out.
    slide = f"""aggregate(sequence(1, size(s.ids)),
        named_struct('counts', array_repeat(0, s.n), 'sum', 0D, 'first', 0, 'last', 0),
        (acc, i) -> transform(array(named_struct('in', s.ids[i - 1], 'out', CASE WHEN i > {WINDOW} THEN s.ids[i - 1 - {WINDOW}] ELSE -1 END)), x ->
          transform(array(acc.sum + CASE WHEN x.in = x.out THEN 0D ELSE
              {clog}[acc.counts[x.in] + 1] - {clog}[acc.counts[x.in]]
              + CASE WHEN x.out >= 0 THEN {clog}[acc.counts[x.out] - 1] - {clog}[acc.counts[x.out]] ELSE 0D END END), total ->
            named_struct('counts', CASE WHEN x.in = x.out THEN acc.counts ELSE transform(acc.counts, (c, k) -> c + CASE k WHEN x.in THEN 1 WHEN x.out THEN -1 ELSE 0 END) END,
              'sum', total,
              'first', CASE WHEN acc.first = 0 AND i >= {WINDOW} AND total <= s.limit + 1e-9D THEN i ELSE acc.first END,
              'last', CASE WHEN i >= {WINDOW} AND total <= s.limit + 1e-9D THEN i ELSE acc.last END))[0])[0],
        acc -> named_struct('start', s.start + acc.first - {WINDOW}, 'kind', 3, 'end', s.start + acc.last, 'ok', acc.first > 0))"""
    return F.expr(f"CASE WHEN {text} RLIKE '{lit}' THEN filter(transform({coded}, s -> {slide}), s -> s.ok) ELSE CAST(array() AS array<struct<start:int,kind:int,end:int,ok:boolean>>) END")


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with ``out``: an array of (start, kind, end), by start, then kind as in KINDS.

    Places are code points, ends exclusive. Null and empty texts have no spans. Repeated rows get
    equal spans. All columns stay, but one already named ``out`` is replaced.
    """
    names = {c: f"sr_secret_scan_{c}" for c in ("text", "assign", "access", "hex", "entropy")}
    rows = docs.withColumn(names["text"], F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    t = names["text"]
    rows = rows.withColumns({names["assign"]: _spans(t, ASSIGN, 0, 2, ASSIGN_VALUE), names["access"]: _spans(t, ACCESS, 1), names["hex"]: _spans(t, HEX, 2), names["entropy"]: _candidate_spans(t)})
    base = f"concat({names['assign']}, {names['access']}, {names['hex']})"
    # In order of place, an entropy span is left out if a pattern span that began before it ends no sooner.
    every = f"array_sort(transform(concat({base}, {names['entropy']}), s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end)))"
    own = _scan(every, _SPAN, "greatest({at}, CASE WHEN x.kind < 3 THEN x.end ELSE 0 END)", "named_struct('start', x.start, 'kind', x.kind, 'end', x.end, 'ok', x.kind < 3 OR {at} < x.end)")
    spans = F.expr(f"transform(filter({own}, s -> s.ok), s -> named_struct('start', s.start, 'kind', element_at(array('assign', 'access', 'hex', 'entropy'), s.kind + 1), 'end', s.end))")
    return rows.withColumn(out, spans).drop(*names.values())


def _written(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def op6_query(docs: DataFrame) -> DataFrame:
    """The digest of :func:`find_secrets` for each document."""
    found = find_secrets(docs.select("doc_id", "text"), out="secrets").select("doc_id", "secrets")
    count = lambda k: F.expr(f"CAST(size(filter(secrets, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}")
    base = F.expr(_written("filter(secrets, s -> s.kind != 'entropy')"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"), F.expr(_written("secrets")).alias("spans"))


def _duck_spans(pattern: str, kind: int, group: int = 0, least: int = 0) -> str:
    lit = pattern.replace("'", "''")
    return f"""
  SELECT k, start, start + n AS "end", {kind} AS kind, hit FROM (
    SELECT k, length(hit) AS n, hit, part, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY k ORDER BY i) AS BIGINT) - length(hit) AS start
    FROM (SELECT k, unnest(string_split_regex(text, '{lit}')[:len(regexp_extract_all(text, '{lit}'))]) AS gap, unnest(regexp_extract_all(text, '{lit}')) AS hit,
                 unnest(regexp_extract_all(text, '{lit}', {group})) AS part, unnest(generate_series(1, len(regexp_extract_all(text, '{lit}')))) AS i
          FROM t WHERE regexp_matches(text, '{lit}')))
  WHERE length(part) >= {least}"""


_BAR = "CASE " + " ".join(f"WHEN regexp_matches(hit, '{CLASSES[k]}') THEN {BARS[k]}" for k in BARS) + " END"
#: DuckDB SQL for the rows of :func:`op6_query`.
OP6_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
base AS ({_duck_spans(ASSIGN, 0, 2, ASSIGN_VALUE)} UNION ALL {_duck_spans(ACCESS, 1)} UNION ALL {_duck_spans(HEX, 2)}),
cand AS ({_duck_spans(CANDIDATE, 3)}),
win AS (
  SELECT k, start, i, hit, list_entropy(string_split(substr(hit, i, {WINDOW}), '')) AS h
  FROM (SELECT k, start, hit, unnest(generate_series(1, length(hit) - {WINDOW} + 1)) AS i FROM cand WHERE NOT {_allowed('hit', "regexp_matches({0}, '{1}')", ", 'g'")})
), own AS (
  SELECT k, start + min(i) - 1 AS start, start + max(i) - 1 + {WINDOW} AS "end", 3 AS kind
  FROM win WHERE h >= {_BAR} - 1e-9 GROUP BY k, win.start
), every AS (
  SELECT k, start, "end", kind FROM base
  UNION ALL SELECT k, start, "end", kind FROM own WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.k = own.k AND b.start <= own.start AND b."end" >= own."end")
), s AS (
  SELECT k, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || start || ':' || "end", ',' ORDER BY start, kind) AS spans,
         string_agg(['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || start || ':' || "end", ',' ORDER BY start, kind) FILTER (kind < 3) AS base
  FROM every GROUP BY k
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN s USING (k)
"""
