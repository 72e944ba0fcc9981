"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a segment in both directions and labels every position with a
probability for each language; a document's probability pools the log-probabilities of all its
positions. Segments are the words of a text, each with the white space before it as one space (the state
starts anew there; longer words are read in pieces), so every position has a label, and those of a word
are computed once and pooled wherever it recurs: a whole text costs one look-up per word. The positions
of a word are not independent, so a word counts by the mean over its positions.

It is trained in numpy by backpropagation through time on a bounded sample of the labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, crc32_of_id, text_batches

UNKNOWN = "und"
#: Documents of each language in the training sample, about, and word occurrences drawn from them.
DOCS_PER_LANG, WORDS = 1500, 120_000
HIDDEN, EPOCHS, BATCH, RATE = 16, 3, 256, 0.01
#: Bytes of a segment at most; segments whose labels a worker remembers.
SEGMENT, MEMO = 32, 1 << 18


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


@dataclass
class Gru:
    """One direction: ``table`` holds each byte's input to the gates (update, reset, candidate)."""

    table: np.ndarray
    recur: np.ndarray

    @classmethod
    def new(cls, hidden: int, rng: np.random.Generator) -> Gru:
        return cls(rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32), rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32))

    def forward(self, ids: np.ndarray, keep: bool = False):
        """States (time, batch, hidden) of byte ids (batch, time); with ``keep``, what back needs."""
        n, steps = ids.shape
        k = self.recur.shape[0]
        h, out, tape = np.zeros((n, k), np.float32), [], []
        for t in range(steps):
            x, u = self.table[ids[:, t]], h @ self.recur
            gates = _sigmoid(x[:, : 2 * k] + u[:, : 2 * k])
            z, r, hu = gates[:, :k], gates[:, k:], u[:, 2 * k :]
            c = np.tanh(x[:, 2 * k :] + r * hu)
            new = c + z * (h - c)
            if keep:
                tape.append((z, r, c, hu, h))
            out.append(new)
            h = new
        return np.stack(out), tape

    def backward(self, ids: np.ndarray, tape, d_out: np.ndarray):
        """Gradients of ``table`` and ``recur``, through time, for the gradient of all states."""
        k = self.recur.shape[0]
        d_table, d_recur = np.zeros_like(self.table), np.zeros_like(self.recur)
        dh = np.zeros_like(d_out[0])
        for t in range(len(tape) - 1, -1, -1):
            z, r, c, hu, h = tape[t]
            dh = dh + d_out[t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * hu * r * (1 - r)
            du = np.concatenate((dz, dr, dc * r), axis=1)
            np.add.at(d_table, ids[:, t], np.concatenate((dz, dr, dc), axis=1))
            d_recur += h.T @ du
            dh = dh * z + du @ self.recur.T
        return d_table, d_recur


@dataclass
class Model:
    langs: list[str]
    ahead: Gru
    back: Gru
    out: np.ndarray
    bias: np.ndarray

    def labels(self, ids: np.ndarray) -> np.ndarray:
        """Log-probabilities (time, batch, language) of every position of equally long segments."""
        a, b = self.ahead.forward(ids)[0], self.back.forward(ids[:, ::-1])[0][::-1]
        return _log_softmax(np.concatenate((a, b), axis=2) @ self.out + self.bias)

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """Mean log-probabilities over the positions of each word (word, language)."""
        total = np.zeros((len(words), len(self.langs)), np.float32)
        by_length: dict[int, list[tuple[int, bytes]]] = {}
        for i, word in enumerate(words):
            for part in segments(word):
                by_length.setdefault(len(part), []).append((i, part))
        for length, parts in by_length.items():
            for k in range(0, len(parts), 4096):
                some = parts[k : k + 4096]
                ids = np.frombuffer(b"".join(p for _, p in some), np.uint8).reshape(-1, length)
                np.add.at(total, [i for i, _ in some], self.labels(ids).sum(axis=0))
        return total / np.array([[len(w) + 1] for w in words], np.float32)


def segments(word: bytes) -> list[bytes]:
    """A word behind its space, in pieces of :data:`SEGMENT` bytes at most."""
    spaced = b" " + word
    return [spaced[k : k + SEGMENT] for k in range(0, len(spaced), SEGMENT)]


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def train(words: list[bytes], langs: list[str], seed: int = 11, hidden: int = HIDDEN, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE) -> Model:
    """Fit a model to (word, language) pairs; every position of a word has the word's language.

    Batches hold segments of one length. Adam on the mean cross-entropy of the positions.
    """
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    number = {x: i for i, x in enumerate(names)}
    model = Model(names, Gru.new(hidden, rng), Gru.new(hidden, rng), rng.normal(0, 0.2, (2 * hidden, len(names))).astype(np.float32), np.zeros(len(names), np.float32))
    params = [model.ahead.table, model.ahead.recur, model.back.table, model.back.recur, model.out, model.bias]
    m1, m2, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    by_length: dict[int, list[tuple[bytes, int]]] = {}
    for word, lang in zip(words, langs):
        for part in segments(word):
            by_length.setdefault(len(part), []).append((part, number[lang]))
    sets = [(np.frombuffer(b"".join(w for w, _ in v), np.uint8).reshape(-1, n), np.array([y for _, y in v])) for n, v in sorted(by_length.items())]
    for epoch in range(epochs):
        todo = [(s, rows) for s, (_, y) in enumerate(sets) for rows in np.array_split(rng.permutation(len(y)), -(-len(y) // batch))]
        for k in rng.permutation(len(todo)):
            s, rows = todo[k]
            ids, y = sets[s][0][rows], sets[s][1][rows]
            (a, tape_a), (b, tape_b) = model.ahead.forward(ids, True), model.back.forward(ids[:, ::-1], True)
            states = np.concatenate((a, b[::-1]), axis=2)
            d = np.exp(_log_softmax(states @ model.out + model.bias))
            d[:, np.arange(len(y)), y] -= 1
            d /= d.shape[0] * d.shape[1]
            flat, d_flat = states.reshape(-1, 2 * hidden), d.reshape(-1, len(names))
            d_states = d @ model.out.T
            grads = [*model.ahead.backward(ids, tape_a, d_states[:, :, :hidden]), *model.back.backward(ids[:, ::-1], tape_b, d_states[::-1, :, hidden:]), flat.T @ d_flat, d_flat.sum(axis=0)]
            step += 1
            lr = rate / (1 + epoch)
            for p, g, m, v in zip(params, grads, m1, m2):
                g = np.clip(g, -1, 1)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG, words: int = WORDS, seed: int = 11) -> Model | None:
    """Train on a sample of the rows with a language: about ``docs_per_lang`` rows of each.

    Of their words, ``words`` occurrences at most reach the driver, very long ones in pieces, of which
    each is drawn for itself. None if no row has both a language and a word.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, docs_per_lang / n))))
    unit = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.where(unit(F.col("text")) < share[F.col("lang")])
    each = max(1, words // len(counts))
    occurrences = rows.select("lang", F.xxhash64("text").alias("k"), F.posexplode(F.split("text", r"[\x20\x09-\x0D]+")).alias("at", "whole")).where("whole != ''")
    pieces = F.transform(F.sequence(F.lit(0), F.expr(f"(length(whole) - 1) div {SEGMENT}")), lambda i: F.substring("whole", (i * SEGMENT + 1).cast("int"), F.lit(SEGMENT)))
    occurrences = occurrences.select("lang", "k", "at", F.posexplode(pieces).alias("part", "word"))
    sizes = {r["lang"]: r["n"] for r in occurrences.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, each / n))))
    order = unit(F.col("k"), F.col("at"), F.col("part"))
    drawn = occurrences.where(order < share[F.col("lang")]).select("lang", F.encode("word", "UTF-8").alias("word"), order.alias("o"))
    found = drawn.orderBy("o", "lang", "word").limit(2 * words).toPandas()
    return train([bytes(w) for w in found["word"]], found["lang"].tolist(), seed)


def predict_udf(model: Model | None):
    """(lang, score) of whole texts."""
    schema = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    ids: dict[bytes, int] = {}  # of this task's words, whose scores are rows of table[0]
    table = [np.zeros((0, len(model.langs) if model else 0), np.float32)]

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        out = []
        docs = [(t or b"").split() for t in as_bytes(texts)]
        new = list({w for words in docs for w in words} - ids.keys()) if model else []
        if len(ids) + len(new) > MEMO:
            ids.clear()
            table[0] = table[0][:0]
            new = list({w for words in docs for w in words})
        ids.update(zip(new, range(len(ids), len(ids) + len(new))))
        if new:
            table[0] = np.concatenate((table[0], model.word_scores(new)))
        for words, text in zip(docs, texts.to_pylist()):
            if not model or text is None or not any(map(str.isalpha, text)):
                out.append({"lang": UNKNOWN, "score": 0.0})
                continue
            total = table[0][[ids[w] for w in words]].sum(axis=0, dtype=np.float64)
            p = np.exp(_log_softmax(total))
            best = int(np.argmax(p))
            out.append({"lang": model.langs[best], "score": float(p[best])})
        return pa.array(out, schema)

    return predict


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with ``out``: (lang, score). Null texts and texts without a letter are ``und``, 0.

    With no model (nothing to learn from) every text is ``und``. Repeated rows get equal results.
    All columns stay, but one already named ``out`` is replaced.
    """
    text_batches(docs.sparkSession)
    return docs.withColumn(out, predict_udf(model)(F.col(text_col).cast("string")))


def op7_query(docs: DataFrame) -> DataFrame:
    """Learn from rows that are not held out; predict all."""
    held = F.pmod(crc32_of_id(), F.lit(5)) == 0
    model = fit(docs.where(~held).select("text", "lang"))
    found = identify(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
