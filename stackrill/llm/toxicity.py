"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts are used as labels; the rest is a sample of all texts, whatever their
label. With the class prior p, the risk of a classifier f under a loss l is estimated as

    p * E_toxic[l(f)] + max(0, E_all[l(-f)] - p * E_toxic[l(-f)])

whose second term, the risk on non-toxic texts, may not go below zero; where a batch takes it below,
the step goes back up instead. Linear classifiers over the presence of words and frequent word beginnings,
fitted in numpy from several starts, are averaged. Features and prior come from counts in Spark; a text is scored whole.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, as_bytes, crc32_of_id, small, text_batches

THRESHOLD = 0.3
#: Rows of each kind in the training sample, about; words used as features; fits averaged.
POSITIVE, UNLABELLED, FEATURES, FITS = 6000, 12_000, 2000, 3
#: A feature occurs in at least so many toxic texts of the sample, at so many times the rate of all
#: texts, and more often by as many standard errors as chance alone would bring among all features.
LEAST_TEXTS, LEAST_LIFT = 3, 2.0
#: Lengths, in bytes, of the word beginnings that are features beside the words: they find stems.
STEMS = (4, 5, 6)
#: A beginning is a feature of a text if at least this share of its words have it.
STEM_SHARE = 0.01
EPOCHS, BATCH, RATE, DECAY = 30, 256, 0.05, 1e-4
#: Steps that a fit takes at least, however small its sample.
STEPS = 400
#: Share of a row's features that a training step leaves out, so that texts with few are learnt too.
DROPOUT = 0.6

#: Bytes of a text -> words: ASCII letters lower-cased, bytes of other characters kept, else a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> set[bytes]:
    """The distinct words of a whole text, and their beginnings that are frequent in it, with a ``*``."""
    words = Counter((text or b"").translate(_LETTERS).split())
    least, out = STEM_SHARE * words.total(), set(words)
    for n in STEMS:
        stems: dict[bytes, int] = {}
        for w, times in words.items():
            if len(w) > n:
                stems[w[:n]] = stems.get(w[:n], 0) + times
        out.update(w + b"*" for w, times in stems.items() if times >= least)
    return out


@dataclass
class Model:
    words: list[bytes]
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, texts: list[bytes | None]) -> list[float]:
        at, out = {w: i for i, w in enumerate(self.words)}, []
        for text in texts:
            rows = sorted(at[w] for w in words_of(text) if w in at)
            f = self.weights[:, rows].sum(axis=1) + self.bias
            out.append(float((1 / (1 + np.exp(-np.clip(f, -30, 30)))).mean()))
        return out


def fit_nnpu(positive: list[list[int]], every: list[list[int]], n_features: int, prior: float, seed: int, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE) -> tuple[np.ndarray, float]:
    """Weights and bias of one linear classifier; logistic loss, Adam."""
    rng = np.random.default_rng(seed)
    dense = lambda rows: _dense(rows, n_features) * (rng.random((len(rows), n_features), np.float32) >= DROPOUT)
    w, b = rng.normal(0, 0.01, n_features), float(np.log(prior / (1 - prior)))
    m1, m2, step = np.zeros(n_features + 1), np.zeros(n_features + 1), 0
    for _ in range(max(epochs, -(-STEPS // -(-len(every) // batch)))):
        order = rng.permutation(len(every))
        for k in range(0, len(order), batch):
            u = dense([every[i] for i in order[k : k + batch]])
            p = dense([positive[i] for i in rng.integers(0, len(positive), min(batch, len(positive)))])
            fu, fp = u @ w + b, p @ w + b
            su, sp = 1 / (1 + np.exp(-fu)), 1 / (1 + np.exp(-fp))
            rest = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            g_rest_u, g_rest_p = su / len(su), -prior * sp / len(sp)
            if rest >= 0:
                gu, gp = g_rest_u, g_rest_p - prior * (1 - sp) / len(sp)
            else:
                gu, gp = -g_rest_u, -g_rest_p
            grad = np.append(gu @ u + gp @ p + DECAY * w, gu.sum() + gp.sum())
            step += 1
            m1 += 0.1 * (grad - m1)
            m2 += 0.001 * (grad * grad - m2)
            move = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
            w -= move[:-1]
            b -= move[-1]
    return w, b


def _dense(rows: list[list[int]], n: int) -> np.ndarray:
    out = np.zeros((len(rows), n), np.float32)
    for i, r in enumerate(rows):
        out[i, r] = 1
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", positive: int = POSITIVE, unlabelled: int = UNLABELLED, features: int = FEATURES, fits: int = FITS, prior: float | None = None) -> Model | None:
    """Learn from about ``positive`` toxic rows and ``unlabelled`` of all rows, drawn by hash of id.

    The prior is the toxic share of all labelled rows, held between 0.005 and 0.9 so that the risk is
    defined, unless given. None without toxic texts or without a word that tells them apart. Rows
    without an id are in neither sample; null texts are empty; repeated rows count each.
    """
    spark = docs.sparkSession
    text_batches(spark)
    known = labels.select(F.col(id_col).alias("id"), F.col(toxic_col).alias("toxic")).where("toxic IS NOT NULL")
    n, n_toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)), F.lit(0))).head()
    if not n_toxic:
        return None
    prior = min(0.9, max(0.005, n_toxic / n)) if prior is None else prior
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    unit = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)

    def split(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array([list(words_of(t)) for t in as_bytes(batch.column("text"))], pa.list_(pa.binary()))], ["p", "words"])

    with Scratch(spark) as temp:
        chosen = temp.stored(known.where("toxic = 1").where(unit < min(1.0, positive / n_toxic)).select("id").distinct(), "toxic-ids")
        sample = rows.join(small(chosen, 24), "id").select("text", F.lit(1).alias("p"))
        sample = sample.unionByName(rows.where(unit < min(1.0, unlabelled / max(1, docs.count()))).select("text", F.lit(0).alias("p")))
        sets = temp.stored(sample.mapInArrow(split, "p int, words array<binary>"), "toxic-words")
        sizes = {r["p"]: r["n"] for r in sets.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not sizes.get(1) or not sizes.get(0):
            return None
        counts = sets.select("p", F.explode("words").alias("word")).groupBy("word").agg(F.sum("p").alias("toxic"), F.sum(1 - F.col("p")).alias("rest"))
        counts = temp.stored(counts.where("toxic > 0"), "toxic-counts")
        # Words by how far their rate among toxic texts is above that among all, in standard errors.
        a, b = F.col("toxic") / float(sizes[1]), F.col("rest") / float(sizes[0])
        pooled = (F.col("toxic") + F.col("rest")) / float(sizes[0] + sizes[1])
        far = (a - b) / F.sqrt(pooled * (1 - pooled) * (1 / sizes[0] + 1 / sizes[1]) + 1e-12)
        bar = math.sqrt(2 * math.log(max(2, counts.count())))
        apart = counts.where((F.col("toxic") >= LEAST_TEXTS) & (a >= LEAST_LIFT * b)).select("word", far.alias("far")).where(F.col("far") >= bar)
        words = [bytes(r["word"]) for r in apart.orderBy(F.col("far").desc(), "word").limit(features).collect()]
        if not words:
            return None
        at = {w: i for i, w in enumerate(words)}

        def index(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array([[at[w] for w in found if w in at] for found in batch.column("words").to_pylist()], pa.list_(pa.int32()))], ["p", "rows"])

        coded = sets.mapInArrow(index, "p int, rows array<int>").toPandas()
    pos, rest = (sorted(sorted(map(int, r)) for r in coded.loc[coded["p"] == k, "rows"]) for k in (1, 0))
    found = [fit_nnpu(pos, rest, len(words), prior, seed) for seed in range(fits)]
    return Model(words, np.array([w for w, _ in found]), np.array([b for _, b in found]))


def score(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with ``out`` from 0 to 1, higher for likelier toxic.

    Null texts count as empty and get the score of a text without known words; without a model
    (no toxic text to learn from) every score is 0. Repeated rows get equal scores. All columns
    stay, but one already named ``out`` is replaced.
    """
    text_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(as_bytes(texts)) if model else [0.0] * len(texts), pa.float64())

    return docs.withColumn(out, of(F.col(text_col).cast("string")))


def op9_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from rows that are not held out; score all."""
    held = lambda c: F.pmod(crc32_of_id(c), F.lit(4)) == 2
    model = fit(docs.where(~held("doc_id")).select("doc_id", "text"), labels.where(~held("doc_id")).select("doc_id", "toxic"))
    scored = score(docs.select("doc_id", held("doc_id").alias("held_out"), "text"), model, out="score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
