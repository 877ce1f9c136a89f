"""Toxicity by non-negative positive-unlabelled learning.

A linear model over hashed words and word beginnings is trained in numpy from
confirmed toxic texts and unlabelled texts. The risk of the unlabelled side is
corrected by the class prior and kept from going negative: where the corrected
part turns below zero its gradient is reversed, so the model stops fitting
unlabelled toxic texts as clean ones. Training rows are a bounded sample of the
labelled rows, picked by hash: confirmed toxic ones, and rows of any label whose
label is not looked at, which are the unlabelled side. The bias is set on sampled
documents that took no part in training, so that the contract's cut parts their
labels best. Spark hashes the whole texts to features; every document is then
scored by Spark tasks, whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches

#: Feature places, and lengths of word beginnings that are features beside whole words.
BITS = 18
STARTS = (4, 5, 6, 7, 8)
#: Labelled rows used as confirmed toxic and as unlabelled texts, at most: the bound of the sample.
MAX_POSITIVE, MAX_UNLABELLED = 2_500, 6_000
#: Features that a step of the gradient handles at once: bounds the driver's memory beside the sample.
STRIDE = 1 << 20
#: One in so many sampled documents is kept from training; the bias is set on those and their labels.
ASIDE = 4
#: Steps; DECAY is divided by the number of training rows.
EPOCHS, RATE, DAMP, DECAY = 120, 0.25, 0.5, 0.4
CUT = 0.3
#: Words kept in a worker's cache of word weights.
CACHE = 400_000

_LETTERS = re.compile(r"[^\W\d_]+").findall


def features(word: str) -> list[int]:
    """Places of a lower-case word and of its beginnings."""
    mask = (1 << BITS) - 1
    return [zlib.crc32(b"w" + word.encode()) & mask] + [zlib.crc32(word[:k].encode()) & mask for k in STARTS if len(word) >= k]


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("use", pa.string()), ("n", pa.int32()), ("at", pa.binary())])
    for batch in batches:
        ats, ns = [], []
        for text in batch.column("text"):
            words = set(_LETTERS(text.as_py().lower()))
            ns.append(len(words))
            ats.append(np.sort(np.array([f for w in words for f in features(w)], "<i4")).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("use"), pa.array(ns, pa.int32()), pa.array(ats, schema.field("at").type)], schema=schema)


class Model:
    """Score of a text: logistic of bias + sum of its distinct words' weights over the root of their number."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias
        self.known: dict[str, float] = {}

    def score(self, text: str) -> float:
        words = set(_LETTERS(text.lower()))
        known = self.known
        total = 0.0
        for w in words:
            g = known.get(w)
            if g is None:
                if len(known) >= CACHE:
                    known.clear()
                g = known[w] = float(self.weights[features(w)].sum())
            total += g
        z = self.bias + total / max(1.0, len(words)) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


class Sample:
    """Features of training texts in one flat array, walked in strides of whole texts."""

    def __init__(self, at: np.ndarray, ends: np.ndarray, n_words: np.ndarray, positive: np.ndarray) -> None:
        self.at, self.ends, self.positive = at, ends.astype(np.int64), positive
        self.scale = 1 / np.sqrt(np.maximum(1, n_words))
        cuts = np.searchsorted(self.ends, np.arange(0, int(self.ends[-1]) if len(self.ends) else 0, STRIDE), "right")
        self.strides = np.unique(np.concatenate([[0], cuts, [len(self.ends)]])).astype(int)

    def _each(self):
        for lo, hi in zip(self.strides[:-1], self.strides[1:]):
            start = int(self.ends[lo - 1]) if lo else 0
            size = np.diff(np.concatenate([[start], self.ends[lo:hi]]))
            yield lo, hi, self.at[start : int(self.ends[hi - 1])], np.repeat(np.arange(hi - lo), size)

    def sums(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.ends))
        for lo, hi, at, owner in self._each():
            out[lo:hi] = np.bincount(owner, w[at], hi - lo)
        return out * self.scale

    def gradient(self, g: np.ndarray) -> np.ndarray:
        out = np.zeros(1 << BITS)
        for lo, hi, at, owner in self._each():
            out += np.bincount(at, (g[lo:hi] * self.scale[lo:hi])[owner], 1 << BITS)
        return out


def slopes(z: np.ndarray, p: np.ndarray, prior: float) -> np.ndarray:
    """What each text's score adds to the gradient of prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]), with logistic loss.

    Where the second part is below zero, it alone is turned back: its gradient is reversed.
    """
    hot = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    lost_clean = np.logaddexp(0, z)
    g, clean = np.zeros(len(z)), np.zeros(len(z))
    clean[~p] = hot[~p] / max(1, (~p).sum())
    risk = lost_clean[~p].mean() if (~p).any() else 0.0
    if p.any():
        g[p] = prior * (hot[p] - 1) / p.sum()
        clean[p] = -prior * hot[p] / p.sum()
        risk -= prior * lost_clean[p].mean()
    return g + clean if risk >= 0 else -clean


def fit(sample: Sample, aside: Sample, prior: float) -> Model:
    """Adam steps on the non-negative risk; the mean of the later ones, with the bias that suits the texts set aside."""
    p = sample.positive
    w, b = np.zeros(1 << BITS), float(np.log(prior / (1 - prior)))
    mean_w, mean_b = np.zeros_like(w), 0.0
    m1, m2, s1, s2 = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for k in range(1, EPOCHS + 1):
        g = slopes(b + sample.sums(w), p, prior)
        gw = sample.gradient(g) + DECAY / max(1, len(p)) * w
        gb = g.sum()
        m1, m2 = 0.9 * m1 + 0.1 * gw, 0.999 * m2 + 0.001 * gw * gw
        s1, s2 = 0.9 * s1 + 0.1 * gb, 0.999 * s2 + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**k, 1 - 0.999**k
        pace = np.sqrt(m2 / c2)
        w -= RATE * (m1 / c1) / (pace + DAMP * pace.max() + 1e-10)  # damped, so that words of a few texts move less
        b -= RATE * (s1 / c1) / (np.sqrt(s2 / c2) + 1e-10)
        if k > EPOCHS // 2:  # the mean of the later steps: reversed gradients make single ones jump
            mean_w += w
            mean_b += b
    w, b = mean_w / (EPOCHS - EPOCHS // 2), mean_b / (EPOCHS - EPOCHS // 2)
    z = (aside if len(aside.ends) else sample).sums(w)
    if aside.positive.any() and not aside.positive.all():
        return Model(w, float(np.log(CUT / (1 - CUT)) - best_cut(z, aside.positive)))
    # without labels on both sides: the mean score is the share of toxic ones
    low, high = -20.0, 20.0
    for _ in range(50 if len(z) else 0):
        mid = (low + high) / 2
        low, high = (low, mid) if (1 / (1 + np.exp(-np.clip(z + b + mid, -40, 40)))).mean() > prior else (mid, high)
    return Model(w, float(b + (low + high) / 2))


def best_cut(z: np.ndarray, positive: np.ndarray) -> float:
    """The value above which texts count as toxic with the best harmonic mean of precision and recall, halfway to the next text."""
    order = np.argsort(-z, kind="stable")
    hits, size = np.cumsum(positive[order]), np.arange(1, len(z) + 1)
    k = int(np.argmax(2 * hits / (size + positive.sum())))
    below = z[order[k + 1]] if k + 1 < len(z) else z[order[k]] - 1
    return float((z[order[k]] + below) / 2)


def _fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of the labels outside the held-out fold; None without a toxic one."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(_fold() != 2)
    known = materialize(known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    share = known.agg(F.avg("toxic")).first()[0]
    if not share:
        return None
    prior = min(0.9, float(share))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # ids only while the sample is picked; texts follow for the picked ones
    aside = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(ASIDE)) == 0
    picked_p = known.where("toxic = 1").orderBy(F.xxhash64("doc_id", F.lit(11))).limit(MAX_POSITIVE).where(~aside).select("doc_id", F.lit("positive").alias("use"))
    picked_u = known.orderBy(F.xxhash64("doc_id", F.lit(12))).limit(MAX_UNLABELLED).select("doc_id", F.when(aside & (F.col("toxic") == 1), "aside, toxic").when(aside, "aside").otherwise("unlabelled").alias("use"))
    picked = materialize(picked_p.union(picked_u))
    bound = F.broadcast(picked)  # at most MAX_POSITIVE + MAX_UNLABELLED ids
    rows = texts.join(bound, "doc_id").select("use", "text").mapInArrow(_featurize, "use string, n int, at binary").toArrow()
    use, n = np.array(rows.column("use").to_pylist(), object), rows.column("n").to_numpy().astype(float)
    flat = [np.frombuffer(x.as_buffer(), "<i4") for x in rows.column("at")]

    def sample(which: np.ndarray) -> Sample:
        own = [flat[i] for i in np.flatnonzero(which)]
        return Sample(np.concatenate(own) if own else np.zeros(0, np.int32), np.cumsum([len(x) for x in own]), n[which], np.isin(use[which], ["positive", "aside, toxic"]))

    apart = np.isin(use, ["aside", "aside, toxic"])
    return fit(sample(~apart), sample(apart), prior)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of documents.

    Null texts are empty; they get the score of a text without words. Texts of
    any length are used whole, in training too. A null doc_id is not held out.
    Other columns are ignored. Without toxic labels every score is 0. Rows that
    repeat, and labels that repeat or contradict, count once for each document
    in training, as toxic if any label says so.
    """
    spark = docs.sparkSession
    small_batches(spark)
    model = train(docs, labels)
    weights = (model.weights.astype(np.float32), model.bias) if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*weights) if weights else None
        for batch in batches:
            scores = [own.score(t.as_py()) if own else 0.0 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= CUT) for s in scores], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(_fold() == 2, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
