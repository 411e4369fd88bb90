"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios (operator 9).

A text is the set of its hashed character n-grams (of lower-cased letters with
word edges). Each n-gram's log-count ratio compares in how many toxic and
other training texts it occurs; the most telling ones, by the likelihood ratio
of their counts, are the features, with the ratio as their value. A logistic
regression with a quadratic penalty is fitted on them.

Training uses at most ``max_texts`` labelled texts, chosen by a hash of
the id; counts are summed on executors, and the driver fits the regression on
the features of those texts alone. Whole texts are scored.

Defined cases: null and empty texts score as a text without features; rows
without a label teach nothing; without both labels every text scores the share
of toxic ones (0.5 if there is none); repeated rows are each scored; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivestats.llm.common import bounded_sample, id_remainder, map_arrow, text_chunks, written
from drivestats.llm.ngrams import letter_codes, ngram_buckets, ngram_spans, spread

BITS, ORDERS = 18, (3, 4, 5)
MAX_TEXTS, FEATURES = 8000, 4096
#: What an n-gram has to reach in the likelihood ratio to be a feature: chance alone hardly gets there.
MIN_RATIO = 20.0
CHUNK_CHARS = 300_000
THRESHOLD = 0.3


@dataclass
class ToxicityModel:
    weights: np.ndarray  # by bucket; 0 for what is no feature
    bias: float


def text_features(texts: list[str], feature: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the distinct n-grams of each text, of those marked in ``feature`` only if given."""
    codes, bounds = letter_codes(texts)
    pairs = []
    for n in ORDERS:
        starts, ends = ngram_spans(bounds, n)
        at = ngram_buckets(codes, n, BITS)[spread(starts, ends)]
        of = np.repeat(np.arange(len(texts)), ends - starts)
        if feature is not None:
            of, at = of[feature[at]], at[feature[at]]
        pairs.append((of << BITS) | at)
    found = np.unique(np.concatenate(pairs))
    return found >> BITS, found & ((1 << BITS) - 1)


def _text_counts(batches):
    sums = np.zeros((2, 1 << BITS), np.int64)
    texts_of = np.zeros(2, np.int64)
    for b in batches:
        toxic, texts = b.column(0).to_numpy(), b.column(1).to_pylist()
        texts_of += np.bincount(toxic, minlength=2)
        for first, chunk in text_chunks(texts, CHUNK_CHARS):
            text, bucket = text_features(chunk)
            sums += np.bincount((toxic[first : first + len(chunk)][text] << BITS) | bucket, minlength=sums.size).reshape(sums.shape)
    bucket = np.flatnonzero(sums.any(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(bucket, -1)), pa.array(np.append(sums[1, bucket], texts_of[1])), pa.array(np.append(sums[0, bucket], texts_of[0]))], ["bucket", "toxic", "other"]
    )


def _sparse_rows(feature_index: np.ndarray):
    def make(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            for first, chunk in text_chunks(texts, CHUNK_CHARS):
                text, bucket = text_features(chunk, feature_index >= 0)
                ends = np.searchsorted(text, np.arange(len(chunk) + 1))
                columns = feature_index[bucket].astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(columns))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(chunk)), values], ["toxic", "features"])

    return make


def _likelihood_ratio(p: np.ndarray, q: np.ndarray, n_p: float, n_q: float) -> np.ndarray:
    """How far counts p of n_p and q of n_q are from one common rate (G squared)."""
    rate = (p + q) / (n_p + n_q)

    def part(k, n, r):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.nan_to_num(k * np.log(k / (n * r))) + np.nan_to_num((n - k) * np.log((n - k) / (n * (1 - r))))

    return part(p, n_p, rate) + part(q, n_q, rate)


def fit_logistic(starts: np.ndarray, columns: np.ndarray, values: np.ndarray, y: np.ndarray, penalty: float, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on sparse rows, by accelerated gradient steps.

    ``values`` scales each column; a row lists its columns. Step sizes follow
    the largest sum of squares in a row, which bounds the curvature.
    """
    rows = np.repeat(np.arange(len(y)), np.diff(starts))
    x = values[columns]
    n = len(y)
    squares = np.bincount(rows, weights=x * x, minlength=n)
    rate = 1.0 / (0.25 * (np.mean(squares) + 1) + penalty)
    w = np.zeros(len(values) + 1)
    previous, momentum = w.copy(), w.copy()

    def loss_gradient(w):
        z = np.bincount(rows, weights=x * w[:-1][columns], minlength=n) + w[-1]
        p = 1 / (1 + np.exp(-z))
        loss = np.mean(np.logaddexp(0, z) - y * z) + penalty / 2 * (w[:-1] @ w[:-1])
        g = (p - y) / n
        return loss, np.append(np.bincount(columns, weights=x * g[rows], minlength=len(values)) + penalty * w[:-1], g.sum())

    for t in range(steps):
        momentum = w + t / (t + 3) * (w - previous)
        loss, gradient = loss_gradient(momentum)
        while True:  # shorter steps until the loss falls as it should
            new = momentum - rate * gradient
            if loss_gradient(new)[0] <= loss - rate / 2 * (gradient @ gradient) + 1e-12 or rate < 1e-9:
                break
            rate /= 2
        previous, w = w, new
        rate *= 1.2
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, usable: Column, *, max_texts: int = MAX_TEXTS, penalty: float = 1e-3) -> ToxicityModel:
    """A model of the ``usable`` rows of ``docs`` (doc_id, text) with a label (doc_id, toxic)."""
    marked = labels.where("toxic IN (0, 1)").select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("long").alias("toxic"))
    n = marked.count()
    own = docs.where(usable).select("doc_id", "text")
    if n > max_texts:
        # At most max_texts ids; their rows are found by id, and bounded again in case an id has very many.
        ids = bounded_sample(marked.where("label_id IS NOT NULL").select("label_id"), [F.col("label_id")], max_texts)
        marked = written(marked.join(F.broadcast(ids), "label_id", "left_semi").distinct(), "toxicity_ids")
        own = own.join(F.broadcast(marked.select(F.col("label_id").alias("doc_id")).distinct()), "doc_id", "left_semi")
    sample = own.join(marked.distinct(), own["doc_id"] == marked["label_id"]).select("toxic", F.coalesce("text", F.lit("")).alias("text"))
    # Copies of a text with the same label teach no more than one.
    sample = written(sample.dropDuplicates(["toxic", "text"]), "toxicity_sample")
    sample = bounded_sample(sample, [F.col("toxic"), F.col("text")], max_texts)
    counts = map_arrow(sample, _text_counts, "bucket long, toxic long, other long").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toPandas()
    totals = counts[counts["bucket"] == -1]
    n_p, n_q = float(totals["toxic"].sum()), float(totals["other"].sum())
    if not n_p or not n_q:
        share = n_p / (n_p + n_q) if n_p + n_q else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    counts = counts[counts["bucket"] >= 0]
    p, q, bucket = counts["toxic"].to_numpy(float), counts["other"].to_numpy(float), counts["bucket"].to_numpy()
    telling = _likelihood_ratio(p, q, n_p, n_q)
    best = np.lexsort((bucket, -telling))[:FEATURES]
    best = best[telling[best] >= MIN_RATIO]
    ratio = np.log((p[best] + 1) / (p.sum() + 1)) - np.log((q[best] + 1) / (q.sum() + 1))
    index = np.full(1 << BITS, -1, np.int32)
    index[bucket[best]] = np.arange(len(best))
    rows = map_arrow(sample, _sparse_rows(index), "toxic long, features array<int>").toArrow()
    features = rows.column("features").combine_chunks()
    starts = np.concatenate(([0], np.cumsum(pc.list_value_length(features).to_numpy(zero_copy_only=False))))
    weights, bias = fit_logistic(starts, features.flatten().to_numpy(zero_copy_only=False), ratio, rows.column("toxic").to_numpy().astype(float), penalty)
    out = np.zeros(1 << BITS, np.float32)
    out[bucket[best]] = weights * ratio
    return ToxicityModel(out, bias)


def _scores(model: ToxicityModel):
    def score(batches):
        feature = model.weights != 0
        for b in batches:
            texts, out = [t or "" for t in b.column(1).to_pylist()], []
            for _, chunk in text_chunks(texts, CHUNK_CHARS):
                text, bucket = text_features(chunk, feature)
                z = np.bincount(text, weights=model.weights[bucket], minlength=len(chunk)) + model.bias
                out.append(1 / (1 + np.exp(-np.clip(z, -50, 50))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(out) if out else [], pa.float64())], ["doc_id", "score"])

    return score


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _scores(model), "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 4) == 2
