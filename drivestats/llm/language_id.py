"""Language identification by error-correcting output codes (operator 2).

Every language has a codeword of +1 and -1; one binary classifier per bit,
linear in hashed character n-grams of lower-cased letters, predicts it. A
classifier's weights are the log-odds of an n-gram between the languages on
its two sides, each language counting alike. Decoding takes the codeword with
the smallest loss over the bits, each bit weighted by how well its classifier
does on the training texts; a small lead over the second codeword marks the
text as ambiguous.

Training uses at most ``max_texts`` texts of each language, chosen by a
hash of the id. The model has ``2 ** bits`` x codeword-length weights, whatever
the input.

Defined cases: texts that are null or have no letter are ``und`` with score 0;
rows without language teach nothing; with no learned language every text is
``und``; repeated rows are each predicted; other columns are not read, whatever
their names.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drivestats.llm.common import bounded_sample, id_remainder, map_arrow, text_chunks
from drivestats.llm.ngrams import letter_codes, ngram_buckets, ngram_spans, span_sums, spread

BITS, ORDERS, MAX_TEXTS = 15, (1, 2, 3), 1500
CHUNK_CHARS = 200_000
#: Evidence of so many n-grams at most: a long text is no surer than this.
SATURATION = 100.0
AMBIGUOUS = 0.6


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages: all splits of few, for more random columns of the best minimum distance."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 6:
        columns = [(1, *c) for c in itertools.product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(columns, np.int8).T
    rng = np.random.default_rng(seed)
    length = int(np.ceil(10 * np.log2(n)))
    best, distance = None, -1
    for _ in range(200):
        code = rng.choice(np.array([1, -1], np.int8), (n, length))
        code = code[:, np.abs(code.sum(0, dtype=int)) < n]
        apart = min(int((code[a] != code[b]).sum()) for a, b in itertools.combinations(range(n), 2))
        if apart > distance:
            best, distance = code, apart
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    bit_weight: np.ndarray


def _bucket_sums(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the rows of ``table`` over the n-grams of each text; how many n-grams."""
    codes, bounds = letter_codes(texts)
    total, count = 0.0, 0
    for n in ORDERS:
        starts, ends = ngram_spans(bounds, n)
        total = total + span_sums(table[ngram_buckets(codes, n, BITS)], starts, ends)
        count = count + (ends - starts)
    return total, count


def _training_counts(languages: list[str]):
    index = {lang: i for i, lang in enumerate(languages)}

    def count(batches):
        sums = np.zeros((len(languages), 1 << BITS), np.int64)
        for b in batches:
            langs, texts = np.array([index[x] for x in b.column(0).to_pylist()], np.int64), b.column(1).to_pylist()
            for first, chunk in text_chunks(texts, CHUNK_CHARS):
                codes, bounds = letter_codes(chunk)
                for n in ORDERS:
                    starts, ends = ngram_spans(bounds, n)
                    at = ngram_buckets(codes, n, BITS)[spread(starts, ends)]
                    of = np.repeat(langs[first : first + len(chunk)], ends - starts)
                    sums += np.bincount(of * (1 << BITS) + at, minlength=sums.size).reshape(sums.shape)
        lang, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(sums[lang, bucket])], ["lang", "bucket", "n"])

    return count


def _margins(texts: list[str], model: LanguageModel) -> np.ndarray:
    """Evidence for each bit: mean log-odds of the n-grams, times their number up to saturation."""
    total, count = _bucket_sums(texts, model.weights)
    count = np.maximum(count, 1)[:, None]
    return total / count * (count / (1 + count / SATURATION))


def _losses(margins: np.ndarray, model: LanguageModel) -> np.ndarray:
    """Weighted logistic loss of each codeword."""
    return np.stack([(np.logaddexp(0, -margins * word) * model.bit_weight).sum(1) for word in model.code], 1)


def train(docs: DataFrame, usable: Column, *, max_texts: int = MAX_TEXTS) -> LanguageModel:
    """A model of the non-null languages of the ``usable`` rows of ``docs`` (doc_id, text, lang)."""
    known = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    named = docs.where(usable & F.col("lang").isNotNull()).select("lang")
    sample = bounded_sample(known.select("doc_id", "lang", "text"), [F.col("doc_id"), F.col("text")], max_texts, "lang", named).select("lang", "text")
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    code = codewords(len(languages))
    if not languages:
        return LanguageModel([], code, np.zeros((1 << BITS, 1), np.float32), np.ones(1))
    rows = map_arrow(sample, _training_counts(languages), "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), 1 << BITS))
    counts[rows["lang"], rows["bucket"]] = rows["n"]
    share = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    floor = 0.5 / max(1.0, counts.sum(1).mean())
    weights = np.empty((1 << BITS, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        plus, minus = code[:, bit] > 0, code[:, bit] < 0
        p = share[plus].mean(0) + floor
        q = (share[minus].mean(0) if minus.any() else 0) + floor
        weights[:, bit] = np.log(p / q)
    model = LanguageModel(languages, code, weights, np.ones(code.shape[1]))
    model.bit_weight = _bit_weights(sample, model)
    return model


def _bit_weights(sample: DataFrame, model: LanguageModel) -> np.ndarray:
    """Log-odds of each bit being right on the training texts, in proportion to their mean."""
    index = {lang: i for i, lang in enumerate(model.languages)}

    def test(batches):
        right, n = np.zeros(model.code.shape[1]), 0
        for b in batches:
            truth = model.code[[index[x] for x in b.column(0).to_pylist()]]
            for first, chunk in text_chunks(b.column(1).to_pylist(), CHUNK_CHARS):
                right += (_margins(chunk, model) * truth[first : first + len(chunk)] > 0).sum(0)
                n += len(chunk)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(right)), pa.int64()), pa.array(right), pa.array([float(n)] * len(right))], ["bit", "right", "n"])

    rows = map_arrow(sample, test, "bit long, right double, n double").groupBy("bit").agg(F.sum("right").alias("right"), F.sum("n").alias("n")).orderBy("bit").toPandas()
    accuracy = np.clip((rows["right"].to_numpy() + 1) / (rows["n"].to_numpy() + 2), 0.51, 0.999)
    odds = np.log(accuracy / (1 - accuracy))
    return odds / odds.mean()


def _predictions(model: LanguageModel):
    def predict(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            langs, scores, unsure = [], [], []
            for _, chunk in text_chunks(texts, CHUNK_CHARS):
                some = [any(map(str.isalpha, t)) for t in chunk]
                if model.languages:
                    losses = _losses(_margins(chunk, model), model)
                    p = np.exp(losses.min(1, keepdims=True) - losses)
                    p /= p.sum(1, keepdims=True)
                for i, ok in enumerate(some):
                    ok = ok and bool(model.languages)
                    langs.append(model.languages[int(losses[i].argmin())] if ok else "und")
                    scores.append(float(p[i].max()) if ok else 0.0)
                    unsure.append(not ok or scores[-1] < AMBIGUOUS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())], ["doc_id", "lang_pred", "score", "ambiguous"]
            )

    return predict


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every row of ``docs`` (doc_id, text)."""
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _predictions(model), "doc_id long, lang_pred string, score double, ambiguous boolean")


def _accepted(names: list[str], text_at: int, model: LanguageModel):
    label = _predictions(model)

    def keep(batches):
        for b in batches:
            made = next(label(iter([pa.RecordBatch.from_arrays([pa.nulls(b.num_rows, pa.int64()), b.column(text_at)], ["doc_id", "text"])])))
            yield pa.RecordBatch.from_arrays(b.columns, names).filter(pc.invert(made.column(3)))

    return keep


def with_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is neither undetermined nor ambiguous."""
    return map_arrow(docs, _accepted(docs.columns, docs.columns.index("text"), model), docs.schema)


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 3) == 1
