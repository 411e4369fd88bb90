"""Hashed character n-grams of many texts at once (NumPy, inside tasks)."""

from __future__ import annotations

import numpy as np

from drivestats.llm.common import worker_cache
from drivestats.llm.textvec import U, mix64


def _letter_table() -> np.ndarray:
    cache = worker_cache()
    if "letters" not in cache:
        cache["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return cache["letters"]


def letter_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of all texts, every run of other characters as one 0; and where each text starts (with the end).

    A text starts and ends with 0, so n-grams see word edges; two texts share the 0 between them.
    """
    lowered = [t.lower() for t in texts]
    joined = "\n".join(["", *lowered, ""])
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letter_table()[cp], cp, 0)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    # The separator of two texts stays, as the 0 after the first one.
    starts = np.cumsum([0] + [len(t) + 1 for t in lowered])  # of the separators before each text, and after the last
    place = np.cumsum(keep) - 1
    return codes[keep].astype(np.uint64), place[starts]


def ngram_buckets(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The bucket of each n-gram of ``codes``, by where it starts."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    h = np.full(size, n, U)
    for j in range(n):
        h = h * U(0x9E3779B97F4A7C15) + codes[j : j + size]
    return (mix64(h) >> U(64 - bits)).astype(np.int64)


def ngram_spans(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each text's n-grams, by where they start; all of an n-gram lies in its text and the 0 on either side."""
    return bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - max(0, n - 2))


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` in each span (0 where empty)."""
    upto = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    last = len(values)  # an empty text at the end starts beyond the last n-gram
    return upto[np.minimum(ends, last)] - upto[np.minimum(starts, last)]


def spread(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of the spans, one after the other."""
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)
