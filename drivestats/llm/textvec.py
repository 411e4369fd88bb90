"""Vectorised text primitives: code points, word hashes, k-gram hashes (NumPy, inside tasks)."""

from __future__ import annotations

import numpy as np

U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), element by element."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a line feed after each; and where each text starts (with the end)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    joined = "\n".join(texts) + "\n" if texts else ""
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), starts


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def span_hashes(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of code points: mixed (code point, place) pairs, summed and mixed again."""
    if not len(starts):
        return np.zeros(0, U)
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    own = cp[place + np.repeat(starts, lengths)].astype(U)
    own += place.astype(U) << U(32)
    own += U(0x9E3779B97F4A7C15 * (2 * seed + 1) % 2**64)
    sums = np.add.reduceat(mix64(own), first)
    return mix64(sums + lengths.astype(U))


# Words: letters and digits of ASCII, and everything beyond it.
_WORD = np.zeros(129, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128] = True


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (A-Z lowered) and where each text's words start (with the end)."""
    cp, text_starts = codepoints(texts)
    cp = np.where((cp >= 65) & (cp <= 90), cp + 32, cp)
    starts, ends = runs(_WORD[np.minimum(cp, 128)])
    return span_hashes(cp, starts, ends), np.searchsorted(starts, text_starts)


def kgrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` consecutive values."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = h[:n].copy()
    for j in range(1, k):
        out = mix64(out * U(0x9E3779B97F4A7C15) + h[j : j + n])
    return mix64(out)
