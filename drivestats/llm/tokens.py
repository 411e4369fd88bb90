"""Token ids of whole texts by the tokenizers library, with a cache of piece encodings.

A byte-level BPE without normaliser encodes the pieces of its pre-tokenizer
one by one, so the ids of a text are those of its pieces in order. Pieces are
found with array operations over many texts at once; each distinct piece is
encoded by the library itself once per worker. Texts with characters whose
class could depend on the Unicode version, or with an added token's text, go
through the library whole. The result is the library's in either case.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np

from drivestats.llm.common import text_chunks, worker_cache
from drivestats.llm.textvec import codepoints, span_hashes

# Code points below this one have had the same class in every Unicode version since 2010.
STABLE_BELOW = 0x530
# The pre-tokenizer's contractions, after an apostrophe.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
# A chunk's arrays take some 100 bytes a character, the cache some 50 a piece: two workers stand beside an executor's heap.
CHUNK_CHARS = 800_000
# The library's own object for a token takes some 100 bytes until the ids are read from it.
WHOLE_CHARS = 100_000
CACHE_PIECES = 1_000_000


def _classes() -> np.ndarray:
    out = np.full(STABLE_BELOW, OTHER, np.uint8)
    for c in range(STABLE_BELOW):
        kind = unicodedata.category(chr(c))
        out[c] = LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = SPACE
    return out


def piece_spans(cp: np.ndarray, text_starts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokenizer's pieces; ``cp`` has a line feed after each text, in no piece.

    A run of letters, of numbers or of other visible characters is a piece,
    together with one blank before it. Of white space before something
    visible, all but the last character is a piece; the last one is a piece of
    its own unless it is a blank. White space that ends a text is one piece.
    An apostrophe and a contraction after it is a piece where it starts one.
    """
    kind = classes[cp]
    n = len(cp)
    ends_text = np.zeros(n, bool)
    ends_text[text_starts[1:] - 1] = True
    cut = np.empty(n + 1, bool)
    cut[0] = cut[n] = True
    cut[1:n] = kind[1:] != kind[:-1]
    cut[:n][ends_text] = True
    cut[1:][ends_text] = True
    # White space before something visible in the same text.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~ends_text[:-1])
    cut[last] = True
    cut[last[cp[last] == 32] + 1] = False
    # Contractions: a lone apostrophe that starts a piece, then letters.
    apostrophe = np.flatnonzero((cp[:-1] == 39) & cut[:-2] & cut[1:-1] & (kind[1:] == LETTER))
    for at in apostrophe.tolist():
        for c in CONTRACTIONS:
            end = at + 1 + len(c)
            if end < n and all(cp[at + 1 + i] == ord(ch) for i, ch in enumerate(c)) and not cut[at + 2 : end].any():
                cut[at + 1] = False
                cut[end] = True
                break
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    own = ~ends_text[starts]
    return starts[own], ends[own]


def _merged(kept: np.ndarray, added: np.ndarray, old: np.ndarray) -> np.ndarray:
    """``kept`` where ``old`` is set and ``added`` elsewhere, both in order."""
    out = np.empty(len(old), kept.dtype)
    out[old], out[~old] = kept, added
    return out


class TextEncoder:
    """Encodes batches of texts; one per worker and tokenizer file."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t["content"] for t in made["added_tokens"]]
        pre, model = made["pre_tokenizer"] or {}, made["model"]
        #: Whether pieces can be encoded one by one.
        self.by_piece = (
            made["normalizer"] is None
            and model["type"] == "BPE"
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
        )
        vocab = self.tokenizer.get_vocab()
        self.vocab_size = max(vocab.values()) + 1
        self.starts_blank = np.zeros(self.vocab_size, bool)
        self.starts_blank[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True
        self.dtype = np.uint16 if self.vocab_size <= 1 << 16 else np.uint32
        self.classes = _classes()
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """By the library, text by text."""
        made = (self.tokenizer.encode_batch_fast(some, add_special_tokens=False) for _, some in text_chunks(texts, WHOLE_CHARS))
        return [np.array(e.ids, self.dtype) for encodings in made for e in encodings]

    def _pieces_ids(self, pieces: list[str]) -> list[np.ndarray]:
        """The library's ids of each piece. Pieces that start with a blank are encoded together: no other token starts with one."""
        out: list = [None] * len(pieces)
        led = [i for i, p in enumerate(pieces) if len(p) > 1 and p[0] == " " and not p[1].isspace()]
        rest = sorted(set(range(len(pieces))) - set(led))
        for j, ids in zip(rest, self.whole([pieces[i] for i in rest])):
            out[j] = ids
        groups = [led[i : i + 400] for i in range(0, len(led), 400)]
        for group, ids in zip(groups, self.whole(["".join(pieces[i] for i in g) for g in groups])):
            first = np.flatnonzero(self.starts_blank[ids])
            if len(first) == len(group):
                for i, part in zip(group, np.split(ids, first[1:])):
                    out[i] = part
            else:
                for i, part in zip(group, self.whole([pieces[i] for i in group])):
                    out[i] = part
        return out

    def _chunk(self, texts: list[str]) -> list[np.ndarray]:
        cp, text_starts = codepoints(texts)
        starts, ends = piece_spans(cp, text_starts, self.classes)
        if not len(starts):
            return [np.zeros(0, self.dtype)] * len(texts)
        key, check = span_hashes(cp, starts, ends), span_hashes(cp, starts, ends, seed=1)
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        slot = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = slot < len(self.keys)
        known[inside] = self.keys[slot[inside]] == distinct[inside]
        if not known.all():
            if len(self.keys) > CACHE_PIECES:
                self._clear()
                known[:] = False
            missing = np.flatnonzero(~known)
            raw, four = cp.astype("<u4").tobytes(), 4
            made = self._pieces_ids([raw[four * starts[f] : four * ends[f]].decode("utf-32-le") for f in first[missing].tolist()])
            count = np.array([len(m) for m in made], np.int64)
            at = len(self.ids) + np.concatenate(([0], np.cumsum(count)[:-1]))
            self.ids = np.concatenate([self.ids, *made])
            new = np.searchsorted(self.keys, distinct[missing]) + np.arange(len(missing))
            old = np.ones(len(self.keys) + len(missing), bool)
            old[new] = False
            self.keys = _merged(self.keys, distinct[missing], old)
            self.checks = _merged(self.checks, check[first[missing]], old)
            self.at = _merged(self.at, at, old)
            self.count = _merged(self.count, count, old)
            slot = np.searchsorted(self.keys, distinct)
        own = slot[which]
        wrong = self.checks[own] != check  # two pieces with one key: their texts go through the library whole
        at, count = self.at[own], self.count[own]
        ends_at = np.cumsum(count)
        begin = ends_at - count
        ids = self.ids[np.arange(int(ends_at[-1])) - np.repeat(begin - at, count)]
        bounds = np.searchsorted(starts, text_starts)
        edge = np.concatenate((begin, ends_at[-1:]))[bounds]
        out = [ids[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        if wrong.any():
            for i in np.unique(np.searchsorted(bounds, np.flatnonzero(wrong), side="right") - 1).tolist():
                out[i] = self.whole([texts[i]])[0]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        top = chr(STABLE_BELOW)
        plain = [i for i, t in enumerate(texts) if self.by_piece and (t.isascii() or not t or max(t) < top) and not any(a in t for a in self.added)]
        rest = sorted(set(range(len(texts))) - set(plain))
        for i, ids in zip(rest, self.whole([texts[i] for i in rest])):
            out[i] = ids
        for first, chunk in text_chunks([texts[i] for i in plain], CHUNK_CHARS):
            for i, ids in zip(plain[first:], self._chunk(chunk)):
                out[i] = ids
        return out


def encoder(path: str) -> TextEncoder:
    cache = worker_cache()
    if ("encoder", path) not in cache:
        cache["encoder", path] = TextEncoder(path)
    return cache["encoder", path]


def default_tokenizer() -> str:
    """The tokenizer file of the registered queries; operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))
