"""Operator 12 against a plain count of every run of words, and its defined cases."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import pytest

from drivestats.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(lowered)


def features(text, max_run, buckets):
    own = words(text)
    return [zlib.crc32(" ".join(own[i : i + n]).encode()) % buckets for n in range(1, max_run + 1) for i in range(len(own) - n + 1)]


def brute(docs, target, max_run=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    s, t = {}, {}
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for b in features(x, max_run, buckets):
                counts[b] = counts.get(b, 0) + 1
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        gains = [math.floor(1000 * math.log((t.get(b, 0) + 1) * (big_t * 0 + big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in features(text, max_run, buckets)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(gains), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= min_words])
    eligible = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {id(r): i for i, r in enumerate(eligible[: percent * len(eligible) // 100], 1)}
    return [(*r[:4], rank.get(id(r))) for r in out]


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def table(spark, docs):
    return spark.createDataFrame([(d, t, "x", 7) for d, t in docs], "doc_id long, text string, score string, row int")


DOCS = [
    (i, f"Shared line one\nthe {i} fox über {'dog ' * (i % 7)}\n\n-- \r\nshared line ONE\nEnd{i} of 😀 text{i % 3}\tand more words here to reach twenty of them a b c d e f g h i j") for i in range(60)
]
ODD = [(100, None), (101, ""), (102, " \n\t\n"), (None, "one two three\nfour"), (None, DOCS[0][1]), (5, DOCS[5][1]), (5, DOCS[5][1]), (103, "w " * 30_000 + "\n" + "w " * 30_000)]
AIMS = ["the fox über\nthe dog", None, "END of text"]


@pytest.mark.parametrize("max_run", [1, 3])
def test_equals_plain_counts(spark, max_run):
    docs = DOCS + ODD
    aims = spark.createDataFrame([(t, 1) for t in AIMS], "text string, item_id int")
    got = resampling.resample(table(spark, docs).repartition(3), aims, max_run=max_run, min_words=10, percent=30).collect()
    want = brute(docs, AIMS, max_run=max_run, min_words=10, percent=30)
    # Rows that share id and score may be ranked in any order; here they are equal rows.
    assert key(got) == key(want)


def test_hot_lines_by_both_joins(spark, monkeypatch):
    """A line in every document: the same rows whichever join it takes."""
    aims = spark.createDataFrame([(t,) for t in AIMS], "text string")
    rows = [key(resampling.resample(table(spark, DOCS), aims).collect())]
    monkeypatch.setattr(resampling, "HOT", 1)
    rows.append(key(resampling.resample(table(spark, DOCS), aims).collect()))
    assert rows[0] == rows[1] == key(brute(DOCS, AIMS))


def test_distinct_lines_are_counted_once(spark):
    lines = resampling.distinct_lines(table(spark, [(1, "a b\na b\nc"), (2, "a b"), (3, None)])).collect()
    assert sorted((r["places"], r["n_words"], len(r["features"])) for r in lines) == [(1, 1, 1), (3, 2, 2)]


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, "too short")]])
def test_nothing_to_draw(spark, docs):
    for aims in ([], ["some target text"]):
        got = resampling.resample(table(spark, docs), spark.createDataFrame([(a,) for a in aims], "text string")).collect()
        assert key(got) == key(brute(docs, aims))
