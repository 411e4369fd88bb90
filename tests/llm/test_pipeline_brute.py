"""The pipeline against plain Python on a small table with planted cases, stage by stage and as a whole."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from drivestats.llm.common import table, written
from drivestats.llm.tokens import TextEncoder, default_tokenizer
from drivestats.session import work_path
from tests.llm.test_operators import all_pairs_classes

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_list(text):
    return WORD.findall((text or "").translate(UPPER))


def without_repeated_runs(rows):
    """Texts by id; a span of lines of 50 words or more stays where it stands first, by id and place."""
    spans, first = [], {}
    for d, text in sorted(rows.items()):
        lines = [(i, " ".join(line.split())) for i, line in enumerate(text.split("\n")) if line.split()]
        sizes = [len(line.split()) for _, line in lines]
        for a in range(len(lines)):
            upto = 0
            for z in range(a, len(lines)):
                upto += sizes[z]
                # The shortest from either end; longer spans are covered by these.
                if upto >= 50 and (upto - sizes[z] < 50 or upto - sizes[a] < 50):
                    key = tuple(line for _, line in lines[a : z + 1])
                    first.setdefault(key, (d, a))
                    spans.append((d, a, key, lines[a][0], lines[z][0]))
                if upto - sizes[a] >= 50:
                    break
    gone = {d: set() for d in rows}
    for d, a, key, p, q in spans:
        if first[key] != (d, a):
            gone[d].update(range(p, q + 1))
    return {d: "\n".join(line for i, line in enumerate(t.split("\n")) if i not in gone[d]) for d, t in rows.items()}


def contaminated(text, items):
    w = word_list(text)
    windows = {n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for n in {min(len(x), 10) for x in items if x}}
    return any(tuple(x[i : i + min(len(x), 10)]) in windows[min(len(x), 10)] for x in items if x for i in range(max(len(x) - 10, 0) + 1))


def planted(spark):
    """sf0.001 and, made from texts of it: an exact copy, a near copy, a copied run of lines, a benchmark passage in a text, and a text without a language."""
    docs, items = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    rows = docs.orderBy("doc_id").collect()
    passage = next(r.text for r in items.orderBy("item_id").collect() if len(word_list(r.text)) >= 12)
    plain = [r for r in rows if r.lang == "en" and 120 <= len((r.text or "").split()) <= 400 and "\n" not in r.text.strip()]
    plain = plain or [r for r in rows if 120 <= len((r.text or "").split()) <= 400]
    a, b, c, d = plain[:4]
    near = b.text.split(" ")
    near[len(near) // 2] = "changed"
    new = [a.text, " ".join(near), "An own line of this document\n" + c.text, " ".join(d.text.split()[::-1]) + "\n" + passage, "12 34 !!"]
    top = max(r.doc_id for r in rows)
    made = spark.createDataFrame([(*(text if k == "text" else top + 1 + i if k == "doc_id" else len(text) if k == "n_chars" else a[k] for k in docs.columns),) for i, text in enumerate(new)], docs.schema)
    path = work_path(spark, "planted")
    docs.union(made).write.parquet(f"{path}/documents.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path, [top + 1 + i for i in range(len(new))]


def test_pipeline_against_brute_force(spark):
    path, (copy, near, run, leak, none) = planted(spark)
    stages = dict(corpus_pipeline.STAGES)
    items = [word_list(r.text) for r in table(spark, path, "benchmark").collect()]
    by_id = lambda df: {r.doc_id: r.text or "" for r in df.collect()}

    docs = table(spark, path, "documents")
    before = by_id(docs)
    docs = written(stages["language_id"](spark, docs, path), "language_id")
    got = by_id(docs)
    assert none not in got and {copy, near, run, leak} <= set(got) and got.items() <= before.items()
    assert len(got) >= 0.9 * sum(len(word_list(t)) >= 5 for t in before.values())

    want = without_repeated_runs(got)
    docs = written(stages["line_dedup"](spark, docs, path), "line_dedup")
    assert by_id(docs) == want and want[run] != got[run]

    classes = all_pairs_classes([(d, t) for d, t in sorted(want.items()) if word_list(t)])
    want = {d: t for d, t in want.items() if classes.get(d, d) == d}
    docs = written(stages["near_duplicates"](spark, docs, path), "near_duplicates")
    assert by_id(docs) == want and near not in want

    want = {d: t for d, t in want.items() if not contaminated(t, items)}
    docs = written(stages["decontaminate"](spark, docs, path), "decontaminate")
    assert by_id(docs) == want and leak not in want

    packed = corpus_pipeline.run(spark, path).collect()
    enc = TextEncoder(default_tokenizer())
    ids = {d: np.append(x, 2).astype("<u4") for d, x in zip(want, enc.encode(list(want.values())))}
    pieces = Counter()
    for r in packed:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        pieces[r.doc_id] += r.length
    assert pieces == {d: len(x) for d, x in ids.items()}
    full = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == full.get(r.sequence_id, 0)
        full[r.sequence_id] = r.offset + r.length
    assert max(full.values()) <= 1024
    assert sorted(full) == list(range(len(full)))
