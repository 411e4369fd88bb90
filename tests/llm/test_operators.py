"""Operators of the subpackage llm against brute force, round trips and held-out labels, on small tables with odd rows."""

from __future__ import annotations

import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from drivestats.llm import decontaminate, html_extract, language_id, licenses, line_dedup, near_dup, packing, quality, token_files, toxicity
from drivestats.llm.common import ARROW_ROWS, table, written
from drivestats.llm.textvec import word_hashes
from drivestats.llm.tokens import TextEncoder, default_tokenizer
from drivestats.session import work_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, node string, row string"
SMALL = "/root/testdata/sf0.001"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def make(spark, rows):
    """Documents with clashing extra columns; rows are (id, text) or (id, text, lang, source)."""
    return spark.createDataFrame([(*r, *(None,) * (4 - len(r)), 1, "x", "y", "z") for r in rows], DOCS)


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "no id here"), (5, "same text twice"), (5, "same text twice"), (6, "long " * 30000)]


@pytest.fixture(scope="module")
def odd(spark):
    return make(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return make(spark, [])


def test_pieces_are_the_tokenizers(spark):
    enc = TextEncoder(default_tokenizer())
    rng = random.Random(3)
    parts = ["'", "'s", "'re", "'ll", " ", "  ", "\n", "\n\n", "a", "re", "é", "1", "23", "!", "_", " ", "日本", "<|endoftext|>", "²", "Ж", " '"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode(texts)] == want


def test_encoder_holds_little_at_a_time(monkeypatch):
    """Memory of a worker: the library gets bounded runs of texts, the cache stays in order whatever comes in."""
    enc = TextEncoder(default_tokenizer())
    texts = [words(i, 300) for i in range(300)]
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    given = []

    class Counting:
        def encode_batch_fast(self, some, **more):
            given.append(sum(map(len, some)))
            return real.encode_batch_fast(some, **more)

    real, enc.tokenizer = enc.tokenizer, Counting()
    monkeypatch.setitem(TextEncoder._chunk.__globals__, "CHUNK_CHARS", 50_000)
    assert [x.tolist() for x in enc.whole(texts)] == want
    assert sum(given) == sum(map(len, texts)) and max(given) <= 100_000
    assert [x.tolist() for x in enc.encode(texts)] == want
    assert (enc.keys[1:] > enc.keys[:-1]).all() and len(enc.keys) == len(enc.checks) == len(enc.at) == len(enc.count)
    assert [x.tolist() for x in enc.encode(texts[::-1])] == want[::-1]


def test_rows_that_workers_get_at_once(spark):
    docs = spark.range(40, numPartitions=1)
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"id": [b.num_rows]}) for b in batches), "id long")
    before = spark.conf.get(ARROW_ROWS)
    assert {r.id for r in written(sizes, "sizes", batch_rows=7).collect()} == {7, 5}
    assert spark.conf.get(ARROW_ROWS) == before


def test_token_files_round_trip(spark, odd, empty):
    enc = TextEncoder(default_tokenizer())
    path = work_path(spark, "t")
    token_files.write_token_files(odd, path, default_tokenizer(), shard_bytes=300)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, path).collect())
    assert len(got) == len(ODD) and got[0][1] is None and [g[1] for g in got[1:]] == [1, 2, 3, 4, 5, 5, 6]
    assert [g[0] for g in got] == np.concatenate(([0], np.cumsum([g[2] for g in got])[:-1])).tolist()
    ids = np.append(enc.encode(["long " * 30000])[0], 0).astype("<u4")
    assert got[-1][2:] == (len(ids), zlib.crc32(ids.tobytes()))
    assert [x.tolist() for x in token_files.read_document(spark, path, 6)] == [ids.tolist()]
    assert len(token_files.read_document(spark, path, 5)) == 2
    path = work_path(spark, "t")
    token_files.write_token_files(empty, path, default_tokenizer())
    assert token_files.read_token_files(spark, path).count() == 0


def test_packing(spark, odd, empty):
    rows = packing.pack(odd, default_tokenizer(), capacity=64).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {r[0] for r in ODD} and len(by_doc[5]) == 2
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.concatenate(([0], np.cumsum([r.length for r in own])[:-1])).tolist()
        assert sum(r.length for r in own) <= 64
    assert packing.pack(empty, default_tokenizer()).count() == 0


@pytest.mark.parametrize("n", [1, 50, 4000])
def test_packing_is_close_to_the_bound(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(5, 1, n).astype(int), 1, 1023)
    demand = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    plan = packing.pack_histogram(demand, 1024)
    got: dict[int, int] = {}
    for config, times in plan:
        assert sum(l * a for l, a in config.items()) <= 1024
        for l, a in config.items():
            got[l] = got.get(l, 0) + a * times
    assert got == demand
    assert sum(t for _, t in plan) <= 1 + 1.02 * -(-lengths.sum() // 1024)


def test_near_duplicates_against_brute_force(spark, odd, empty):
    base = [words(i, 120).split() for i in range(12)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i, w in enumerate(base):
        for j in range(3):
            edited = list(w)
            edited[40 + 7 * j] = "changed"
            rows.append((100 + 10 * i + j, " ".join(edited)))
        rows.append((500 + i, " ".join(words(90 + i + j, 100).split() + w[:12])))  # a shared passage alone
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(make(spark, rows)).collect()}
    for i in range(12):
        assert all(got[d] == i for d in (i, *(100 + 10 * i + j for j in range(3)))), i
        assert got[500 + i] == 500 + i
    got = near_dup.near_duplicates(odd).collect()
    assert len(got) == len(ODD) and {r.class_size for r in got if r.doc_id == 5} == {2} and {r.class_id for r in got if r.doc_id in (1, 2, 3)} == {1, 2, 3}
    assert sorted(r.doc_id for r in near_dup.keep_one(odd).where("doc_id IS NOT NULL").collect()) == [1, 2, 3, 4, 5, 6]
    assert near_dup.near_duplicates(empty).count() == 0


def test_keep_one_by_row(spark):
    """An id with two texts keeps the one that is no copy; of a class without ids one text stays; equal rows stay once."""
    a, b, c = words(1, 60), words(2, 60), words(3, 60)
    rows = [(3, a), (5, b), (5, a), (None, c), (None, c + " more"), (None, None), (8, b), (8, b), (9, "")]
    got = near_dup.keep_one(make(spark, rows)).collect()
    assert sorted(((r.doc_id or 0, r.text or "") for r in got)) == sorted([(3, a), (5, b), (0, next(r.text for r in got if r.doc_id is None and r.text)), (0, ""), (9, "")])


@pytest.mark.parametrize(
    "demand, least",
    [({100: 1000}, 100), ({200: 1000}, 200), ({1: 5000}, 5), ({100: 3, 101: 4}, 1), ({1000: 10, 1: 240}, 10), ({600: 30, 100: 120}, 30), ({700: 50, 1: 16200}, 50), ({341: 300, 342: 300}, 225), ({300: 7}, 3)],
)
def test_packing_of_few_lengths(demand, least):
    plan = packing.pack_histogram(demand, 1024)
    got: dict[int, int] = {}
    for config, times in plan:
        assert sum(l * a for l, a in config.items()) <= 1024
        for l, a in config.items():
            got[l] = got.get(l, 0) + a * times
    assert got == demand
    assert sum(t for _, t in plan) <= least + 1


def all_pairs_classes(rows):
    """doc_id -> smallest id of its class, by the similarity of all pairs."""
    h, bounds = word_hashes([text for _, text in rows])
    grams = [near_dup.kmers(h[a:z]) for a, z in zip(bounds[:-1], bounds[1:])]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and near_dup.similarity(grams[i], grams[j], near_dup.THRESHOLD) > 0:
                root = [root[j] if r == root[i] else r for r in root]
    return {d: min(e for (e, _), s in zip(rows, root) if s == r) for (d, _), r in zip(rows, root)}


def test_near_duplicates_of_few_links(spark):
    # Copies of five texts with three words changed each: most pairs lie just under the threshold, so classes hang together by few links.
    rows = []
    for seed in range(5):
        base, rng = words(seed, 200).split(), random.Random(seed)
        for _ in range(60):
            edited = list(base)
            for _ in range(3):
                edited[rng.randrange(200)] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(edited)))
    want = all_pairs_classes(rows)
    assert {r.doc_id: r.class_id for r in near_dup.near_duplicates(make(spark, rows)).collect()} == want


def test_near_duplicates_compare_no_pairs_that_cannot_link(spark, monkeypatch):
    # Copies with four words of their own each agree on sketches, but no two can reach the threshold; the others of the group can.
    rows, rng, base = [], random.Random(7), words(7, 150).split()
    for i in range(80):
        edited = list(base)
        for place in rng.sample(range(10, 140, 10), 4 if i < 60 else 2):
            edited[place] = f"own{i}x{place}"
        rows.append((i, " ".join(edited)))
    compared, keep = [], near_dup.written

    def spy(df, name):
        out = keep(df, name)
        if name == "pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "written", spy)
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(make(spark, rows)).collect()}
    assert got == all_pairs_classes(rows)
    assert compared and max(compared) < len(rows)


def test_pairs_by_where_they_meet(spark):
    """Every pair that shares enough k-mers is found, whatever the order, and each once."""
    rng = random.Random(11)
    sets = {n: rng.sample(range(60), rng.randint(1, 40)) for n in range(150)}
    for n in range(150, 300):
        of = list(sets[n - 150])
        sets[n] = list(dict.fromkeys([*of[: len(of) - rng.randint(0, 2)], 100 + n]))
    df = spark.createDataFrame([(n, n // 3, s) for n, s in sets.items()], "node long, root long, labelled array<bigint>")
    got = [(r.node, r.leader) for r in near_dup._met(df, 0.8).collect()]
    want = set()
    for b in sets:
        for a in range(b):
            common = len(set(sets[a]) & set(sets[b]))
            if a // 3 != b // 3 and common / (len(sets[a]) + len(sets[b]) - common) >= 0.8:
                want.add((a, b))
    assert want and want <= set(got) and len(got) == len(set(got))


def test_near_duplicates_of_short_texts(spark):
    # A word more or less at the end, and one changed near the end: pairs at or just over the threshold.
    rows = []
    for n in range(8, 40):
        for i in range(4):
            base = words(1000 * n + i, n).split()
            edited = list(base)
            edited[-1 - i] = "changed"
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base + ["more"] * (i + 1))), (len(rows) + 2, " ".join(edited))]
    want = all_pairs_classes(rows)
    assert want[1] == 0
    assert {r.doc_id: r.class_id for r in near_dup.near_duplicates(make(spark, rows)).collect()} == want


def test_alignment_is_a_longest_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (rng.integers(0, 6, rng.integers(0, 30)).astype(np.uint64) for _ in range(2))
        table_ = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table_[i + 1, j + 1] = table_[i, j] + 1 if a[i] == b[j] else max(table_[i, j + 1], table_[i + 1, j])
        assert near_dup.aligned(a, b, 40) == table_[-1, -1]


def test_decontaminate(spark, odd, empty):
    passage = words(7, 30)
    items = spark.createDataFrame([(1, passage), (2, "Three short words"), (3, None), (None, passage), (1, passage)], "item_id long, text string")
    rows = [(10, words(1, 40) + " " + " ".join(passage.split()[5:20]) + " " + words(2, 40)), (11, "a Three, SHORT words b"), (12, " ".join(passage.split()[:9]))]
    got = {r.doc_id: r for r in decontaminate.contamination(make(spark, rows), items).collect()}
    assert (got[10].n_hit, got[10].n_items, got[10].contaminated) == (15, 1, True)
    assert (got[11].n_words, got[11].n_hit, got[11].n_items) == (5, 3, 1)
    assert (got[12].n_hit, got[12].contaminated) == (0, False)
    assert decontaminate.contamination(odd, items).count() == len(ODD)
    assert decontaminate.contamination(odd, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(empty, items).count() == 0
    assert sorted(r.doc_id for r in decontaminate.without_contaminated(make(spark, rows), items).collect()) == [12]


def test_line_dedup(spark, odd, empty):
    run = [words(50, 30), words(51, 25), "", words(52, 8)]
    rows = [(1, "\n".join(["own first line", *run])), (2, "\n".join(["other", *run, "last"])), (3, run[0]), (4, "\n".join([words(9, 60)] * 3))]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(make(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "other\nlast", 3: run[0], 4: words(9, 60)}
    out = line_dedup.dedup_lines(odd)
    assert out.columns == odd.columns and out.count() == len(ODD) and out.where("doc_id = 1 AND text IS NULL").count() == 1
    assert line_dedup.dedup_lines(empty).count() == 0


def test_language_id(spark, odd, empty):
    docs = table(spark, SMALL, "documents")
    model = language_id.train(docs, ~language_id.held_out(F.col("doc_id")))
    tested = language_id.predict(docs, model).withColumnRenamed("doc_id", "id").join(docs.where(language_id.held_out(F.col("doc_id"))), F.col("id") == docs["doc_id"])
    assert tested.where("lang_pred = lang").count() >= 0.95 * tested.count()
    got = language_id.predict(make(spark, [*ODD, (9, "12 34 !!")]), model).collect()
    assert len(got) == len(ODD) + 1 and {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 9)} == {"und"}
    assert language_id.with_language(odd, model).columns == odd.columns
    nothing = language_id.train(empty, F.lit(True))
    assert {r.lang_pred for r in language_id.predict(odd, nothing).collect()} == {"und"}
    code = language_id.codewords(20)
    assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= 10


def test_toxicity(spark, odd, empty):
    rude = ["vile", "awful", "rotten"]
    rows = [(i, words(i, 40) + (f" {rude[i % 3]} " if i % 5 == 0 else " ") + words(1000 + i, 20)) for i in range(600)]
    docs = make(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(600)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs, labels, ~held)
    got = toxicity.score(docs, model).where(held).collect()
    assert np.mean([(r.score >= toxicity.THRESHOLD) == (r.doc_id % 5 == 0) for r in got]) > 0.97
    assert toxicity.score(odd, model).where("score BETWEEN 0 AND 1").count() == len(ODD)
    assert {r.score for r in toxicity.score(odd, toxicity.train(empty, labels, F.lit(True))).collect()} == {0.5}


def test_quality(spark, empty):
    rows = [(i, words(i, 80), "en", "a") for i in range(80)] + [(100, " ".join(w + "###" for w in words(3, 80).split()), "en", "a"), (101, "the same three " * 40, "en", None), (102, None, None, None)]
    got = {r.doc_id: r for r in quality.judge(make(spark, rows)).collect()}
    assert len(got) == len(rows) and sum(got[i].kept for i in range(80)) == 80
    assert not got[100].base_failed and not got[100].kept and got[100].n_symbols == 240
    assert got[101].base_failed and got[101].n_repeat_words == got[101].n_words == 120
    assert got[102].n_words == 0 and not got[102].kept
    assert quality.judge(empty).count() == 0


def test_licenses(spark, odd, empty):
    mit = next(t for i, t in licenses.KNOWN if i == "MIT" and len(t) > 300)
    rows = [(1, "Copyright (c) 2020 Someone\n" + mit.upper().replace(" ", "\n  ")), (2, "x\nReleased under the MIT Licence\ny"), (3, "text with no notice")]
    got = {r.doc_id: r for r in licenses.scan(make(spark, rows), licenses.known_licenses(spark)).collect()}
    assert got[1].license_id == "MIT" and got[3].license_id is None
    assert (got[2].license_id, got[2].n_license_lines, got[2].line_licenses) == (None, 1, "MIT")
    assert licenses.scan(odd, licenses.known_licenses(spark)).count() == len(ODD)
    assert licenses.scan(empty, licenses.known_licenses(spark)).count() == 0


def test_licenses_published_in_full(spark):
    mit = next(t for i, t in licenses.KNOWN if i == "MIT" and len(t) > 300)
    isc = next(t for i, t in licenses.KNOWN if i == "ISC")
    full = {i: (Path(licenses.__file__).parent / "license_texts" / f"{i}.txt").read_text() for i in licenses.FULL}
    apache = full["Apache-2.0"]
    rows = [
        ("MIT", "MIT License\n\nCopyright (c) 2020 Someone\n\n" + mit.replace(". ", ".\n\n")),
        ("ISC", "ISC License\n\nCopyright (c) 2020, Someone\n\n" + isc),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Someone\nAll rights reserved.\n\n" + full["BSD-3-Clause"]),
        ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2020 Someone")),
        ("Apache-2.0", apache.split("END OF TERMS")[0] + "END OF TERMS AND CONDITIONS\n"),
        ("GPL-3.0", full["GPL-3.0"].split("2007", 1)[1]),
        *full.items(),
        (None, mit + " And more."),
    ]
    got = {r.doc_id: r.license_id for r in licenses.scan(make(spark, list(enumerate(t for _, t in rows))), licenses.known_licenses(spark)).collect()}
    assert got == {i: want for i, (want, _) in enumerate(rows)}


PAGE = "<html><head><title>t</title><script>var a='</p>'</script></head><body>{top}<p>{own}<p>More of {own} &amp; so&nbsp;on<br>here{bottom}</body></html>"


def test_html_marked_article_and_differencing(spark):
    marked = "<nav>menu</nav><div class='cookie-notice'>cookies</div><article><h1>Title</h1><p>One <b>two</b></p><aside>side</aside><div id='comments'><p>reply</div></article><footer>foot</footer>"
    shared = {"top": "<div><p>Site name<p>Today's weather", "bottom": "<p>All rights reserved</div>"}
    rows = [(i, f"http://h.example/a/{i}", PAGE.format(**{k: v.replace("<p>", "<p>") for k, v in shared.items()}, own=f"story {i}")) for i in range(5)]
    rows += [(10, "http://h.example/b/1", marked), (11, None, None), (12, "nonsense", "plain text"), (12, "nonsense", "plain text")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, lines string")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    assert got[3] == "story 3\n\nMore of story 3 & so on here"
    assert got[10] == "Title\n\nOne two" and got[11] == "" and got[12] == "plain text"
    assert html_extract.extract(pages).count() == len(rows)
    assert html_extract.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        ("<form id='aspnetForm'><nav>menu</nav><article><p>One<p>two</article></form>", "One\n\ntwo"),
        ("<form id='aspnetForm'><input><p>One<p>two</form>", "One\n\ntwo"),
        ("<div class='layout has-sidebar'><article><p>One</article><aside>side</aside></div>", "One"),
        ("<div id='page' class='no-sidebar'><main><p>One</main></div>", "One"),
        ("<div id='page' class='no-sidebar'><p>One</div>", "One"),
        ("<article><div class='has-sidebar'><p>One</div></article>", "One"),
        ("<article class='post comment-open'><p>One</article>", "One"),
        ("<article class='hentry category-social'><p>One</article><div class='comments'><article>reply</article></div>", "One"),
        ("<div class='modal'><div role='main'><p>One</div><nav>menu</nav></div>", "One"),
        ("<div class='sidebar'>side</div><p>One<div class='comments'>reply</div>", "One"),
        ("<article><header class='header'><h1>Title</h1></header><p>One<form><p>write</form><div class='share'>x</div></article>", "Title\n\nOne"),
    ],
)
def test_html_wrappers(page, want):
    blocks = html_extract.blocks_of(f"<html><body>{page}</body></html>")
    assert html_extract.main_text(blocks, [False] * len(blocks)) == want


def test_html_doubtful_blocks_by_differencing():
    blocks = html_extract.blocks_of("<article><p>One</p><div class='related-posts'><p>same everywhere</p><p>own</p></div></article>")
    assert html_extract.main_text(blocks, [False, True, False]) == "One\n\nown"
    assert html_extract.main_text(blocks[:1], [True]) == "One"


def test_pages_against_their_articles(spark):
    import html

    pages = table(spark, SMALL, "pages")
    for r in html_extract.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)[^>]*>", article))
        assert r.text == "\n\n".join(b for b in blocks if b)
