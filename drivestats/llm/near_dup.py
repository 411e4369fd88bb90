"""Near-duplicate documents by Order MinHash, verified by banded alignment (operator 4).

Words are lower-cased runs of letters and digits; k-mers are five consecutive
words, labelled with their occurrence number in the text (a text of fewer
words is one k-mer). For each of ``sketches`` hash functions the ``keep``
smallest labelled k-mers are taken and hashed in text order, so two texts
agree on a sketch only if they share these k-mers in the same order, which
makes agreement sensitive to edit distance rather than to the set of k-mers.
Texts of few k-mers, which sketches miss, also meet exactly: by a shared k-mer
among the rarest of each, as many as a pair at the threshold can't all differ
in (prefix filtering).

Texts with the same words form one node. Nodes that share a sketch are
compared with a leader of the bucket first: in the buckets of a few sketches,
which brings most copies into one class, then in all that still hold several
classes. The leader is of the largest class there, the node that linked with
most of what it met so far. Then all nodes of different classes that agree on
enough sketches, and share enough k-mers by where they first meet to reach the
threshold, are compared, in blocks of bounded size, so classes are the
connected components of all links between candidates, whatever else the table
holds. There is no cap on buckets or partners (figures in the README).

A link is a similarity of at least ``threshold``: of the k-mers of both
texts, the share that a longest common subsequence aligns, matched / (a + b -
matched). The band of the alignment is as wide as that similarity allows, so
no alignment that reaches it is missed.

Defined cases: null texts and texts without a word are in no group; class ids
are the smallest doc_id of the class; rows repeated with the same id and text
belong to one class; an empty table gives an empty result. Other columns are
not read, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivestats.llm.common import map_arrow, removed, text_chunks, written, written_at
from drivestats.llm.textvec import U, kgrams, mix64, word_hashes

K, KEEP, SKETCHES, THRESHOLD = 5, 6, 40, 0.8
#: Sketches of the first round: enough to bring most copies into one class before the others are looked at.
FIRST = 6
#: Sketches on which nodes have to agree to be compared: two texts at the threshold agree on about ten of forty.
AGREED = 4
#: Texts with up to so many k-mers are candidates by prefixes; a pair with one text of at most ``SHORT * threshold`` is never missed.
SHORT = 80
#: Nodes of a bucket, and texts, that a block holds on each side where all remaining pairs are compared.
BUCKET_BLOCK, TEXT_BLOCK = 1000, 128
CHUNK_CHARS = 500_000
MEMBERS = "doc_id long, text_hash long, digest binary, sketch array<bigint>, kmers int, short array<bigint>"


def kmers(words: np.ndarray, k: int = K) -> np.ndarray:
    return kgrams(words, min(k, len(words))) if len(words) else words


def occurrence_labelled(h: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how many equal ones come before it)."""
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    place = np.arange(len(h))
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    nth = np.empty(len(h), np.uint64)
    nth[order] = (place - np.maximum.accumulate(np.where(new, place, 0))).astype(np.uint64)
    return mix64(h ^ mix64(nth + U(1)))


def order_minhash(labelled: np.ndarray, seeds: np.ndarray, keep: int) -> np.ndarray:
    """One hash per (odd) seed: that of the ``keep`` smallest labelled k-mers, in text order."""
    keep, n = min(keep, len(labelled)), len(labelled)
    ranked = labelled[None, :] * seeds[:, None]
    # Only what is small enough can be among the smallest; all of it where too little is.
    likely = ranked <= U(min(2**64 - 1, 2**64 // n * (3 * keep + 6)))
    row, place = np.nonzero(likely)
    if len(row) and np.bincount(row, minlength=len(seeds)).min() >= keep:
        order = np.lexsort((ranked[row, place], row))
        first = np.searchsorted(row, np.arange(len(seeds)))
        least = place[order][first[:, None] + np.arange(keep)]
    else:
        least = np.argsort(ranked, axis=1, kind="stable")[:, :keep]
    chosen = labelled[np.sort(least, axis=1)]
    out = mix64(seeds + U(keep))
    for j in range(keep):
        out = mix64(out * U(0x9E3779B97F4A7C15) + chosen[:, j])
    return out


def _digest(words: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(words.tobytes())


def _member_rows(k: int, keep: int, sketches: int):
    def make(batches):
        seeds = mix64(np.arange(1, sketches + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for first, chunk in text_chunks(texts, CHUNK_CHARS):
                h, bounds = word_hashes(chunk)
                ids, digests, signatures, sizes, short = [], [], [], [], []
                hashes = b.column(2).slice(first, len(chunk))
                for doc_id, a, z in zip(doc_ids[first:], bounds[:-1].tolist(), bounds[1:].tolist()):
                    ids.append(doc_id)
                    digests.append(_digest(h[a:z]) if z > a else None)
                    labelled = occurrence_labelled(kmers(h[a:z], k)) if z > a else None
                    sizes.append(len(labelled) if z > a else 0)
                    short.append(labelled.view(np.int64).tolist() if 0 < sizes[-1] <= SHORT else None)
                    # Long texts by parts of the seeds: the matrix of ranks stays small.
                    step = max(1, 4_000_000 // max(1, z - a))
                    signatures.append(
                        np.concatenate([order_minhash(labelled, seeds[i : i + step], keep) for i in range(0, sketches, step)]).view(np.int64).tolist() if z > a else None
                    )
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), hashes, pa.array(digests, pa.binary()), pa.array(signatures, pa.list_(pa.int64())), pa.array(sizes, pa.int32()), pa.array(short, pa.list_(pa.int64()))], ["doc_id", "text_hash", "digest", "sketch", "kmers", "short"])

    return make


def _labelled_rows(k: int):
    def make(batches):
        for b in batches:
            for first, chunk in text_chunks(b.column(2).to_pylist(), CHUNK_CHARS):
                h, bounds = word_hashes(chunk)
                out = [occurrence_labelled(kmers(h[a:z], k)).view(np.int64) for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(chunk)), b.column(1).slice(first, len(chunk)), pa.array(out, pa.list_(pa.int64()))], ["node", "root", "labelled"])

    return make


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence whose matches lie at most ``band`` off the diagonal (bit-parallel)."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    ones = (1 << len(a)) - 1
    state, width = ones, (1 << 2 * band + 1) - 1
    for i, y in enumerate(b.tolist()):
        if match := places.get(y):
            near = width << (i - band) if i >= band else width >> (band - i)
            hit = state & match & near
            state = ((state + hit) | (state - hit)) & ones
    return head + tail + len(a) - state.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """The aligned share of the k-mers of both texts; 0 where it can't reach ``threshold``."""
    total = len(a) + len(b)
    needed = math.ceil(threshold * total / (1 + threshold) - 1e-9)
    if min(len(a), len(b)) < needed:
        return 0.0
    counts = Counter(a.tolist())
    shared = sum(min(n, counts[x]) for x, n in Counter(b.tolist()).items() if x in counts)
    if shared < needed:
        return 0.0
    matched = aligned(a, b, max(len(a), len(b)) - needed)
    return matched / (total - matched) if matched >= needed else 0.0


def _verify_rows(k: int, threshold: float):
    def check(batches):
        for b in batches:
            nodes, leaders, texts, others = (b.column(i).to_pylist() for i in range(4))
            out = []
            for first, chunk in text_chunks([x + "\n" + y for x, y in zip(texts, others)], CHUNK_CHARS):
                n = len(chunk)
                both = texts[first : first + n] + others[first : first + n]
                h, bounds = word_hashes(both)
                for i in range(n):
                    x, y = (kmers(h[bounds[j] : bounds[j + 1]], k) for j in (i, n + i))
                    out.append(similarity(x, y, threshold))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(leaders, pa.int64()), pa.array(out, pa.float64())], ["node", "leader", "similarity"])

    return check


def _verify_blocks(k: int, threshold: float):
    def check(pairs, texts):
        """The links among ``pairs`` (node, root, leader, other_root, i, j) that join classes not yet joined in this block."""
        nodes, words = texts.column("node").to_pylist(), texts.column("text").to_pylist()
        of: dict[int, np.ndarray] = {}
        for first, chunk in text_chunks(words, CHUNK_CHARS):
            h, bounds = word_hashes(chunk)
            for node, a, z in zip(nodes[first:], bounds[:-1].tolist(), bounds[1:].tolist()):
                of[node] = kmers(h[a:z], k)
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = x = up.get(y, y)
            return x

        out: list[list[int]] = [[], []]
        for node, root, leader, other in zip(*(pairs.column(c).to_pylist() for c in ("node", "root", "leader", "other_root"))):
            a, b = top(root), top(other)
            if a != b and similarity(of[node], of[leader], threshold) > 0:
                up[a] = b
                out[0].append(node)
                out[1].append(leader)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["node", "leader"])

    return check


def _same_digest(batches):
    for b in batches:
        texts = [t or "" for t in b.column(1).to_pylist()]
        same = []
        for first, chunk in text_chunks(texts, CHUNK_CHARS):
            h, bounds = word_hashes(chunk)
            same += [_digest(h[a:z]) == d for a, z, d in zip(bounds[:-1].tolist(), bounds[1:].tolist(), b.column(2).to_pylist()[first:])]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3)], ["node", "text", "sketch"]).filter(pa.array(same, pa.bool_()))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``links`` (node, leader) that are not roots themselves: connected components by alternating stars.

    Each round hangs all neighbours of a node on its smallest one; no group is
    gathered in one place, and lineage is cut after every round. A round's
    table goes when the next one is written.
    """
    edges = links.select(F.greatest("node", "leader").alias("u"), F.least("node", "leader").alias("v")).where("u > v").distinct()
    before = old = None
    while True:
        edges, path = written_at(edges, "stars")
        if old:
            removed(links.sparkSession, old)
        old = path
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = small.select("u", F.col("m").alias("v")).union(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


def _roots(buckets: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame | None:
    """(node, root) by verified links for nodes that are not roots, none without a link; buckets: (bucket, node, band, kmers, weight); texts: (node, text, sketch)."""
    roots = history = None
    text, sketch = texts.select("node", "text"), texts.select("node", "sketch")
    other = texts.select(F.col("node").alias("leader"), F.col("text").alias("other"))
    other_sketch = texts.select(F.col("node").alias("leader"), F.col("sketch").alias("other_sketch"))
    agreed = F.size(F.filter(F.zip_with("sketch", "other_sketch", lambda a, b: a == b), lambda e: e)) >= AGREED
    everything = buckets

    def rooted(buckets: DataFrame) -> DataFrame:
        if roots is None:
            return buckets.withColumn("root", F.col("node"))
        return buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def classes_of(named: DataFrame) -> DataFrame:
        """The classes in each bucket, with their size there and the node that stands for them.

        That is the node with the best share of links in what it was compared
        with so far (the text that others were copied from, in a group of
        copies), by a hash of bucket and node among equals.
        """
        if history is not None:
            met = history.select("node", "linked").union(history.select(F.col("leader"), "linked"))
            named = named.join(met.groupBy("node").agg((F.sum("linked") / (F.count("*") + 3)).alias("score")), "node", "left")
        else:
            named = named.withColumn("score", F.lit(0.0))
        best = F.max(F.struct(F.coalesce("score", F.lit(0.0)).alias("score"), F.xxhash64("bucket", "node").alias("h"), "node"))
        return named.groupBy("bucket", "root").agg(F.count("*").alias("n"), best.alias("best")).select("bucket", "root", "n", F.col("best.score").alias("score"), F.col("best.node").alias("leader"))

    def compare(named: DataFrame, led: DataFrame) -> None:
        """Compares nodes with the leaders of their bucket that are of another class."""
        nonlocal roots, history
        pairs = named.join(led, "bucket").where("root != own").select("node", "leader").distinct()
        # Sketches first: whole texts move only for the pairs that agree.
        pairs = pairs.join(other_sketch, "leader").join(sketch, "node").where(agreed).select("node", "leader")
        paired = pairs.join(other, "leader").join(text, "node").select("node", "leader", "text", "other")
        checked = written(map_arrow(paired, _verify_rows(k, threshold), "node long, leader long, similarity double"), "checked")
        made = checked.select("node", "leader", (F.col("similarity") > 0).cast("int").alias("linked"))
        history = made if history is None else history.union(made)
        links = history.where("linked = 1").select("node", "leader")
        if not links.isEmpty():
            roots = components(links)

    # Leaders of the largest class of each bucket: stars that grow, so that few pairs are left to compare.
    for buckets in (everything.where(F.col("band") < FIRST), everything):
        named = rooted(buckets.select("bucket", "node"))
        led = classes_of(named).groupBy("bucket").agg(F.max(F.struct("n", "score", "leader", "root")).alias("of"), F.count("*").alias("classes")).where("classes > 1")
        compare(named, led.select("bucket", "of.leader", F.col("of.root").alias("own")))
    # All that are still of different classes, each pair once.
    pairs = written(_candidates(rooted(everything), texts, k, threshold), "pairs")
    n = pairs.select(F.explode(F.array("node", "leader")).alias("node")).distinct().count()
    if not n:
        return roots
    links = written(_linked(pairs, text, -(-n // TEXT_BLOCK), k, threshold), "links")
    links = history.where("linked = 1").select("node", "leader").union(links)
    return roots if links.isEmpty() else components(links)


def _candidates(named: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """(node, root, leader, other_root): pairs of different roots that agree on enough sketches, or are both short, and can reach the threshold.

    A pair at the threshold has so many labelled k-mers in common that it
    meets, in any order that is the same for all texts, early in both
    (``_met``). Pairs that can't link then cost nothing, in groups of near
    copies as well, where a text with several edits of its own agrees on
    sketches with all others.
    """
    mixed = named.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("bucket")
    held = named.join(mixed, "bucket").groupBy("node", "root").agg(F.sum("weight").alias("agreed")).where(F.col("agreed") >= AGREED).select("node", "root")
    rows = map_arrow(held.join(texts, "node").select("node", "root", "text"), _labelled_rows(k), "node long, root long, labelled array<bigint>")
    pairs = _met(written(rows, "labelled"), threshold)
    # The sketches decide, as in the rounds before.
    sketch, other = texts.select("node", "sketch"), texts.select(F.col("node").alias("leader"), F.col("sketch").alias("other_sketch"))
    agreed = F.size(F.filter(F.zip_with("sketch", "other_sketch", lambda a, b: a == b), lambda e: e)) >= AGREED
    return pairs.join(other, "leader").join(sketch, "node").where(F.col("short") | agreed).select("node", "root", "leader", "other_root")


def _met(labelled: DataFrame, threshold: float) -> DataFrame:
    """(node, root, leader, other_root, short): the pairs of different roots that share enough of ``labelled`` (node, root, labelled) by where they first meet.

    k-mers are ordered by the number of texts that hold them, those of one
    class first. If the first one that two texts share is at place p of n and
    q of m, they share at most min(n - p, m - q). Common k-mers are cut into
    blocks, and each pair of blocks is joined by itself.
    """
    own = labelled.select("node", "root", F.size("labelled").alias("kmers"), F.explode("labelled").alias("bucket"))
    counts = own.groupBy("bucket").agg((F.min("root") < F.max("root")).alias("shared"), F.count("*").alias("texts"))
    ranked = own.join(counts, "bucket").groupBy("node", "root", "kmers").agg(F.sort_array(F.collect_list(F.struct("shared", "texts", "bucket"))).alias("ranked"))
    first = ranked.select("node", "root", "kmers", F.posexplode(F.slice("ranked", F.lit(1), F.col("kmers") - F.ceil(threshold * F.col("kmers") - 1e-9).cast("int") + 1)).alias("place", "of"))
    first = written(first.where("of.shared").select("node", "root", "kmers", "place", F.col("of.bucket").alias("bucket")), "first")
    # Both ends and the blocks from what the prefixes hold: a k-mer that is early in one class only makes no pair.
    early = first.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.ceil(F.count("*") / BUCKET_BLOCK).alias("blocks")).where("a < b").drop("a", "b")
    rows = first.join(early, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    a = rows.select("bucket", "node", "root", "kmers", "place", F.col("block").alias("i"), F.explode(F.expr("sequence(block, blocks - 1)")).alias("j"))
    b = rows.select(
        "bucket", F.col("node").alias("leader"), F.col("root").alias("other_root"), F.col("kmers").alias("other_kmers"), F.col("place").alias("other_place"),
        F.col("block").alias("j"), F.explode(F.expr("sequence(0L, block)")).alias("i"),
    )
    enough = F.least(F.col("kmers") - F.col("place"), F.col("other_kmers") - F.col("other_place")) >= F.lit(threshold / (1 + threshold)) * (F.col("kmers") + F.col("other_kmers")) - 1e-6
    pairs = a.join(b, ["bucket", "i", "j"]).where((F.col("root") != F.col("other_root")) & enough & F.expr("i < j OR node < leader"))
    # A pair meets in the order of its blocks, which differs between k-mers.
    swap = "node > leader"
    return pairs.selectExpr(
        "least(node, leader) AS node", f"IF({swap}, other_root, root) AS root", "greatest(node, leader) AS leader", f"IF({swap}, root, other_root) AS other_root", f"greatest(kmers, other_kmers) <= {SHORT} AS short"
    ).distinct()


def _linked(pairs: DataFrame, text: DataFrame, blocks: int, k: int, threshold: float) -> DataFrame:
    """(node, leader) of links among ``pairs``, enough of them to connect what all of them would.

    Texts are dealt into ``blocks`` by hash and move once for each pair of
    blocks with a candidate, not for each candidate.
    """
    a, b = (F.pmod(F.xxhash64(c), F.lit(blocks)) for c in ("node", "leader"))
    pairs = pairs.withColumns({"i": F.least(a, b), "j": F.greatest(a, b)})
    needed = pairs.select(F.col("i").alias("of_i"), F.col("j").alias("of_j"), F.explode(F.array("node", "leader")).alias("node")).distinct().join(text, "node")
    return pairs.groupBy("i", "j").cogroup(needed.groupBy("of_i", "of_j")).applyInArrow(_verify_blocks(k, threshold), "node long, leader long")


def _prefixes(nodes: DataFrame, band: int, threshold: float) -> DataFrame:
    """(node, kmers, band, bucket, weight) of the rarest k-mers of short texts; one in common makes two of them a candidate.

    A pair at the threshold shares at least that part of the k-mers of each
    text, so it shares one of the first n - ceil(threshold * n) + 1 of each in
    any order that is the same for all texts.
    """
    own = nodes.select("node", "kmers", F.explode("short").alias("bucket"))
    counts = own.groupBy("bucket").agg(F.count("*").alias("texts"))
    rare = own.join(counts, "bucket").groupBy("node", "kmers").agg(F.sort_array(F.collect_list(F.struct("texts", "bucket"))).alias("rare"))
    first = rare.select("node", "kmers", F.explode(F.slice("rare", F.lit(1), F.col("kmers") - F.ceil(threshold * F.col("kmers") - 1e-9).cast("int") + 1)).alias("of"))
    return first.select("node", "kmers", F.lit(band).alias("band"), F.col("of.bucket").alias("bucket"), F.lit(AGREED).alias("weight"))


def near_duplicates(docs: DataFrame, *, k: int = K, keep: int = KEEP, sketches: int = SKETCHES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, class_size) for every row of ``docs``; class_size counts documents."""
    return _classes(docs, k, keep, sketches, threshold).select("doc_id", "class_id", "class_size")


def _classes(docs: DataFrame, k: int, keep: int, sketches: int, threshold: float) -> DataFrame:
    """(doc_id, text_hash, class, class_id, class_size) for every row; ``class`` names the class, null for texts without a word."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = written(map_arrow(docs.select("doc_id", "text", F.xxhash64("text")), _member_rows(k, keep, sketches), MEMBERS), "members")
    nodes = (
        members.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"), F.first("kmers").alias("kmers"), F.first("short").alias("short"), F.count("*").alias("n"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "doc_id", "sketch", "kmers", "short", "n")
    )
    nodes = written(nodes, "nodes")
    buckets = nodes.select("node", "kmers", F.posexplode("sketch").alias("band", "bucket")).withColumn("weight", F.lit(1)).union(_prefixes(nodes, sketches, threshold))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("bucket")
    buckets = written(buckets.join(shared, "bucket"), "buckets")
    wanted = buckets.select("node").distinct().join(nodes, "node").select("node", "digest", F.col("doc_id").alias("rep"), "sketch")
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["rep"])).select("node", "text", "digest", "sketch")
    texts = written(map_arrow(texts, _same_digest, "node long, text string, sketch array<bigint>").dropDuplicates(["node"]), "texts")
    roots = _roots(buckets, texts, k, threshold)
    if roots is None:
        classes = nodes.select("digest", F.col("node").alias("class"), F.col("doc_id").alias("class_id"), F.col("n").alias("class_size"))
    else:
        rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        classes = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"))
        classes = rooted.select("digest", "root").join(classes, "root").select("digest", F.col("root").alias("class"), "class_id", "class_size")
    grouped = members.where("digest IS NOT NULL").select("doc_id", "text_hash", "digest").join(classes, "digest").drop("digest")
    alone = members.where("digest IS NULL").select("doc_id", "text_hash", F.lit(None).cast("long").alias("class"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return grouped.unionByName(alone)


def keep_one(docs: DataFrame, *, k: int = K, keep: int = KEEP, sketches: int = SKETCHES, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class; texts without a word all stay.

    It is the one with the smallest id, and of the texts under that id the one
    with the smallest hash; null ids come last. Rows of one id and text are
    one document and stay once.
    """
    classes = _classes(docs, k, keep, sketches, threshold)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("best")
    kept = classes.where("class IS NOT NULL").groupBy("class").agg(best).select("best.doc_id", "best.text_hash")
    kept = kept.union(classes.where("class IS NULL").select("doc_id", "text_hash")).distinct()
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    joined = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"].cast("string")) == F.col("__hash")), "left_semi")
    return joined.dropDuplicates(["doc_id", "text"])
