"""Target-distribution importance resampling over deduplicated lines (operator 12).

Features are runs of 1 to ``max_run`` consecutive words, hashed into buckets.
A bucket's gain says how much commoner it is in the target than in the corpus;
a document's weight is the mean gain of its features, and Gumbel noise seeded
by its id turns the largest scores into a draw without replacement.

A line feed ends every word, so a text is cut into lines whose features can be
counted apart. Each distinct line of the corpus is hashed once: corpus counts
are its counts times its occurrences, a document's gain is the sum over its
lines. Runs that cross a line end are counted per document and added.

Lines move as text only once, combined within each task. The lines that hold
at least one in ``HOT`` of all line places (so at most ``HOT`` of them) are
broadcast, the others are joined by a 128-bit digest. Driver and broadcasts
hold the buckets, the hot lines and one row per distinct score; scores are
whole numbers within about +-60,000 by the formula.

Defined cases: null texts and texts without a word have no features, weight 0
and are never drawn; null ids count as empty text in the noise and come last
among ties; repeated rows are documents of their own; rows that share id and
score are ranked in any order; an empty target or corpus only empties its
counts. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drivestats.llm.common import removed, written_at

MAX_RUN, BUCKETS, MIN_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: A line with more than one in so many of all line places is joined by broadcast.
HOT = 10_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]|[A-Z]"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), NOT_WORD), lambda w: w != "")


def bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def _neighbours(own: Column, n: int) -> Column:
    """The runs of ``n`` consecutive elements as structs, by zipping shifted arrays: nothing is looked up per element."""
    size = F.greatest(F.size(own) - (n - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(own, F.lit(j + 1), size).alias(f"_{j}") for j in range(n)])


def _runs(own: Column, max_run: int, buckets: int) -> Column:
    """Buckets of the runs of 1 to ``max_run`` words of one line."""

    def of(n: int) -> Column:
        return F.transform(_neighbours(own, n), lambda z: bucket(F.concat_ws(" ", *[z.getField(f"_{j}") for j in range(n)]), buckets))

    single = F.transform(own, lambda w: bucket(w, buckets))
    return single if max_run == 1 else F.concat(single, *[of(n) for n in range(2, max_run + 1)])


def _crossing(docs: DataFrame, max_run: int, buckets: int, *keep: Column) -> DataFrame:
    """``keep`` and the bucket of each run of 2 to ``max_run`` words that crosses a line end of ``text``."""
    placed = F.flatten(F.transform(F.split("text", "\n"), lambda line, i: F.transform(words(line), lambda w: F.struct(i.alias("line"), w.alias("word")))))

    def of(n: int) -> Column:
        def ends(z: Column) -> list[Column]:
            return [z.getField(f"_{j}") for j in range(n)]

        across = F.filter(_neighbours(F.col("placed"), n), lambda z: ends(z)[0]["line"] != ends(z)[-1]["line"])
        return F.transform(across, lambda z: bucket(F.concat_ws(" ", *[e["word"] for e in ends(z)]), buckets))

    held = docs.where(F.contains("text", F.lit("\n"))).select(*keep, placed.alias("placed"))
    names = [c for c in held.columns if c != "placed"]
    return held.select(*names, F.explode(F.concat(*[of(n) for n in range(2, max_run + 1)])).alias("bucket"))


def _digest(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def distinct_lines(docs: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(h1, h2, places, n_words, features) of every distinct line with a word; ``places`` counts its occurrences."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(WORD)).groupBy("line").agg(F.count("*").alias("places"))
    own = lines.select("line", "places", words(F.col("line")).alias("words"))
    return own.select(*_digest(F.col("line")), "places", F.size("words").alias("n_words"), _runs(F.col("words"), max_run, buckets).alias("features"))


def bucket_counts(docs: DataFrame, lines: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts, from the distinct lines and the runs that cross line ends."""
    found = lines.select("places", F.explode("features").alias("bucket"))
    if max_run > 1:
        found = found.union(_crossing(docs, max_run, buckets, F.lit(1).cast("long").alias("places")))
    return found.groupBy("bucket").agg(F.sum("places").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for the buckets of the corpus: thousandths of the log ratio of smoothed shares."""
    sums = [F.coalesce(F.sum("n"), F.lit(0)).cast("double")]
    whole_corpus, whole_target = (t.agg(*sums).first()[0] for t in (corpus, target))
    both = corpus.select("bucket", F.col("n").alias("s")).join(F.broadcast(target.select("bucket", F.col("n").alias("t"))), "bucket", "left")
    s, t = F.col("s").cast("double"), F.coalesce("t", F.lit(0)).cast("double")
    ratio = ((t + 1.0) * F.lit(whole_corpus + buckets)) / ((s + 1.0) * F.lit(whole_target + buckets))
    return both.select("bucket", F.floor(1000.0 * F.log(ratio)).alias("gain"))


def _noise(doc_id: Column, seed: int) -> Column:
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(docs: DataFrame, target: DataFrame, *, max_run: int = MAX_RUN, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    target = target.select(F.col("text").cast("string").alias("text"))
    lines, path = written_at(distinct_lines(docs, max_run, buckets), "lines")
    corpus, corpus_path = written_at(bucket_counts(docs, lines, max_run, buckets), "corpus_counts")  # at most a row a bucket
    aimed, aimed_path = written_at(bucket_counts(target, distinct_lines(target, max_run, buckets), max_run, buckets), "target_counts")
    gains, gains_path = written_at(bucket_gains(corpus, aimed, buckets), "gains")
    # What a line adds to each document that holds it.
    exploded = lines.select("h1", "h2", "places", "n_words", F.size("features").alias("n_features"), F.explode("features").alias("bucket"))
    worth = exploded.join(F.broadcast(gains), "bucket").groupBy("h1", "h2", "places", "n_words", "n_features").agg(F.sum("gain").alias("gain"))
    worth, worth_path = written_at(worth, "line_gains")
    places = lines.agg(F.sum("places")).first()[0] or 0
    hot = F.broadcast(worth.where(F.col("places") * HOT >= places).select("h1", "h2", *[F.col(c).alias(f"hot_{c}") for c in ("n_words", "n_features", "gain")]))
    held = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    held = held.select("row", "doc_id", F.explode_outer(F.split("text", "\n")).alias("line"))
    held = held.select("row", "doc_id", *_digest(F.col("line")))
    held = held.join(hot, ["h1", "h2"], "left").withColumn("is_hot", F.col("hot_gain").isNotNull())
    # Within a task, hot lines shrink to a row a document.
    common = held.where("is_hot").groupBy("row", "doc_id").agg(*[F.sum(f"hot_{c}").alias(c) for c in ("n_words", "n_features", "gain")])
    rare = held.where("NOT is_hot").select("row", "doc_id", "h1", "h2").join(worth.drop("places"), ["h1", "h2"], "left").select("row", "doc_id", "n_words", "n_features", "gain")
    parts = common.union(rare)
    if max_run > 1:
        runs = _crossing(docs.withColumn("row", F.monotonically_increasing_id()), max_run, buckets, F.col("row"), F.col("doc_id"))
        runs = runs.join(F.broadcast(gains), "bucket").select("row", "doc_id", F.lit(0), F.lit(1), "gain")
        parts = parts.union(runs)
    sums = parts.groupBy("row", "doc_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_words", "n_features", "gain")])
    weight = F.when(F.col("n_features") == 0, F.lit(0).cast("long")).otherwise(F.expr("(gain - pmod(gain, n_features)) div n_features"))
    scored = sums.select("doc_id", "n_words", "n_features", weight.alias("weight")).withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))
    scored, _ = written_at(scored, "scored")
    for p in (path, corpus_path, aimed_path, gains_path, worth_path):
        removed(docs.sparkSession, p)
    return scored


def draw(scored: DataFrame, *, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored`` with the rank of the ``percent`` of eligible rows of largest score; null where not drawn."""
    spark = scored.sparkSession
    eligible = F.col("n_words") >= min_words
    # A row per distinct score: bounded by the range of scores, not by the documents.
    counts = sorted(map(tuple, scored.where(eligible).groupBy("score").agg(F.count("*")).collect()), reverse=True)
    wanted = percent * sum(n for _, n in counts) // 100
    before, starts = 0, []
    for score, n in counts:
        if before >= wanted:
            break
        starts.append((score, before))
        before += n
    first = F.broadcast(spark.createDataFrame(starts, "score long, before long"))
    marked = scored.join(first, "score", "left").withColumn("before", F.when(eligible, F.col("before")))
    nth = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    near = marked.where("before IS NOT NULL").withColumn("rank", F.col("before") + nth)
    near = near.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = marked.where("before IS NULL").withColumn("rank", F.lit(None).cast("long"))
    return near.unionByName(rest).drop("before")


def resample(docs: DataFrame, target: DataFrame, *, max_run: int = MAX_RUN, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs``."""
    scored = weigh(docs, target, max_run=max_run, buckets=buckets, seed=seed)
    return draw(scored, min_words=min_words, percent=percent).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = rf"""
WITH RECURSIVE bits AS (SELECT i, CAST(i AS BIGINT) AS v, 0 AS step FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM bits WHERE step < 8),
tbl AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8),
docs AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
aims AS (SELECT regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
dw AS (SELECT r, unnest(ws) AS w FROM docs), aw AS (SELECT unnest(ws) AS w FROM aims),
vocabulary AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM aw)),
hashed AS MATERIALIZED (SELECT w, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(h) // 2), lambda i: CAST(instr('0123456789ABCDEF', h[2 * i + 1]) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 17 AS BIGINT))),
    lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))) % {BUCKETS} AS b FROM vocabulary, tbl),
s AS (SELECT b, count(*) AS s FROM dw JOIN hashed USING (w) GROUP BY b), t AS (SELECT b, count(*) AS t FROM aw JOIN hashed USING (w) GROUP BY b),
gains AS (SELECT b, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + {BUCKETS})::DOUBLE)
    / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (b)),
sums AS (SELECT r, sum(gain) AS g FROM dw JOIN hashed USING (w) JOIN gains USING (b) GROUP BY r),
weighed AS (SELECT doc_id, coalesce(len(ws), 0) AS n, CAST(CASE WHEN coalesce(len(ws), 0) = 0 THEN 0 ELSE (g - (g % len(ws) + len(ws)) % len(ws)) // len(ws) END AS BIGINT) AS weight,
    list_reduce(list_transform(range(1, 9), lambda i: CAST(instr('0123456789abcdef', substr(sha256(concat('{SEED}:', doc_id)), i, 1)) - 1 AS BIGINT)), lambda x, y: x * 16 + y) AS h FROM docs LEFT JOIN sums USING (r)),
scored AS (SELECT doc_id, n, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM weighed),
ranked AS (SELECT *, CASE WHEN n >= {MIN_WORDS} THEN row_number() OVER (PARTITION BY n >= {MIN_WORDS} ORDER BY score DESC, doc_id) END AS k FROM scored)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, weight, score,
       CASE WHEN k <= {PERCENT} * (SELECT count(*) FROM scored WHERE n >= {MIN_WORDS}) // 100 THEN k END AS rank FROM ranked
"""
