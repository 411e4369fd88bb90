"""Quality rules with adaptive thresholds from mergeable quantile sketches (operator 3); DataFrame functions only.

Every document gets its word statistics. Four ratios of them are held against
thresholds that follow the documents of the same language and source: a
quantile sketch of each ratio gives quartiles, and a document is an outlier
beyond a quartile by ``SPREADS`` times the distance of the quartiles (or of a
least distance, where a corpus is so even that any difference would count).

A sketch is a histogram over buckets that grow with the value (a relative
error of 1/16 at most), so sketches merge by adding counts: those of a
language and of the whole corpus are sums of the same rows, and stand in where
a source has fewer than ``MIN_DOCS`` documents. Its size is bounded by the
buckets, whatever the number of documents, and it does not depend on order.

Defined cases: null texts have no words, fail the base rules and enter no
sketch; null languages and sources are groups of their own; repeated rows each
count; an empty table gives an empty result. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from drivestats.llm.common import written

SPREADS, MIN_DOCS, SALTS = 4, 50, 16
#: Ratio -> (SQL of whole numbers, least distance of quartiles, whether small values are outliers too).
RATIOS = {
    "symbols": ("1000 * n_symbols DIV word_chars", 10, False),
    "word_length": ("100 * word_chars DIV n_words", 50, True),
    "dup_lines": ("1000 * n_dup_lines DIV n_lines", 50, False),
    "repeats": ("1000 * n_repeat_words DIV n_words", 50, False),
}
#: Buckets: whole numbers below 32 have one each, larger ones share their five leading binary digits.
BUCKET = "IF(value < 32, value, shiftleft(shiftright(value, length(bin(value)) - 5), length(bin(value)) - 5))"


def word_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of the contract; also n_lines, the lines with a word."""
    spaces = "\\\\x20\\\\x09-\\\\x0D"
    t = docs.select("doc_id", "lang", "source", F.coalesce(F.col("text"), F.lit("")).alias("t"))
    t = t.select(
        "doc_id", "lang", "source",
        F.expr(f"filter(split(t, '[{spaces}]+'), w -> w != '')").alias("words"),
        F.char_length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        F.expr("CAST(char_length(t) - char_length(translate(t, '#*$%&|<>', '')) AS bigint)").alias("n_symbols"),
        F.expr(f"filter(split(t, '\\n'), l -> l RLIKE '[^{spaces}]')").alias("lines"),
    )
    # The places of 3-word windows by their hash, so that equal windows lie side by side.
    t = t.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        F.expr("CAST(size(words) AS bigint)").alias("n_words"),
        F.expr("CAST(size(lines) AS bigint)").alias("n_lines"),
        F.expr("CAST(size(lines) - size(array_distinct(lines)) AS bigint)").alias("n_dup_lines"),
        F.expr(
            "IF(size(words) < 3, array(), sort_array(transform(sequence(0, size(words) - 3), i -> struct(xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)) AS h, i AS i))))"
        ).alias("grams"),
    )
    t = t.withColumn("places", F.expr("sort_array(transform(filter(grams, (g, i) -> coalesce(g.h = get(grams, i - 1).h, false) OR coalesce(g.h = get(grams, i + 1).h, false)), g -> g.i))")).drop("grams")
    # Each window adds three words, less those that it shares with the next one.
    repeated = "CAST(aggregate(transform(places, (p, i) -> least(3, coalesce(get(places, i + 1) - p, 3))), 0, (a, b) -> a + b) AS bigint)"
    t = t.withColumn("n_repeat_words", F.expr(repeated)).drop("places")
    return t.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


def quantile_sketches(ratios: DataFrame) -> DataFrame:
    """(lang, source, ratio, bucket, n): the sketch of each ratio for each language and source."""
    long = ratios.selectExpr("lang", "source", f"stack({len(RATIOS)}, {', '.join(f'{name!r}, {name}' for name in RATIOS)}) AS (ratio, value)")
    return long.groupBy("lang", "source", "ratio", F.expr(BUCKET).alias("bucket")).agg(F.count("*").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ratio, total, q1, q3) from sketches merged by ``keys``: the smallest buckets with a quarter, and three, at or below them."""
    merged = sketches.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    of = Window.partitionBy(*keys, "ratio")
    upto = of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(of).alias("total"))
    return ranked.groupBy(*keys, "ratio").agg(
        F.max("total").alias("total"), F.min(F.expr("IF(4 * upto >= total, bucket, NULL)")).alias("q1"), F.min(F.expr("IF(4 * upto >= 3 * total, bucket, NULL)")).alias("q3")
    )


def thresholds(sketches: DataFrame) -> DataFrame:
    """(lang, source, and high_ and low_ of every ratio): from the source's own sketch, else its language's, else all."""
    own = quartiles(sketches, ["lang", "source"])
    by_lang = quartiles(sketches, ["lang"]).select(F.col("lang").alias("of"), "ratio", F.struct("total", "q1", "q3").alias("of_lang"))
    by_all = quartiles(sketches, []).select("ratio", F.struct("total", "q1", "q3").alias("of_all"))
    own = own.join(by_lang, own["lang"].eqNullSafe(by_lang["of"]) & (own["ratio"] == by_lang["ratio"])).drop(by_lang["ratio"], "of").join(by_all, "ratio")
    own = own.withColumn("q", F.expr(f"CASE WHEN total >= {MIN_DOCS} THEN struct(total, q1, q3) WHEN of_lang.total >= {MIN_DOCS} THEN of_lang ELSE of_all END"))
    bounds = []
    for name, (_, least, both) in RATIOS.items():
        spread = f"greatest(q.q3 - q.q1, {least}L) * {SPREADS}"
        bounds.append(F.max(F.expr(f"IF(ratio = '{name}', q.q3 + {spread}, NULL)")).alias(f"high_{name}"))
        if both:
            bounds.append(F.max(F.expr(f"IF(ratio = '{name}', q.q1 - {spread}, NULL)")).alias(f"low_{name}"))
    return own.groupBy("lang", "source").agg(*bounds)


def judge(docs: DataFrame) -> DataFrame:
    """The statistics of every row of ``docs`` (doc_id, text, lang, source), base_failed and kept."""
    # Written once: the sketches and the verdict both read the statistics, and no filter is pushed into them.
    stats = written(word_statistics(docs), "word_statistics")
    ratios = stats.selectExpr("*", *(f"IF(n_words > 0, {sql}, NULL) AS {name}" for name, (sql, _, _) in RATIOS.items()), f"pmod(xxhash64(doc_id), {SALTS}) AS salt")
    # Documents that pass the base rules set the thresholds. One source may hold a third of all rows: salted.
    limits = thresholds(quantile_sketches(ratios.where("NOT base_failed")))
    limits = limits.withColumnsRenamed({"lang": "of_lang", "source": "of_source"}).withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = ratios.join(limits, F.expr("lang <=> of_lang AND source <=> of_source AND salt = of_salt"), "left")
    inside = " AND ".join(f"{name} <= high_{name}" + (f" AND {name} >= low_{name}" if both else "") for name, (_, _, both) in RATIOS.items())
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.expr(f"NOT base_failed AND coalesce({inside}, true)").alias("kept")
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are not kept; a document id stands for its rows."""
    good = judge(docs).where("kept").select(F.col("doc_id").alias("__good")).distinct()
    return docs.join(good, docs["doc_id"].eqNullSafe(F.col("__good")), "left_semi")


ORACLE = r"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM t),
n AS (SELECT row_number() OVER () AS r, *, len(words) AS n_words, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM w),
g AS (SELECT r, unnest(range(1, n_words - 1)) AS i, words FROM n WHERE n_words >= 3),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i+1], words[i+2]) AS c FROM g),
p AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM h, (VALUES (0), (1), (2)) AS k(k) WHERE c > 1 GROUP BY r),
s AS (SELECT n.*, coalesce(n_repeat_words, 0) AS n_repeat_words, n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed FROM n LEFT JOIN p USING (r)),
v AS (SELECT *, 1000 * n_symbols // word_chars AS symbols, 100 * word_chars // n_words AS word_length, 1000 * n_dup_lines // n_lines AS dup_lines, 1000 * n_repeat_words // n_words AS repeats FROM s),
l AS (SELECT lang, source, unnest([{'ratio': 'symbols', 'value': symbols}, {'ratio': 'word_length', 'value': word_length}, {'ratio': 'dup_lines', 'value': dup_lines}, {'ratio': 'repeats', 'value': repeats}]) AS x FROM v WHERE NOT base_failed),
b AS (SELECT lang, source, x.ratio AS ratio, CASE WHEN x.value < 32 THEN x.value ELSE (x.value >> (length(bin(x.value)) - 5)) << (length(bin(x.value)) - 5) END AS bucket FROM l),
groups AS (SELECT DISTINCT lang, source FROM b),
lv AS (SELECT lang, source, ratio, bucket, 0 AS level FROM b
       UNION ALL SELECT g.lang, g.source, b.ratio, b.bucket, 1 FROM groups g JOIN b ON g.lang IS NOT DISTINCT FROM b.lang
       UNION ALL SELECT g.lang, g.source, b.ratio, b.bucket, 2 FROM groups g, b),
q AS (SELECT lang, source, ratio, level, count(*) AS total, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM lv GROUP BY ALL),
c AS (SELECT * FROM q WHERE total >= 50 OR level = 2 QUALIFY row_number() OVER (PARTITION BY lang, source, ratio ORDER BY level) = 1),
f AS (SELECT lang, source,
        max(q3 + 4 * greatest(q3 - q1, 10)) FILTER (ratio = 'symbols') AS high_symbols,
        max(q3 + 4 * greatest(q3 - q1, 50)) FILTER (ratio = 'word_length') AS high_word_length, max(q1 - 4 * greatest(q3 - q1, 50)) FILTER (ratio = 'word_length') AS low_word_length,
        max(q3 + 4 * greatest(q3 - q1, 50)) FILTER (ratio = 'dup_lines') AS high_dup_lines,
        max(q3 + 4 * greatest(q3 - q1, 50)) FILTER (ratio = 'repeats') AS high_repeats FROM c GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(symbols <= high_symbols AND word_length BETWEEN low_word_length AND high_word_length AND dup_lines <= high_dup_lines AND repeats <= high_repeats, true) AS kept
FROM v LEFT JOIN f ON v.lang IS NOT DISTINCT FROM f.lang AND v.source IS NOT DISTINCT FROM f.source
"""
