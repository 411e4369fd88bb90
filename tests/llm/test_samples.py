"""Training samples: a bound that holds, and is reached, at any size and for repeated and null ids."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from drivestats.llm import language_id, token_files, toxicity
from drivestats.llm.common import bounded_sample
from drivestats.llm.tokens import default_tokenizer

def by():
    return [F.col("doc_id"), F.col("text")]


@pytest.mark.parametrize("rows", [
    [(i, f"text {i}") for i in range(3000)],
    [(None, f"text {i}") for i in range(3000)],
    [(7, f"text {i}") for i in range(3000)],
])
def test_exactly_the_bound(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bounded_sample(df, by(), 20).collect()
    assert len(got) == 20 and set(map(tuple, got)) <= set(rows)
    # The same rows whatever their order and partitions.
    assert sorted(map(str, got)) == sorted(map(str, bounded_sample(df.repartition(7).orderBy("text"), by(), 20).collect()))


def test_few_distinct_rows_in_many(spark):
    """One millionth and less of the rows hold all distinct texts: none is missed, copies count once."""
    df = spark.range(3_000_000).select((F.col("id") % 3).alias("doc_id"), F.lit("same").alias("text"))
    assert bounded_sample(df, by(), 10).count() == 3
    assert bounded_sample(df.limit(0), by(), 10).count() == 0


def test_per_group(spark):
    rows = [(i, f"t{i}", "de" if i % 100 else "fr") for i in range(2000)] + [(9, "t", None)] * 5
    got = bounded_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), by(), 30, "lang")
    assert {r["lang"]: r["count"] for r in got.groupBy("lang").count().collect()} == {"de": 30, "fr": 20, None: 1}


def test_models_learn_from_repeated_and_null_ids(spark):
    """A third of all rows without id, a third under one id: op2, op6 and op9 still learn, from bounded samples."""
    text = {"de": "der hund und die katze schlafen im garten", "en": "the dog and the cat are sleeping outside"}
    ids = {0: None, 1: 5}
    rows = [(ids.get(i % 3, i), f"{text[lang]} {i}", lang) for i in range(600) for lang in ("de", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs, F.lit(True), max_texts=40)
    found = language_id.predict(docs, model).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"]: r["count"] for r in found} == {"de": 600, "en": 600}
    odd = spark.createDataFrame([(1, "² ½ ① 12 _"), (2, None), (3, "é")], "doc_id long, text string")
    assert [r["lang_pred"] == "und" for r in language_id.predict(odd, model).orderBy("doc_id").collect()] == [True, True, False]
    assert token_files.train_dictionary(docs, default_tokenizer(), 0, 2000, 300, 10_000)
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(600)] + [(5, 1)] * 300 + [(None, 1)] * 300, "doc_id long, toxic int")
    marked = docs.where("lang = 'en'").withColumn("text", F.when(F.coalesce("doc_id", F.lit(0)) % 2 == 1, F.concat("text", F.lit(" vile rubbish"))).otherwise(F.col("text")))
    judge = toxicity.train(marked, labels, F.lit(True), max_texts=100)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame([(1, "vile rubbish"), (2, "the cat")], "doc_id long, text string"), judge).collect()}
    assert scores[1] > 0.5 > scores[2]
