"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivestats.llm import decontaminate, language_id, line_dedup, near_dup, packing
from drivestats.llm.common import table, written
from drivestats.llm.tokens import default_tokenizer


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; undetermined and ambiguous ones go."""
    model = language_id.train(docs, ~language_id.held_out(F.col("doc_id")))
    return language_id.with_language(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines of runs that occur earlier; n_chars follows."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in training sequences."""
    return packing.pack(docs, default_tokenizer())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("packing", pack_sequences),
]

#: The first and the last stage are not SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
