"""Registered queries of this subpackage: ``opN_<name>``, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivestats.llm import (
    decontaminate, drift_kmeans, embedding_dedup, html_extract, language_id, licenses, line_dedup, near_dup, packing, quality, resampling, token_files, toxicity,
)
from drivestats.llm.common import table
from drivestats.llm.tokens import default_tokenizer
from drivestats.session import work_path


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out(F.col("doc_id"))
    return language_id.predict(docs, language_id.train(docs, ~held)).withColumn("held_out", held)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "token_files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, default_tokenizer(), end_id=0)
    return token_files.read_token_files(spark, path)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), deleted="n_deleted_lines")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = toxicity.held_out(F.col("doc_id"))
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), ~held))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), default_tokenizer())


def op11_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift_kmeans.cluster(table(spark, sf_dir, "embeddings"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_html_extract, op2_language_id, op3_quality, op4_near_duplicates, op5_decontaminate,
            op6_token_files, op7_licenses, op8_line_dedup, op9_toxicity, op10_packing, op11_embedding_duplicates, op12_resampling, op13_clustering,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_quality": quality.ORACLE, "op5_decontaminate": decontaminate.ORACLE, "op7_licenses": licenses.oracle(), "op8_line_dedup": line_dedup.ORACLE,
        "op12_resampling": resampling.ORACLE, "op13_clustering": drift_kmeans.oracle(),
    }
