"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, centroids, decontaminate, exact, hmm, language, license, near, pieces, pii, quality, repeats, secrets
from .common import table
from .sql import SQL


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumn("places", F.array_join("places", ","))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.find_near_duplicates(table(spark, sf_dir, "documents"), width=4, threshold=80)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.find_duplicates(table(spark, sf_dir, "documents"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(table(spark, sf_dir, "embeddings"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_repeats, op3_quality, op4_license_scan, op5_secret_scan, op6_minhash,
                            op7_decontamination, op8_exact_dedup, op9_language_model, op10_sentencepiece, op11_filter_audit,
                            op12_centroids, op13_language)}

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
