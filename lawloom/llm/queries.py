"""Queries of the text operators, with production parameters, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lawloom.llm import bpe, decontam, language, lm_scoring, merkle, pii, probminhash, quality, rules, spelling, token_counts, tokens_out, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_digest(table(spark, folder, "documents"))


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents"))


@query
def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), urls.rule_table(spark))


ORACLES |= {"op6_quality_rules": rules.ORACLE, "op9_url_filters": urls.ORACLE}


@query
def op10_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


@query
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokens_out.write_and_read(table(spark, folder, "documents"))


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.document_counts(table(spark, folder, "documents"))


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return probminhash.classes(table(spark, folder, "documents"))


@query
def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op11_naive_bayes_lang(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.tamper_and_audit(table(spark, folder, "documents"))


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


ORACLES |= {"op12_merkle_manifest": merkle.ORACLE, "op13_spelling_variants": spelling.ORACLE}
