"""Registered queries of the training-data operators: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asphalt.llm import (
    chat, clustering, decontaminate, fingerprints, language_id, line_dedup, lm_scoring, mixture, near_dedup, personal_data, resampling,
    sharding, toxicity,
)
from asphalt.llm.folds import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_scaled_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, sf, "documents"))


@query
def op2_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, sf, "benchmark"))


@query
def op3_temperature_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixture.mixed(table(spark, sf, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "tokens", "epoch", "turn", "block")


ORACLE["op3_temperature_mixing"] = mixture.ORACLE


@query
def op4_cross_entropy_difference(spark: SparkSession, sf: str) -> DataFrame:
    good = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return lm_scoring.cross_entropy_difference(table(spark, sf, "documents"), good)


ORACLE["op4_cross_entropy_difference"] = lm_scoring.ORACLE


@query
def op5_line_windows(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = line_dedup.deduplicated(table(spark, sf, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "kept_text")


ORACLE["op5_line_windows"] = line_dedup.ORACLE


@query
def op6_preference_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return chat.swapped_answer_pairs(table(spark, sf, "conversations"))


ORACLE["op6_preference_pairs"] = chat.ORACLE


@query
def op7_language_spans(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    labelled = language_id.identify(docs.select("doc_id", "text"), language_id.fit(docs))
    return labelled.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.spans").alias("spans"))


@query
def op8_two_pass_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.sharded_digest(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity.score").alias("score"),
        toxicity.rejected(F.col("toxicity.score")).cast("int").alias("predicted"),
        F.col("toxicity.words").alias("words"))


@query
def op10_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents"))


@query
def op11_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.resampled(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))


ORACLE["op11_importance_resampling"] = resampling.ORACLE


@query
def op12_centroid_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.clustered(table(spark, sf, "embeddings").select("vec_id", "embedding"))


ORACLE["op12_centroid_clusters"] = clustering.ORACLE


@query
def op13_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return personal_data.span_digests(table(spark, sf, "documents").select("doc_id", "text"))
