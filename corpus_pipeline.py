"""A training corpus from raw documents, in stages that each read what the one before wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asphalt.llm import decontaminate, mixture, near_dedup, sharding, toxicity
from asphalt.session import checkpoint_ready

SIMILARITY = 0.8  # of five-word shingles make an edited copy


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select(F.struct("*").alias("row"), "text"), model)
    return scored.where(~toxicity.rejected(F.col("toxicity.score"))).select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Of rows that repeat an id and its text one stays. Rows without an id stay, as nothing names their group.
    """
    groups = near_dedup.near_duplicates(docs, similarity=SIMILARITY)
    kept = groups.where("doc_id IS NULL OR doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    kept_docs = docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")
    spread = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    same = Window.partitionBy("doc_id", F.xxhash64("text"), spread).orderBy("doc_id")
    return kept_docs.select("*", F.row_number().over(same).alias("__copy")).where("__copy = 1").drop("__copy")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copied benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for, once at least."""
    return mixture.mixed(docs).select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in shuffled order: shard and slot."""
    return sharding.shuffled_shards(docs)


STAGES = [
    ("toxicity", toxicity_stage), ("near_dedup", near_dedup_stage), ("decontamination", decontamination_stage),
    ("mixing", mixing_stage), ("sharding", sharding_stage),
]

# Fingerprints, alignments and the toxicity model have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table in the shared folder.

    A stage's table is removed once the next one is written; the last one stays for the result.
    """
    checkpoint_ready(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = f"{folder}/{name}"
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
