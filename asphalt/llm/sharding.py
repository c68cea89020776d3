"""Shards of a uniformly shuffled collection, by an external shuffle in two passes.

The first pass scatters records over buckets of a size that fits into a task's
memory, by a seeded hash of their id. The second permutes each bucket by
Fisher-Yates. Buckets stand one after the other in the shuffled order, so a
record's position is the number of records in the buckets before its own plus
its place in it. Shards are equal stretches of positions: their row counts
differ by one at most, and a bucket is written to one or two shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asphalt.llm.batches import text_batches
from asphalt.llm.columns import packed, unpacked

SHARDS = 24
BUCKET_BYTES = 16 << 20
# Counts of so many buckets reach the driver at most; beyond, buckets grow.
MAX_BUCKETS = 500_000
RECORD_BYTES = 8
CROWDED = 4  # a bucket of so many times the wanted size holds an id that repeats very often
RUN = 1_000  # equal rows are numbered in runs of so many


def record_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) and a fixed part for the record."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + RECORD_BYTES


def _bucketed(rows: DataFrame, buckets: int, seed: int, *keys: str) -> DataFrame:
    spot = F.xxhash64(F.lit(seed), *keys)
    return rows.withColumns({"bucket": F.pmod(spot, F.lit(buckets)), "spot": spot})


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number that tells equal rows apart, 0 for one that occurs once.

    Equal rows are counted, partial sums first, and written out again in runs
    that are spread before they are: numbers don't depend on the layout.
    """
    counted = rows.groupBy("row", "id", "size").agg(F.count("*").alias("n"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))))
    spread = runs.repartition(F.xxhash64("row"), "run")
    last = F.least(F.col("n"), F.col("run") + RUN) - 1
    return spread.select("row", "id", "size", F.explode(F.sequence("run", last)).alias("number"))


def shuffled_shards(
    docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text",
    bucket_bytes: int = BUCKET_BYTES, seed: int = 8,
) -> DataFrame:
    """Every row once, with ``shard`` (from 0) and ``slot`` (from 0, without gaps in a shard).

    The order depends on ids, texts and the seed, not on the table's layout.
    Null texts and null ids are records like others. Rows that share an id
    share a bucket; if one id fills a bucket of several times the wanted size,
    all rows are scattered by what else they hold as well, equal rows by a
    number. Which of equal rows stands where can't be told. Very long texts
    move whole, so a bucket holds one text at least.
    Columns named ``shard`` or ``slot`` are replaced, others stay. An empty
    table gives an empty result.
    """
    spark, names = docs.sparkSession, docs.columns
    text_batches(spark)
    rows = docs.select(packed(docs).alias("row"), F.col(id_column).alias("id"), record_size(F.col(text_column)).alias("size"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = int(min(max(1, -(-total // bucket_bytes)), MAX_BUCKETS))
    keyed = _bucketed(rows, buckets, seed, "id")
    sums = keyed.groupBy("bucket").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).collect()
    if any(r["bytes"] > CROWDED * max(bucket_bytes, total / buckets) for r in sums):
        keyed = _bucketed(_numbered(rows), buckets, seed, "id", "row", "number").drop("number")
        sums = keyed.groupBy("bucket").agg(F.count("*").alias("rows")).collect()
    counts = np.zeros(buckets, dtype=np.int64)
    for r in sums:
        counts[r["bucket"]] = r["rows"]
    starts = spark.sparkContext.broadcast(np.concatenate(([0], np.cumsum(counts))))  # one number a bucket
    n = int(counts.sum())

    def permute(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        order = np.lexsort((table["tie"].to_numpy(), table["spot"].to_numpy()))
        order = order[np.random.default_rng([seed, bucket]).permutation(len(order))]  # Fisher-Yates
        position = starts.value[bucket] + np.arange(len(order), dtype=np.int64)
        shard = ((position + 1) * shards - 1) // n
        return pa.table({
            "row": table["row"].take(pa.array(order)), "shard": pa.array(shard.astype(np.int32)),
            "slot": pa.array(position - shard * n // shards),
        })

    schema = T.StructType([
        T.StructField("row", keyed.schema["row"].dataType), T.StructField("shard", T.IntegerType()),
        T.StructField("slot", T.LongType()),
    ])
    ties = F.xxhash64("row").alias("tie")
    dealt = keyed.select("bucket", "spot", ties, "row").groupBy("bucket").applyInArrow(permute, schema)
    return dealt.select(*unpacked(names, "row", ["shard", "slot"]))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, each file in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def sharded_digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """What the records of each shard are: sizes, checksums, shard and slot."""
    return shuffled_shards(docs, shards).select(
        "doc_id", record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
