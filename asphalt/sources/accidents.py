"""Input tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from asphalt.schema import raw_schema


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """Accident file with a header and the fixed schema; an unreadable cell is NULL."""
    return spark.read.option("header", True).schema(raw_schema()).csv(path)


def read_prepared(spark: SparkSession, folder: str, table: str, schema: StructType | None = None) -> DataFrame:
    """A prepared table; a filter on its partition column reads only those folders."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{table}")


def is_prepared(spark: SparkSession, folder: str, table: str) -> bool:
    try:
        read_prepared(spark, folder, table)
    except AnalysisException:
        return False
    return True


def road_segments(spark: SparkSession, path: str) -> DataFrame:
    """Road segments: ``u``, ``v`` (end nodes), ``start_lat``, ``start_lng``, ``length_m`` and, if known, ``end_lat``, ``end_lng``."""
    found = spark.read.parquet(path)
    ends = [c for c in ("end_lat", "end_lng") if c in found.columns]
    return found.select("u", "v", "start_lat", "start_lng", *ends, "length_m")
