"""Output tables and files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asphalt.functions import hexgrid


def write_prepared(df: DataFrame, folder: str, table: str, by: str | None = None) -> None:
    """Prepared Parquet table.

    With ``by`` each value gets its own folder. Rows are gathered by a rebalance
    that splits large values, so one busy value is not written by one task.
    """
    if by is None:
        df.write.mode("overwrite").parquet(f"{folder}/{table}")
    else:
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(f"{folder}/{table}")


def write_csv(df: DataFrame, folder: str, name: str) -> None:
    """Report of bounded size as one CSV file in a folder of its own."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def write_summary(spark: SparkSession, summary: dict, folder: str, name: str) -> None:
    """Run summary as one JSON line."""
    line = spark.createDataFrame([(json.dumps(summary, ensure_ascii=False),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{folder}/{name}")


def geojson_features(zones: DataFrame, properties: list[str], resolution: int = 8) -> DataFrame:
    """One GeoJSON feature per zone: outline, centre and the given columns as properties."""
    lat, lng = hexgrid.centre(F.col("cell"), resolution)
    ring = F.transform(hexgrid.boundary(F.col("cell"), resolution), lambda p: F.array(p["lng"], p["lat"]))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.struct(*properties, lat.alias("centre_lat"), lng.alias("centre_lng")).alias("properties"),
    )
    return zones.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_geojson(zones: DataFrame, properties: list[str], folder: str, name: str, resolution: int = 8) -> None:
    """Features as GeoJSON text, one per line."""
    geojson_features(zones, properties, resolution).write.mode("overwrite").text(f"{folder}/{name}")
