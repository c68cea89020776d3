"""WHEN: severity by hour, weather, month, year and calendar event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asphalt.functions.dates import event_window
from asphalt.labels import NATIONAL



def by_dimension(df: DataFrame, dimension: str) -> DataFrame:
    """Accidents and severe share for each value of a dimension."""
    return df.groupBy(dimension).agg(F.count("*").alias("n"), F.avg("grave").alias("part_grave"))


def by_event(df: DataFrame) -> DataFrame:
    """Accidents, severe percent and mean severity per calendar event."""
    return (
        df.groupBy(event_window(F.col("start_time")).alias("event"))
        .agg(F.count("*").alias("n"), F.avg("grave").alias("share"), F.avg("severity").alias("mean"))
        .select(
            "event", "n",
            F.bround(F.col("share") * 100, 1).alias("part_grave"),
            F.bround("mean", 3).alias("sev_moy"),
        )
        .orderBy(F.desc("n"), "event")
    )


def event_counts(df: DataFrame, *dimensions: str) -> DataFrame:
    """Accidents, severe accidents and total severity per calendar event and dimension values."""
    return df.groupBy(event_window(F.col("start_time")).alias("event"), *dimensions).agg(
        F.count("*").alias("n"), F.sum("grave").cast("long").alias("graves"), F.sum("severity").alias("charge"))


def events_of(counts: DataFrame) -> DataFrame:
    """The table of ``by_event`` from counted groups."""
    sums = counts.groupBy("event").agg(F.sum("n").alias("n"), F.sum("graves").alias("graves"), F.sum("charge").alias("charge"))
    return sums.select(
        "event", "n", F.bround(F.col("graves") / F.col("n") * 100, 1).alias("part_grave"),
        F.bround(F.col("charge") / F.col("n"), 3).alias("sev_moy"),
    ).orderBy(F.desc("n"), "event")


def peak_hour(hourly: DataFrame) -> DataFrame:
    """Hour with the largest severe share, the earliest one on a tie."""
    best = F.max_by(
        F.struct("hour", "part_grave"), F.struct("part_grave", (-F.col("hour")).alias("early"))
    )
    return hourly.agg(best.alias("best")).select(
        F.col("best.hour").alias("peak_hour"),
        F.bround(F.col("best.part_grave") * 100, 1).alias("pct_max"),
    )


def grouped_counts(df: DataFrame, *dimensions: str) -> DataFrame:
    """Accidents and severe accidents per state and dimension values."""
    return df.groupBy("state", *dimensions).agg(
        F.count("*").alias("n"), F.sum("grave").cast("long").alias("graves")
    )


def shares_of(counts: DataFrame, dimension: str) -> DataFrame:
    """Accidents and severe share for each value of a dimension, from counted groups."""
    sums = counts.groupBy(dimension).agg(F.sum("n").alias("n"), F.sum("graves").alias("graves"))
    return sums.select(dimension, "n", (F.col("graves") / F.col("n")).alias("part_grave"))


def totals_of(counts: DataFrame, dimension: str, national: str = NATIONAL) -> DataFrame:
    """Totals per (state, value) and for the whole country, from counted groups.

    A missing state is a group of its own and is not taken for the country.
    Both levels run over the counted groups, not over the accidents.
    """
    return (
        counts.groupingSets([["state", dimension], [dimension]], "state", dimension)
        .agg(
            F.sum("n").alias("n"), F.sum("graves").cast("long").alias("graves"),
            F.grouping("state").alias("is_total"),
        )
        .withColumn("state", F.when(F.col("is_total") == 1, national).otherwise(F.col("state")))
        .drop("is_total")
    )


def cube_of(counts: DataFrame, dimension: str) -> DataFrame:
    return totals_of(counts, dimension).select(
        "state", dimension, "n", (F.col("graves") / F.col("n")).alias("part_grave")
    )


def cube(df: DataFrame, dimension: str) -> DataFrame:
    """(state or country, value) with accidents and severe share."""
    return cube_of(grouped_counts(df, dimension), dimension)


def year_trend(df: DataFrame) -> DataFrame:
    """(state or country, year) with accidents and severe accidents."""
    return totals_of(grouped_counts(df, "year"), "year")


def for_territory(cubes: DataFrame, territories: DataFrame, national: str = NATIONAL) -> DataFrame:
    """Rows of each requested territory, national rows where it has none.

    ``territories`` has one column ``territory``.
    """
    known = cubes.select(F.col("state").alias("territory")).where(F.col("territory").isNotNull()).distinct()
    present = territories.join(known, "territory", "left_semi").withColumn("source", F.col("territory"))
    absent = territories.join(known, "territory", "left_anti").withColumn("source", F.lit(national))
    wanted = present.unionByName(absent)
    return wanted.join(cubes, wanted["source"] == cubes["state"]).drop("state")
