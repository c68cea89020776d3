"""From raw records to the clean accident table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asphalt.functions.dates import calendar_fields
from asphalt.functions.text import weather_bucket
from asphalt.schema import INFRA, KEY_COLUMNS, UNUSABLE_COLUMNS, normal_name


def normalise_names(raw: DataFrame) -> DataFrame:
    return raw.toDF(*[normal_name(name) for name in raw.columns])


def flag(column: str) -> Column:
    """A boolean as 0 or 1, unknown counted as absent."""
    return F.coalesce(F.col(column).cast("int"), F.lit(0))


def clean(raw: DataFrame, severe_from: int = 3) -> DataFrame:
    """Drop unusable columns and unplaceable rows, add target, calendar and flags."""
    return (
        raw.drop(*UNUSABLE_COLUMNS)
        .na.drop(subset=KEY_COLUMNS)
        .withColumns({
            "grave": (F.col("severity") >= severe_from).cast("int"),
            **calendar_fields(F.col("start_time")),
            "is_night": F.coalesce((F.col("sunrise_sunset") == "Night").cast("int"), F.lit(0)),
            "weather_bucket": weather_bucket(F.col("weather_condition")),
            **{name: flag(name) for name in INFRA},
        })
    )


def territory(df: DataFrame, state: str | None) -> DataFrame:
    """Rows of one state, or of the whole country when none is named."""
    return df if state is None else df.where(F.col("state") == state)


def states(df: DataFrame) -> DataFrame:
    """Named states, without the unknown one."""
    return df.where(F.col("state") != "").select("state").distinct()


def part_of(test_from: int) -> Column:
    """The part a row belongs to: train before a year, test from it on, none without a date."""
    return F.when(F.col("year") < test_from, "train").when(F.col("year") >= test_from, "test")


def temporal_split(df: DataFrame, test_from: int) -> tuple[DataFrame, DataFrame]:
    """Train before a year, test from it on; an undated row is in neither."""
    return df.where(F.col("year") < test_from), df.where(F.col("year") >= test_from)
