"""Checks that stop a run instead of letting a wrong table through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asphalt.schema import (
    CATEGORICAL_CONTROLS, FEATURES, INFRA, NUMERIC_CONTROLS, TARGET, UNUSABLE_COLUMNS,
)

SIZES = ("train_rows",)  # told next to the violations
DERIVED = ["hour", "dow", "month", "year", "is_night"]


class CheckFailed(AssertionError):
    """Names the checks that did not hold."""


def require(violations: DataFrame) -> None:
    """Raise when any column of a one-row table of violation counts is not zero."""
    row = violations.drop(*SIZES).first().asDict()
    failed = sorted(name for name, count in row.items() if count)
    if failed:
        raise CheckFailed(", ".join(f"{name} ({row[name]})" for name in failed))


def _absent(columns: Sequence[str], wanted: Sequence[str]) -> int:
    return len(set(wanted) - set(columns))


def clean_violations(df: DataFrame) -> DataFrame:
    """Violation counts of the clean table, in one scan."""
    return df.agg(
        F.count_if(~F.coalesce(F.col(TARGET).isin(0, 1), F.lit(False))).alias("target_not_binary"),
        F.count_if(F.col("start_lat").isNull() | F.col("start_lng").isNull()).alias("no_position"),
        F.count_if(F.col("severity").isNull()).alias("no_severity"),
        *[F.count_if(~F.coalesce(F.col(e).isin(0, 1), F.lit(False))).alias(f"bad_{e}") for e in INFRA],
        F.lit(len(set(UNUSABLE_COLUMNS) & set(df.columns))).cast("long").alias("unusable_kept"),
        F.lit(_absent(df.columns, DERIVED)).cast("long").alias("derived_missing"),
    )


def leak_violations(
    table: DataFrame, train: DataFrame, test: DataFrame, test_from: int, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Violation counts of the modelling split: nothing of the outcome or the future leaks in."""
    known = set(INFRA) | set(NUMERIC_CONTROLS) | set(CATEGORICAL_CONTROLS)
    late, early = F.col("year") >= test_from, F.col("year") < test_from
    parts = train.select(F.lit(True).alias("is_train"), "year").unionAll(test.select(F.lit(False), "year"))
    return parts.agg(
        F.count_if(F.col("is_train") & late).alias("train_rows_from_test_years"),
        F.count_if(~F.col("is_train") & early).alias("test_rows_from_train_years"),
        F.count_if("is_train").alias("train_rows"),
        F.lit(len({TARGET, "severity"} & set(features))).cast("long").alias("target_in_features"),
        F.lit(_absent(table.columns, features)).cast("long").alias("features_missing"),
        F.lit(len(set(features) ^ known)).cast("long").alias("features_unexpected"),
    )


def plan_violations(plan: DataFrame, distinct_actions: int = 3) -> DataFrame:
    """Violation counts of a finished plan."""
    n, charge, severity = F.col("n_accidents"), F.col("charge"), F.col("avg_severity")
    return plan.agg(
        (F.count("*") - F.count_distinct("rank")).alias("rank_repeated"),
        F.count_if(F.col("rank") < 1).alias("rank_below_one"),
        F.when(F.min("rank") == 1, 0).otherwise(1).cast("long").alias("rank_not_from_one"),
        F.count_if(~severity.between(1, 4)).alias("severity_out_of_range"),
        F.count_if(charge < n).alias("charge_below_accidents"),
        F.count_if(F.abs(charge - n * severity) > n * 0.01 + 5).alias("charge_unlike_mean"),
        F.count_if(F.col("impact_graves_evites") < 0).alias("impact_negative"),
        F.count_if(~F.col("cell").rlike(r"^\d+:-?\d+:-?\d+$")).alias("cell_invalid"),
        F.when(F.count_distinct("amenagement") >= distinct_actions, 0).otherwise(1).cast("long").alias("actions_alike"),
    )
