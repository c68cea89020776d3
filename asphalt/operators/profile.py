"""Descriptive profile of the clean table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asphalt.schema import INFRA
from asphalt.session import materialise



def long_format(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Turn a one-row result with one column per item into one row per item."""
    return row.unpivot([], list(columns), name, value)


def target_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.avg("grave").alias("part_grave"))


def missing_rate(df: DataFrame) -> DataFrame:
    """Percent of missing values for each column that has any, in one scan.

    Rows are counted per pattern of missing columns: one key and one counter a
    row, where a counter a column would be too much code to compile. The few
    patterns are then taken apart.
    """
    names = df.columns
    pattern = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in names])
    patterns = df.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n"))
    items = F.array(*[
        F.struct(F.lit(c).alias("column"), (F.substring("pattern", i + 1, 1) == "1").alias("missing"))
        for i, c in enumerate(names)
    ])
    missing = F.sum(F.when(F.col("item.missing"), F.col("n")).otherwise(0))
    return (
        patterns.select("n", F.explode(items).alias("item")).groupBy("item.column")
        .agg((missing * 100.0 / F.sum("n")).alias("pct_missing"))
        .where(F.col("pct_missing") > 0)
        .orderBy(F.desc("pct_missing"), "column")
    )


def coverage(df: DataFrame, top: int = 15, leaders: int = 3) -> DataFrame:
    """Largest states by volume, and the share of the table the leaders hold."""
    by_state = materialise(df.groupBy("state").agg(F.count("*").alias("n")))
    total = by_state.agg(F.sum("n").alias("total")).scalar()
    leading = (
        by_state.orderBy(F.desc("n"), "state").limit(leaders).agg(F.sum("n").alias("held")).scalar()
    )
    return (
        by_state.orderBy(F.desc("n"), "state").limit(top)
        .withColumn("leaders_pct", leading / total * 100)
    )


def severity_distribution(df: DataFrame) -> DataFrame:
    counts = df.groupBy("severity").agg(F.count("*").alias("n"))
    # The window spans one row per severity class.
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", F.col("n") / total * 100).orderBy("severity")


def flag_patterns(df: DataFrame, elements: Sequence[str] = INFRA) -> DataFrame:
    """Accidents and total severity per combination of flags.

    There are at most 2^12 combinations: questions about flags are answered on
    these few rows after one scan that updates two sums per accident.
    """
    return df.groupBy(*elements).agg(F.count("severity").alias("n"), F.sum("severity").alias("charge"))


def infra_delta(df: DataFrame, elements: Sequence[str] = INFRA) -> DataFrame:
    """Mean severity with and without each element."""
    return delta_of(flag_patterns(df, elements), elements)


def delta_of(patterns: DataFrame, elements: Sequence[str] = INFRA) -> DataFrame:
    """The table of ``infra_delta`` from totals per flag combination."""
    item = F.explode(F.array(*[F.struct(F.lit(e).alias("element"), F.col(e).alias("flag")) for e in elements]))

    def mean(flag: int) -> Column:
        return F.try_divide(
            F.sum(F.when(F.col("item.flag") == flag, F.col("charge"))).cast("double"),
            F.sum(F.when(F.col("item.flag") == flag, F.col("n"))).cast("double"),
        )

    return (
        patterns.select("n", "charge", item.alias("item"))
        .groupBy("item.element").agg(mean(0).alias("sev_without"), mean(1).alias("sev_with"))
        .withColumn("delta", F.col("sev_with") - F.col("sev_without"))
        .where(F.col("delta").isNotNull())
        .orderBy("delta", "element")
    )


def flag_domain(df: DataFrame, elements: Sequence[str] = INFRA) -> DataFrame:
    """Smallest and largest value of each flag."""
    bounds = df.agg(*[F.struct(F.min(e).alias("lo"), F.max(e).alias("hi")).alias(e) for e in elements])
    return long_format(bounds, elements, "element", "b").select("element", "b.lo", "b.hi")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
