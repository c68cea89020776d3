"""Does the ranking hold over time?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asphalt.functions.scoring import correlation_tails
from asphalt.operators.ordering import quantiles, tie_ranks
from asphalt.operators.scalars import with_row
from asphalt.operators.zones import with_cell
from asphalt.session import materialise


def period_burdens(
    df: DataFrame, early: tuple[int, int], late: tuple[int, int], resolution: int = 8
) -> DataFrame:
    """Burden of each cell in two periods, NULL where it has no accident in one.

    Both periods come out of one aggregation, so no join of two is needed.
    """

    def burden(first: int, last: int) -> Column:
        return F.sum(F.when(F.col("year").between(first, last), F.col("severity")))

    return (
        with_cell(df, resolution).groupBy("cell")
        .agg(burden(*early).alias("early"), burden(*late).alias("late"))
        .where(F.col("early").isNotNull() | F.col("late").isNotNull())
    )


def period_scores(burdens: DataFrame) -> DataFrame:
    """Burdens scaled to [0, 1] within each period, for cells present in both."""
    bounds = burdens.agg(*[
        f(c).alias(f"{n}_{c}") for c in ("early", "late") for n, f in (("lo", F.min), ("hi", F.max))
    ])

    def scaled(column: str) -> Column:
        low, high = F.col(f"_limits.lo_{column}"), F.col(f"_limits.hi_{column}")
        return F.try_divide((F.col(column) - low).cast("double"), (high - low).cast("double")).alias(column)

    placed = with_row(burdens, bounds, "_limits")
    return placed.select("cell", scaled("early"), scaled("late")).na.drop(subset=["early", "late"])


def rank_correlation(df: DataFrame, left: str, right: str) -> DataFrame:
    """Spearman correlation (n, rho) of two columns.

    Rows are counted per distinct pair of values first: everything after that
    works on pairs, however many rows share one.
    """
    pairs = df.where(F.col(left).isNotNull() & F.col(right).isNotNull()).groupBy(
        F.col(left).alias("l"), F.col(right).alias("r")
    ).agg(F.count("*").alias("w"))
    pairs = materialise(pairs)
    left_ranks = tie_ranks(pairs, "l", "w").withColumnRenamed("avg_rank", "lr")
    right_ranks = tie_ranks(pairs, "r", "w").withColumnRenamed("avg_rank", "rr")
    n = pairs.agg(F.sum("w").alias("n")).scalar()
    # The mean of averaged ranks is always (n + 1) / 2.
    x, y, w = F.col("lr") - (n + 1) / 2.0, F.col("rr") - (n + 1) / 2.0, F.col("w")
    sums = pairs.join(left_ranks, "l").join(right_ranks, "r").agg(
        F.sum("w").alias("n"),
        F.sum(w * x * y).alias("xy"), F.sum(w * x * x).alias("xx"), F.sum(w * y * y).alias("yy"),
    )
    return sums.select("n", F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")).alias("rho"))


def stability(burdens: DataFrame) -> DataFrame:
    """Correlation of the two periods with its two-sided p-value: (n, rho, p_value).

    The p-value is that of Student's t. Without a correlation or with two cells
    at most it is unknown; a perfect correlation has 0.
    """
    slack = F.lit(1.0) - F.col("rho") * F.col("rho")
    p = F.when(F.col("n") <= 2, None).when(slack <= 1e-12, 0.0).otherwise(correlation_tails(F.col("rho"), F.col("n")))
    return rank_correlation(burdens, "early", "late").withColumn("p_value", F.when(F.col("rho").isNotNull(), p))


def still_on_top(burdens: DataFrame, top: int, fraction: float = 0.95) -> DataFrame:
    """How many of the first ``top`` cells of the early period reach the top of the late one."""
    burdens = materialise(burdens)
    threshold = quantiles(burdens, ["late"], fraction).select("value").scalar()
    first = burdens.where(F.col("early").isNotNull()).orderBy(F.desc("early"), "cell").limit(top)
    return first.withColumn("threshold", threshold).agg(
        F.count("*").alias("early_top"),
        F.count(F.when(F.col("late") >= F.col("threshold"), 1)).alias("kept"),
        F.max("threshold").alias("late_threshold"),
    )


def backtest(zone_years: DataFrame, top: int, past_until: int, future_from: int) -> DataFrame:
    """Share of later severe accidents in the zones an earlier ranking names.

    ``zone_years`` has one row per (…, cell, year). Past burden and later severe
    accidents of a cell come out of one aggregation; the shares are unknown when
    there is no past zone or no later severe accident.
    """
    past, future = F.col("year") <= past_until, F.col("year") >= future_from
    cells = materialise(zone_years.groupBy("cell").agg(
        F.sum(F.when(past, F.col("charge"))).alias("past_charge"),
        F.sum(F.when(future, F.col("graves"))).alias("future_graves"),
    ))
    named = cells.where(F.col("past_charge").isNotNull()).orderBy(F.desc("past_charge"), "cell").limit(top)
    captured = named.agg(F.sum("future_graves").alias("captured")).scalar()
    return (
        cells.agg(F.sum("future_graves").alias("future_graves"), F.count("future_graves").alias("future_zones"))
        .withColumn("captured", captured)
        .withColumn("share", F.try_divide(F.col("captured").cast("double"), F.col("future_graves").cast("double")))
        .withColumn("weight", F.lit(float(top)) / F.greatest("future_zones", F.lit(1)))
        .withColumn("ratio", F.col("share") / F.greatest("weight", F.lit(1e-9)))
    )
