"""Exact ranks, running totals and quantiles over tables too large for one task.

A window without partitions moves every row to one task. Here the rows are
range-partitioned by their order instead: each range is totalled on its own
and shifted by the sum of the ranges before it. Ranges are checkpointed, so
that a lost executor cannot change which row belongs to which range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asphalt.session import materialise


def running_totals(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """Add ``cum_<name>`` (this row included) and ``all_<name>`` for every sum.

    ``order`` must not tie between rows: collapse equal keys first, which also
    keeps a key held by many rows from filling one range.
    """
    ranged = materialise(df.repartitionByRange(*order))
    ranged = ranged.withColumns({"_range": F.spark_partition_id(), **{f"_v_{n}": c for n, c in sums.items()}})

    # One row per range: its size is the number of partitions, not of rows.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = ranged.groupBy("_range").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    offsets = offsets.select(
        "_range",
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(everything).alias(f"all_{n}") for n in sums],
    )

    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({f"_c_{n}": F.sum(f"_v_{n}").over(within) for n in sums})
    return summed.join(F.broadcast(offsets), "_range").select(
        *df.columns,
        *[(F.col(f"_c_{n}") + F.col(f"_o_{n}")).alias(f"cum_{n}") for n in sums],
        *[F.col(f"all_{n}") for n in sums],
    )


def row_numbers(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number all rows from 1 in a total order."""
    numbered = running_totals(df, order, {"_rows": F.lit(1)})
    return numbered.withColumn(name, F.col("cum__rows").cast("int")).drop("cum__rows", "all__rows")


def tie_ranks(df: DataFrame, value: str, weight: str | None = None, descending: bool = True) -> DataFrame:
    """Average rank of every distinct value: one row per value, not per input row."""
    rows = F.count("*") if weight is None else F.sum(weight)
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(rows.alias("_ties"))
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranked = running_totals(counts, [order], {"ties": F.col("_ties")})
    return ranked.select(value, (F.col("cum_ties") - (F.col("_ties") - 1) / 2.0).alias("avg_rank"))


def quantiles(df: DataFrame, columns: Sequence[str], fraction: float, weight: str | None = None) -> DataFrame:
    """Exact linearly interpolated quantile of each column: (name, value).

    ``weight`` names a column that says how many rows a row stands for. NULLs and NaNs are left out. A column without values gets no row.
    """
    long = df.select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value"))
            for c in columns
        ])).alias("item"), (F.lit(1) if weight is None else F.col(weight)).alias("_weight")
    ).select("item.*", "_weight")
    counts = long.where(F.col("value").isNotNull()).groupBy("name", "value").agg(F.sum("_weight").alias("rows"))
    ordered = running_totals(counts, [F.col("name"), F.col("value")], {"rows": F.col("rows")})

    # One row per requested column.
    spans = ordered.groupBy("name").agg(
        F.min(F.col("cum_rows") - F.col("rows")).alias("_start"), F.sum("rows").alias("_rows")
    ).withColumn("_at", (F.col("_rows") - 1) * F.lit(float(fraction)))
    placed = ordered.join(F.broadcast(spans), "name").withColumns({
        "_last": F.col("cum_rows") - F.col("_start"),
        "_first": F.col("cum_rows") - F.col("_start") - F.col("rows"),
    })

    def value_at(index: Column) -> Column:
        return F.max(F.when((F.col("_first") <= index) & (index < F.col("_last")), F.col("value")))

    low, high = value_at(F.floor("_at")), value_at(F.ceil("_at"))
    step = F.max(F.col("_at") - F.floor("_at"))
    return placed.groupBy("name").agg((low + (high - low) * step).alias("value"))


# A range of so many rows is counted value by value.
COUNTED_ROWS = 10_000
SKETCH_ACCURACY = 2_000


@dataclass(frozen=True)
class _Search:
    """Where the value of a rank (from 0) lies: ``inside`` rows in ``low`` to ``high``, ``below`` rows under it."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    inside: int

    @property
    def found(self) -> bool:
        return self.low == self.high


def _number(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None))


def _narrowed(df: DataFrame, searches: Sequence[_Search]) -> list[_Search]:
    """Each search in a range of a few thousandths of its rows; two passes that leave one row a task."""
    def within(s: _Search) -> Column:
        v = _number(s.column)
        return F.when(v.between(s.low, s.high), v)

    margin = 2.0 / SKETCH_ACCURACY
    shares = [(s.rank - s.below + 0.5) / s.inside for s in searches]
    bounds = df.agg(*[
        F.percentile_approx(within(s), [max(0.0, p - margin), min(1.0, p + margin)], SKETCH_ACCURACY).alias(f"b{i}")
        for i, (s, p) in enumerate(zip(searches, shares))]).first()
    tried = [replace(s, low=bounds[f"b{i}"][0], high=bounds[f"b{i}"][1]) for i, s in enumerate(searches)]
    # The bounds' own rows are counted apart: a bound that many rows share is settled, and every round gets further.
    counts = []
    for i, (s, old) in enumerate(zip(tried, searches)):
        v = within(old)
        counts += [
            F.count_if(v < s.low).alias(f"below{i}"), F.count_if(v == s.low).alias(f"low{i}"),
            F.count_if((v > s.low) & (v < s.high)).alias(f"mid{i}"), F.count_if(v == s.high).alias(f"high{i}"),
            F.max(F.when(v < s.low, v)).alias(f"under{i}"), F.min(F.when(v > s.high, v)).alias(f"over{i}"),
            F.min(F.when((v > s.low) & (v < s.high), v)).alias(f"first{i}"), F.max(F.when((v > s.low) & (v < s.high), v)).alias(f"last{i}"),
        ]
    row = df.agg(*counts).first()
    result = []
    for i, (s, old) in enumerate(zip(tried, searches)):
        at = s.rank - old.below
        below, low, mid, high = (row[f"{n}{i}"] for n in ("below", "low", "mid", "high"))
        both = low if s.low == s.high else low + mid + high
        if at < below:
            result.append(replace(old, high=row[f"under{i}"], inside=below))
        elif at < below + low:
            result.append(replace(s, high=s.low, below=old.below + below, inside=low))
        elif at < below + low + mid:
            result.append(replace(s, low=row[f"first{i}"], high=row[f"last{i}"], below=old.below + below + low, inside=mid))
        elif at < below + both:
            result.append(replace(s, low=s.high, below=old.below + below + low + mid, inside=high))
        else:
            result.append(replace(old, low=row[f"over{i}"], below=old.below + below + both, inside=old.inside - below - both))
    return result


def refined_quantiles(df: DataFrame, columns: Sequence[str], fraction: float) -> DataFrame:
    """Exact linearly interpolated quantile of each column of a very large table: (name, value).

    The range that holds a wanted rank is narrowed by sketches and counts until
    few rows are left in it, which are counted by value. No row is moved: a pass
    leaves one row a task. ``df`` is read several times, so it is best kept.
    NULLs and NaNs are left out. A column without values gets no row.
    """
    spark = df.sparkSession
    spans = df.agg(*[
        F.struct(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high")).alias(f"c{i}")
        for i, v in enumerate(map(_number, columns))]).first()
    wanted, searches = {}, {}
    for i, c in enumerate(columns):
        span = spans[f"c{i}"]
        if span["n"]:
            at = (span["n"] - 1) * float(fraction)
            wanted[c] = at
            for rank in {floor(at), ceil(at)}:
                searches[c, rank] = _Search(c, rank, span["low"], span["high"], 0, span["n"])
    while open_ := [k for k, s in searches.items() if not s.found and s.inside > COUNTED_ROWS]:
        searches |= zip(open_, _narrowed(df, [searches[k] for k in open_]))
    left = {k: s for k, s in searches.items() if not s.found}
    values = {k: s.low for k, s in searches.items() if s.found}
    if left:
        items = F.array(*[
            F.struct(F.lit(i).alias("search"), F.when(_number(s.column).between(s.low, s.high), _number(s.column)).alias("value"))
            for i, s in enumerate(left.values())])
        counted = df.select(F.explode(items).alias("item")).select("item.*").where("value IS NOT NULL").groupBy("search", "value").count()
        # At most COUNTED_ROWS rows a search.
        rows = sorted(tuple(r) for r in counted.collect())
        for i, (k, s) in enumerate(left.items()):
            reached = s.below
            for search, value, n in rows:
                if search == i and k not in values:
                    reached += n
                    if reached > s.rank:
                        values[k] = value
    table = []
    for c, at in wanted.items():
        low, high = values[c, floor(at)], values[c, ceil(at)]
        table.append((c, low if low == high else low + (high - low) * (at - floor(at))))
    return spark.createDataFrame(table, "name string, value double")
