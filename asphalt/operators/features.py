"""Modelling table: sampling, imputation, scaling, encoding and place history."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asphalt.operators.ordering import quantiles, refined_quantiles
from asphalt.operators.scalars import with_row
from asphalt.operators.zones import with_cell, with_cells
from asphalt.schema import CATEGORICAL_CONTROLS, FEATURES, INFRA, NUMERIC_CONTROLS, TARGET
from asphalt.session import broadcast_if_small, materialise

INFREQUENT = "_infrequent"
HISTORY_RESOLUTIONS = (7, 5)
# Says in a collapsed table how many equal rows a row stands for.
ROWS = "_rows"


def model_table(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return df.select(*FEATURES, TARGET, "year", *extra)


def collapsed(df: DataFrame) -> DataFrame:
    """Equal rows as one row with their number in ``_rows``; ``df`` may be collapsed over more columns."""
    return df.groupBy(*[c for c in df.columns if c != ROWS]).agg(row_count(df).alias(ROWS))


def expanded(df: DataFrame) -> DataFrame:
    """The rows that were collapsed."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(ROWS)))).drop("_copy", ROWS)


def row_count(df: DataFrame) -> Column:
    """The aggregate that counts the rows, collapsed or not."""
    return F.sum(ROWS) if ROWS in df.columns else F.count("*")


def drawn(key: Sequence[str], seed: int) -> Column:
    """A seeded draw of 32 bits for each row: the same in every layout, and other SQL engines can compute it."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 8), 16, 10).cast("long")


def capped_sample(df: DataFrame, max_rows: int | None, key: Sequence[str], seed: int = 42) -> DataFrame:
    """About ``max_rows`` rows drawn evenly by a hash of ``key``; everything without a cap."""
    if max_rows is None:
        return df
    rows = df.count()
    return df if rows <= max_rows else df.where(drawn(key, seed) < int(max_rows / rows * 2**32))


def stratified_cap(df: DataFrame, cap: int, key: Sequence[str], seed: int = 42, by: str = "state") -> DataFrame:
    """Exactly ``cap`` rows of each group, drawn by a repeatable hash of ``key``.

    Rows are counted by group and hash slice first. What lies beyond the slice
    the cut falls in is dropped before anything moves, and the rest is ordered
    by slice, so that no group, however large, is sorted in one task.
    """
    draw = drawn(key, seed)
    hashed = df.withColumns({"_draw": draw, "_slice": F.shiftright(draw, 20)})
    sizes = hashed.groupBy(by, "_slice").agg(F.count("*").alias("_rows"))
    # At most 4096 slices per group.
    before = Window.partitionBy(by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    cut = (
        sizes.where((F.col("_before") < cap) & (F.col("_before") + F.col("_rows") >= cap))
        .select(F.col(by).alias("_group"), F.col("_slice").alias("_cut"), (F.lit(cap) - F.col("_before")).alias("_room"))
    )
    # One row per group that has to be cut.
    cut = broadcast_if_small(materialise(cut))
    placed = hashed.join(cut, F.col(by).eqNullSafe(F.col("_group")), "left")
    kept = placed.where(F.col("_cut").isNull() | (F.col("_slice") <= F.col("_cut")))
    order = Window.partitionBy(by, "_slice").orderBy("_draw", *key)
    return (
        kept.withColumn("_place", F.row_number().over(order))
        .where(F.col("_cut").isNull() | (F.col("_slice") < F.col("_cut")) | (F.col("_place") <= F.col("_room")))
        .select(*df.columns)
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return quantiles(df, columns, 0.5, ROWS) if ROWS in df.columns else refined_quantiles(df, columns, 0.5)


def impute_median(df: DataFrame, columns: Sequence[str], found: DataFrame | None = None) -> DataFrame:
    """Replace missing numbers by the exact median, of ``df`` or as ``found`` elsewhere."""
    fills = {r["name"]: r["value"] for r in (medians(df, columns) if found is None else found).collect()}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fills.get(c))) for c in columns})


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column as text, the smallest one on a tie: (name, value)."""
    return _most_frequent(category_counts(df, columns))


def _most_frequent(counts: DataFrame) -> DataFrame:
    return counts.groupBy("name").agg(
        F.min_by("value", F.struct((-F.col("rows")).alias("rows"), F.col("value"))).alias("value")
    )


def impute_mode(df: DataFrame, columns: Sequence[str], found: DataFrame | None = None) -> DataFrame:
    """Replace missing categories by the most frequent one, of ``df`` or as ``found`` elsewhere."""
    fills = {r["name"]: r["value"] for r in (modes(df, columns) if found is None else found).collect()}
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(fills.get(c))) for c in columns})


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (name, value) of several text columns, missing values left out."""
    items = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    counted = [ROWS] if ROWS in df.columns else []
    return (
        df.select(F.explode(items).alias("item"), *counted).select("item.*", *counted)
        .where(F.col("value").isNotNull())
        .groupBy("name", "value").agg(row_count(df).alias("rows"))
    )


def pool_rare(df: DataFrame, column: str, min_rows: int = 20, reference: DataFrame | None = None) -> DataFrame:
    """Replace categories with fewer than ``min_rows`` rows by a common one."""
    counts = category_counts(df if reference is None else reference, [column])
    rare = broadcast_if_small(materialise(
        counts.where(F.col("rows") < min_rows).select(F.col("value").alias("_rare"))
    ))
    pooled = df.join(rare, F.col(column).cast("string") == F.col("_rare"), "left")
    return pooled.withColumn(
        column, F.when(F.col("_rare").isNotNull(), INFREQUENT).otherwise(F.col(column).cast("string"))
    ).drop("_rare")


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Subtract the mean and divide by the population deviation; a constant becomes 0."""
    spread = df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c) for c in columns])
    return with_row(df, spread, "_stats").withColumns({
        c: F.coalesce(
            F.try_divide(F.col(c) - F.col(f"_stats.{c}.mean"), F.col(f"_stats.{c}.sd")), F.col(c) - F.col(c)
        )
        for c in columns
    }).drop("_stats")


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Weight of each class so that all classes count the same in total."""
    counts = df.groupBy(label).agg(row_count(df).alias("n"))
    # The windows span one row per class.
    everything = Window.partitionBy()
    return counts.withColumn(
        "weight", F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))
    )


def history_columns(resolutions: Sequence[int] = HISTORY_RESOLUTIONS) -> list[str]:
    return [name for r in resolutions for name in (f"zone_hist{r}", f"zone_hist{r}_n")]


def zone_history(
    rows: DataFrame, train: DataFrame, resolutions: Sequence[int] = HISTORY_RESOLUTIONS, weight: float = 30.0
) -> DataFrame:
    """Smoothed severe rate of each row's surroundings, learnt on the training rows.

    A place without training rows gets the overall rate and a count of 0.
    """
    learnt = materialise(
        with_cells(train, resolutions, "_cell").groupBy("_cell")
        .agg(F.sum(TARGET).alias("_graves"), F.count("*").alias("_n"))
    )
    prior = learnt.agg(F.sum("_graves") / F.sum("_n")).scalar()
    table = broadcast_if_small(learnt)
    rows = rows.withColumn("_prior", prior)
    for resolution in resolutions:
        name, count = f"zone_hist{resolution}", F.coalesce("_n", F.lit(0))
        smoothed = (F.coalesce("_graves", F.lit(0)) + F.col("_prior") * weight) / (count + weight)
        rows = (
            with_cell(rows, resolution, "_cell").join(table, "_cell", "left")
            .withColumns({name: smoothed, f"{name}_n": count})
            .drop("_cell", "_graves", "_n")
        )
    return rows.drop("_prior")


@dataclass(frozen=True)
class Encoder:
    """Encodes the controls: scaled numbers ``_x_<name>``, categories as positions ``_k_<name>``.

    Flags stay plain columns, so that they can be switched before scoring.
    Numbers are encoded by column expressions. Categories are looked up in a
    dictionary table, which is joined by broadcast while it is small and by
    shuffle beyond; no category reaches the driver. The position after the last
    label stands for what training did not have.
    """

    numeric: tuple[str, ...]
    fills: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]
    modes: dict[str, str | None]
    sizes: dict[str, int]  # labels of each categorical control
    dictionary: DataFrame  # (name, value, label, position)

    @classmethod
    def fit(
        cls, train: DataFrame, numeric: Sequence[str] = NUMERIC_CONTROLS,
        categorical: Sequence[str] = CATEGORICAL_CONTROLS, min_rows: int = 20, drop_first: bool = False,
    ) -> Encoder:
        """Learn fills, scales and categories; with ``drop_first`` the first category is the reference.

        ``train`` may be collapsed.
        """
        found = {r["name"]: r["value"] for r in medians(train, numeric).collect()}
        fills = {c: found.get(c, 0.0) for c in numeric}
        times = F.col(ROWS) if ROWS in train.columns else F.lit(1)
        # Distances from the fill, which a missing value is filled with: nothing large cancels out.
        away = {c: F.coalesce(F.col(c).cast("double") - F.lit(fills[c]), F.lit(0.0)) for c in numeric}
        stats = train.agg(
            row_count(train).alias("rows"),
            *[F.sum(f * times).alias(f"{n}_{c}") for c, d in away.items() for n, f in (("sum", d), ("square", d * d))],
            *[F.sum(F.when(F.col(c).isNull(), times).otherwise(0)).alias(f"missing_{c}") for c in categorical],
        ).first()
        means, deviations = {}, {}
        for c in numeric:
            rows = stats["rows"] or 1
            shift = (stats[f"sum_{c}"] or 0.0) / rows
            means[c] = fills[c] + shift
            deviations[c] = math.sqrt(max(0.0, (stats[f"square_{c}"] or 0.0) / rows - shift * shift)) or 1.0
        counted = materialise(category_counts(train, categorical))
        most = {r["name"]: r["value"] for r in _most_frequent(counted).collect()}
        filled = F.col("rows")
        for c in categorical:  # missing values count for the most frequent category
            is_most = (F.col("name") == c) & (F.col("value") == F.lit(most.get(c)))
            filled = filled + F.when(is_most, stats[f"missing_{c}"] or 0).otherwise(0)
        marked = counted.select("name", "value", (filled >= min_rows).alias("kept"))
        # A window holds the labels of a control, which are positions of a model; rare ones share the last.
        place = F.row_number().over(Window.partitionBy("name").orderBy("value")) - 1
        labels = marked.where("kept").select("name", "value", F.col("value").alias("label"), place.alias("position"))
        totals = marked.groupBy("name").agg(F.count_if("kept").alias("position"), F.count_if(~F.col("kept")).alias("rare"))
        totals = materialise(totals)  # one row a control
        rare = marked.where(~F.col("kept")).join(F.broadcast(totals), "name").select(
            "name", "value", F.lit(INFREQUENT).alias("label"), F.col("position").cast("int").alias("position"))
        first = int(drop_first)
        dictionary = materialise(
            labels.unionByName(rare).withColumn("position", F.col("position") - first).where("position >= 0"))
        sizes = {r["name"]: max(0, r["position"] + (r["rare"] > 0) - first) for r in totals.collect()}
        return cls(
            tuple(numeric), fills, means, deviations, {c: most.get(c) for c in categorical},
            {c: sizes.get(c, 0) for c in categorical}, dictionary,
        )

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        """The dictionary of each control: (value, position) under names of its own."""
        return {
            c: broadcast_if_small(self.dictionary.where(F.col("name") == c).select(
                F.col("value").alias(f"_value_{c}"), F.col("position").cast("double").alias(f"_k_{c}")))
            for c in self.used
        }

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the encoded columns."""
        scaled = {
            f"_x_{c}": (F.coalesce(F.col(c).cast("double"), F.lit(self.fills[c])) - self.means[c]) / self.deviations[c]
            for c in self.numeric
        }
        df = df.withColumns(scaled)
        for c in self.used:
            value = F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))
            df = df.join(self.tables[c], value == F.col(f"_value_{c}"), "left").drop(f"_value_{c}")
        return df.withColumns({f"_k_{c}": F.coalesce(f"_k_{c}", F.lit(float(self.sizes[c]))) for c in self.used})

    def labels(self, c: str) -> DataFrame:
        """The labels of a control: (position, label)."""
        return self.dictionary.where(F.col("name") == c).select("position", "label").distinct()

    @property
    def used(self) -> list[str]:
        return [c for c, size in self.sizes.items() if size]

    @property
    def columns(self) -> list[str]:
        """The encoded columns."""
        return [*[f"_x_{c}" for c in self.numeric], *[f"_k_{c}" for c in self.used]]

    @cached_property
    def one_hot(self) -> OneHotEncoderModel:
        """Positions to sparse vectors; the position after the last label is all zeros."""
        sizes = SparkSession.active().createDataFrame([tuple(float(self.sizes[c]) for c in self.used)], [f"_k_{c}" for c in self.used])
        return OneHotEncoder(inputCols=sizes.columns, outputCols=[f"_v_{c}" for c in self.used], dropLast=True).fit(sizes)

    def spread(self, df: DataFrame, flags: Sequence[str] = INFRA) -> DataFrame:
        """Flags and controls as the sparse vector ``features``, one position a category."""
        named = [*flags, *[f"_x_{c}" for c in self.numeric]]
        hot = self.one_hot.transform(df) if self.used else df
        return _assembled(hot, [*named, *[f"_v_{c}" for c in self.used]]).drop(
            *self.columns, *[f"_v_{c}" for c in self.used])

    def grouped(self, df: DataFrame, flags: Sequence[str] = INFRA) -> DataFrame:
        """Flags and controls as the vector ``features``, one position a control; trees split categories by themselves."""
        for c in self.used:
            kind = {"type": "nominal", "name": f"_k_{c}", "num_vals": self.sizes[c] + 1}
            df = df.withMetadata(f"_k_{c}", {"ml_attr": kind})
        return _assembled(df, [*flags, *self.columns]).drop(*self.columns)

    @property
    def largest(self) -> int:
        """Positions of the control with most categories."""
        return max((size + 1 for size in self.sizes.values()), default=1)


def _assembled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)
