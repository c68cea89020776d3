"""WHERE: hexagonal zones ranked by severity-weighted burden."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asphalt.functions import hexgrid
from asphalt.operators.ordering import row_numbers, running_totals
from asphalt.operators.scalars import with_row
from asphalt.schema import INFRA



def by_burden() -> list[Column]:
    """Total order of zones: largest burden first, then the cell name."""
    return [F.desc("charge"), F.asc("cell")]


def with_cell(df: DataFrame, resolution: int = 8, name: str = "cell") -> DataFrame:
    return df.withColumn(name, hexgrid.cell(F.col("start_lat"), F.col("start_lng"), resolution))


def with_cells(df: DataFrame, resolutions: Sequence[int], name: str = "cell") -> DataFrame:
    """Repeat each row once per resolution with the cell it falls in.

    Cell names start with their resolution, so one column holds them all. The
    cells are columns first: inside the explode they would be compiled without
    sharing their common parts.
    """
    lat, lng = F.col("start_lat"), F.col("start_lng")
    columns = {f"_cell_{r}": hexgrid.cell(lat, lng, r) for r in resolutions}
    return df.withColumns(columns).withColumn(name, F.explode(F.array(*columns))).drop(*columns)


def bins(df: DataFrame, resolutions: Sequence[int]) -> DataFrame:
    """Accidents and burden per cell at several resolutions, in one scan."""
    return with_cells(df, resolutions).groupBy("cell").agg(
        F.count("*").alias("n"), F.sum("severity").alias("charge")
    )


def zone_table(df: DataFrame, resolution: int = 8, keys: Sequence[str] = ("state",)) -> DataFrame:
    """One row per zone: accidents, mean severity, burden and both kinds of flag totals.

    ``keys`` are kept next to the cell; leave them out to merge a border cell
    over its states. The sums are combined before the only shuffle, so a zone
    that holds a third of the rows costs no more than another.
    """
    return (
        with_cell(df, resolution)
        .groupBy(*keys, "cell")
        .agg(
            F.count("*").alias("n_accidents"),
            F.avg("severity").alias("avg_severity"),
            F.sum("severity").alias("charge"),
            *[F.sum(e).alias(f"n_{e}") for e in INFRA],
            *[F.sum(F.col("severity") * F.col(e)).alias(f"charge_{e}") for e in INFRA],
        )
    )


def zone_years(df: DataFrame, resolution: int = 8, keys: Sequence[str] = ("state",)) -> DataFrame:
    return (
        with_cell(df, resolution)
        .groupBy(*keys, "cell", "year")
        .agg(F.count("*").alias("n"), F.sum("severity").alias("charge"), F.sum("grave").alias("graves"))
    )


def ranked(zones: DataFrame) -> DataFrame:
    """All zones numbered by burden."""
    return row_numbers(zones, by_burden(), "rank")


def priority(zones: DataFrame, top: int) -> DataFrame:
    """The ``top`` zones by burden with their rank; all zones if there are fewer."""
    # The window runs over the ``top`` rows that the limit leaves.
    best = zones.orderBy(*by_burden()).limit(top)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*by_burden())))


def concentration(zones: DataFrame) -> DataFrame:
    """Share of the burden held by the first zones, for every rank."""
    totals = running_totals(zones.select("cell", "charge"), by_burden(), {"charge": F.col("charge"), "zones": F.lit(1)})
    return totals.select(
        F.col("cum_zones").cast("int").alias("rank"), "cell", "charge",
        (F.col("cum_zones") / F.col("all_zones") * 100).alias("zones_pct"),
        (F.col("cum_charge") / F.col("all_charge")).alias("charge_share"),
    )


def priority_with_share(zones: DataFrame, top: int) -> DataFrame:
    """Priority zones with the running share of the whole burden they hold.

    Only the total needs all zones, so no global order is built.
    """
    best = priority(zones, top)
    total = zones.agg(F.sum("charge").alias("total")).scalar()
    return best.withColumn("charge_share", F.sum("charge").over(Window.orderBy("rank")) / total)


def extent(zones: DataFrame, resolution: int = 8) -> DataFrame:
    """Bounds and middle of the centres of a set of cells."""
    lat, lng = hexgrid.centre(F.col("cell"), resolution)
    box = zones.select(lat.alias("lat"), lng.alias("lng")).agg(
        F.min("lat").alias("south"), F.max("lat").alias("north"),
        F.min("lng").alias("west"), F.max("lng").alias("east"),
    )
    return box.withColumns({
        "mid_lat": (F.col("south") + F.col("north")) / 2, "mid_lng": (F.col("west") + F.col("east")) / 2,
    })


def marker_size(zones: DataFrame) -> DataFrame:
    """Size in [0, 1] from burden per km, from plain burden where that is unknown."""
    bounds = zones.agg(
        *[f(c).alias(f"{n}_{c}") for c in ("charge_per_km", "charge") for n, f in (("lo", F.min), ("hi", F.max))]
    )

    def scaled(column: str) -> Column:
        low, high = F.col(f"_limits.lo_{column}"), F.col(f"_limits.hi_{column}")
        position = F.when(high > low, (F.col(column) - low) / (high - low)).otherwise(F.lit(0.0))
        return F.when(F.col(column).isNotNull(), position)

    size = F.coalesce(scaled("charge_per_km"), scaled("charge"))
    return with_row(zones, bounds, "_limits").withColumn("size", size).drop("_limits")


def totals(zones: DataFrame) -> DataFrame:
    """Headline figures of a territory."""
    return zones.agg(
        F.sum("n_accidents").alias("accidents"), F.count("*").alias("zones"), F.sum("charge").alias("charge"),
        (F.sum("charge") / F.sum("n_accidents")).alias("avg_severity"),
    )
