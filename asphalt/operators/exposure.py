"""Road exposure of zones: how much street and how many junctions they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asphalt import labels
from asphalt.functions import hexgrid
from asphalt.operators.ordering import quantiles, tie_ranks
from asphalt.session import broadcast_if_small, materialise


LEAST_SHARE = 1e-9  # of a segment; shorter pieces are rounding


def walked(segments: DataFrame, resolution: int = 8) -> DataFrame:
    """Segments cut where they leave a cell: (cell, is_end, node, length_m).

    A segment is walked as a straight line from its start to its end, and each
    cell gets the share of ``length_m`` that lies in it. Its two ends are rows
    of their own, with a node and no length, in the cells where they lie.
    Without an end position a segment lies where it starts. A segment without a
    start is left out, one without a length counts as 0.
    """
    ends = [F.coalesce(F.col(f"end_{c}"), F.col(f"start_{c}")) if f"end_{c}" in segments.columns else F.col(f"start_{c}")
            for c in ("lat", "lng")]
    q0, r0 = hexgrid.planar(F.col("start_lat"), F.col("start_lng"), resolution)
    q1, r1 = hexgrid.planar(*ends, resolution)
    lines = segments.where("start_lat IS NOT NULL AND start_lng IS NOT NULL").select(
        "u", "v", F.coalesce(F.col("length_m").cast("double"), F.lit(0.0)).alias("length_m"),
        q0.alias("q0"), r0.alias("r0"), q1.alias("q1"), r1.alias("r1"))
    inner = hexgrid.edge_crossings(F.col("q0"), F.col("r0"), F.col("q1"), F.col("r1"))
    cut = lines.withColumn("cuts", F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), inner)))
    node = dict(segments.dtypes)["u"]

    def row(low: Column, high: Column, end: bool, at: Column) -> Column:
        return F.struct(low.alias("low"), high.alias("high"), F.lit(end).alias("is_end"), at.cast(node).alias("node"))

    pieces = F.transform(
        F.sequence(F.lit(1), F.size("cuts") - 1), lambda i: row(F.get("cuts", i - 1), F.get("cuts", i), False, F.lit(None)))
    pieces = F.filter(pieces, lambda p: p["high"] - p["low"] > LEAST_SHARE)
    tips = F.array(*[row(F.lit(at), F.lit(at), True, F.col(name)) for at, name in ((0.0, "u"), (1.0, "v"))])
    rows = cut.select("length_m", "q0", "r0", "q1", "r1", F.explode(F.concat(pieces, tips)).alias("p"))
    middle = (F.col("p.low") + F.col("p.high")) / 2
    at = [F.col(f"{c}0") + (F.col(f"{c}1") - F.col(f"{c}0")) * middle for c in "qr"]
    return rows.select(
        hexgrid.cell_at(*at, resolution).alias("cell"), "p.is_end", "p.node",
        ((F.col("p.high") - F.col("p.low")) * F.col("length_m")).alias("length_m"))


def road_exposure(segments: DataFrame, resolution: int = 8, zones: DataFrame | None = None) -> DataFrame:
    """Street length and number of intersections per cell, of the cells of ``zones`` if given.

    An intersection is a node where at least two street ends of the cell meet.
    Lengths are kept to the millimetre, as cutting is not exact beyond. A list of zones is broadcast only while it is small.
    """
    pieces = walked(segments, resolution)
    if zones is not None:
        pieces = pieces.join(broadcast_if_small(materialise(zones.select("cell").distinct())), "cell", "left_semi")
    nodes = pieces.groupBy("cell", "is_end", "node").agg(F.count("*").alias("streets"), F.sum("length_m").alias("length_m"))
    return nodes.groupBy("cell").agg(
        F.round(F.sum("length_m") / 1000, 6).alias("street_km"),
        F.count(F.when(F.col("is_end") & (F.col("streets") >= 2), 1)).alias("n_intersections"),
    )


def with_exposure(zones: DataFrame, roads: DataFrame) -> DataFrame:
    """Exposure and intensity per km; unknown where a zone has no road data."""
    return zones.join(roads, "cell", "left").withColumns({
        "acc_per_km": F.try_divide(F.col("n_accidents").cast("double"), F.col("street_km")),
        "charge_per_km": F.try_divide(F.col("charge").cast("double"), F.col("street_km")),
    })


def with_zone_type(zones: DataFrame) -> DataFrame:
    """Tell a concentrated black spot from an extended network by the median intensity."""
    zones = materialise(zones)
    median = quantiles(zones, ["acc_per_km"], 0.5).select("value").scalar()
    intensity = F.col("acc_per_km")
    return zones.withColumn("_median", median).withColumn(
        "type_zone",
        F.when(F.col("_median").isNull(), labels.ZONE_NO_EXPOSURE)
        .when(intensity.isNull(), labels.ZONE_UNKNOWN)
        .when(intensity >= F.col("_median"), labels.ZONE_CONCENTRATED)
        .otherwise(labels.ZONE_DIFFUSE),
    ).drop("_median")


def rank_movement(zones: DataFrame) -> DataFrame:
    """Places gained by a zone when its burden is divided by its street length.

    Most zones share a few small burdens. The rank tables have one row per
    value, so they are broadcast while small; beyond that adaptive execution
    splits the busy values of the joins.
    """
    known = materialise(zones.where(F.col("street_km") > 0))
    by_charge = broadcast_if_small(materialise(tie_ranks(known, "charge").withColumnRenamed("avg_rank", "rank_charge")))
    by_density = broadcast_if_small(materialise(
        tie_ranks(known, "charge_per_km").withColumnRenamed("avg_rank", "rank_per_km")))
    return (
        known.join(by_charge, "charge").join(by_density, "charge_per_km")
        .withColumn("movement", F.col("rank_charge") - F.col("rank_per_km"))
    )
