"""The decision: zones, exposure and effects become one action plan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asphalt import labels
from asphalt.operators import exposure, recommend, zones
from asphalt.schema import Thresholds


def recommended_zones(
    table: DataFrame, effects: DataFrame, limits: Thresholds, segments: DataFrame | None = None,
    weight: str = "severity", wording: Mapping[str, str] = labels.PLAN_WORDING,
) -> DataFrame:
    """Priority zones with exposure, hazard, equipment, recommendation and impact, unrounded.

    ``table`` is a materialised zone table of the territory. Without road
    segments the exposure columns are left out.
    """
    top = zones.priority(table, limits.top_zones)
    if segments is not None:
        top = exposure.with_exposure(top, exposure.road_exposure(segments, limits.resolution, top))
        top = exposure.with_zone_type(top)
    top = recommend.with_lift(top, recommend.territory_share(table, weight), weight, limits.lift_min)
    top = top.withColumn("equip_present", recommend.equipment_present(limits.presence_min))
    return recommend.recommend(top, effects, limits.presence_min, wording)


def screen_plan(table: DataFrame, effects: DataFrame, accidents: DataFrame, limits: Thresholds) -> DataFrame:
    """The plan as shown on screen: counted lift, a reason per zone and the gain per year."""
    done = recommended_zones(table, effects, limits, weight="count", wording=labels.SCREEN_WORDING)
    shown = done.select(
        F.col("rank").alias("rang"), "cell", F.col("n_accidents").alias("accidents"),
        F.bround("avg_severity", 2).alias("gravite_moy"),
        recommend.element_name(F.col("dominant")).alias("alea_dominant"),
        F.col("amenagement").alias("recommandation"), recommend.reason().alias("justification"),
        F.bround("impact_graves_evites", 1).alias("impact_graves_evites"),
    )
    yearly = recommend.per_year(shown, recommend.observed_years(accidents))
    return yearly.orderBy(F.desc("impact_graves_evites"), "rang")
