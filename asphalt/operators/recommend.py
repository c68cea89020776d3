"""From zones and effects to one recommended intervention per zone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asphalt import labels
from asphalt.functions.text import label_of
from asphalt.operators.scalars import with_row
from asphalt.schema import DEPLOYABLE, INFRA



def _weights(weight: str) -> tuple[str, str]:
    """Prefix of the flag totals and name of the zone total of a weighting."""
    return {"severity": ("charge_", "charge"), "count": ("n_", "n_accidents")}[weight]


def territory_share(zones: DataFrame, weight: str = "severity", elements: Sequence[str] = INFRA) -> DataFrame:
    """Share of the territory's burden (or accidents) with each element: one wide row."""
    prefix, total = _weights(weight)
    return zones.agg(*[
        (F.sum(f"{prefix}{e}") / F.greatest(F.sum(total), F.lit(1))).alias(e) for e in elements
    ])


def with_lift(zones: DataFrame, shares: DataFrame, weight: str = "severity", lift_min: float = 1.5) -> DataFrame:
    """Dominant hazard of each zone: the element most over-represented against the territory.

    Equal lifts go to the element that comes first in the list.
    """
    prefix, total = _weights(weight)
    def lift(element: str) -> Column:
        local, usual = F.col(f"{prefix}{element}") / F.greatest(F.col(total), F.lit(1)), F.col(f"_shares.{element}")
        return F.when(usual > 0, local / usual).otherwise(F.lit(0.0))

    candidates = F.array(*[
        F.struct(lift(e).alias("lift"), F.lit(-i).alias("place"), F.lit(e).alias("element"))
        for i, e in enumerate(INFRA)
    ])
    top = F.array_max(candidates)
    return with_row(zones, shares, "_shares").withColumn("_top", top).withColumns({
        "lift": F.col("_top.lift"),
        "dominant": F.when(F.col("_top.lift") >= lift_min, F.col("_top.element")).otherwise(labels.DIFFUSE),
    }).drop("_top", "_shares")


def presence(element: str) -> Column:
    """Share of a zone's accidents that happened next to an element."""
    return F.col(f"n_{element}") / F.greatest("n_accidents", F.lit(1))


def equipment_present(presence_min: float = 0.05, elements: Sequence[str] = INFRA) -> Column:
    """Comma list of the elements a zone has, a dash when it has none."""
    found = F.concat_ws(", ", *[F.when(presence(e) >= presence_min, F.lit(e)) for e in elements])
    return F.when(found == "", labels.NONE_PRESENT).otherwise(found)


def recommend(
    zones: DataFrame, effects: DataFrame, presence_min: float = 0.05,
    wording: Mapping[str, str] = labels.PLAN_WORDING, measures: Sequence[str] = DEPLOYABLE,
) -> DataFrame:
    """Add the missing measure that lowers severity most next to a zone's dominant hazard.

    ``effects`` has one row per (hazard, measure) of the fixed lists, so its
    options per hazard are few and are broadcast.
    """
    order = F.array_position(F.array(*[F.lit(m) for m in measures]), F.col("measure"))
    options = (
        effects.where(F.col("delta") < 0)
        .groupBy(F.col("hazard").alias("dominant"))
        .agg(F.array_sort(F.collect_list(F.struct("delta", order.alias("order"), "measure"))).alias("options"))
    )
    present = F.create_map(*[part for m in measures for part in (F.lit(m), presence(m))])
    first_missing = F.get(
        F.filter("options", lambda option: F.element_at("_present", option["measure"]) < presence_min), F.lit(0)
    )
    chosen = (
        zones.join(F.broadcast(options), "dominant", "left")
        .withColumn("_present", present)
        .withColumn("_pick", first_missing)
    )
    pick = F.col("_pick.measure")
    action = (
        F.when(F.col("dominant") == labels.DIFFUSE, wording["diffuse"])
        .when(pick.isNull(), wording["equipped"])
        .when(F.col("dominant") == "railway", wording["railway"])
        .otherwise(label_of(pick, {m: wording[m] for m in measures}))
    )
    return chosen.withColumns({
        "measure": pick,
        "measure_delta": F.col("_pick.delta"),
        "amenagement": action,
        "impact_graves_evites": F.coalesce(F.abs("_pick.delta") * F.col("n_accidents"), F.lit(0.0)),
    }).drop("options", "_present", "_pick")


# Columns of the published plan.
PLAN_COLUMNS = [
    "rank", "cell", "n_accidents", "charge", "avg_severity", "street_km", "n_intersections",
    "charge_per_km", "type_zone", "dominant", "lift", "equip_present", "amenagement", "impact_graves_evites",
]
# Decimals of the published plan, rounded half to even.
PLAN_DECIMALS = {"avg_severity": 3, "lift": 2, "street_km": 2, "charge_per_km": 2, "impact_graves_evites": 1}


def final_plan(recommended: DataFrame, decimals: Mapping[str, int] = PLAN_DECIMALS) -> DataFrame:
    """Columns, rounding and order of the written plan."""
    columns = [c for c in PLAN_COLUMNS if c in recommended.columns]
    return recommended.orderBy(F.desc("impact_graves_evites"), "rank").select(*[
        F.bround(c, decimals[c]).alias(c) if c in decimals else F.col(c) for c in columns
    ])


def observed_years(df: DataFrame) -> DataFrame:
    """Years covered, read from the distinct months with accidents."""
    month = F.when(F.col("year").isNotNull() & F.col("month").isNotNull(), F.struct("year", "month"))
    return df.agg(F.greatest(F.count_distinct(month) / 12.0, F.lit(1e-9)).alias("years"))


def per_year(plan: DataFrame, years: DataFrame) -> DataFrame:
    """Expected severe accidents avoided per year."""
    return plan.withColumn(
        "impact_par_an", F.bround(F.col("impact_graves_evites") / years.select("years").scalar(), 1)
    )


def element_name(code: Column) -> Column:
    return label_of(code, labels.ELEMENT_NAMES)


def reason() -> Column:
    """Sentence that explains a recommendation, from the unrounded columns."""
    def shown(value: Column) -> Column:
        return F.bround(value, 1).cast("string")

    # The sentences of the interactive plan.
    diffuse = "aucun défaut d'infrastructure ne domine dans cette zone"
    equipped = "aléa « %s » mais les mesures efficaces sont déjà en place"
    missing = (
        "aléa dominant « %s » (×%s vs moyenne) ; « %s » absent alors qu'il réduit la gravité de %s pts"
        " dans ce contexte"
    )
    return (
        F.when(F.col("dominant") == labels.DIFFUSE, diffuse)
        .when(F.col("measure").isNull(), F.format_string(equipped, element_name(F.col("dominant"))))
        .otherwise(F.format_string(
            missing, element_name(F.col("dominant")), shown(F.col("lift")), element_name(F.col("measure")),
            shown(F.abs("measure_delta") * 100),
        ))
    )


def recap(plan: DataFrame) -> DataFrame:
    """Zones and expected gain per intervention."""
    return (
        plan.groupBy("amenagement")
        .agg(F.count("*").alias("zones"), F.bround(F.sum("impact_graves_evites"), 0).alias("impact"))
        .orderBy(F.desc("impact"), "amenagement")
    )
