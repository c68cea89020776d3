import pytest
from pyspark.sql import functions as F

from asphalt import labels
from asphalt.operators import quality, recommend, zones
from asphalt.schema import Thresholds
from asphalt.plans import decide
from tests import frames

EFFECTS = [
    ("junction", "stop", 500, -0.2), ("junction", "crossing", 500, -0.1), ("junction", "traffic_signal", 500, 0.3),
    ("junction", "traffic_calming", 500, None), ("railway", "stop", 500, -0.05),
]


@pytest.fixture(scope="module")
def effects(spark):
    return spark.createDataFrame(EFFECTS, "hazard string, measure string, n long, delta double")


def zone(cell, **totals):
    return {"cell": cell, "n_accidents": 100, "charge": 200, **totals}


def lifted(spark, rows, weight="count", background=()):
    everything = frames.zones(spark, [*rows, *background])
    table = frames.zones(spark, rows)
    return recommend.with_lift(table, recommend.territory_share(everything, weight), weight)


def test_lift_of_a_single_zone_is_one_and_diffuse(spark):
    row = lifted(spark, [zone("a", n_junction=10, charge_junction=20)]).first()
    assert (row["lift"], row["dominant"]) == (1.0, labels.DIFFUSE)


def test_ties_go_to_the_first_element_and_absent_elements_count_zero(spark):
    rows = [zone("a", n_crossing=50, n_junction=50)]
    row = lifted(spark, rows, background=[zone("z")]).first()
    assert (row["dominant"], row["lift"]) == ("junction", 2.0)
    assert lifted(spark, [zone("a")]).first()["lift"] == 0.0


def test_weightings_differ(spark):
    rows = [zone("a", n_junction=10, charge_junction=40, n_stop=20, charge_stop=20)]
    background = [zone("b", n_stop=20, charge_stop=40, n_junction=10, charge_junction=10)]
    assert lifted(spark, rows, "severity", background).first()["dominant"] == "junction"
    assert lifted(spark, rows, "count", background).first()["dominant"] == labels.DIFFUSE


def advise(spark, effects, dominant, **present):
    table = frames.zones(spark, [zone("a", **present)]).withColumns({"dominant": F.lit(dominant), "lift": F.lit(2.0)})
    return recommend.recommend(table, effects).withColumn("reason", recommend.reason()).first()


def test_best_missing_measure_is_chosen(spark, effects):
    row = advise(spark, effects, "junction", n_junction=80)
    assert (row["measure"], row["amenagement"]) == ("stop", labels.PLAN_WORDING["stop"])
    assert row["impact_graves_evites"] == pytest.approx(20.0)
    assert "×2.0" in row["reason"] and "20.0 pts" in row["reason"] and "« stop »" in row["reason"]


def test_present_measures_are_passed_over(spark, effects):
    assert advise(spark, effects, "junction", n_stop=5)["measure"] == "crossing"
    assert advise(spark, effects, "junction", n_stop=4)["measure"] == "stop"
    row = advise(spark, effects, "junction", n_stop=5, n_crossing=5)
    assert (row["amenagement"], row["impact_graves_evites"]) == (labels.PLAN_WORDING["equipped"], 0.0)
    assert "déjà en place" in row["reason"]


def test_fallbacks_and_railway_label(spark, effects):
    row = advise(spark, effects, labels.DIFFUSE)
    assert (row["amenagement"], row["impact_graves_evites"]) == (labels.PLAN_WORDING["diffuse"], 0.0)
    row = advise(spark, effects, "railway")
    assert (row["amenagement"], row["measure"]) == (labels.PLAN_WORDING["railway"], "stop")
    assert advise(spark, effects, "amenity")["amenagement"] == labels.PLAN_WORDING["equipped"]


def test_equipment_list(spark):
    table = frames.zones(spark, [zone("a", n_stop=5, n_junction=50, n_bump=4), zone("b")])
    rows = {r[0]: r[1] for r in table.select("cell", recommend.equipment_present()).collect()}
    assert rows == {"a": "junction, stop", "b": labels.NONE_PRESENT}


def test_plan_is_rounded_ordered_and_consistent(spark, effects):
    rows = [zone(f"8:{i}:-{i}", charge=200 + i, avg_severity=(200 + i) / 100, n_junction=90 - i) for i in range(5)]
    rows.append(zone("8:9:9", charge=300, avg_severity=3.0))
    rows.append(zone("8:7:9", charge=301, avg_severity=3.01, n_railway=100, n_stop=50))
    table = frames.zones(spark, rows)
    done = decide.recommended_zones(table, effects, Thresholds(lift_min=1.2), weight="count")
    plan = recommend.final_plan(done)
    gains = [r["impact_graves_evites"] for r in plan.collect()]
    assert gains == sorted(gains, reverse=True) and len(gains) == 7
    quality.require(quality.plan_violations(plan))
    with pytest.raises(quality.CheckFailed, match="rank_repeated"):
        quality.require(quality.plan_violations(plan.withColumn("rank", F.lit(1))))
    with pytest.raises(quality.CheckFailed, match="cell_invalid"):
        quality.require(quality.plan_violations(plan.withColumn("cell", F.lit("x"))))
    recap = recommend.recap(plan).collect()
    assert sum(r["zones"] for r in recap) == 7
    yearly = recommend.per_year(plan, spark.createDataFrame([(2.0,)], "years double")).first()
    assert yearly["impact_par_an"] == pytest.approx(yearly["impact_graves_evites"] / 2, abs=0.051)


def test_screen_plan(spark, effects):
    accidents = frames.accidents(spark, [{"junction": 1}, {}])
    plan = decide.screen_plan(zones.zone_table(accidents, keys=()), effects, accidents, Thresholds()).collect()
    assert len(plan) == 1 and plan[0]["recommandation"] == labels.SCREEN_WORDING["diffuse"]
