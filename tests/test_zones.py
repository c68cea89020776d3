import math
import random

import pytest
from pyspark.sql import functions as F

from asphalt import labels
from asphalt.functions import hexgrid
from asphalt.operators import exposure, recommend, validation, when, zones
from tests import frames

HERE, THERE = {"start_lat": 34.0, "start_lng": -118.0}, {"start_lat": 36.0, "start_lng": -120.0}


def test_zone_counts_add_up_and_the_key_is_explicit(spark):
    df = frames.accidents(spark, [HERE, {**HERE, "severity": 4, "junction": 1}, {**HERE, "state": "NV"}, THERE])
    by_state, whole = zones.zone_table(df), zones.zone_table(df, keys=())
    assert (by_state.count(), whole.count()) == (3, 2)
    top = whole.orderBy(F.desc("charge")).first()
    assert (top["n_accidents"], top["charge"], top["n_junction"], top["charge_junction"]) == (3, 8, 1, 4)
    assert top["avg_severity"] == pytest.approx(8 / 3)


def test_priority_is_clamped_and_ties_follow_the_cell(spark):
    table = frames.zones(spark, [{"cell": "b", "charge": 5}, {"cell": "a", "charge": 5}, {"cell": "c", "charge": 9}])
    rows = zones.priority(table, 50).orderBy("rank").collect()
    assert [(r["rank"], r["cell"]) for r in rows] == [(1, "c"), (2, "a"), (3, "b")]
    assert [r["cell"] for r in zones.ranked(table).orderBy("rank").collect()] == ["c", "a", "b"]


def test_concentration_rises_to_one(spark):
    table = frames.zones(spark, [{"cell": str(i), "charge": i + 1} for i in range(30)])
    shares = [r["charge_share"] for r in zones.concentration(table).orderBy("rank").collect()]
    assert shares == sorted(shares) and shares[-1] == pytest.approx(1.0)
    top = zones.priority_with_share(table, 30).orderBy("rank").collect()
    assert [r["charge_share"] for r in top] == pytest.approx(shares)


def test_exposure_labels(spark):
    table = frames.zones(spark, [
        {"cell": c, "n_accidents": n, "charge": 2 * n} for c, n in (("a", 10), ("b", 20), ("c", 30), ("d", 40), ("e", 50))])
    roads = spark.createDataFrame([("a", 1.0, 1), ("b", 1.0, 0), ("c", 1.0, 2), ("d", 0.0, 0)],
                                  "cell string, street_km double, n_intersections long")
    typed = exposure.with_zone_type(exposure.with_exposure(table, roads))
    found = {r["cell"]: r["type_zone"] for r in typed.collect()}
    assert found == {"a": labels.ZONE_DIFFUSE, "b": labels.ZONE_CONCENTRATED, "c": labels.ZONE_CONCENTRATED,
                     "d": labels.ZONE_UNKNOWN, "e": labels.ZONE_UNKNOWN}
    nothing = exposure.with_zone_type(exposure.with_exposure(table, roads.where("false")))
    assert {r["type_zone"] for r in nothing.collect()} == {labels.ZONE_NO_EXPOSURE}


def test_marker_size_falls_back_to_burden(spark):
    table = frames.zones(spark, [{"cell": c, "n_accidents": 1, "charge": n} for c, n in (("a", 1), ("b", 3), ("c", 5))])
    roads = spark.createDataFrame([("a", 1.0, 1), ("b", 1.0, 1)], "cell string, street_km double, n_intersections long")
    sized = zones.marker_size(exposure.with_exposure(table, roads))
    assert {r["cell"]: r["size"] for r in sized.collect()} == {"a": 0.0, "b": 1.0, "c": 1.0}
    same = frames.zones(spark, [{"cell": "a", "charge": 2}, {"cell": "b", "charge": 2}])
    flat = zones.marker_size(same.withColumn("charge_per_km", F.lit(None).cast("double")))
    assert {r["size"] for r in flat.collect()} == {0.0}


def test_intersections_need_two_street_ends(spark):
    segments = spark.createDataFrame(
        [(1, 2, 34.0, -118.0, 100.0), (2, 3, 34.0, -118.0, 50.0), (7, 8, 36.0, -120.0, 10.0)],
        "u long, v long, start_lat double, start_lng double, length_m double")
    rows = {r["street_km"]: r["n_intersections"] for r in exposure.road_exposure(segments).collect()}
    assert rows == {0.15: 1, 0.01: 0}


def sampled_lengths(segments, resolution, steps=20_000):
    """Lengths per cell by many points along each segment."""
    side, cos = hexgrid.side_m(resolution), math.cos(math.radians(37))
    found = {}
    for lat0, lng0, lat1, lng1, length in segments:
        x0, x1 = (math.radians(g) * 6371007.2 * cos for g in (lng0, lng1))
        y0, y1 = (math.sin(math.radians(t)) * 6371007.2 / cos for t in (lat0, lat1))
        for i in range(steps):
            at = (i + 0.5) / steps
            x, y = x0 + (x1 - x0) * at, y0 + (y1 - y0) * at
            q, r = (x / math.sqrt(3) - y / 3) / side, y * 2 / 3 / side
            a, b = round(q), round(r)  # the nearest centre is one of these nine
            spot = min(((a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)), key=lambda c: (
                (c[0] - q) ** 2 + (c[1] - r) ** 2 + (c[0] - q) * (c[1] - r)))
            found[spot] = found.get(spot, 0.0) + length / steps
    return {f"{resolution}:{q}:{r}": km / 1000 for (q, r), km in found.items()}


def test_segments_are_cut_where_they_leave_a_cell(spark):
    rng = random.Random(6)
    rows = []
    for i in range(30):
        lat, lng = 34 + rng.random() * 0.02, -118 + rng.random() * 0.02
        rows.append((i, 100 + i, lat, lng, lat + rng.uniform(-0.05, 0.05), lng + rng.uniform(-0.05, 0.05), 1000.0 * rng.random()))
    segments = spark.createDataFrame(
        rows, "u long, v long, start_lat double, start_lng double, end_lat double, end_lng double, length_m double")
    got = {r["cell"]: r["street_km"] for r in exposure.road_exposure(segments, 8).collect()}
    want = sampled_lengths([r[2:] for r in rows], 8)
    assert sum(got.values()) == pytest.approx(sum(r[-1] for r in rows) / 1000, abs=1e-4)
    assert all(got.get(c, 0.0) == pytest.approx(want.get(c, 0.0), abs=1e-3) for c in got.keys() | want.keys())
    some = frames.zones(spark, [{"cell": c} for c in sorted(got)[:5]])
    near = {r["cell"]: r["street_km"] for r in exposure.road_exposure(segments, 8, some).collect()}
    assert near == pytest.approx({c: got[c] for c in sorted(got)[:5]})


def test_ends_count_where_they_lie(spark):
    here, there = (34.0, -118.0), (34.05, -118.05)
    segments = spark.createDataFrame(
        [(1, 2, *here, *there, 100.0), (3, 2, *here, *there, None), (1, 9, *here, None, None, 50.0), (5, 5, None, None, *there, 7.0)],
        "u long, v long, start_lat double, start_lng double, end_lat double, end_lng double, length_m double")
    rows = {r["cell"]: r for r in exposure.road_exposure(segments).collect()}
    cells = spark.range(1).select(*[hexgrid.cell(F.lit(a), F.lit(b), 8) for a, b in (here, there)]).first()
    assert [rows[c]["n_intersections"] for c in cells] == [1, 1]
    assert sum(r["street_km"] for r in rows.values()) == pytest.approx(0.15, abs=1e-5)
    assert sum(r["n_intersections"] for r in rows.values()) == 2
    assert exposure.road_exposure(segments.limit(0)).collect() == []


def test_a_missing_state_is_not_the_country(spark):
    df = frames.accidents(spark, [{"state": "CA"}, {"state": None}, {"state": "CA", "severity": 4}])
    rows = {r["state"]: (r["n"], r["part_grave"]) for r in when.cube(df, "month").collect()}
    assert rows == {"CA": (2, 0.5), None: (1, 0.0), "US": (3, pytest.approx(1 / 3))}


def test_unknown_territory_falls_back_to_the_country(spark):
    cubes = when.cube(frames.accidents(spark, [{"state": "CA"}, {"state": "NV"}]), "month")
    asked = spark.createDataFrame([("CA",), ("ZZ",)], "territory string")
    rows = {r["territory"]: (r["source"], r["n"]) for r in when.for_territory(cubes, asked).collect()}
    assert rows == {"CA": ("CA", 1), "ZZ": ("US", 2)}


def test_peak_hour_takes_the_first_on_a_tie(spark):
    df = frames.accidents(spark, [{"hour": h, "severity": s} for h, s in ((9, 3), (7, 3), (8, 2))])
    row = when.peak_hour(when.by_dimension(df, "hour")).first()
    assert (row["peak_hour"], row["pct_max"]) == (7, 100.0)


def test_backtest_and_periods(spark):
    df = frames.accidents(spark, [
        {**HERE, "year": 2018}, {**HERE, "year": 2018}, {**THERE, "year": 2019},
        {**HERE, "year": 2021, "severity": 3}, {**THERE, "year": 2021, "severity": 3}, {**THERE, "year": 2021}])
    years = zones.zone_years(df)
    row = validation.backtest(years, 1, 2019, 2020).first()
    assert (row["captured"], row["future_graves"], row["future_zones"], row["share"], row["weight"]) == (1, 2, 2, 0.5, 0.5)
    assert validation.backtest(years.where("year < 2020"), 1, 2019, 2020).first()["share"] is None
    burdens = validation.period_burdens(df, (2016, 2019), (2020, 2023))
    scores = validation.period_scores(burdens).collect()
    assert sorted((r["early"], r["late"]) for r in scores) == [(0.0, 1.0), (1.0, 0.0)]
    kept = validation.still_on_top(burdens, 1).first()
    assert (kept["early_top"], kept["kept"]) == (1, 0)


def test_span_counts_known_months(spark):
    df = frames.accidents(spark, [{"month": m, "year": 2020} for m in (1, 1, 2, 3)] + [{"year": None}])
    assert recommend.observed_years(df).first()["years"] == 3 / 12
    assert recommend.observed_years(df.where("false")).first()["years"] == 1e-9


def test_stability_is_unknown_without_a_correlation(spark):
    from asphalt.operators import validation

    def found(rows):
        r = validation.stability(spark.createDataFrame(rows, "cell string, early long, late long")).first()
        return r["rho"], r["p_value"]

    assert found([("a", 1, 5), ("b", 1, 7), ("c", 1, 9)]) == (None, None)
    assert found([("a", 1, None), ("b", None, 7)]) == (None, None)
    assert found([("a", 1, 2), ("b", 2, 4)])[1] is None
    assert found([(str(i), i, 2 * i) for i in range(9)])[1] == 0.0
    rho, p = found([(str(i), i, (i * 7) % 11) for i in range(10)])
    # Student's t with 8 degrees of freedom, its density summed up to the statistic.
    width = abs(rho) * math.sqrt(8 / (1 - rho * rho)) / 20_000
    scale = math.gamma(4.5) / (math.sqrt(8 * math.pi) * math.gamma(4))
    inside = sum(scale * (1 + ((i + 0.5) * width) ** 2 / 8) ** -4.5 for i in range(20_000)) * width
    assert p == pytest.approx(1 - 2 * inside, abs=1e-6)


def test_a_busy_value_is_joined_by_broadcast(spark):
    rows = [(str(i), 5 if i < 90 else i, 1.0 + i % 3, 5.0 if i < 90 else float(i)) for i in range(100)]
    table = spark.createDataFrame(rows, "cell string, charge long, street_km double, charge_per_km double")
    moved = exposure.rank_movement(table)
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and moved.count() == 100
