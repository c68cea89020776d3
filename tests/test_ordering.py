import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from asphalt.functions import hexgrid, scoring
from asphalt.operators import ordering, validation

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_running_totals_equal_one_global_window(spark):
    df = spark.range(5000).select(
        (F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 13).alias("v")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mine = ordering.running_totals(df, [F.desc("k")], {"v": F.col("v"), "n": F.lit(1)})
        assert mine.select(F.spark_partition_id()).distinct().count() > 1
        whole = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
        expected = df.select("k", F.sum("v").over(whole).alias("e"), F.row_number().over(whole).alias("n"))
        wrong = mine.join(expected, "k").where((F.col("cum_v") != F.col("e")) | (F.col("cum_n") != F.col("n")))
        assert mine.count() == 5000 and wrong.count() == 0
        assert mine.select("all_v").distinct().collect()[0][0] == df.agg(F.sum("v")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@FEW
@given(st.lists(st.integers(0, 6), min_size=1, max_size=40))
def test_tie_ranks_are_averaged(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    mine = {r["v"]: r["avg_rank"] for r in ordering.tie_ranks(df, "v").collect()}
    expected = pd.Series(values).rank(ascending=False)
    assert all(mine[v] == e for v, e in zip(values, expected))


@FEW
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40), st.sampled_from([0.0, 0.25, 0.5, 0.95, 1.0]))
def test_quantiles_interpolate_like_numpy(spark, values, fraction):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    found = ordering.quantiles(df, ["v"], fraction).first()["value"]
    assert found == pytest.approx(np.quantile(values, fraction), rel=1e-9, abs=1e-9)


def test_quantiles_of_several_columns_and_of_none(spark):
    df = spark.createDataFrame([(1.0, 10, None), (2.0, 30, None), (4.0, None, None)], "a double, b int, c double")
    assert {r["name"]: r["value"] for r in ordering.quantiles(df, ["a", "b", "c"], 0.5).collect()} == {"a": 2.0, "b": 20.0}


def test_spearman_with_ties(spark):
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(x, y)], "early int, late int")
    rx, ry = pd.Series(x).rank(), pd.Series(y).rank()
    found = validation.stability(df).first()
    assert found.n == 300 and found.rho == pytest.approx(np.corrcoef(rx, ry)[0, 1])
    assert 0 <= found.p_value <= 1


@FEW
@given(st.floats(-80, 80), st.floats(-179, 179), st.sampled_from([8, 7, 5]))
def test_centre_of_a_cell_lies_in_it(spark, lat, lng, resolution):
    df = spark.createDataFrame([(lat, lng)], "lat double, lng double")
    df = df.withColumn("cell", hexgrid.cell(F.col("lat"), F.col("lng"), resolution))
    clat, clng = hexgrid.centre(F.col("cell"), resolution)
    df = df.withColumns({"clat": clat, "clng": clng})
    again = df.withColumn("again", hexgrid.cell(F.col("clat"), F.col("clng"), resolution)).first()
    assert again["again"] == again["cell"]


def test_outline_is_closed_and_has_the_area_of_its_resolution(spark):
    df = spark.createDataFrame([("8:-14318:5554",)], "cell string")
    ring = df.select(hexgrid.boundary(F.col("cell"), 8)).first()[0]
    assert len(ring) == 7 and ring[0] == ring[-1]
    xy = [(np.radians(p["lng"]) * 6371007.2 * np.cos(np.radians(37)),
           np.sin(np.radians(p["lat"])) * 6371007.2 / np.cos(np.radians(37))) for p in ring]
    area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(xy, xy[1:]))) / 2
    assert area == pytest.approx(0.7373e6, rel=1e-6)


@pytest.mark.parametrize("kind", ["even", "tied", "heavy", "two", "few"])
@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.95, 1.0])
def test_refined_quantiles_match_numpy(spark, monkeypatch, kind, fraction):
    monkeypatch.setattr(ordering, "COUNTED_ROWS", 20)
    monkeypatch.setattr(ordering, "SKETCH_ACCURACY", 50)
    rng = np.random.default_rng(2)
    values = {
        "even": rng.normal(0, 1, 3_001), "tied": rng.integers(0, 9, 2_000) / 4, "heavy": np.exp(rng.normal(0, 60, 2_000)),
        "two": np.repeat([1.0, 5.0], 700), "few": np.array([3.0, 1.0, 2.0]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)] * 5, "v double").repartition(6)
    found = ordering.refined_quantiles(df, ["v"], fraction).first()["value"]
    assert found == pytest.approx(np.quantile(values, fraction), rel=1e-12)


def test_refined_quantiles_of_several_columns_and_of_none(spark):
    df = spark.createDataFrame([(1, 10.0, None), (2, None, None), (3, 30.0, None)], "a int, b double, c double")
    assert {r["name"]: r["value"] for r in ordering.refined_quantiles(df, ["a", "b", "c"], 0.5).collect()} == {"a": 2.0, "b": 20.0}
    assert ordering.refined_quantiles(df.limit(0), ["a"], 0.5).collect() == []


def test_refined_quantiles_move_no_rows(spark):
    """What is exchanged are one row a task and the counts of a bounded range."""
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(0, 400_000, 1, 8).select((F.xxhash64("id") % 1_000_003).cast("double").alias("v")).persist()
    df.count()
    spark.sparkContext.setJobGroup("refined", "refined")
    try:
        ordering.refined_quantiles(df, ["v"], 0.5).collect()
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = [s for j in tracker.getJobIdsForGroup("refined") for s in tracker.getJobInfo(j).stageIds]
    written = [store.lastStageAttempt(s).shuffleWriteRecords() for s in stages]
    df.unpersist()
    assert sum(written) <= 8 * 20 + 2 * ordering.COUNTED_ROWS


def test_correlation_tails_are_those_of_student(spark):
    """Closed forms of 1, 2 and 4 degrees of freedom, and the normal curve for very many."""
    rhos = [0.0, 0.1, -0.5, 0.9, 0.999]
    cases = [(r, n) for r in rhos for n in (3, 4, 6)]
    df = spark.createDataFrame([*cases, (0.002, 1_000_002), (0.5, 5_000)], "rho double, n long")
    got = {(r["rho"], r["n"]): r["p"] for r in df.select("rho", "n", scoring.correlation_tails(F.col("rho"), F.col("n")).alias("p")).collect()}
    exact = {3: lambda r: 1 - 2 / np.pi * np.arcsin(r), 4: lambda r: 1 - r, 6: lambda r: 1 - 1.5 * (r - r**3 / 3)}
    for r, n in cases:
        assert got[r, n] == pytest.approx(exact[n](abs(r)), abs=1e-9)
    assert got[0.002, 1_000_002] == pytest.approx(0.0455, abs=1e-4) and got[0.5, 5_000] < 1e-200
