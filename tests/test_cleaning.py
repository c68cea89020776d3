import datetime as dt

import pytest
from pyspark.sql import functions as F

from asphalt import labels
from asphalt.checks import views
from asphalt.functions.dates import event_window
from asphalt.functions.text import label_of, weather_bucket
from asphalt.operators import cleaning, quality
from asphalt.schema import INFRA, RAW_COLUMNS, normal_name, raw_schema
from tests import frames


def test_names_and_schema():
    assert normal_name("Humidity(%)") == "humidity_pct"
    assert normal_name("Wind_Speed(mph)") == "wind_speed_mph"
    assert raw_schema().names == RAW_COLUMNS and len(RAW_COLUMNS) == 46


def test_key_columns_are_required_and_nothing_else(spark):
    df = cleaning.clean(frames.raw(spark, [
        {}, {"severity": None}, {"start_lat": None}, {"start_lng": None}, {"start_time": None}, {"state": None}]))
    assert df.count() == 3
    assert "end_lat" not in df.columns


def test_missing_flags_hours_and_nights_become_zero_but_dates_stay_unknown(spark):
    row = cleaning.clean(frames.raw(spark, [{"start_time": None, "junction": None, "stop": True, "severity": 3}])).first()
    assert (row["junction"], row["stop"], row["hour"], row["is_night"], row["grave"]) == (0, 1, 0, 0, 1)
    assert row["year"] is None and row["month"] is None and row["dow"] is None


def test_undated_rows_are_in_neither_part(spark):
    train, test = cleaning.temporal_split(frames.accidents(spark, [{"year": None}, {"year": 2021}, {"year": 2022}]), 2022)
    assert (train.count(), test.count()) == (1, 1)


@pytest.mark.parametrize("text, bucket", [
    ("Light Snow / Rain", "Snow"), ("Ice Pellets", "Snow"), ("Thunder in the Vicinity", "Rain"), ("Haze", "Fog"),
    ("Mostly CLOUDY", "Cloud"), ("Fair", "Clear"), ("Blowing Dust", "Other"), (None, "Other"), ("", "Other"),
])
def test_weather_buckets_in_order(spark, text, bucket):
    df = spark.createDataFrame([(text,)], "w string")
    assert df.select(weather_bucket(F.col("w"))).first()[0] == bucket


@pytest.mark.parametrize("month, day, event", [
    (12, 23, labels.EVENT_NORMAL), (12, 24, labels.EVENT_YEAR_END), (12, 31, labels.EVENT_YEAR_END),
    (1, 2, labels.EVENT_YEAR_END), (1, 3, labels.EVENT_NORMAL), (11, 21, labels.EVENT_NORMAL),
    (11, 22, labels.EVENT_THANKSGIVING), (11, 28, labels.EVENT_THANKSGIVING), (11, 29, labels.EVENT_NORMAL),
    (7, 2, labels.EVENT_NORMAL), (7, 3, labels.EVENT_JULY_4), (7, 5, labels.EVENT_JULY_4), (7, 6, labels.EVENT_NORMAL),
    (5, 24, labels.EVENT_NORMAL), (5, 25, labels.EVENT_MEMORIAL), (5, 31, labels.EVENT_MEMORIAL),
])
def test_event_edges(spark, month, day, event):
    df = spark.createDataFrame([(dt.datetime(2021, month, day),)], "t timestamp")
    assert df.select(event_window(F.col("t"))).first()[0] == event


def test_unknown_date_is_a_normal_period(spark):
    df = spark.createDataFrame([(None,)], "t timestamp")
    assert df.select(event_window(F.col("t"))).first()[0] == labels.EVENT_NORMAL


def test_label_of_unknown_code_is_the_code(spark):
    df = spark.createDataFrame([("traffic_signal",), ("ZZ",), (None,)], "s string")
    assert [r[0] for r in df.select(label_of(F.col("s"), labels.ELEMENT_NAMES)).collect()] == ["feux", "ZZ", None]


def test_states_leave_out_the_unknown(spark):
    df = frames.accidents(spark, [{"state": "CA"}, {"state": None}, {"state": ""}, {"state": "CA"}])
    assert [r[0] for r in cleaning.states(df).collect()] == ["CA"]


def test_checks_pass_on_clean_rows_and_name_what_fails(spark):
    df = cleaning.clean(frames.raw(spark, [{}, {"severity": 4}]))
    quality.require(quality.clean_violations(df))
    with pytest.raises(quality.CheckFailed, match="bad_stop"):
        quality.require(quality.clean_violations(df.withColumn("stop", F.lit(2))))
    with pytest.raises(quality.CheckFailed, match="unusable_kept"):
        quality.require(quality.clean_violations(df.withColumn("end_lat", F.lit(2.0))))


def test_leaks_are_found(spark):
    df = cleaning.clean(frames.raw(spark, [{}])).withColumns({c: F.lit(1.0) for c in (
        "temperature_f", "humidity_pct", "visibility_mi", "wind_speed_mph", "pressure_in")})
    train, test = cleaning.temporal_split(df, 2022)
    quality.require(quality.leak_violations(df, train, test, 2022))
    with pytest.raises(quality.CheckFailed, match="train_rows_from_test_years"):
        quality.require(quality.leak_violations(df, train, test, 2019))
    with pytest.raises(quality.CheckFailed, match="target_in_features"):
        quality.require(quality.leak_violations(df, train, test, 2022, [*INFRA, "grave"]))


def test_weather_bucket_is_computed_from_one_lowered_text(spark):
    """Written out once per word, the code of a stage grew beyond what the JVM compiles."""
    df = spark.createDataFrame([("Light SNOW / Rain",), ("Fair",), ("dust",), (None,)], "weather string")
    found = df.select("weather", weather_bucket(F.col("weather")).alias("bucket"))
    assert [r["bucket"] for r in found.collect()] == ["Snow", "Clear", "Other", "Other"]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1


def test_orders_meet_customers_before_lines_and_parts_come_last(spark):
    plan = views.load(spark, "/root/testdata/sf0.001", "incidents")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert [next(k for k in ("partkey", "orderkey", "custkey") if k in line) for line in joins] == ["partkey", "orderkey", "custkey"]
