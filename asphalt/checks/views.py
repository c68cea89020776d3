"""Accident-shaped views over the test tables.

No accident file ships with the project, so the checks run on views derived
from whole test tables. The text is plain SQL that Spark and DuckDB share;
``{table}`` marks an input table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from asphalt.schema import INFRA, RAW_COLUMNS, normal_name

_JOINED = """
b AS (
  SELECT l.*, o.o_orderstatus, o.o_orderpriority, p.p_type, p.p_size, p.p_brand, p.p_name, c.c_nationkey
  FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
  JOIN {part} p ON l.l_partkey = p.p_partkey JOIN {customer} c ON o.o_custkey = c.c_custkey),
"""
# The same rows as Spark joins them, in the order of the text: orders meet their customers before they meet the
# lines, and the long names of parts come last, so lines move twice instead of three times and without names.
_JOINED_ON_SPARK = """
b AS (
  SELECT l.*, o.o_orderstatus, o.o_orderpriority, p.p_type, p.p_size, p.p_brand, p.p_name, o.c_nationkey
  FROM {lineitem} l JOIN (
    SELECT o_orderkey, o_orderstatus, o_orderpriority, c_nationkey
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey) o ON l.l_orderkey = o.o_orderkey
  JOIN {part} p ON l.l_partkey = p.p_partkey),
"""
# Base rows with their flags; severity is planted: junctions raise it, signals lower it.
_BASE = _JOINED.rstrip() + """
f AS (
  SELECT CONCAT('S', CAST(c_nationkey AS VARCHAR(4))) AS state, l_shipdate AS start_time,
    32.0E0 + (l_suppkey % 40) * 0.05E0 + (l_partkey % 7) * 0.002E0 AS start_lat,
    -120.0E0 + (l_suppkey % 25) * 0.08E0 + (l_partkey % 5) * 0.003E0 AS start_lng,
    CAST(l_returnflag = 'R' AS INT) AS junction, CAST(p_type = 'SMALL' AS INT) AS crossing,
    CAST(o_orderstatus = 'P' AS INT) AS stop, CAST(o_orderpriority = '1-URGENT' AS INT) AS traffic_signal,
    CAST(p_size <= 3 AS INT) AS railway, CAST(p_name LIKE '%ring' AS INT) AS station,
    CAST(p_brand = 'Brand#1' AS INT) AS roundabout, CAST(p_size = 50 AS INT) AS bump,
    CAST(p_brand = 'Brand#2' AS INT) AS give_way, CAST(p_name LIKE 'cold%' AS INT) AS no_exit,
    CAST(p_size BETWEEN 20 AND 22 AS INT) AS traffic_calming, CAST(p_type = 'PROMO' AS INT) AS amenity,
    l_quantity, l_discount * 100 AS humidity_pct,
    CASE WHEN p_size = 49 THEN NULL ELSE l_tax * 100 END AS temperature_f,
    p_size * 0.2E0 AS visibility_mi, l_quantity * 0.5E0 AS wind_speed_mph, 29.0E0 + l_linenumber * 0.1E0 AS pressure_in,
    CASE WHEN p_size = 48 THEN NULL ELSE CONCAT(p_name, CASE WHEN p_brand = 'Brand#3' THEN ' snow' WHEN p_type = 'LARGE' THEN ' rain'
      WHEN p_type = 'MEDIUM' THEN ' cloudy' WHEN p_type = 'STANDARD' THEN ' clear' ELSE ' haze' END) END AS weather_condition,
    CASE WHEN p_size = 47 THEN NULL WHEN l_linestatus = 'F' THEN 'Night' ELSE 'Day' END AS sunrise_sunset,
    l_orderkey, l_linenumber, l_linestatus, l_discount, p_size, p_name, p_brand, p_type
  FROM b),
incidents AS (
  SELECT *, 1 + CAST(l_quantity + 6 * junction - 6 * traffic_signal > 5 AS INT)
              + CAST(l_quantity + 6 * junction - 6 * traffic_signal > 38 AS INT)
              + CAST(l_quantity + 6 * junction - 6 * traffic_signal > 46 AS INT) AS severity
  FROM f)
"""


def _flag(name: str) -> str:
    """A raw boolean; two flags are unknown on some rows."""
    unknown = {"crossing": "p_size = 44", "bump": "p_size = 43"}.get(name)
    value = f"({name} = 1)"
    return f"CASE WHEN {unknown} THEN NULL ELSE {value} END" if unknown else value


# The 46 raw fields, with rows that lack a severity, a position or a date.
_RAW_FIELDS = {
    "id": "CONCAT('A-', CAST(l_orderkey AS VARCHAR(20)), '-', CAST(l_linenumber AS VARCHAR(20)))",
    "source": "CONCAT('Source', l_linestatus)",
    "severity": "CASE WHEN p_size = 46 THEN NULL ELSE severity END",
    "start_time": "CASE WHEN p_size = 42 THEN NULL ELSE start_time END",
    "end_time": "start_time",
    "start_lat": "CASE WHEN p_size = 45 THEN NULL ELSE start_lat END",
    "start_lng": "CASE WHEN p_size = 41 THEN NULL ELSE start_lng END",
    "end_lat": "CASE WHEN p_size <= 22 THEN NULL ELSE start_lat END",
    "end_lng": "CASE WHEN p_size <= 22 THEN NULL ELSE start_lng END",
    "distance_mi": "l_discount * 10",
    "description": "p_name", "street": "p_brand", "city": "p_type",
    "county": "CAST(NULL AS VARCHAR(9))", "state": "state", "zipcode": "CAST(p_size AS VARCHAR(9))",
    "country": "'US'", "timezone": "'UTC'", "airport_code": "CONCAT('K', state)",
    "weather_timestamp": "start_time", "temperature_f": "temperature_f",
    "wind_chill_f": "CASE WHEN p_size <= 13 THEN NULL ELSE temperature_f END",
    "humidity_pct": "humidity_pct", "pressure_in": "pressure_in", "visibility_mi": "visibility_mi",
    "wind_direction": "p_brand", "wind_speed_mph": "wind_speed_mph", "precipitation_in": "l_discount",
    "weather_condition": "weather_condition",
    **{name: _flag(name) for name in INFRA},
    "turning_loop": "(p_size < 0)",
    "sunrise_sunset": "sunrise_sunset", "civil_twilight": "sunrise_sunset",
    "nautical_twilight": "sunrise_sunset", "astronomical_twilight": "sunrise_sunset",
}
_RAW_NAMES = [normal_name(name) for name in RAW_COLUMNS]
_RAW = "raw_incidents AS (SELECT " + ", ".join(f"{_RAW_FIELDS[n]} AS {n}" for n in _RAW_NAMES) + " FROM incidents)"

_TIMED = """
incidents_ts AS (
  SELECT event_id, ts AS start_time, CONCAT('U', CAST(user_id % 10 AS VARCHAR(4))) AS state,
    CASE WHEN value < 10 THEN 1 WHEN value < 70 THEN 2 WHEN value < 120 THEN 3 ELSE 4 END AS severity,
    CASE event_type WHEN 'error' THEN 'Light Snow / Rain' WHEN 'click' THEN 'Mostly Cloudy'
      WHEN 'view' THEN 'Fair' WHEN 'signup' THEN NULL ELSE 'Haze' END AS weather_condition
  FROM {events})
"""

_ROADS = """
road_segments AS (
  SELECT p_partkey AS segment_id, p_partkey % 997 AS u, (p_partkey * 7 + 1) % 997 AS v,
    32.0E0 + (p_partkey % 40) * 0.05E0 + (p_partkey % 7) * 0.002E0 AS start_lat,
    -120.0E0 + (p_partkey % 25) * 0.08E0 + (p_partkey % 5) * 0.003E0 AS start_lng,
    CASE WHEN p_partkey % 50 <> 0 THEN 32.0E0 + (p_partkey % 40) * 0.05E0 + (p_partkey % 7) * 0.002E0 + (p_size - 25) * 0.0004E0 END AS end_lat,
    CASE WHEN p_partkey % 50 <> 0 THEN -120.0E0 + (p_partkey % 25) * 0.08E0 + (p_partkey % 5) * 0.003E0 + (p_partkey % 11 - 5) * 0.003E0 END AS end_lng,
    p_size * 22.0E0 AS length_m
  FROM {part})
"""

# View name -> the WITH clauses it needs.
VIEWS = {
    "incidents": [_BASE], "raw_incidents": [_BASE, _RAW], "incidents_ts": [_TIMED], "road_segments": [_ROADS],
}


def duckdb_clauses(*names: str) -> list[str]:
    """WITH clauses of some views on tables that go by their own name."""
    clauses = dict.fromkeys(clause for name in names for clause in VIEWS[name])
    return [re.sub(r"\{(\w+)\}", r"\1", clause).strip() for clause in clauses]


def load(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A view as a DataFrame over the Parquet tables of a folder."""
    clauses = ", ".join(VIEWS[view]).replace(_JOINED.strip(), _JOINED_ON_SPARK.strip())
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in sorted(set(re.findall(r"\{(\w+)\}", clauses)))}
    return spark.sql(f"WITH {clauses} SELECT * FROM {view}", **tables)


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw view under the column names of the accident file."""
    return load(spark, sf_dir, "raw_incidents").toDF(*RAW_COLUMNS)
