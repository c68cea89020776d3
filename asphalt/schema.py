"""Names, types and parameters shared by every job."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- Fixed values: the published layout of the accident file -----------------

RAW_STRINGS = [
    "ID", "Source", "Description", "Street", "City", "County", "State", "Zipcode", "Country",
    "Timezone", "Airport_Code", "Wind_Direction", "Weather_Condition", "Sunrise_Sunset",
    "Civil_Twilight", "Nautical_Twilight", "Astronomical_Twilight",
]
RAW_TIMESTAMPS = ["Start_Time", "End_Time", "Weather_Timestamp"]
RAW_BOOLEANS = [
    "Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout",
    "Station", "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop",
]
RAW_COLUMNS = [
    "ID", "Source", "Severity", "Start_Time", "End_Time", "Start_Lat", "Start_Lng", "End_Lat",
    "End_Lng", "Distance(mi)", "Description", "Street", "City", "County", "State", "Zipcode",
    "Country", "Timezone", "Airport_Code", "Weather_Timestamp", "Temperature(F)",
    "Wind_Chill(F)", "Humidity(%)", "Pressure(in)", "Visibility(mi)", "Wind_Direction",
    "Wind_Speed(mph)", "Precipitation(in)", "Weather_Condition", "Amenity", "Bump", "Crossing",
    "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout", "Station", "Stop",
    "Traffic_Calming", "Traffic_Signal", "Turning_Loop", "Sunrise_Sunset", "Civil_Twilight",
    "Nautical_Twilight", "Astronomical_Twilight",
]

# --- Fixed values: feature lists (the order of INFRA breaks ties) ------------

INFRA = [
    "junction", "crossing", "stop", "traffic_signal", "railway", "station", "roundabout",
    "bump", "give_way", "no_exit", "traffic_calming", "amenity",
]
DEPLOYABLE = ["traffic_signal", "crossing", "stop", "traffic_calming"]
WEATHER_NUMERIC = ["temperature_f", "humidity_pct", "visibility_mi", "wind_speed_mph", "pressure_in"]
NUMERIC_CONTROLS = WEATHER_NUMERIC + ["hour", "dow", "month"]
CATEGORICAL_CONTROLS = ["weather_bucket", "state", "is_night"]
UNUSABLE_COLUMNS = ["end_lat", "end_lng", "wind_chill_f"]
KEY_COLUMNS = ["severity", "start_lat", "start_lng"]
TARGET = "grave"

FEATURES = INFRA + NUMERIC_CONTROLS + CATEGORICAL_CONTROLS
PREPARED_COLUMNS = (
    INFRA + WEATHER_NUMERIC
    + ["hour", "dow", "month", "year", "is_night", "weather_bucket", "state", "grave",
       "severity", "start_lat", "start_lng"]
)


def raw_schema() -> T.StructType:
    """The 46 fields of the accident file, in file order and never inferred."""

    def kind(name: str) -> T.DataType:
        if name in RAW_STRINGS:
            return T.StringType()
        if name in RAW_TIMESTAMPS:
            return T.TimestampType()
        if name in RAW_BOOLEANS:
            return T.BooleanType()
        return T.IntegerType() if name == "Severity" else T.DoubleType()

    return T.StructType([T.StructField(name, kind(name)) for name in RAW_COLUMNS])


def normal_name(name: str) -> str:
    """``Humidity(%)`` becomes ``humidity_pct``."""
    return name.lower().translate(str.maketrans({"(": "_", ")": "", "%": "pct"}))


@dataclass(frozen=True)
class Thresholds:
    """Decision parameters of a run; the defaults are the published ones."""

    severe_from: int = 3
    resolution: int = 8
    top_zones: int = 50
    lift_min: float = 1.5
    presence_min: float = 0.05
    min_rows: int = 200
    test_from: int = 2022
    early: tuple[int, int] = (2016, 2019)
    late: tuple[int, int] = (2020, 2023)
    history_weight: float = 30.0
    distinct_actions: int = 3


@dataclass(frozen=True)
class ModelChoice:
    """Which classifier to fit and how."""

    algorithm: str = "hist_gradient_boosting"
    params: dict = field(default_factory=dict)
    balanced: bool = True
    place_history: bool = False
    scope: str = "us"
    max_rows: int | None = None
    seed: int = 42
