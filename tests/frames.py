"""Small hand-made accident frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from asphalt.schema import INFRA

BASE = {"severity": 2, "start_lat": 34.0, "start_lng": -118.0, "state": "CA", "year": 2020, "month": 1, "hour": 8}


def accidents(spark, rows):
    """Clean accidents from dicts; absent flags are 0."""
    fields = ["severity int", "start_lat double", "start_lng double", "state string", "year int", "month int", "hour int"]
    fields += [f"{e} int" for e in INFRA]
    names = [f.split()[0] for f in fields]
    full = [{**dict.fromkeys(INFRA, 0), **BASE, **row} for row in rows]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in full], ", ".join(fields))
    return df.withColumn("grave", (F.col("severity") >= 3).cast("int"))


def raw(spark, rows):
    """Raw accidents under normalised names from dicts."""
    fields = (
        ["severity int", "start_time timestamp", "start_lat double", "start_lng double", "end_lat double",
         "state string", "weather_condition string", "sunrise_sunset string"] + [f"{e} boolean" for e in INFRA]
    )
    names = [f.split()[0] for f in fields]
    base = {"severity": 2, "start_time": dt.datetime(2020, 3, 1, 7), "start_lat": 34.0, "start_lng": -118.0,
            "state": "CA", "end_lat": 1.0}
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], ", ".join(fields))


def zones(spark, rows):
    """Zone rows from dicts with n_/charge_ totals; absent totals are 0."""
    names = ["cell", "n_accidents", "avg_severity", "charge"] + [f"{p}_{e}" for e in INFRA for p in ("n", "charge")]
    kinds = ["string", "long", "double", "long"] + ["long"] * (2 * len(INFRA))
    base = {**dict.fromkeys(names, 0), "avg_severity": 2.0}
    return spark.createDataFrame(
        [tuple({**base, **r}[n] for n in names) for r in rows], ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
