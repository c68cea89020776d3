"""Batch job that writes the tables an interactive tool reads.

    spark-submit -m asphalt.plans.prepare --csv FILE --out FOLDER
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asphalt.operators import cleaning, features, when, zones
from asphalt.schema import PREPARED_COLUMNS, Thresholds
from asphalt.session import job_session, materialise
from asphalt.sources.accidents import is_prepared, read_prepared, scan_csv
from asphalt.sources.results import write_prepared


def keep_sample(accidents: DataFrame, folder: str, cap: int | None = None) -> None:
    """Write ``accidents_sample``, up to ``cap`` rows of each state, unless there is one.

    An existing sample is kept, so that a model trained on it stays reproducible.
    """
    if is_prepared(accidents.sparkSession, folder, "accidents_sample"):
        return
    key = [c for c in ("id", "start_time", "start_lat", "start_lng") if c in accidents.columns]
    sample = accidents.select(*dict.fromkeys([*key, *PREPARED_COLUMNS]))
    sample = sample if cap is None else features.stratified_cap(sample, cap, key)
    write_prepared(sample.select(*PREPARED_COLUMNS), folder, "accidents_sample")


def prepare(raw: DataFrame, folder: str, cap: int | None = None, limits: Thresholds = Thresholds()) -> None:
    """Write the clean table, sample, zones, yearly zones and time tables of a raw accident table.

    ``cap`` bounds the rows of each state in ``accidents_sample``, a table to fit models on; without it all are in.
    """
    cleaned = cleaning.clean(cleaning.normalise_names(raw), limits.severe_from)
    # The text file is parsed once; everything below reads pruned columns of the written table.
    write_prepared(cleaned, folder, "accidents", by="state")
    accidents = read_prepared(raw.sparkSession, folder, "accidents", cleaned.schema)
    placed = accidents.where(F.col("state") != "")

    keep_sample(accidents, folder, cap)

    zone_columns = ["state", "cell", "n_accidents", "avg_severity", "charge"]
    table = zones.zone_table(placed, limits.resolution)
    counts = [c for c in table.columns if c.startswith(("n_", "charge_")) and c not in zone_columns]
    write_prepared(table.select(*zone_columns, *counts), folder, "zones", by="state")
    write_prepared(zones.zone_years(placed, limits.resolution), folder, "zones_year", by="state")

    # All time tables come from one grouping of the accidents.
    grouped = materialise(when.grouped_counts(accidents, "hour", "weather_bucket", "month", "year"))
    for name, dimension in (("hour", "hour"), ("weather", "weather_bucket"), ("month", "month")):
        write_prepared(when.cube_of(grouped, dimension), folder, f"quand_{name}")
    write_prepared(when.totals_of(grouped, "year"), folder, "quand_year")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--csv", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--cap", type=int, help="rows of each state in the sample")
    arguments = parser.parse_args()
    spark = job_session("prepare")
    prepare(scan_csv(spark, arguments.csv), arguments.out, arguments.cap)
    spark.stop()


if __name__ == "__main__":
    main()
