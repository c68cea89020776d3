"""Registered queries: ``(spark, folder) -> DataFrame`` for every operator."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asphalt.checks import parameters as P
from asphalt.checks.views import load, load_raw
from asphalt.functions import hexgrid
from asphalt.functions.dates import calendar_fields, event_window
from asphalt.functions.scoring import linear_predictor, logistic
from asphalt.functions.text import weather_bucket
from asphalt.operators import (
    attribution, cleaning, effects, exposure, features, metrics, models, penalised, profile, quality, recommend, validation, when,
    zones,
)
from asphalt.plans import decide
from asphalt.plans.prepare import keep_sample, prepare
from asphalt.schema import FEATURES, INFRA, NUMERIC_CONTROLS, TARGET, WEATHER_NUMERIC, ModelChoice
from asphalt.session import broadcast_if_small, checkpoint_ready, materialise, shuffles_dropped
from asphalt.sources.accidents import read_prepared, scan_csv
from asphalt.sources.results import write_csv, write_prepared, write_summary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a few digits, without a negative zero, so that engines can be compared."""
    doubles = {f.name: F.round(F.col(f.name), digits) + 0.0 for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(doubles) if doubles else df


@contextmanager
def shared_folder(spark: SparkSession) -> Iterator[str]:
    """A folder in the shared checkpoint folder that is removed after use."""
    checkpoint_ready(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/query-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# --- inputs -------------------------------------------------------------------


def clean_table(spark: SparkSession, sf: str) -> DataFrame:
    """Clean accidents, from raw ones with every kind of gap."""
    return cleaning.clean(cleaning.normalise_names(load_raw(spark, sf)), P.STAND_IN.severe_from)


def timed_table(spark: SparkSession, sf: str) -> DataFrame:
    timed = load(spark, sf, "incidents_ts")
    return timed.withColumns({
        "grave": (F.col("severity") >= P.STAND_IN.severe_from).cast("int"),
        **calendar_fields(F.col("start_time")),
        "weather_bucket": weather_bucket(F.col("weather_condition")),
    })


def national_zones(spark: SparkSession, sf: str) -> DataFrame:
    return zones.zone_table(clean_table(spark, sf), P.STAND_IN.resolution, keys=())


def shared_zones(spark: SparkSession, sf: str) -> DataFrame:
    """The zone table computed once, for questions that read it several times."""
    return materialise(national_zones(spark, sf))


def roads(spark: SparkSession, sf: str) -> DataFrame:
    return exposure.road_exposure(load(spark, sf, "road_segments"), P.STAND_IN.resolution)


def split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return cleaning.temporal_split(clean_table(spark, sf), P.STAND_IN.test_from)


def model_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of a model, equal ones as one with their number: the raw tables are joined once for both."""
    part = cleaning.part_of(P.STAND_IN.test_from).alias("_part")
    dated = clean_table(spark, sf).select(*FEATURES, TARGET, part).where("_part IS NOT NULL")
    with shuffles_dropped(spark):
        rows = materialise(features.collapsed(dated))
    train, test = (rows.where(F.col("_part") == name).drop("_part") for name in ("train", "test"))
    return train, test


def fixed_score(df: DataFrame) -> DataFrame:
    return df.withColumn("score", logistic(linear_predictor(P.INTERCEPT, P.COEFFICIENTS)))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows with the fixed score, equal up to nine digits meaning equal."""
    test = fixed_score(split(spark, sf)[1])
    return test.select(F.round("score", 9).alias("score"), F.col(TARGET).alias("label"))


def burdens(spark: SparkSession, sf: str) -> DataFrame:
    t = P.STAND_IN
    return validation.period_burdens(clean_table(spark, sf), t.early, t.late, t.resolution)


def conditional(spark: SparkSession, sf: str) -> DataFrame:
    return effects.conditional_effects(split(spark, sf)[1], fixed_score, P.STAND_IN.min_rows)


def recommended(spark: SparkSession, sf: str, table: DataFrame | None = None) -> DataFrame:
    """Priority zones with exposure, hazard, equipment and recommendation."""
    table = shared_zones(spark, sf) if table is None else table
    return decide.recommended_zones(
        table, conditional(spark, sf), P.STAND_IN, load(spark, sf, "road_segments"))


def written_plan(spark: SparkSession, sf: str, table: DataFrame | None = None) -> DataFrame:
    return recommend.final_plan(recommended(spark, sf, table))


# --- sources and cleaning -----------------------------------------------------


@query
def scan_csv_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table written as CSV to shared storage and scanned back."""
    with shared_folder(spark) as folder:
        load_raw(spark, sf).write.option("header", True).option("compression", "gzip").csv(folder)
        df = cleaning.normalise_names(scan_csv(spark, folder))
        present = df.agg(*[F.count(c).alias(c) for c in df.columns])
        return materialise(profile.long_format(present, df.columns, "column", "n_present"))


@query
def sinks(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that come back from each kind of output, and from a table that is kept because it is there."""
    schema = clean_table(spark, sf).schema
    with shared_folder(spark) as folder:
        # The raw table is joined and cleaned once, by the job; all else reads columns of what it wrote.
        prepare(load_raw(spark, sf), f"{folder}/tables", cap=P.CAP_PER_STATE)
        accidents = read_prepared(spark, f"{folder}/tables", "accidents", schema)
        keep_sample(accidents, f"{folder}/tables", cap=1)  # finds the sample and keeps it
        quality.require(quality.clean_violations(accidents))
        write_prepared(accidents.select("id", "state", "severity"), folder, "accidents", by="state")
        back = read_prepared(spark, folder, "accidents")
        counts = when.by_dimension(back.withColumn("grave", F.lit(0)), "severity")
        write_csv(counts, folder, "counts.csv")
        write_summary(spark, {"rows": back.count()}, folder, "summary.json")
        found = {
            "prepared": back, "csv": spark.read.option("header", True).csv(f"{folder}/counts.csv"),
            "summary": spark.read.schema("rows long").json(f"{folder}/summary.json"),
            "sample": read_prepared(spark, f"{folder}/tables", "accidents_sample"),
        }
        sizes = [df.agg((F.sum("rows") if name == "summary" else F.count("*")).alias("n")).withColumn("sink", F.lit(name))
                 for name, df in found.items()]
        return materialise(effects.stack(sizes))


@query
def normalised_schema(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.normalise_names(load_raw(spark, sf))
    present = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return profile.long_format(present, df.columns, "column", "n_present")


@query
def clean(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.clean(cleaning.normalise_names(load_raw(spark, sf)), P.STAND_IN.severe_from)
    return rounded(df.select(
        "id", "severity", "grave", "hour", "dow", "month", "year", "is_night", "weather_bucket", "state",
        "start_lat", "start_lng", "temperature_f", *INFRA,
    ))


@query
def calendar_fields_counts(spark: SparkSession, sf: str) -> DataFrame:
    return timed_table(spark, sf).groupBy("hour", "dow", "month", "year").agg(F.count("*").alias("n"))


@query
def keyword_bucket(spark: SparkSession, sf: str) -> DataFrame:
    parts = [clean_table(spark, sf), timed_table(spark, sf)]
    both = parts[0].select("weather_condition", "weather_bucket").unionByName(
        parts[1].select("weather_condition", "weather_bucket"))
    return both.groupBy("weather_condition", "weather_bucket").agg(F.count("*").alias("n"))


@query
def event_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    df = clean_table(spark, sf)
    return df.groupBy(
        "month", F.dayofmonth("start_time").alias("day"), event_window(F.col("start_time")).alias("event")
    ).agg(F.count("*").alias("n"))


@query
def territory(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.territory(clean_table(spark, sf), P.STATE).groupBy("state", "year").agg(
        F.count("*").alias("n"), F.sum("severity").alias("charge"))


@query
def states(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.states(clean_table(spark, sf))


@query
def temporal_split(spark: SparkSession, sf: str) -> DataFrame:
    parts = clean_table(spark, sf).withColumn("part", cleaning.part_of(P.STAND_IN.test_from))
    return parts.where(F.col("part").isNotNull()).groupBy("part").agg(
        F.count("*").alias("n"), F.sum(TARGET).alias("graves"), F.min("year").alias("first_year"),
        F.max("year").alias("last_year"))


@query
def model_table(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.model_table(clean_table(spark, sf)))


# --- profile and WHEN ---------------------------------------------------------


@query
def target_rate(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.target_rate(clean_table(spark, sf)))


@query
def missing_rate(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.missing_rate(cleaning.normalise_names(load_raw(spark, sf))))


@query
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.coverage(clean_table(spark, sf)))


@query
def severity_dist(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.severity_distribution(clean_table(spark, sf)))


@query
def infra_delta(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.infra_delta(clean_table(spark, sf)))


@query
def flag_domain(spark: SparkSession, sf: str) -> DataFrame:
    return profile.flag_domain(clean_table(spark, sf))


@query
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(clean_table(spark, sf), "weather_bucket")


@query
def quand_hour(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(when.by_dimension(timed_table(spark, sf), "hour"))


@query
def quand_weather(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(when.by_dimension(timed_table(spark, sf), "weather_bucket"))


@query
def quand_event(spark: SparkSession, sf: str) -> DataFrame:
    return when.by_event(clean_table(spark, sf))


@query
def quand_month(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(when.cube(clean_table(spark, sf), "month"))


@query
def quand_year(spark: SparkSession, sf: str) -> DataFrame:
    return when.year_trend(clean_table(spark, sf))


@query
def peak_hour(spark: SparkSession, sf: str) -> DataFrame:
    return when.peak_hour(when.by_dimension(timed_table(spark, sf), "hour"))


@query
def quand_fallback(spark: SparkSession, sf: str) -> DataFrame:
    accidents = clean_table(spark, sf)
    asked = accidents.select("state").unionByName(timed_table(spark, sf).select("state")).distinct()
    return rounded(when.for_territory(when.cube(accidents, "month"), asked.withColumnRenamed("state", "territory")))


# --- WHERE --------------------------------------------------------------------


@query
def hex_bin(spark: SparkSession, sf: str) -> DataFrame:
    return zones.bins(clean_table(spark, sf), (8, 7, 5))


@query
def zone_agg(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(zones.zone_table(clean_table(spark, sf), P.STAND_IN.resolution))


@query
def zone_year(spark: SparkSession, sf: str) -> DataFrame:
    return zones.zone_years(clean_table(spark, sf), P.STAND_IN.resolution)


@query
def zone_rank(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(zones.ranked(national_zones(spark, sf)).select(
        "rank", "cell", "n_accidents", "avg_severity", "charge"))


@query
def flagship_zones(spark: SparkSession, sf: str) -> DataFrame:
    top = zones.priority_with_share(shared_zones(spark, sf), P.STAND_IN.top_zones)
    return rounded(top.select("rank", "cell", "n_accidents", "avg_severity", "charge", "charge_share"))


@query
def concentration(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(zones.concentration(national_zones(spark, sf)))


@query
def kpi(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(zones.totals(national_zones(spark, sf)))


@query
def zone_extent(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(zones.extent(zones.priority(national_zones(spark, sf), P.STAND_IN.top_zones)))


@query
def zone_geojson(spark: SparkSession, sf: str) -> DataFrame:
    """Centre and outline of every zone, one row per outline point."""
    cell, r = F.col("cell"), P.STAND_IN.resolution
    lat, lng = hexgrid.centre(cell, r)
    return rounded(
        national_zones(spark, sf)
        .select("cell", "charge", lat.alias("centre_lat"), lng.alias("centre_lng"),
                F.posexplode(hexgrid.boundary(cell, r)).alias("corner", "point"))
        .select("cell", "charge", "centre_lat", "centre_lng", "corner", "point.lat", "point.lng")
    )


@query
def zone_size(spark: SparkSession, sf: str) -> DataFrame:
    sized = zones.marker_size(exposure.with_exposure(shared_zones(spark, sf), roads(spark, sf)))
    return rounded(sized.select("cell", "size"))


@query
def road_exposure(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(roads(spark, sf))


@query
def zone_exposure(spark: SparkSession, sf: str) -> DataFrame:
    table = exposure.with_exposure(national_zones(spark, sf), roads(spark, sf))
    return rounded(table.select(
        "cell", "n_accidents", "charge", "street_km", "n_intersections", "acc_per_km", "charge_per_km"))


@query
def zone_type(spark: SparkSession, sf: str) -> DataFrame:
    table = exposure.with_zone_type(exposure.with_exposure(national_zones(spark, sf), roads(spark, sf)))
    return rounded(table.select("cell", "acc_per_km", "type_zone"))


@query
def rank_movement(spark: SparkSession, sf: str) -> DataFrame:
    table = exposure.rank_movement(exposure.with_exposure(national_zones(spark, sf), roads(spark, sf)))
    return rounded(table.select("cell", "rank_charge", "rank_per_km", "movement"))


@query
def period_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(validation.period_scores(burdens(spark, sf)))


@query
def temporal_stability(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(validation.stability(burdens(spark, sf)))


@query
def top_kept(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(validation.still_on_top(burdens(spark, sf), P.STAND_IN.top_zones))


@query
def backtest(spark: SparkSession, sf: str) -> DataFrame:
    years = zones.zone_years(clean_table(spark, sf), P.STAND_IN.resolution, keys=())
    return rounded(validation.backtest(years, P.STAND_IN.top_zones, *P.BACKTEST))


# --- features -----------------------------------------------------------------


@query
def stratified_cap(spark: SparkSession, sf: str) -> DataFrame:
    return features.stratified_cap(clean_table(spark, sf), P.CAP_PER_STATE, ["id"]).select("id", "state")


@query
def capped_sample(spark: SparkSession, sf: str) -> DataFrame:
    return features.capped_sample(clean_table(spark, sf), P.CAP_ROWS, ["id"]).select("id", "state")


@query
def impute_median(spark: SparkSession, sf: str) -> DataFrame:
    # Every pass reads the five columns, not the accidents they come from.
    df = clean_table(spark, sf).select(*WEATHER_NUMERIC).persist()
    try:
        found = materialise(features.medians(df, WEATHER_NUMERIC))
        filled = features.impute_median(df, WEATHER_NUMERIC, found)
        means = materialise(filled.agg(*[F.avg(c).alias(c) for c in WEATHER_NUMERIC]))
    finally:
        df.unpersist()
    after = profile.long_format(means, WEATHER_NUMERIC, "name", "mean_after")
    return rounded(found.join(F.broadcast(after), "name"))


@query
def impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["sunrise_sunset", "weather_condition"]
    return features.category_counts(features.impute_mode(clean_table(spark, sf), columns), columns)


@query
def standardise(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.standardise(clean_table(spark, sf), WEATHER_NUMERIC).select("id", *WEATHER_NUMERIC))


@query
def rare_pooling(spark: SparkSession, sf: str) -> DataFrame:
    pooled = features.pool_rare(clean_table(spark, sf), "weather_condition", P.RARE_BELOW)
    return pooled.groupBy("weather_condition").agg(F.count("*").alias("n"))


@query
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.class_weights(split(spark, sf)[0]))


@query
def zone_history(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split(spark, sf)
    learnt = features.zone_history(train.unionByName(test), train, weight=P.STAND_IN.history_weight)
    return rounded(learnt.select("id", *features.history_columns()))


@query
def encode_controls(spark: SparkSession, sf: str) -> DataFrame:
    """What the models see of the controls of every row, learnt on the training rows."""
    train = materialise(features.collapsed(split(spark, sf)[0].select(*NUMERIC_CONTROLS, *P.ENCODED)))
    encoder = features.Encoder.fit(train, NUMERIC_CONTROLS, P.ENCODED, P.RARE_BELOW)
    dated = clean_table(spark, sf).where(F.col("year").isNotNull())  # training and test rows in one scan
    rows = encoder.transform(dated.select("id", *NUMERIC_CONTROLS, *P.ENCODED))
    for c in encoder.used:
        labels = broadcast_if_small(
            encoder.labels(c).select(F.col("position").alias("_at"), F.col("label").alias(f"_label_{c}")))
        rows = rows.join(labels, F.col(f"_k_{c}").cast("int") == F.col("_at"), "left").drop("_at")
    shown = [F.col(f"_label_{c}").alias(c) for c in encoder.used]
    return rounded(rows.select("id", *[F.col(f"_x_{c}").alias(c) for c in NUMERIC_CONTROLS], *shown))


# --- scores -------------------------------------------------------------------


@query
def avg_precision(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.average_precision(scored(spark, sf)))


@query
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.roc_auc(scored(spark, sf)))


@query
def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.pr_curve(scored(spark, sf)))


@query
def gain_curve(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.gain_curve(scored(spark, sf)))


@query
def gain_capture(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.capture_at(scored(spark, sf)))


@query
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.confusion(scored(spark, sf), P.THRESHOLD))


@query
def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.threshold_sweep(scored(spark, sf), P.SWEEP))


@query
def model_floor(spark: SparkSession, sf: str) -> DataFrame:
    constant = split(spark, sf)[1].select(F.lit(0.5).alias("score"), F.col(TARGET).alias("label"))
    return rounded(metrics.evaluate(constant).select("n", "pr_auc", "roc_auc"))


@query
def reliability(spark: SparkSession, sf: str) -> DataFrame:
    table = metrics.reliability(metrics.evaluate(scored(spark, sf)))
    return rounded(table.select("n", "baseline", "pr_auc", "ratio", F.col("low_signal").cast("int").alias("low_signal")))


# --- WHAT ---------------------------------------------------------------------


@query
def gcomp_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(effects.adjusted_effects(split(spark, sf)[1], fixed_score))


@query
def cond_effects(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(conditional(spark, sf))


@query
def cond_delta_raw(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(effects.raw_conditional_effects(clean_table(spark, sf), P.STAND_IN.min_rows))


@query
def effect_concordance(spark: SparkSession, sf: str) -> DataFrame:
    raw = effects.raw_conditional_effects(clean_table(spark, sf), P.STAND_IN.min_rows)
    return rounded(effects.pair_concordance(conditional(spark, sf), raw))


@query
def element_concordance(spark: SparkSession, sf: str) -> DataFrame:
    """Odds ratios of the fixed score against adjusted effects, two elements without odds."""
    odds = spark.createDataFrame(
        [(e, math.exp(P.COEFFICIENTS[e])) for e in INFRA if e not in P.WITHOUT_ODDS], "element string, odds_ratio double")
    return rounded(effects.concordance(odds, effects.adjusted_effects(split(spark, sf)[1], fixed_score)))


@query
def linear_attribution(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split(spark, sf)
    return rounded(effects.linear_attribution(test, train, P.COEFFICIENTS))


@query
def fixed_tree_attribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(attribution.tree_attribution(split(spark, sf)[1], P.TREE))


def _method_values(spark: SparkSession, sf: str) -> DataFrame:
    """Four measures of every element's weight: three from totals per flag combination, one from scores."""
    parted = clean_table(spark, sf).withColumn("part", cleaning.part_of(P.STAND_IN.test_from))
    patterns = materialise(parted.groupBy(*INFRA, "part").agg(F.count("severity").alias("n"), F.sum("severity").alias("charge")))
    train, test = (patterns.where(F.col("part") == part) for part in ("train", "test"))
    infra = {name: P.COEFFICIENTS[name] for name in INFRA}
    shares = patterns.agg(*[(F.sum(F.col(e) * F.col("n")) / F.sum("n")).alias(e) for e in INFRA])
    parts = {
        "raw": profile.delta_of(patterns).select("element", F.abs("delta").alias("value")),
        "adjusted": effects.adjusted_effects(split(spark, sf)[1], fixed_score).select("element", F.abs("delta").alias("value")),
        "presence": profile.long_format(shares, INFRA, "element", "value"),
        "attribution": effects.linear_attribution(test, train, infra, weight="n").select(
            F.col("feature").alias("element"), F.col("mean_abs").alias("value")),
    }
    return effects.stack([part.withColumn("method", F.lit(name)) for name, part in parts.items()])


@query
def method_ranks(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(effects.importance_ranks(rounded(_method_values(spark, sf), 9)).select("method", "element", "rank"))


@query
def rank_convergence(spark: SparkSession, sf: str) -> DataFrame:
    ranks = effects.importance_ranks(rounded(_method_values(spark, sf), 9))
    return rounded(effects.rank_convergence(ranks, ["raw", "adjusted", "presence", "attribution"]))


# --- decision -----------------------------------------------------------------


@query
def territory_share(spark: SparkSession, sf: str) -> DataFrame:
    table = shared_zones(spark, sf)
    sides = [
        profile.long_format(recommend.territory_share(table, w), INFRA, "element", "share").withColumn("weight", F.lit(w))
        for w in ("severity", "count")
    ]
    return rounded(effects.stack(sides))


@query
def zone_lift(spark: SparkSession, sf: str) -> DataFrame:
    table = shared_zones(spark, sf)
    sides = [
        recommend.with_lift(table, recommend.territory_share(table, w), w, P.STAND_IN.lift_min)
        .select("cell", "lift", "dominant", F.lit(w).alias("weight"))
        for w in ("severity", "count")
    ]
    return rounded(effects.stack(sides))


@query
def equip_present(spark: SparkSession, sf: str) -> DataFrame:
    return national_zones(spark, sf).select(
        "cell", recommend.equipment_present(P.STAND_IN.presence_min).alias("equip_present"))


@query
def recommend_all(spark: SparkSession, sf: str) -> DataFrame:
    """Recommendation for every zone, not only the priority list."""
    table = shared_zones(spark, sf)
    lifted = recommend.with_lift(table, recommend.territory_share(table), lift_min=P.STAND_IN.lift_min)
    done = recommend.recommend(lifted, conditional(spark, sf), P.STAND_IN.presence_min)
    return rounded(done.select("cell", "dominant", "measure", "amenagement", "impact_graves_evites"))


@query
def priority_zones(spark: SparkSession, sf: str) -> DataFrame:
    return written_plan(spark, sf)


@query
def plan_annual(spark: SparkSession, sf: str) -> DataFrame:
    years = recommend.observed_years(clean_table(spark, sf))
    return recommend.per_year(written_plan(spark, sf), years).select("rank", "cell", "impact_graves_evites", "impact_par_an")


@query
def span_years(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(recommend.observed_years(clean_table(spark, sf)))


@query
def plan_recap(spark: SparkSession, sf: str) -> DataFrame:
    return recommend.recap(written_plan(spark, sf))


@query
def plan_reason(spark: SparkSession, sf: str) -> DataFrame:
    return recommended(spark, sf).select("rank", "cell", recommend.reason().alias("reason"))


@query
def screen_plan(spark: SparkSession, sf: str) -> DataFrame:
    return decide.screen_plan(shared_zones(spark, sf), conditional(spark, sf), clean_table(spark, sf), P.STAND_IN)


# --- quality ------------------------------------------------------------------


@query
def dq_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Violations before and after cleaning: the raw counts show that the checks bite."""
    raw = cleaning.normalise_names(load_raw(spark, sf))
    after = quality.clean_violations(cleaning.clean(raw))
    return after.withColumn("raw_without_key", raw.agg(F.count_if(
        F.col("severity").isNull() | F.col("start_lat").isNull() | F.col("start_lng").isNull())).scalar())


@query
def leak_checks(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split(spark, sf)
    return quality.leak_violations(clean_table(spark, sf), train, test, P.STAND_IN.test_from)


@query
def plan_checks(spark: SparkSession, sf: str) -> DataFrame:
    table = shared_zones(spark, sf)
    return quality.plan_violations(written_plan(spark, sf, table), P.STAND_IN.distinct_actions).withColumn(
        "zones", table.agg(F.count("*")).scalar())


# --- fitted models (no SQL equivalent) ----------------------------------------


def _fit(train: DataFrame, choice: ModelChoice) -> models.SeverityModel:
    rows = models.training_rows(train, choice.place_history)
    try:
        return models.fit(rows, choice)
    finally:
        rows.unpersist()


def _fitted(spark: SparkSession, sf: str, algorithm: str, **params) -> tuple[models.SeverityModel, DataFrame]:
    train, test = model_rows(spark, sf)
    return _fit(train, ModelChoice(algorithm, params)), test


def distinct_rows(test: DataFrame) -> DataFrame:
    """What a model reads of the collapsed test rows, equal rows as one: each is scored thirteen times."""
    return features.collapsed(test.select(*FEATURES, features.ROWS))


def _quality(spark: SparkSession, sf: str, algorithm: str, **params) -> DataFrame:
    model, test = _fitted(spark, sf, algorithm, **params)
    return metrics.reliability(metrics.evaluate(models.counted_scores(model, test)))


@query
def fit_logistic(spark: SparkSession, sf: str) -> DataFrame:
    return _quality(spark, sf, "logistic")


@query
def fit_tree(spark: SparkSession, sf: str) -> DataFrame:
    return _quality(spark, sf, "tree")


@query
def tree_attribution(spark: SparkSession, sf: str) -> DataFrame:
    """Which flags and controls the fitted tree's probabilities of the test rows come from."""
    train, test = split(spark, sf)
    model = _fit(train, ModelChoice("tree"))
    tree = attribution.of_classifier(model.classifier, [*INFRA, *model.encoder.columns])
    found = attribution.tree_attribution(model.prepare(test), tree)
    return found.withColumn("feature", F.regexp_replace("feature", "^_[xk]_", ""))


@query
def fit_forest(spark: SparkSession, sf: str) -> DataFrame:
    return _quality(spark, sf, "random_forest")


@query
def fit_gbt(spark: SparkSession, sf: str) -> DataFrame:
    return _quality(spark, sf, "hist_gradient_boosting")


@query
def fit_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """A fitted model is above the floor and finds the planted signs."""
    model, test = _fitted(spark, sf, "logistic")
    quality_row = metrics.evaluate(models.counted_scores(model, test)).select((F.col("pr_auc") > F.col("baseline")).cast("int").alias("ok"))
    deltas = effects.adjusted_effects(model.prepare(distinct_rows(test)), model.score)
    signs = {"junction raises severity": ("junction", F.col("delta") > 0), "signals lower severity": ("traffic_signal", F.col("delta") < 0)}
    found = [deltas.where(F.col("element") == e).select(F.lit(name).alias("claim"), test_.cast("int").alias("ok"))
             for name, (e, test_) in signs.items()]
    return effects.stack([quality_row.select(F.lit("above the floor").alias("claim"), "ok"), *found])


@query
def fit_with_history(spark: SparkSession, sf: str) -> DataFrame:
    choice = ModelChoice("logistic", place_history=True)
    with shared_folder(spark) as folder:
        # History, training and test rows each read the clean table: the raw tables are joined once, by its writing.
        with shuffles_dropped(spark):
            clean_table(spark, sf).select(*FEATURES, TARGET, "year", "start_lat", "start_lng").write.parquet(folder)
        train, test = models.split_for(spark.read.parquet(folder), choice, P.STAND_IN.test_from, None)
        evaluated = metrics.evaluate(models.counted_scores(_fit(train, choice), test))
        return materialise(metrics.reliability(evaluated))


_CHOICES = {
    "floor": ModelChoice("dummy"), "logistic": ModelChoice("logistic"), "tree": ModelChoice("tree"),
    "forest": ModelChoice("random_forest", P.COMPARED_FOREST),
    "boosting": ModelChoice("hist_gradient_boosting", P.COMPARED_BOOSTING),
}


@query
def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    return models.compare(*model_rows(spark, sf), _CHOICES)[0]


@query
def gcomp(spark: SparkSession, sf: str) -> DataFrame:
    model, test = _fitted(spark, sf, "hist_gradient_boosting", **P.COMPARED_BOOSTING)
    return effects.adjusted_effects(model.prepare(distinct_rows(test)), model.score)


@query
def odds_ratio(spark: SparkSession, sf: str) -> DataFrame:
    rows = models.training_rows(split(spark, sf)[0])
    try:
        return effects.odds_ratios(rows)
    finally:
        rows.unpersist()


@query
def penalised_odds_ratio(spark: SparkSession, sf: str) -> DataFrame:
    rows = models.training_rows(split(spark, sf)[0])
    try:
        return effects.penalised_odds_ratios(rows)
    finally:
        rows.unpersist()


@query
def penalised_odds_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Two flags only, so that SQL can state the iteration too."""
    return rounded(penalised.ratios(split(spark, sf)[0], P.PENALISED, TARGET))


@query
def importances(spark: SparkSession, sf: str) -> DataFrame:
    rows = models.training_rows(split(spark, sf)[0])
    try:
        encoder = features.Encoder.fit(rows)
        return models.importances({
            name: models.fit(rows, choice, encoder) for name, choice in _CHOICES.items() if name != "floor"
        })
    finally:
        rows.unpersist()


@query
def method_convergence(spark: SparkSession, sf: str) -> DataFrame:
    """Rank correlation of the fitted methods over the elements."""
    values = importances(spark, sf)
    return effects.rank_convergence(effects.importance_ranks(values), [n for n in _CHOICES if n != "floor"])


@query
def importance_ranks(spark: SparkSession, sf: str) -> DataFrame:
    return effects.importance_ranks(importances(spark, sf))


# Names in the coverage list that a Python function of the module would shadow.
for _name, _function in {
    "scan_csv": "scan_csv_counts", "calendar_fields": "calendar_fields_counts",
    "event_window": "event_window_counts", "recommend": "recommend_all",
}.items():
    QUERIES[_name] = QUERIES.pop(_function)
