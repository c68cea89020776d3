"""WHAT: effect of each piece of equipment on severity, context held equal.

Effects are read from any scorer, a function that adds ``score`` to rows with
flag columns. Each row is scored as it is and once more per element with that
flag switched; both arms of every comparison are rebuilt from these scores.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asphalt.operators import penalised
from asphalt.operators.features import ROWS, Encoder, row_count
from asphalt.operators.profile import flag_patterns, long_format
from asphalt.operators.scalars import with_row
from asphalt.schema import DEPLOYABLE, INFRA, NUMERIC_CONTROLS, TARGET
from asphalt.session import materialise

Scorer = Callable[[DataFrame], DataFrame]
NORMAL_95 = 1.959964
_AS_IT_IS = -1


def pairs(hazards: Sequence[str] = INFRA, measures: Sequence[str] = DEPLOYABLE) -> list[tuple[str, str]]:
    return [(h, p) for h in hazards for p in measures if h != p]


def switched(df: DataFrame, elements: Sequence[str]) -> DataFrame:
    """Each row as it is (``_switch`` = -1) and once per element with that flag switched.

    ``_was`` keeps the flags as observed. No shuffle is involved.
    """
    numbered = F.array(*[F.lit(i) for i in range(_AS_IT_IS, len(elements))])
    copies = df.withColumn("_was", F.struct(*INFRA)).withColumn("_switch", F.explode(numbered))
    return copies.withColumns({
        e: F.when(F.col("_switch") == i, 1 - F.col(e)).otherwise(F.col(e)) for i, e in enumerate(elements)
    })


def score_patterns(df: DataFrame, scorer: Scorer, elements: Sequence[str] = INFRA) -> DataFrame:
    """Total score per combination of observed flags and switch: a bounded number of rows. ``df`` may be collapsed."""
    scored = scorer(switched(df, elements))
    score = F.col("score") * F.col(ROWS) if ROWS in df.columns else F.col("score")
    return scored.groupBy("_was", "_switch").agg(F.sum(score).alias("score"), row_count(scored).alias("n"))


def _signed_score(position: Column, flag: Column) -> Column:
    """Part of a pattern in "flag on minus flag off", NULL where it has none."""
    sign = F.when(flag == 1, 1.0).otherwise(-1.0)
    return F.when(F.col("_switch") == _AS_IT_IS, sign * F.col("score")).when(
        F.col("_switch") == position, -sign * F.col("score")
    )


def adjusted_effects(df: DataFrame, scorer: Scorer, elements: Sequence[str] = INFRA) -> DataFrame:
    """Mean change of the predicted severe probability, element on minus off."""
    return adjusted_of(score_patterns(df, scorer, elements), elements)


def adjusted_of(patterns: DataFrame, elements: Sequence[str] = INFRA) -> DataFrame:
    """Adjusted effects from scores per pattern of the same elements."""
    item = F.explode(F.array(*[
        F.struct(F.lit(e).alias("element"), F.lit(i).alias("position"), F.col(f"_was.{e}").alias("flag"))
        for i, e in enumerate(elements)
    ]))
    observed = F.when(F.col("_switch") == _AS_IT_IS, F.col("n"))
    return (
        patterns.withColumn("item", item).groupBy("item.element")
        .agg((F.sum(_signed_score(F.col("item.position"), F.col("item.flag"))) / F.sum(observed)).alias("delta"))
    )


def conditional_effects(
    df: DataFrame, scorer: Scorer, min_rows: int,
    hazards: Sequence[str] = INFRA, measures: Sequence[str] = DEPLOYABLE,
) -> DataFrame:
    """Adjusted effect of each measure among the rows that carry a hazard.

    All pairs come out of one scan. A hazard with fewer than ``min_rows`` rows
    has an unknown effect. The result has one row per (hazard, measure).
    """
    return conditional_of(score_patterns(df, scorer, measures), min_rows, hazards, measures, measures)


def conditional_of(
    patterns: DataFrame, min_rows: int, hazards: Sequence[str] = INFRA, measures: Sequence[str] = DEPLOYABLE,
    elements: Sequence[str] = INFRA,
) -> DataFrame:
    """Conditional effects from scores per pattern; ``elements`` are those that the patterns switch."""
    item = F.explode(F.array(*[
        F.struct(
            F.lit(h).alias("hazard"), F.lit(p).alias("measure"), F.lit(list(elements).index(p)).alias("position"),
            F.col(f"_was.{h}").alias("carried"), F.col(f"_was.{p}").alias("flag"),
        )
        for h, p in pairs(hazards, measures)
    ]))
    carried = F.col("item.carried") == 1
    rows = F.sum(F.when(carried & (F.col("_switch") == _AS_IT_IS), F.col("n")).otherwise(0))
    total = F.sum(F.when(carried, _signed_score(F.col("item.position"), F.col("item.flag"))))
    return (
        patterns.withColumn("item", item).groupBy("item.hazard", "item.measure")
        .agg(rows.alias("n"), total.alias("_total"))
        .withColumn("delta", F.when(F.col("n") >= min_rows, F.try_divide(F.col("_total"), F.col("n").cast("double"))))
        .drop("_total")
    )


def raw_conditional_effects(
    df: DataFrame, min_rows: int, hazards: Sequence[str] = INFRA, measures: Sequence[str] = DEPLOYABLE
) -> DataFrame:
    """Observed mean severity with minus without a measure among rows that carry a hazard.

    ``n`` is the size of the smaller arm; below ``min_rows`` the effect is unknown.
    """
    item = F.explode(F.array(*[
        F.struct(
            F.lit(h).alias("hazard"), F.lit(p).alias("measure"), F.col(h).alias("carried"), F.col(p).alias("flag")
        )
        for h, p in pairs(hazards, measures)
    ]))

    def arm(flag: int, total: str) -> Column:
        inside = (F.col("item.carried") == 1) & (F.col("item.flag") == flag)
        return F.sum(F.when(inside, F.col(total)).otherwise(0))

    arms = flag_patterns(df).select("n", "charge", item.alias("item")).groupBy("item.hazard", "item.measure").agg(
        arm(0, "n").alias("n0"), arm(0, "charge").alias("c0"), arm(1, "n").alias("n1"), arm(1, "charge").alias("c1"),
    )
    change = F.try_divide(F.col("c1").cast("double"), F.col("n1").cast("double")) - F.try_divide(
        F.col("c0").cast("double"), F.col("n0").cast("double")
    )
    smaller = F.least("n0", "n1")
    return arms.select("hazard", "measure", smaller.alias("n"), F.when(smaller >= min_rows, change).alias("delta"))


def pair_concordance(adjusted: DataFrame, raw: DataFrame) -> DataFrame:
    """Do model and data agree on the direction of each conditional effect?"""
    # Both sides have one row per (hazard, measure) of the fixed lists.
    observed = raw.select("hazard", "measure", F.col("delta").alias("raw_delta"))
    same = (F.col("delta") < 0) == (F.col("raw_delta") < 0)
    return (
        adjusted.where(F.col("delta").isNotNull()).select("hazard", "measure", "delta")
        .join(F.broadcast(observed), ["hazard", "measure"], "left")
        .withColumn("agrees", F.when(F.coalesce(same, F.lit(False)), "✓").otherwise("—"))
    )


def concordance(odds: DataFrame, effects: DataFrame) -> DataFrame:
    """Do odds ratio and adjusted effect point the same way? One row per element, also of those without odds."""
    joined = effects.select("element", "delta").join(
        F.broadcast(odds.select("element", "odds_ratio")), "element", "left"
    )
    same = (F.col("odds_ratio") > 1) == (F.col("delta") > 0)
    return joined.withColumn("agrees", F.when(F.coalesce(same, F.lit(False)), "✓").otherwise("✗"))


def _odds_rows(train: DataFrame, elements: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Encoded rows of an unweighted regression, kept, and the elements that vary; ``train`` itself is released.

    A column that never varies is left out, as it has no ratio.
    """
    candidates = [*elements, *NUMERIC_CONTROLS]
    span = train.agg(*[(F.max(c) - F.min(c)).alias(c) for c in candidates]).first()
    varying, numeric = ([c for c in group if span[c]] for group in (elements, NUMERIC_CONTROLS))
    encoder = Encoder.fit(train, numeric, min_rows=1, drop_first=True)
    # The reweighted fits read the encoded rows once per iteration.
    times = F.col(ROWS) if ROWS in train.columns else F.lit(1)
    encoded = encoder.spread(encoder.transform(train), varying)
    rows = encoded.select("features", TARGET, times.cast("double").alias("weight")).persist()
    rows.count()
    train.unpersist()
    return rows, varying


def odds_ratios(train: DataFrame, elements: Sequence[str] = INFRA) -> DataFrame:
    """Adjusted odds ratio of each element with its 95 % interval, on all training rows.

    Unweighted and without a penalty, so ratios diverge where columns separate
    the classes. Once the encoded rows are kept, ``train`` itself is released.
    """
    spark = train.sparkSession
    rows, varying = _odds_rows(train, elements)
    try:
        model = GeneralizedLinearRegression(
            family="binomial", link="logit", labelCol=TARGET, weightCol="weight", maxIter=25, tol=1e-6
        ).fit(rows)
        errors = model.summary.coefficientStandardErrors
    finally:
        rows.unpersist()
    betas = model.coefficients.toArray()
    found = [(e, float(betas[i]), float(errors[i])) for i, e in enumerate(varying)]
    table = spark.createDataFrame(found, "element string, beta double, error double")
    half = F.col("error") * NORMAL_95
    return table.select(
        "element", F.exp("beta").alias("odds_ratio"),
        F.exp(F.col("beta") - half).alias("lo"), F.exp(F.col("beta") + half).alias("hi"),
    ).orderBy("odds_ratio")


def penalised_odds_ratios(train: DataFrame, elements: Sequence[str] = INFRA) -> DataFrame:
    """As ``odds_ratios``, with the bias-reducing penalty: finite also where columns separate the classes."""
    spark = train.sparkSession
    rows, varying = _odds_rows(train, elements)
    x = F.concat(F.array(F.lit(1.0)), vector_to_array("features"))
    known = rows.where(F.col(TARGET).isNotNull())
    table = known.select(x.alias("x"), F.col("weight").alias("n"), (F.col(TARGET) * F.col("weight")).alias("y"))
    try:
        fitted = penalised.fit(table)
    finally:
        rows.unpersist()
    return penalised.table_of(spark, varying, fitted, NORMAL_95).orderBy("odds_ratio")


def linear_attribution(
    df: DataFrame, background: DataFrame, coefficients: Mapping[str, float], top: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Shapley values of a linear score: signed mean, mean size and direction per feature, or of the ``top`` ones.

    ``weight`` names a column that says how many rows a row stands for.

    For independent features the value is the weight times the distance to the
    background mean, in log-odds, exact for every row.
    """
    names = list(coefficients)

    def mean(value: Column) -> Column:
        return F.avg(value) if weight is None else F.sum(value * F.col(weight)) / F.sum(weight)

    means = background.agg(*[mean(F.col(n)).alias(n) for n in names])
    parts = {n: (F.col(n) - F.col(f"_means.{n}")) * float(coefficients[n]) for n in names}
    summary = with_row(df, means, "_means").agg(*[
        F.struct(mean(v).alias("signed"), mean(F.abs(v)).alias("size")).alias(n) for n, v in parts.items()
    ])
    values = (
        long_format(summary, names, "feature", "v")
        .select("feature", F.col("v.signed").alias("mean_signed"), F.col("v.size").alias("mean_abs"))
        .withColumn(
            "direction",
            F.when(F.col("mean_signed") > 0, "aggravating").when(F.col("mean_signed") < 0, "protective"),
        )
        .orderBy(F.desc("mean_abs"), "feature")
    )
    return values if top is None else values.limit(top)


def importance_ranks(values: DataFrame) -> DataFrame:
    """Rank of each element within each method, equal values sharing the mean rank."""
    # A method has one row per element.
    by_value = Window.partitionBy("method").orderBy(F.desc("value"))
    ties = Window.partitionBy("method", "value")
    return values.withColumn("rank", F.rank().over(by_value) + (F.count("*").over(ties) - 1) / 2.0)


def rank_convergence(ranks: DataFrame, methods: Sequence[str]) -> DataFrame:
    """Spearman correlation between methods over the elements: (method_a, method_b, rho)."""
    wide = ranks.groupBy("element").pivot("method", list(methods)).agg(F.first("rank"))
    combos = [(a, b) for i, a in enumerate(methods) for b in methods[i + 1:]]
    cells = [
        F.struct(
            F.lit(a).alias("method_a"), F.lit(b).alias("method_b"),
            F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias("rho"),
        )
        for a, b in combos
    ]
    return wide.agg(F.array(*cells).alias("all")).select(F.inline("all"))


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)
