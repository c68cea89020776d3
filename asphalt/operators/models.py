"""Severity classifiers: Spark ML's, and forests on collapsed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asphalt.operators import trees
from asphalt.operators.features import (
    ROWS, Encoder, capped_sample, class_weights, collapsed, expanded, history_columns, zone_history,
)
from asphalt.operators.metrics import evaluate
from asphalt.schema import FEATURES, INFRA, NUMERIC_CONTROLS, TARGET, ModelChoice
from asphalt.session import materialise

# Algorithm names of the run file, the hyper-parameters each takes
# there with the Spark name, and the published defaults.
ALGORITHMS = {
    "dummy": ({}, {}),
    "logistic": ({"C": "C"}, {"C": 1.0}),
    "tree": ({"max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode"}, {"max_depth": 6}),
    "random_forest": (
        {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode"},
        {"n_estimators": 200, "max_depth": 18, "min_samples_leaf": 20},
    ),
    "hist_gradient_boosting": (
        {"max_iter": "maxIter", "learning_rate": "stepSize", "max_depth": "maxDepth"},
        {"max_iter": 300, "learning_rate": 0.1, "max_depth": 5},
    ),
}
FLOOR = "dummy"
LINEAR = "logistic"
FOREST = "random_forest"
# Distinct rows of a partition of the training table: fits don't depend on the number of cores.
FIT_ROWS = 50_000


def check_choice(algorithm: str, params: Mapping) -> dict:
    """Hyper-parameters with defaults filled in; unknown names are refused."""
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm!r}, choose one of {sorted(ALGORITHMS)}")
    names, defaults = ALGORITHMS[algorithm]
    unknown = sorted(set(params) - set(names))
    if unknown:
        raise ValueError(f"{algorithm} has no hyper-parameters {unknown}, only {sorted(names)}")
    return {**defaults, **params}


def make_classifier(algorithm: str, params: Mapping, total_weight: float, seed: int, categories: int = 1):
    """Estimator of an algorithm; ``total_weight`` turns C into a regularisation per row."""
    chosen = check_choice(algorithm, params)
    columns = {"featuresCol": "features", "labelCol": TARGET, "weightCol": "weight"}
    if algorithm == LINEAR:
        return LogisticRegression(
            maxIter=2000, tol=1e-6, regParam=1.0 / (chosen["C"] * total_weight), standardization=False, **columns
        )
    spark_names = ALGORITHMS[algorithm][0]
    settings = {spark_names[name]: value for name, value in chosen.items()}
    kind = {"tree": DecisionTreeClassifier, "hist_gradient_boosting": GBTClassifier}[algorithm]
    return kind(seed=seed, maxBins=max(255, categories), maxMemoryInMB=1024, **settings, **columns)


@dataclass(frozen=True)
class SeverityModel:
    """A fitted classifier with the encoding it was trained on."""

    algorithm: str
    encoder: Encoder
    classifier: object | None
    prior: float

    def prepare(self, df: DataFrame) -> DataFrame:
        """Encode the controls; flags can still be changed before ``score``."""
        return self.encoder.transform(df)

    def score(self, prepared: DataFrame) -> DataFrame:
        if self.classifier is None:
            return prepared.withColumn("score", F.lit(self.prior))
        if self.algorithm == FOREST:
            return prepared.withColumn("score", self.classifier.score()).drop(*self.encoder.columns)
        scored = self.classifier.transform(_features(self.algorithm, self.encoder, prepared))
        return scored.withColumn("score", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction"
        )


def _features(algorithm: str, encoder: Encoder, df: DataFrame) -> DataFrame:
    return encoder.spread(df) if algorithm == LINEAR else encoder.grouped(df)


def training_rows(train: DataFrame, place_history: bool = False) -> DataFrame:
    """The columns a fit needs, collapsed, spread evenly and kept: a fit reads them many times.

    A fit weighs a row by the rows it stands for, so its work grows with the
    distinct rows. The number of partitions follows from their number.
    """
    columns = [*FEATURES, *(history_columns() if place_history else []), TARGET]
    return spread_evenly(_collapsed_over(train, columns)).persist()


def _collapsed_over(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows collapsed over some columns and computed once; a table that is so by now stays as it is."""
    counted = [ROWS] if ROWS in df.columns else []
    if counted and {*df.columns} == {*columns, ROWS}:
        return df
    return materialise(collapsed(df.select(*columns, *counted)))


def spread_evenly(rows: DataFrame) -> DataFrame:
    """A computed table in partitions of about ``FIT_ROWS`` rows, whatever the number of cores."""
    partitions = max(8, -(-rows.count() // FIT_ROWS))
    return rows.repartition(partitions, F.xxhash64(*rows.columns))


def fit(train: DataFrame, choice: ModelChoice, encoder: Encoder | None = None) -> SeverityModel:
    """Fit one algorithm; ``train`` is best given as ``training_rows``."""
    check_choice(choice.algorithm, choice.params)
    encoder = encoder or Encoder.fit(train, numeric_features(choice))
    weights = {r[TARGET]: (r["n"], r["weight"]) for r in class_weights(train).collect()}
    rows = sum(n for n, _ in weights.values())
    prior = weights.get(1, (0, 0.0))[0] / rows
    if choice.algorithm == FLOOR:
        return SeverityModel(FLOOR, encoder, None, prior)
    if choice.algorithm == FOREST:
        return SeverityModel(choice.algorithm, encoder, _forest(train, choice, encoder, weights), prior)
    weight = F.lit(1.0)
    if choice.balanced:
        for label, (_, w) in weights.items():
            weight = F.when(F.col(TARGET) == label, w).otherwise(weight)
    if ROWS in train.columns and _counts_rows(choice):
        train = spread_evenly(expanded(train))
    if ROWS in train.columns:
        weight = weight * F.col(ROWS)
    # Both weightings add up to the number of rows.
    classifier = make_classifier(choice.algorithm, choice.params, rows, choice.seed, encoder.largest)
    encoded = _features(choice.algorithm, encoder, encoder.transform(train.withColumn("weight", weight)))
    return SeverityModel(choice.algorithm, encoder, classifier.fit(encoded.select("features", TARGET, "weight")), prior)


def _forest(train: DataFrame, choice: ModelChoice, encoder: Encoder, weights: Mapping) -> trees.Ensemble:
    """A forest; rows that stand for several are neither expanded nor drawn as one."""
    chosen = check_choice(choice.algorithm, choice.params)
    columns = [*INFRA, *encoder.columns]
    nominal = {f"_k_{c}": encoder.sizes[c] + 1 for c in encoder.used}
    if ROWS not in train.columns:
        train = train.withColumn(ROWS, F.lit(1))
    class_weight = [weights.get(label, (0, 1.0))[1] if choice.balanced else 1.0 for label in (0, 1)]
    blocks, bins = trees.blocks_of(encoder.transform(train), columns, TARGET, ROWS, nominal)
    try:
        return trees.forest(
            blocks, bins, columns, class_weight, chosen["n_estimators"], chosen["max_depth"], chosen["min_samples_leaf"], choice.seed)
    finally:
        blocks.unpersist()


def _counts_rows(choice: ModelChoice) -> bool:
    """Does the algorithm count rows against the smallest leaf? Weights don't replace rows then."""
    return check_choice(choice.algorithm, choice.params).get("min_samples_leaf", 1) > 1


def numeric_features(choice: ModelChoice) -> list[str]:
    return NUMERIC_CONTROLS + (history_columns() if choice.place_history else [])


def split_for(
    df: DataFrame, choice: ModelChoice, test_from: int, state: str | None, history_weight: float = 30.0
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of a choice: scope, year cut, optional cap and place history.

    A cap bounds the rows of the fit only: metrics and effects are measured on all test rows.
    """
    scoped = df if choice.scope == "us" or state is None else df.where(F.col("state") == state)
    whole = scoped.where(F.col("year") < test_from)
    test = scoped.where(F.col("year") >= test_from)
    key = [c for c in ("id", "start_time", "start_lat", "start_lng", *FEATURES) if c in df.columns]
    train = capped_sample(whole, choice.max_rows, key, choice.seed)
    if choice.place_history:
        # History is learnt on all earlier rows, also those a cap leaves out.
        train = zone_history(train, whole, weight=history_weight)
        test = zone_history(test, whole, weight=history_weight)
    return train, test


def scored_rows(model: SeverityModel, df: DataFrame) -> DataFrame:
    """Score and label of every row; equal rows are scored once."""
    return expanded(counted_scores(model, df))


def counted_scores(model: SeverityModel, df: DataFrame) -> DataFrame:
    """Score and label of distinct rows with their number."""
    inputs = [*INFRA, *model.encoder.numeric, *model.encoder.sizes]
    rows = spread_evenly(_collapsed_over(df, [*inputs, TARGET]))
    return _score_and_label(model, model.prepare(rows))


def _score_and_label(model: SeverityModel, prepared: DataFrame) -> DataFrame:
    return model.score(prepared).select("score", F.col(TARGET).alias("label"), ROWS)


def compare(
    train: DataFrame, test: DataFrame, choices: Mapping[str, ModelChoice]
) -> tuple[DataFrame, dict[str, SeverityModel]]:
    """Fit several algorithms on the same encoding and tabulate their quality.

    The table also has the ratio to the floor and marks the best by average
    precision, the floor left out. There is one row per algorithm.
    """
    rows = training_rows(train)
    try:
        encoder = Encoder.fit(rows)
        fitted = {name: fit(rows, choice, encoder) for name, choice in choices.items()}
    finally:
        rows.unpersist()
    # All models read the same encoded test rows; each evaluation ends in a small table.
    prepared = encoder.transform(spread_evenly(_collapsed_over(test, [*FEATURES, TARGET]))).persist()
    try:
        tables = [
            evaluate(_score_and_label(model, prepared))
            .withColumn("model", F.lit(name)).withColumn("is_floor", F.lit(model.algorithm == FLOOR))
            for name, model in fitted.items()
        ]
    finally:
        prepared.unpersist()
    table = reduce(DataFrame.unionByName, tables)
    best = table.where(~F.col("is_floor")).agg(F.max_by("model", "pr_auc").alias("best")).scalar()
    return (
        table.withColumn("vs_floor", F.try_divide(F.col("pr_auc"), F.col("baseline")))
        .withColumn("best", F.coalesce(F.col("model") == best, F.lit(False)))
        .select("model", "n", "pr_auc", "roc_auc", "f1", "recall", "baseline", "vs_floor", "best"),
        fitted,
    )


def importances(models: Mapping[str, SeverityModel], elements: Sequence[str] = INFRA) -> DataFrame:
    """Weight of each flag in each fitted model: (method, element, value)."""
    rows = []
    for method, model in models.items():
        weights = _weights(model)
        rows += [(method, e, float(weights[INFRA.index(e)])) for e in elements]  # the flags come first
    return SparkSession.active().createDataFrame(rows, "method string, element string, value double")


def _weights(model: SeverityModel) -> Sequence[float]:
    fitted = model.classifier
    if model.algorithm == FOREST:
        return fitted.importances
    if hasattr(fitted, "featureImportances"):
        return fitted.featureImportances.toArray()
    return abs(fitted.coefficients.toArray())
