"""Quality of a severity score against the observed outcome.

Input rows have ``score`` and ``label`` (0 or 1). Curves are built on distinct
scores: rows are counted per score before anything is ordered, so equal scores
are treated alike and cost one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asphalt.operators.features import ROWS, row_count
from asphalt.operators.ordering import running_totals
from asphalt.session import materialise


def kept_scores(scored: DataFrame) -> DataFrame:
    """Scores and labels computed once, for figures that each read them."""
    return materialise(scored.select("score", "label"))


def score_table(scored: DataFrame) -> DataFrame:
    """One row per distinct score, best first, with running positives and rows; ``scored`` may be collapsed."""
    label = F.col("label") * F.col(ROWS) if ROWS in scored.columns else F.col("label")
    counts = scored.groupBy("score").agg(
        F.sum(label).cast("long").alias("pos"), row_count(scored).alias("rows")
    )
    return running_totals(counts, [F.desc("score")], {"pos": F.col("pos"), "rows": F.col("rows")})


def _average_precision() -> Column:
    step = F.try_divide(F.col("pos").cast("double"), F.col("all_pos").cast("double"))
    return F.sum(step * F.col("cum_pos") / F.col("cum_rows"))


def _roc_auc() -> Column:
    negatives = (F.col("rows") - F.col("pos")).cast("double")
    all_negatives = (F.col("all_rows") - F.col("all_pos")).cast("double")
    beaten_by = F.col("cum_pos") - F.col("pos") / 2.0
    return F.sum(F.try_divide(negatives * beaten_by, F.col("all_pos") * all_negatives))


def average_precision(scored: DataFrame) -> DataFrame:
    """Step-wise area under the precision-recall curve."""
    return score_table(scored).agg(_average_precision().alias("pr_auc"))


def roc_auc(scored: DataFrame) -> DataFrame:
    return score_table(scored).agg(_roc_auc().alias("roc_auc"))


def pr_curve(scored: DataFrame) -> DataFrame:
    """Precision and recall at every threshold, closed by the point (1, 0)."""
    points = score_table(scored).select(
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / F.col("cum_rows")).alias("precision"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("all_pos").cast("double")).alias("recall"),
    )
    end = points.agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def gain_curve(scored: DataFrame) -> DataFrame:
    """Share of severe accidents captured against share of accidents targeted."""
    return score_table(scored).select(
        "score",
        (F.col("cum_rows") / F.col("all_rows")).alias("targeted"),
        (F.col("cum_pos") / F.greatest("all_pos", F.lit(1))).alias("captured"),
    )


def capture_at(scored: DataFrame, fractions: Sequence[float] = (0.1, 0.2)) -> DataFrame:
    """Captured share when the first ``fraction`` of the rows is targeted.

    When the cut falls among equal scores they count in proportion.
    """
    table = score_table(scored)
    points = []
    for fraction in fractions:
        cut = F.floor(F.col("all_rows") * fraction)
        taken = F.greatest(F.lit(0), F.least("rows", cut - (F.col("cum_rows") - F.col("rows"))))
        share = F.sum(F.col("pos") * taken / F.col("rows")) / F.greatest(F.max("all_pos"), F.lit(1))
        points.append(F.struct(F.lit(float(fraction)).alias("targeted"), share.alias("captured")))
    return (
        table.agg(F.array(*points).alias("points")).select(F.inline("points"))
        .withColumn("versus_chance", F.col("captured") / F.col("targeted"))
    )


def confusion(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Confusion counts at a threshold with the rates read from them."""
    return threshold_sweep(scored, [threshold])


def threshold_sweep(scored: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Confusion counts and rates at several thresholds in one scan."""

    def counts(threshold: float) -> Column:
        hit, true = F.col("score") >= threshold, F.col("label") == 1
        return F.struct(
            F.lit(float(threshold)).alias("threshold"),
            F.count_if(~hit & ~true).alias("tn"), F.count_if(hit & ~true).alias("fp"),
            F.count_if(~hit & true).alias("fn"), F.count_if(hit & true).alias("tp"),
        )

    at_least_one = F.lit(1)
    counted = scored.agg(F.array(*[counts(t) for t in thresholds]).alias("points")).select(F.inline("points"))
    return (
        counted
        .withColumn("recall", F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), at_least_one))
        .withColumn("precision", F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), at_least_one))
        .withColumn("f1", F.col("tp") * 2.0 / F.greatest(F.col("tp") * 2 + F.col("fp") + F.col("fn"), at_least_one))
        .withColumn("base_rate", (F.col("tp") + F.col("fn")) / F.greatest(
            F.col("tp") + F.col("fn") + F.col("tn") + F.col("fp"), at_least_one))
        .withColumn("lift", F.col("precision") / F.greatest("base_rate", F.lit(1e-9)))
    )


def evaluate(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """All headline figures of a score in one row; ``scored`` may be collapsed."""
    hit = F.col("score") >= threshold
    tp, flagged = F.sum(F.when(hit, F.col("pos")).otherwise(0)), F.sum(F.when(hit, F.col("rows")).otherwise(0))
    return score_table(scored).agg(
        F.max("all_rows").alias("n"),
        (F.max("all_pos") / F.max("all_rows")).alias("baseline"),
        _average_precision().alias("pr_auc"), _roc_auc().alias("roc_auc"),
        (tp * 2.0 / F.greatest(flagged + F.max("all_pos"), F.lit(1))).alias("f1"),
        (tp / F.greatest(F.max("all_pos"), F.lit(1))).alias("recall"),
    )


def reliability(evaluated: DataFrame, low_below: float = 1.3) -> DataFrame:
    """How far a score is above the floor, and whether that is too little to act on."""
    ratio = F.try_divide(F.col("pr_auc"), F.col("baseline"))
    return evaluated.withColumn("ratio", ratio).withColumn("low_signal", F.col("ratio") < low_below)
