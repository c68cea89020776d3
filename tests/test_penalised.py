import numpy as np
import pytest
from pyspark.sql import functions as F

from asphalt.operators import penalised


def plain(x, y):
    """Newton steps of the penalised likelihood, row by row; half steps where it would fall."""
    x = np.column_stack([np.ones(len(x)), x]).astype(float)

    def parts(beta):
        p = 1 / (1 + np.exp(-x @ beta))
        w = p * (1 - p)
        information = x.T @ (x * w[:, None])
        height = np.sum(y * np.log(p) + (1 - y) * np.log(1 - p)) + np.linalg.slogdet(information)[1] / 2
        return p, w, information, height

    beta = np.zeros(x.shape[1])
    for _ in range(200):
        p, w, information, height = parts(beta)
        inverse = np.linalg.inv(information)
        h = w * np.einsum("ij,jk,ik->i", x, inverse, x)
        step = inverse @ (x.T @ (y - p + h * (0.5 - p)))
        while parts(beta + step)[3] < height - 1e-10 and np.abs(step).max() > 1e-12:
            step = step / 2
        beta = beta + step
    return beta, np.sqrt(np.diag(np.linalg.inv(parts(beta)[2])))


def table(spark, x, y):
    rows = [(*map(float, r), int(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(x.shape[1])) + ", y int")


@pytest.mark.parametrize("separated", [False, True])
def test_ratios_match_newton(spark, separated):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 2, (150, 2)), rng.normal(0, 1, 150).round(1)])
    y = (rng.random(150) < 1 / (1 + np.exp(0.4 - 1.2 * x[:, 0] + 0.8 * x[:, 2]))).astype(int)
    if separated:
        y = np.where(x[:, 1] == 1, 1, y)
    beta, errors = plain(x, y)
    columns = ["x0", "x1", "x2"]
    found = {r["element"]: r for r in penalised.ratios(table(spark, x, y).repartition(5), columns, "y").collect()}
    for i, c in enumerate(columns, start=1):
        assert found[c]["odds_ratio"] == pytest.approx(np.exp(beta[i]), rel=1e-5)
        assert found[c]["lo"] == pytest.approx(np.exp(beta[i] - 1.959964 * errors[i]), rel=1e-5)
        assert found[c]["hi"] == pytest.approx(np.exp(beta[i] + 1.959964 * errors[i]), rel=1e-5)
    assert all(np.isfinite(r["hi"]) and r["lo"] > 0 for r in found.values())
    if separated:
        assert found["x1"]["odds_ratio"] > 20


def test_one_flag_has_the_closed_form(spark):
    """With one flag the penalty adds half a row to each of the four cells."""
    rows = [(1.0, 1)] * 7 + [(1.0, 0)] * 0 + [(0.0, 1)] * 5 + [(0.0, 0)] * 12 + [(0.0, None), (1.0, None)]
    df = spark.createDataFrame(rows, "x0 double, y int")
    got = penalised.ratios(df, ["x0"], "y").first()["odds_ratio"]
    assert got == pytest.approx((7.5 / 0.5) / (5.5 / 12.5), rel=1e-6)


def test_missing_values_and_refusals(spark):
    df = spark.createDataFrame([(None, 1), (0.0, 0), (1.0, 1), (1.0, 0)] * 3, "x0 double, y int")
    zero = penalised.ratios(df.na.fill(0.0), ["x0"], "y").collect()
    assert penalised.ratios(df, ["x0"], "y").collect() == zero
    with pytest.raises(ValueError, match="no rows"):
        penalised.ratios(df.limit(0), ["x0"], "y")
    with pytest.raises(ValueError, match="depend linearly"):
        penalised.ratios(df.na.fill(0.0).withColumn("x1", F.col("x0")), ["x0", "x1"], "y")


def test_passes_read_kept_blocks_without_a_shuffle(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, (3000, 6))
    rows = table(spark, x, rng.integers(0, 2, 3000)).repartition(5)
    found = penalised.patterns(rows, F.array(*[f"x{i}" for i in range(6)]), "y").persist()
    found.count()
    context = spark.sparkContext
    context.setJobGroup("penalised passes", "penalised passes")
    try:
        rounds = penalised.fit(found).rounds
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker().getJobIdsForGroup("penalised passes")
    assert 2 * rounds < len(jobs) <= 2 * rounds + 4  # a shuffle would be a job of its own in each pass
    found.unpersist()
