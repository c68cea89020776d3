import numpy as np
import pytest
from pyspark.sql import functions as F

from asphalt.functions.scoring import linear_predictor, logistic
from asphalt.operators import cleaning, effects, features, metrics, models, trees
from asphalt.checks import views
from asphalt.schema import INFRA, ModelChoice
from tests import frames

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark):
    df = cleaning.clean(views.load(spark, SMALL, "incidents")).persist()
    return cleaning.temporal_split(df, 2000)


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "score double, label int")


def test_average_precision_and_auc_match_numpy(spark):
    rng = np.random.default_rng(5)
    s, y = rng.integers(0, 40, 500) / 40, rng.integers(0, 2, 500)
    row = metrics.evaluate(scored(spark, [(float(a), int(b)) for a, b in zip(s, y)])).first()
    ap, seen = 0.0, 0
    for value in sorted(set(s), reverse=True):
        hits = y[s == value].sum()
        seen += hits
        ap += hits / y.sum() * seen / (s >= value).sum()
    wins = sum((p > n) + 0.5 * (p == n) for p in s[y == 1] for n in s[y == 0])
    assert row["pr_auc"] == pytest.approx(ap)
    assert row["roc_auc"] == pytest.approx(wins / (y.sum() * (1 - y).sum()))
    recall = ((s >= 0.5) & (y == 1)).sum() / y.sum()
    assert row["recall"] == pytest.approx(recall)
    confusion = metrics.confusion(scored(spark, [(float(a), int(b)) for a, b in zip(s, y)])).first()
    assert confusion["f1"] == pytest.approx(row["f1"]) and confusion["recall"] == pytest.approx(recall)


def test_constant_score_and_single_class(spark):
    row = metrics.evaluate(scored(spark, [(0.3, 1), (0.3, 0), (0.3, 0), (0.3, 0)])).first()
    assert (row["pr_auc"], row["roc_auc"], row["baseline"]) == (0.25, 0.5, 0.25)
    none = metrics.reliability(metrics.evaluate(scored(spark, [(0.3, 0), (0.4, 0)]))).first()
    assert none["pr_auc"] is None and none["roc_auc"] is None and none["recall"] == 0.0


def test_gain_is_shared_among_equal_scores(spark):
    pairs = [(0.9, 1)] * 2 + [(0.5, 1), (0.5, 0)] * 4
    rows = {r["targeted"]: r["captured"] for r in metrics.capture_at(scored(spark, pairs), [0.2, 0.6]).collect()}
    assert rows == {0.2: pytest.approx(2 / 6), 0.6: pytest.approx(4 / 6)}


def test_stratified_cap_is_exact_and_repeatable(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, "A").when(F.col("id") < 2900, "B").alias("state"))
    first = features.stratified_cap(df, 500, ["id"])
    assert {r["state"]: r["n"] for r in first.groupBy("state").agg(F.count("*").alias("n")).collect()} == {
        "A": 500, "B": 500, None: 100}
    assert first.exceptAll(features.stratified_cap(df.repartition(7), 500, ["id"])).count() == 0
    other = features.stratified_cap(df, 500, ["id"], seed=7)
    assert first.exceptAll(other).count() > 0


def test_encoder_pools_rare_and_zeroes_unseen(spark):
    rows = [("A", 1.0)] * 30 + [("B", 3.0)] * 25 + [("C", None)] * 2 + [(None, 3.0)] * 3
    df = spark.createDataFrame(rows, "c string, x double")
    encoder = features.Encoder.fit(df, ["x"], ["c"])
    assert sorted(map(tuple, encoder.labels("c").collect())) == [(0, "A"), (1, "B"), (2, "_infrequent")]
    assert encoder.sizes == {"c": 3} and encoder.columns == ["_x_x", "_k_c"]
    new = spark.createDataFrame([("A", None), ("C", None), ("Z", None), (None, None)], "c string, x double")
    rows = encoder.transform(new)
    values = [list(r["features"].toArray()) for r in encoder.spread(rows, []).collect()]
    assert [v[1:] for v in values] == [[1, 0, 0], [0, 0, 1], [0, 0, 0], [1, 0, 0]]
    assert [r["features"].toArray()[1] for r in encoder.grouped(rows, []).collect()] == [0, 2, 3, 0]
    x = np.array([1.0] * 30 + [3.0] * 28 + [1.0] * 2)
    filled = np.where(np.arange(60) < 30, 1.0, 3.0)
    median = np.median([1.0] * 30 + [3.0] * 28)
    filled[55:57] = median
    assert values[0][0] == pytest.approx((median - filled.mean()) / filled.std()) and len(x) == 60
    reference = features.Encoder.fit(df, ["x"], ["c"], min_rows=1, drop_first=True)
    assert sorted(map(tuple, reference.labels("c").collect())) == [(0, "B"), (1, "C")]


def test_encoder_takes_very_many_categories(spark):
    """A column of 200,000 values, half of them rare, next to one without any value."""
    df = spark.range(300_000).select(
        F.concat(F.lit("v"), F.when(F.col("id") < 200_000, F.col("id") % 100_000).otherwise(F.col("id"))).alias("c"),
        F.lit(None).cast("string").alias("nothing"), F.lit(1.0).alias("x"))
    encoder = features.Encoder.fit(df, ["x"], ["c", "nothing"], min_rows=2)
    assert encoder.sizes == {"c": 100_001, "nothing": 0} and encoder.used == ["c"]
    new = spark.createDataFrame([("v0", None), ("v99999", "y"), ("v250000", None), ("new", None), (None, None)], "c string, nothing string")
    places = {r["c"]: r["_k_c"] for r in encoder.transform(new.withColumn("x", F.lit(2.0))).collect()}
    assert places == {"v0": 0.0, "v99999": 99_999.0, "v250000": 100_000.0, "new": 100_001.0, None: 0.0}
    assert encoder.transform(df).where("_k_c = 100000").count() == 100_000


def test_zone_history_smooths_and_defaults_to_the_prior(spark):
    train = frames.accidents(spark, [{"severity": 3}] * 3 + [{"severity": 2}] * 7 + [{"start_lat": 40.0, "severity": 4}] * 2)
    rows = frames.accidents(spark, [{}, {"start_lat": 60.0}])
    found = {r["start_lat"]: r for r in features.zone_history(rows, train).collect()}
    prior = 5 / 12
    assert found[34.0]["zone_hist7"] == pytest.approx((3 + prior * 30) / 40) and found[34.0]["zone_hist7_n"] == 10
    assert found[60.0]["zone_hist5"] == pytest.approx(prior) and found[60.0]["zone_hist5_n"] == 0


def test_choices_are_checked():
    with pytest.raises(ValueError, match="unknown algorithm"):
        models.check_choice("svm", {})
    with pytest.raises(ValueError, match="max_iter"):
        models.check_choice("logistic", {"max_iter": 5})
    assert models.check_choice("tree", {"max_depth": 3}) == {"max_depth": 3}


def test_models_beat_the_floor_and_effects_have_the_planted_signs(spark, parts):
    train, test = parts
    table, fitted = models.compare(train, test, {
        "floor": ModelChoice("dummy"), "logistic": ModelChoice("logistic"),
        "boosting": ModelChoice("hist_gradient_boosting", {"max_iter": 5}),
    })
    rows = {r["model"]: r for r in table.collect()}
    assert rows["floor"]["pr_auc"] == pytest.approx(rows["floor"]["baseline"])
    assert all(rows[m]["pr_auc"] > 1.3 * rows["floor"]["pr_auc"] for m in ("logistic", "boosting"))
    assert sum(r["best"] for r in rows.values()) == 1 and not rows["floor"]["best"]
    for name in ("logistic", "boosting"):
        model = fitted[name]
        found = {r["element"]: r["delta"] for r in effects.adjusted_effects(model.prepare(test), model.score).collect()}
        assert found["junction"] > 0.02 and found["traffic_signal"] < -0.02


def test_place_history_and_local_scope(spark, parts):
    df = parts[0].unionByName(parts[1])
    choice = ModelChoice("logistic", place_history=True)
    train, test = models.split_for(df, choice, 2000, None)
    assert "zone_hist7" in train.columns and train.count() == parts[0].count()
    local = models.split_for(df, ModelChoice(scope="territoire"), 2000, "S3")[0]
    assert {r[0] for r in local.select("state").distinct().collect()} == {"S3"}
    whole = models.split_for(df, ModelChoice(), 2000, None)[1]
    train, test = models.split_for(df, ModelChoice(max_rows=400), 2000, None)
    assert train.count() < 600 and test.count() == whole.count()
    assert train.exceptAll(models.split_for(df.repartition(5), ModelChoice(max_rows=400), 2000, None)[0]).count() == 0


def test_a_cap_leaves_effects_on_all_test_rows(spark, parts):
    df = parts[0].unionByName(parts[1])
    counts = []
    for cap in (None, 300):
        train, test = models.split_for(df, ModelChoice("logistic", max_rows=cap), 2000, None)
        model = models.fit(models.training_rows(train), ModelChoice("logistic"))
        found = effects.conditional_effects(model.prepare(test), model.score, 20)
        counts.append({(r["hazard"], r["measure"]): r["n"] for r in found.collect()})
    assert counts[0] == counts[1]


def test_effects_match_brute_force(spark, parts):
    weights = {"junction": 0.8, "traffic_signal": -0.7, "stop": -0.3, "wind_speed_mph": 0.03}
    scorer = lambda d: d.withColumn("score", logistic(linear_predictor(-1.5, weights)))
    test = parts[1]
    data = test.select(*INFRA, "wind_speed_mph").toPandas()

    def p(frame):
        return 1 / (1 + np.exp(-(-1.5 + sum(frame[c] * w for c, w in weights.items()))))

    found = {(r["hazard"], r["measure"]): r for r in effects.conditional_effects(test, scorer, 20).collect()}
    assert len(found) == 44
    for (hazard, measure), row in found.items():
        part = data[data[hazard] == 1]
        assert row["n"] == len(part)
        if len(part) < 20:
            assert row["delta"] is None
        else:
            delta = (p(part.assign(**{measure: 1})) - p(part.assign(**{measure: 0}))).mean()
            assert row["delta"] == pytest.approx(delta, abs=1e-9)


def test_odds_ratios_match_newton(spark):
    rng = np.random.default_rng(11)
    n = 1500
    flags = rng.integers(0, 2, (n, 3))
    humidity, states = rng.normal(50, 10, n), rng.choice(["A", "B", "C"], n)
    z = -0.5 + 0.9 * flags[:, 0] - 0.7 * flags[:, 1] + 0.02 * (humidity - 50)
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    rows = [(*map(int, f), float(h), str(s), int(t)) for f, h, s, t in zip(flags, humidity, states, y)]
    df = spark.createDataFrame(rows, "junction int, stop int, bump int, humidity_pct double, state string, grave int")
    rest = [c for c in ("temperature_f", "visibility_mi", "wind_speed_mph", "pressure_in", "hour", "dow", "month")]
    df = df.withColumns({**{c: F.lit(1.0) for c in rest}, "weather_bucket": F.lit("Clear"), "is_night": F.lit(0),
                         "year": F.lit(2020), "amenity": F.lit(0)})
    found = {r["element"]: r for r in effects.odds_ratios(df, ["junction", "stop", "bump", "amenity"]).collect()}
    assert "amenity" not in found
    x = np.column_stack([np.ones(n), flags, (humidity - humidity.mean()) / humidity.std(), states == "B", states == "C"]).astype(float)
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        mu = 1 / (1 + np.exp(-x @ beta))
        information = x.T @ (x * (mu * (1 - mu))[:, None])
        beta += np.linalg.solve(information, x.T @ (y - mu))
    error = np.sqrt(np.diag(np.linalg.inv(information)))
    for i, name in enumerate(["junction", "stop", "bump"], start=1):
        assert found[name]["odds_ratio"] == pytest.approx(np.exp(beta[i]), rel=1e-4)
        assert found[name]["lo"] == pytest.approx(np.exp(beta[i] - 1.959964 * error[i]), rel=1e-3)
        assert found[name]["hi"] == pytest.approx(np.exp(beta[i] + 1.959964 * error[i]), rel=1e-3)


def test_concordance_and_convergence(spark):
    odds = spark.createDataFrame([("a", 1.2), ("b", 0.8), ("c", 1.1)], "element string, odds_ratio double")
    deltas = spark.createDataFrame([("a", 0.1), ("b", 0.2)], "element string, delta double")
    deltas = deltas.unionByName(spark.createDataFrame([("d", -0.1)], deltas.schema))
    found = {r["element"]: (r["agrees"], r["odds_ratio"]) for r in effects.concordance(odds, deltas).collect()}
    assert found == {"a": ("✓", 1.2), "b": ("✗", 0.8), "d": ("✗", None)}
    values = [(m, e, float(v)) for m, vs in (("x", (3, 2, 1)), ("y", (30, 20, 10)), ("z", (1, 1, 5)))
              for e, v in zip("abc", vs)]
    ranks = effects.importance_ranks(spark.createDataFrame(values, "method string, element string, value double"))
    assert {r["element"]: r["rank"] for r in ranks.where("method = 'z'").collect()} == {"a": 2.5, "b": 2.5, "c": 1.0}
    rho = {(r["method_a"], r["method_b"]): r["rho"] for r in effects.rank_convergence(ranks, ["x", "y", "z"]).collect()}
    assert rho[("x", "y")] == pytest.approx(1.0) and rho[("x", "z")] < 0


def test_collapsed_rows_fit_as_the_rows_they_stand_for(spark, parts):
    """Four copies of the training rows make no more rows for a fit, and the same model as one row each."""
    train = parts[0].limit(600).persist()
    copies = train.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(4)))).drop("copy")
    rows = models.training_rows(copies)
    assert rows.count() == train.select(*rows.drop("_rows").columns).distinct().count() < 2400
    assert features.expanded(rows).count() == 2400
    plain, packed = features.Encoder.fit(copies, min_rows=4), features.Encoder.fit(rows, min_rows=4)
    assert packed.fills == plain.fills and packed.sizes == plain.sizes and packed.modes == plain.modes
    assert [packed.means[c] for c in plain.numeric] == pytest.approx([plain.means[c] for c in plain.numeric])
    assert [packed.deviations[c] for c in plain.numeric] == pytest.approx([plain.deviations[c] for c in plain.numeric])
    weights = [{r["grave"]: (r["n"], r["weight"]) for r in features.class_weights(d).collect()} for d in (copies, rows)]
    assert weights[0] == weights[1]
    choice = ModelChoice("logistic")
    a, b = (models.fit(d, choice, plain).classifier.coefficients.toArray() for d in (copies, rows))
    assert a == pytest.approx(b, abs=1e-3)
    model = models.fit(rows, ModelChoice("tree"), plain)
    effects_of = [
        {r["element"]: r["delta"] for r in effects.adjusted_effects(model.prepare(d), model.score).collect()} for d in (copies, rows)]
    assert effects_of[0] == pytest.approx(effects_of[1])


def test_rows_that_stand_for_very_many_are_not_expanded(spark, parts):
    """Every row a billion times: a fit that read each copy would not end."""
    rows = models.training_rows(parts[0]).withColumn("_rows", F.col("_rows") * F.lit(10**9))
    model = models.fit(rows, ModelChoice("random_forest", {"n_estimators": 4, "max_depth": 6}))
    row = metrics.evaluate(models.scored_rows(model, parts[1])).first()
    assert row["pr_auc"] > 2 * row["baseline"]


def test_forest_is_as_that_of_spark_ml_on_every_row(spark, parts):
    """Draws differ, so scores agree on average and in what they order first."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import vector_to_array

    copies = parts[0].withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("copy")
    rows = models.training_rows(copies)
    model = models.fit(rows, ModelChoice("random_forest", {"n_estimators": 40}))
    encoder, weights = model.encoder, {r["grave"]: r["weight"] for r in features.class_weights(rows).collect()}
    plain = features.expanded(rows).withColumn("weight", F.when(F.col("grave") == 1, weights[1]).otherwise(weights[0]))
    theirs = RandomForestClassifier(
        seed=1, maxBins=255, numTrees=40, maxDepth=18, minInstancesPerNode=20, labelCol="grave", weightCol="weight",
    ).fit(encoder.grouped(encoder.transform(plain)))
    found = [
        model.score(model.prepare(parts[1])).select("score").toPandas()["score"],
        theirs.transform(encoder.grouped(encoder.transform(parts[1]))).select(
            vector_to_array("probability")[1].alias("score")).toPandas()["score"]]
    assert np.corrcoef(found[0].to_numpy(), found[1].to_numpy())[0, 1] > 0.98
    assert model.classifier.importances == pytest.approx(theirs.featureImportances.toArray(), abs=0.06)


def test_collapsed_scores_are_measured_as_the_rows_they_stand_for(spark):
    rows = spark.createDataFrame([(0.9, 1, 3), (0.9, 0, 1), (0.6, 0, 2), (0.4, 1, 5), (0.1, 0, 9)], "score double, label int, _rows long")
    assert metrics.evaluate(rows).collect() == metrics.evaluate(features.expanded(rows)).collect()


def test_model_queries_join_the_raw_tables_once(spark):
    """What is left to read when a query returns comes from its own rows, not from the tables again."""
    from asphalt.checks.queries import QUERIES

    plan = QUERIES["fit_invariants"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "parquet" not in plan


def test_place_history_joins_the_raw_tables_once(spark, monkeypatch):
    from asphalt.checks import queries

    read = []
    split_for = models.split_for
    monkeypatch.setattr(queries.models, "split_for", lambda df, *rest: read.append(df) or split_for(df, *rest))
    assert queries.QUERIES["fit_with_history"](spark, SMALL).count() == 1
    assert "Join" not in read[0]._jdf.queryExecution().optimizedPlan().toString()


def test_trees_grown_in_turns_are_those_grown_at_once(spark, parts, monkeypatch):
    """What a task holds of the rows drawn is bounded, whatever the number of trees."""
    rows = models.training_rows(parts[0])
    encoder = features.Encoder.fit(rows)
    choice = ModelChoice("random_forest", {"n_estimators": 5, "max_depth": 4})
    whole = models.fit(rows, choice, encoder).classifier
    turns = []
    grown = trees._grown
    monkeypatch.setattr(trees, "_grown", lambda *a: turns.append(a[4]) or grown(*a))
    monkeypatch.setattr(trees, "HELD", trees.DRAWN_BYTES)
    split = models.fit(rows, choice, encoder).classifier
    assert len(turns) == 5 and sorted(t for turn in turns for t in turn) == list(range(5))
    assert split.importances.tolist() == whole.importances.tolist()
    assert [t.value.tolist() for t in split.trees] == [t.value.tolist() for t in whole.trees]
