import random
from itertools import combinations
from math import factorial

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from asphalt.operators.attribution import Leaf, Split, mean_score, of_classifier, splits_of, tree_attribution, tree_values


def expected_score(tree, row, known):
    """Score with the features of ``known`` as in the row and the others averaged out."""
    if isinstance(tree, Leaf):
        return tree.value
    left, right = (expected_score(t, row, known) for t in (tree.left, tree.right))
    if tree.feature not in known:
        return (tree.left.cover * left + tree.right.cover * right) / tree.cover
    x = row[tree.feature]
    goes = x is not None and (x in tree.categories if tree.at is None else x <= tree.at)
    return left if goes else right


def enumerated(tree, row):
    """Shapley values by all subsets of the tree's features."""
    names = sorted({s.feature for s in splits_of(tree)})
    values = {}
    for j in names:
        others = [n for n in names if n != j]
        values[j] = sum(
            factorial(k) * factorial(len(names) - k - 1) / factorial(len(names))
            * (expected_score(tree, row, {*s, j}) - expected_score(tree, row, set(s)))
            for k in range(len(names)) for s in combinations(others, k))
    return values


def random_tree(rng, depth):
    if depth == 0 or rng.random() < 0.15:
        return Leaf(round(rng.random(), 3), rng.randint(1, 50))
    feature = rng.choice("abcde")
    kind = {"categories": tuple(float(c) for c in rng.sample(range(4), 2))} if feature == "e" else {"at": rng.choice([0.0, 1.0, 2.0])}
    return Split(feature, random_tree(rng, depth - 1), random_tree(rng, depth - 1), **kind)


@pytest.mark.parametrize("seed,depth", [(1, 3), (2, 4), (3, 7)])
def test_values_equal_enumeration(spark, seed, depth):
    rng = random.Random(seed)
    tree = Split("a", random_tree(rng, depth - 1), random_tree(rng, depth - 1), at=1.0)
    rows = [{n: rng.choice([None, 0.0, 1.0, 2.0, 3.0]) for n in "abcde"} for _ in range(40)]
    df = spark.createDataFrame([tuple(r[n] for n in "abcde") for r in rows], "a double, b double, c double, d double, e double")
    want = [enumerated(tree, r) for r in rows]
    got = {r["feature"]: r for r in tree_attribution(df, tree).collect()}
    for name in want[0]:
        signed = sum(w[name] for w in want) / len(want)
        size = sum(abs(w[name]) for w in want) / len(want)
        assert (got[name]["mean_signed"] if name in got else 0.0) == pytest.approx(signed, abs=1e-9)
        assert (got[name]["mean_abs"] if name in got else 0.0) == pytest.approx(size, abs=1e-9)
    total = tree_values(df, tree).agg(F.sum(F.col("n") * F.col("value"))).first()[0] or 0.0
    scores = sum(expected_score(tree, r, set("abcde")) for r in rows)
    assert total == pytest.approx(scores - len(rows) * mean_score(tree))


def test_fitted_tree_adds_up_to_its_scores(spark):
    rng = random.Random(5)
    data = []
    for _ in range(600):
        a, b, c = rng.randint(0, 3), rng.random(), rng.randint(0, 1)
        data.append((float(a), b, float(c), float(rng.random() < 0.2 + 0.15 * a * c + 0.2 * (b > 0.5)), 1.0 + c))
    df = spark.createDataFrame(data, "a double, b double, c double, y double, w double")
    df = df.withMetadata("a", {"ml_attr": {"type": "nominal", "name": "a", "vals": ["0", "1", "2", "3"]}})
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = DecisionTreeClassifier(labelCol="y", weightCol="w", maxDepth=5, seed=1).fit(vectors)
    tree = of_classifier(model, ["a", "b", "c"])
    rows = [r.asDict() for r in df.collect()]
    proba = [r["probability"][1] for r in model.transform(vectors).collect()]
    assert [expected_score(tree, r, set("abc")) for r in rows] == pytest.approx(proba)
    got = {r["feature"]: r["mean_abs"] for r in tree_attribution(df, tree).collect()}
    want = [enumerated(tree, r) for r in rows]
    assert got == pytest.approx({n: sum(abs(w[n]) for w in want) / len(want) for n in want[0]})


def test_weights_top_leaf_and_empty_table(spark):
    tree = Split("a", Leaf(0.1, 3), Split("b", Leaf(0.9, 1), Leaf(0.4, 2), at=0.0), at=0.0)
    df = spark.createDataFrame([(0.0, 1.0, 2), (1.0, 0.0, 3)], "a double, b double, k long")
    repeated = df.select("a", "b", F.explode(F.sequence(F.lit(1), "k")))
    once = [tuple(r) for r in tree_attribution(df, tree, weight="k").collect()]
    assert [r[:1] + (pytest.approx(r[1]), pytest.approx(r[2])) + r[3:] for r in once] == [tuple(r) for r in tree_attribution(repeated, tree).collect()]
    assert tree_attribution(df, tree, top=1).count() == 1
    assert tree_attribution(df, Leaf(0.3, 5)).collect() == [] and tree_attribution(df.limit(0), tree).collect() == []
