"""Additive attribution of a tree's score: exact Shapley values with path-dependent expectations.

An unknown feature is averaged out by following both branches of its splits in
proportion to their training cover. For one leaf, a row matters only by which
of the path's features lead towards it. So every leaf has a small table: for
each pattern of agreeing features the values of all its features, summed over
their subsets once. Rows collapse to the outcomes of all splits, one bit each;
each distinct outcome meets every leaf's table by a join on leaf and pattern.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations
from math import factorial, prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asphalt.session import materialise

# A leaf's table has two to the power of its path's features rows; outcomes of so many splits fit into one number.
MAX_DEPTH = 10
WORD = 62


@dataclass(frozen=True)
class Split:
    """Rows go left if ``feature`` is at most ``at`` or, with ``categories``, one of these."""

    feature: str
    left: Split | Leaf
    right: Split | Leaf
    at: float | None = None
    categories: tuple[float, ...] = ()

    @property
    def cover(self) -> float:
        return self.left.cover + self.right.cover

    def goes_left(self) -> Column:
        return F.col(self.feature).isin(list(self.categories)) if self.at is None else F.col(self.feature) <= self.at


@dataclass(frozen=True)
class Leaf:
    value: float
    cover: float


Tree = Split | Leaf


def of_classifier(model, features: Sequence[str]) -> Tree:
    """The tree of a fitted classifier of two classes over named features; a leaf's value is its share of class 1."""
    def walk(node) -> Tree:
        if node.getClass().getSimpleName() == "LeafNode":
            stats = list(node.impurityStats().stats())
            return Leaf(stats[1] / sum(stats), sum(stats))
        split = node.split()
        left, right = walk(node.leftChild()), walk(node.rightChild())
        name = features[split.featureIndex()]
        if split.getClass().getSimpleName() == "ContinuousSplit":
            return Split(name, left, right, at=split.threshold())
        return Split(name, left, right, categories=tuple(split.leftCategories()))

    return walk(model._java_obj.rootNode())


def splits_of(tree: Tree) -> list[Split]:
    return [] if isinstance(tree, Leaf) else [tree, *splits_of(tree.left), *splits_of(tree.right)]


def mean_score(tree: Tree) -> float:
    """Mean score of the training rows: what an attribution adds up from."""
    if isinstance(tree, Leaf):
        return tree.value
    return (tree.left.cover * mean_score(tree.left) + tree.right.cover * mean_score(tree.right)) / tree.cover


def _paths(tree: Tree, number: dict[int, int], way: tuple = ()) -> list[tuple[Leaf, dict[str, tuple[list, float]]]]:
    """Leaves with, for each feature of their path, the outcomes that lead there and the share that takes them by chance."""
    if isinstance(tree, Split):
        sides = ((tree.left, True), (tree.right, False))
        return [p for child, left in sides for p in _paths(
            child, number, (*way, (tree.feature, number[id(tree)], left, child.cover / tree.cover)))]
    conditions: dict[str, tuple[list, float]] = {}
    for feature, split, left, share in way:
        outcomes, chance = conditions.get(feature, ([], 1.0))
        conditions[feature] = ([*outcomes, (split, left)], chance * share)
    return [(tree, conditions)]


def _values(leaf: Leaf, chances: Sequence[float], pattern: int) -> list[float]:
    """Shapley value of each feature of a path for a row that agrees with the path in the features of ``pattern``."""
    n, agrees = len(chances), [float(pattern >> i & 1) for i in range(len(chances))]
    values = []
    for j in range(n):
        others = [k for k in range(n) if k != j]
        total = 0.0
        for size in range(n):
            weight = factorial(size) * factorial(n - size - 1) / factorial(n)
            for known in combinations(others, size):
                total += weight * prod(agrees[k] if k in known else chances[k] for k in others)
        values.append(leaf.value * (agrees[j] - chances[j]) * total)
    return values


def outcomes(df: DataFrame, tree: Tree, weight: str | None = None) -> DataFrame:
    """Rows by the outcomes of all splits: (outcome array<long>, n). A missing value counts as not going left."""
    splits = splits_of(tree)
    words = []
    for first in range(0, max(1, len(splits)), WORD):
        word = F.lit(0).cast("long")
        for i, split in enumerate(splits[first:first + WORD]):
            word = word + F.when(split.goes_left(), F.lit(1 << i).cast("long")).otherwise(0)
        words.append(word)
    rows = F.count("*") if weight is None else F.sum(weight)
    return df.select(F.array(*words).alias("outcome"), *([weight] if weight else [])).groupBy("outcome").agg(rows.alias("n"))


def tree_values(df: DataFrame, tree: Tree, weight: str | None = None) -> DataFrame:
    """Attribution of every distinct outcome: (outcome, n, feature, value), features without a part left out.

    Values of an outcome add up to its leaf's score less ``mean_score``.
    """
    spark = df.sparkSession
    schema = "outcome array<long>, n long, feature string, value double"
    if isinstance(tree, Leaf):
        return spark.createDataFrame([], schema)
    splits = splits_of(tree)
    paths = _paths(tree, {id(s): i for i, s in enumerate(splits)})
    if max(len(c) for _, c in paths) > MAX_DEPTH:
        raise ValueError(f"a path of the tree has more than {MAX_DEPTH} features")
    leaves, table = [], []
    for number, (leaf, conditions) in enumerate(paths):
        masks = []
        for outcomes_, _ in conditions.values():
            mask, want = ([0] * -(-len(splits) // WORD) for _ in range(2))
            for split, left in outcomes_:
                mask[split // WORD] |= 1 << split % WORD
                want[split // WORD] |= left << split % WORD
            masks.append((mask, want))
        leaves.append((number, masks))
        chances = [chance for _, chance in conditions.values()]
        for pattern in range(1 << len(chances)):
            for feature, value in zip(conditions, _values(leaf, chances, pattern)):
                if value:
                    table.append((number, pattern, feature, value))
    # Both tables are bounded by the tree: leaves, and two to the power of a path's features for each.
    named = spark.createDataFrame(leaves, "leaf int, conditions array<struct<mask:array<long>,want:array<long>>>")
    every = named.agg(F.collect_list(F.struct("leaf", "conditions")).alias("all"))
    values = F.broadcast(spark.createDataFrame(table, "leaf int, pattern int, feature string, value double"))
    kinds = materialise(outcomes(df, tree, weight))

    def holds(condition: Column) -> Column:
        words = F.zip_with(condition["mask"], condition["want"], lambda m, w: F.struct(m.alias("m"), w.alias("w")))
        return F.forall(F.zip_with(words, F.col("outcome"), lambda c, o: o.bitwiseAND(c["m"]) == c["w"]), lambda x: x)

    met = kinds.withColumn("at", F.explode(every.select("all").scalar())).select("outcome", "n", "at.leaf", "at.conditions")
    bits = F.transform("conditions", lambda c, i: F.when(holds(c), F.pow(F.lit(2), i).cast("int")).otherwise(0))
    met = met.select("outcome", "n", "leaf", F.aggregate(bits, F.lit(0), lambda a, b: a + b).alias("pattern"))
    return met.join(values, ["leaf", "pattern"]).groupBy("outcome", "n", "feature").agg(F.sum("value").alias("value"))


def tree_attribution(df: DataFrame, tree: Tree, top: int | None = None, weight: str | None = None) -> DataFrame:
    """Mean signed value, mean size and direction per feature of a tree, or of the ``top`` ones.

    A feature that the tree doesn't use has no row. An empty table gives an empty result.
    """
    values = tree_values(df, tree, weight)
    rows = outcomes(df, tree, weight).agg(F.sum("n")).scalar()
    summed = values.groupBy("feature").agg(
        (F.sum(F.col("n") * F.col("value"))).alias("signed"), F.sum(F.col("n") * F.abs("value")).alias("size"))
    result = summed.select("feature", (F.col("signed") / rows).alias("mean_signed"), (F.col("size") / rows).alias("mean_abs"))
    result = result.withColumn(
        "direction", F.when(F.col("mean_signed") > 0, "aggravating").when(F.col("mean_signed") < 0, "protective"))
    result = result.orderBy(F.desc("mean_abs"), "feature")
    return result if top is None else result.limit(top)
