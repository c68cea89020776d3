import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from asphalt.llm import clustering
from asphalt.llm.clustering import Simplex

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance int, id string, vector int, inertia double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "y", 3, 0.5) for i, v in rows], SCHEMA)


def expected(rows, dimensions=64, scale=64, clusters=16, rounds=3, seed=1):
    """The contract in plain integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:clusters]]

    def assign():
        found = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (k, _) in zip(kept, found) if k == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    inertia = Counter()
    for k, d in found:
        inertia[k] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, k, d, inertia[k], sum(inertia.values()), names[k]) for (i, _), (k, d) in zip(kept, found))


def got(df):
    return Counter(tuple(r) for r in df.collect())


def floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def vectors(seed, n, dimensions=64, centres=20):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(dimensions)] for _ in range(centres)]
    return floats((i, [x + rng.gauss(0, 0.3) for x in rng.choice(middle)]) for i in range(n))


def test_against_brute_force(spark):
    rows = vectors(1, 400)
    assert got(clustering.clustered(table(spark, rows).repartition(7))) == expected(rows)


def test_awkward_vectors(spark):
    rows = vectors(2, 60)
    good = rows[0][1]
    rows += floats([
        (900, None), (901, []), (902, good[:63]), (903, good + [1.0]), (904, [None, *good[1:]]), (905, [float("nan"), *good[1:]]),
        (906, [float("inf"), *good[1:]]), (907, [-float("inf"), *good[1:]]), (None, good), (None, [-x for x in good]), (5, good),
        (908, [1000.0] * 64), (909, [-0.001] * 64),
    ])
    rows += [rows[3]] * 50
    out = clustering.clustered(table(spark, rows))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert got(out) == expected(rows)


@pytest.mark.parametrize("rows", [
    [], [(1, [0.5] * 64)], [(i, [0.25] * 64) for i in range(40)], [(i, [i / 64, *[0.0] * 63]) for i in range(50)],
])
def test_few_equal_and_collinear_vectors(spark, rows):
    out = clustering.clustered(table(spark, rows))
    assert got(out) == expected(rows) and len(out.columns) == 6


def test_other_parameters(spark):
    rows = vectors(3, 200, dimensions=5, centres=4)
    df = table(spark, rows)
    assert got(clustering.clustered(df, dimensions=5, clusters=7, rounds=1, scale=1000, seed=9, pivots=3)) == expected(
        rows, 5, 1000, 7, 1, 9)


def test_components_out_of_range_are_refused(spark):
    with pytest.raises(Exception, match="smaller scale"):
        clustering.clustered(table(spark, [(1, [1e30] * 64), (2, [0.0] * 64)])).collect()


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from([1, 3, 30, 10**6]), st.sampled_from([1, 2, 6, 12]), st.booleans())
def test_bounds_never_lose_the_nearest(seed, size, pivots, shifted):
    rng = np.random.default_rng(seed)
    centroids = rng.integers(-size, size + 1, (10, 8))
    points = np.vstack([rng.integers(-size, size + 1, (60, 8)), centroids, rng.integers(-1000 * size, 1000 * size, (20, 8))])
    if shifted:
        points, centroids = points + 10**6, centroids + 10**6
    simplex = Simplex.over(centroids, pivots)
    now = centroids + rng.integers(-1, 2, centroids.shape)
    cluster, distance = simplex.nearest(points, simplex.apexes(points), now)
    squared = ((points[:, None] - now[None]) ** 2).sum(axis=2)
    assert (cluster == squared.argmin(axis=1)).all() and (distance == squared.min(axis=1)).all()


def test_bounds_enclose_the_distance_and_filter():
    rng = np.random.default_rng(3)
    middle = rng.integers(-100, 100, (16, 64))
    points = middle[rng.integers(0, 16, 2_000)] + rng.integers(-3, 4, (2_000, 64))
    simplex = Simplex.over(middle, 6)
    apexes = simplex.apexes(points)
    assert simplex.possible(apexes, middle).mean() < 0.5
    assert (simplex.nearest(points, apexes, middle)[0] == ((points[:, None] - middle) ** 2).sum(axis=2).argmin(axis=1)).all()
