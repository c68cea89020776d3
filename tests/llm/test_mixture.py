import math
import random
from collections import Counter, defaultdict

import pytest

from asphalt.llm import mixture
from tests.llm.frames import awkward, empty, table, words


def test_exponent_meets_the_entropy():
    tokens = [1000, 100, 100, 10]
    exponent, weights, _ = mixture.solve(tokens, mixture.Target(evenness=0.9, repeats=1e9))
    assert 0 < exponent < 1
    assert mixture.entropy(weights) == pytest.approx(0.9 * math.log(4), abs=1e-6)
    assert mixture.solve(tokens, mixture.Target(evenness=0.0))[0] == 1.0


def test_repetition_limit_prevails():
    tokens = [1000, 10]
    _, weights, budget = mixture.solve(tokens, mixture.Target(evenness=1.0, repeats=2.0))
    assert max(budget * w / t for t, w in zip(tokens, weights)) <= 2.0 + 1e-6
    assert mixture.solve([7], mixture.Target())[1] == [1.0]
    assert mixture.solve([0, 0], mixture.Target()) == (1.0, [0.0, 0.0], 0)


def sources(spark, seed=1):
    rng = random.Random(seed)
    rows, n = [], 0
    for source, size in (("a", 300), ("b", 60), ("c", 25), (None, 12)):
        for _ in range(size):
            rows.append((n, words(rng, rng.randint(1, 20)), "en", source))
            n += 1
    return table(spark, rows)


def test_every_source_gets_its_budget_as_whole_epochs_and_a_cut_one(spark):
    docs = sources(spark)
    target = mixture.Target(evenness=0.97, repeats=3.0)
    plan = {r[0]: r for r in mixture.source_plan(docs, target)}
    rows = mixture.mixed(docs, target).collect()
    seen, tokens = defaultdict(Counter), Counter()
    for r in rows:
        key = mixture_key(r["source"])
        seen[key, r["epoch"]][r["doc_id"]] += 1
        tokens[key] += r["tokens"]
    size = Counter(mixture_key(r["source"]) for r in docs.collect())
    for key, (_, _, all_tokens, _, whole, rest) in plan.items():
        for epoch in range(whole):
            assert len(seen[key, epoch]) == size[key] and set(seen[key, epoch].values()) == {1}
        wanted = whole * all_tokens + rest
        assert wanted - 21 < tokens[key] <= wanted
        assert set(seen[key, whole].values()) <= {1}


def mixture_key(source):
    return "n" if source is None else "s" + source


def test_cut_follows_the_order_of_blocks(spark):
    docs = sources(spark)
    rows = mixture.mixed(docs, mixture.Target(evenness=0.0, budget=600)).collect()
    by_block = defaultdict(set)
    for r in rows:
        by_block[mixture_key(r["source"]), r["turn"]].add(r["block"])
        assert r["epoch"] == 0
    for key in {k for k, _ in by_block}:
        turns = sorted(t for k, t in by_block if k == key)
        assert turns[-1] >= len(turns) and all(len(by_block[key, t]) == 1 for t in turns)
    assert len(rows) < docs.count()


def test_awkward_rows_and_no_loss_without_a_budget(spark):
    docs = awkward(spark)
    rows = mixture.mixed(docs)
    assert [c for c in rows.columns if c not in ("epoch", "turn", "block", "tokens")] == [c for c in docs.columns if c != "epoch"]
    first = rows.where("epoch = 0")
    assert Counter(r["doc_id"] for r in first.collect()) == Counter(r["doc_id"] for r in docs.collect())


def test_layout_changes_nothing(spark):
    docs = sources(spark)
    a = sorted(mixture.mixed(docs).select("doc_id", "epoch", "turn").collect())
    b = sorted(mixture.mixed(docs.repartition(7, "n_chars")).select("doc_id", "epoch", "turn").collect())
    assert a == b


def test_empty_table(spark):
    assert mixture.mixed(empty(spark)).collect() == []


@pytest.mark.parametrize("tokens", [(1, 5 * 10**9, 5 * 10**9), (10, 5 * 10**10, 5 * 10**10), (50, 2 * 10**11, 2 * 10**11)])
def test_tiny_sources_beside_huge_ones_go_through_once(tokens):
    plan = mixture.planned([(f"s{i}", 1, t) for i, t in enumerate(tokens)], mixture.Target())
    assert all(whole >= 1 for *_, whole, _ in plan)
    assert mixture.planned([("sa", 1, 1), ("sb", 1, 10**6)], mixture.Target(budget=10))[1][4] == 0
