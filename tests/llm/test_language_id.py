import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from asphalt.llm import folds, language_id
from tests.llm.frames import awkward, empty, table

PARTS = {"xa": ["on", "th", "er", "an", "re"], "xb": ["lo", "mi", "ka", "pu", "zi"], "xc": ["при", "вет", "мо", "ска", "та"]}


def written(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(2, 4))) for _ in range(n))


def learning(spark):
    rng = random.Random(1)
    return table(spark, [(i, written(rng, lang, rng.randint(3, 60)), lang) for i, lang in enumerate(rng.choice(list(PARTS)) for _ in range(400))])


@pytest.fixture(scope="module")
def model(spark):
    return language_id.fit(learning(spark))


@pytest.mark.parametrize("seed", range(30))
def test_viterbi_against_all_paths(seed):
    rng = np.random.default_rng(seed)
    scores = rng.normal(0, 4, (rng.integers(1, 7), rng.integers(1, 4)))
    worth = lambda p: sum(scores[i, k] for i, k in enumerate(p)) - 3.0 * sum(a != b for a, b in zip(p, p[1:]))
    best = max(worth(p) for p in product(range(scores.shape[1]), repeat=len(scores)))
    assert worth(tuple(language_id.viterbi(scores, 3.0))) == pytest.approx(best)


def best_worth(scores, switch):
    worth = lambda p: sum(scores[i, k] for i, k in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:]))
    return worth, max(worth(p) for p in product(range(scores.shape[1]), repeat=len(scores)))


def test_two_languages_with_a_third_as_best_single_label():
    scores = np.array([[-1.0, -20.0, -9.0], [-20.0, -1.0, -9.0]])
    assert language_id.viterbi(scores, 10.0).tolist() == [0, 1]


@pytest.mark.parametrize("seed", range(200))
def test_viterbi_where_the_shortcut_is_close(seed):
    rng = np.random.default_rng(seed)
    scores = rng.normal(0, 4, (rng.integers(2, 6), 4))
    scores[:, 3] = np.sort(scores[:, :3], axis=1)[:, 1]  # never the best word, often the best label
    worth, best = best_worth(scores, 6.0)
    assert worth(tuple(language_id.viterbi(scores, 6.0))) == pytest.approx(best)


def test_held_out_accuracy(spark, model):
    rows = language_id.identify(learning(spark), model).where(folds.held_out(F.col("doc_id"))).select("lang", "language.*").collect()
    assert len(rows) > 50 and sum(r[0] == r[1] for r in rows) / len(rows) > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_mixed_texts_get_spans(spark, model):
    rng = random.Random(5)
    text = " ".join([written(rng, "xa", 20), written(rng, "xb", 30), written(rng, "xc", 10)])
    row = language_id.identify(table(spark, [(1, text)]), model).first()["language"]
    assert [(s["lang"], s["first"], s["last"]) for s in row["spans"]] == [("xa", 0, 20), ("xb", 20, 50), ("xc", 50, 60)]
    assert row["lang"] == "xb" and row["score"] < 0.6


def test_scripts_narrow_the_candidates(model):
    assert language_id.script("привет") == language_id._NAMES.index("cyrillic")
    assert language_id.script("漢字") == language_id._NAMES.index("han") and language_id.script("éa") == 0
    labeller = language_id.Labeller(model)
    assert labeller.label(["лоломи"])[0][0] == "xc"
    lang, score, spans = labeller.label(["漢字 漢字"])[0]
    assert lang in PARTS and score == 0.0 and spans == [("und", 0, 2)]


def test_only_the_learning_fold_counts(spark, model):
    docs = learning(spark)
    changed = docs.withColumn("lang", F.when(folds.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    other = language_id.fit(changed)
    assert other.languages == model.languages and np.allclose(
        sorted(other.scores.sum(axis=1)), sorted(model.scores.sum(axis=1)))


def test_awkward_and_empty_tables(spark, model):
    docs = awkward(spark)
    got = language_id.identify(docs, model)
    assert got.count() == docs.count() and set(got.columns) == set(docs.columns)
    by_text = {r["text"]: r["language"]["lang"] for r in got.collect()}
    assert by_text[None] == by_text[""] == by_text["1234 5678"] == "und" and by_text["a"] in PARTS
    assert language_id.identify(empty(spark), model).collect() == []
    nothing = language_id.fit(empty(spark))
    assert {r[0] for r in language_id.identify(docs, nothing).select("language.lang").collect()} == {"und"}
    language_id.fit(docs)
