import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from asphalt.llm import folds, toxicity
from tests.llm.frames import awkward, empty, table, words


def labelled(spark, rows):
    return spark.createDataFrame([(i, 1, t, "x") for i, t in rows], "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def letters():
    rng = random.Random(1)
    text = " ".join(["idiot loser moron stupid clown other thing"] * 30) + " " + words(rng, 3000)
    return toxicity.letter_model(toxicity.trigram_counts([text]))


@pytest.mark.parametrize("written, word", [
    ("1d10t", "idiot"), ("I.D.I.O.T", "idiot"), ("i-d-i-o-t", "idiot"), ("idioooot", "idiot"), ("$tup1d!!!", "stupid"),
    ("l0ser,", "loser"), ("m0r0n", "moron"), ("c l o w n", "clown"), ("ｍоron".replace("ｍ", "m"), "moron"), ("lo­ser", "loser"),
])
def test_disguises_are_restored(letters, written, word):
    assert word in toxicity.restored_words(f"a thing {written} here", letters, {})


def test_plain_words_stay(letters):
    assert toxicity.restored_words("On the 3rd, over 100 all see", letters, {}) >= {"on", "the", "over", "all", "see"}


@pytest.mark.parametrize("written", ["1d10t", "l0s3r", "1 o 5 e", "aaab", "x4$"])
def test_viterbi_finds_the_cheapest_reading(letters, written):
    places = toxicity.lattice(written)

    def cost(reading):
        a = b = 0
        total = sum(c for _, c in reading)
        for letter in "".join(t for t, _ in reading) + " ":
            code = toxicity._code(letter)
            total += letters[a if b else 0][b][code]
            a, b = b, code
        return total

    best = min(product(*places), key=lambda r: (cost(r), "".join(t for t, _ in r)))
    assert toxicity.decode(places, letters) == "".join(t for t, _ in best).strip()


def corpus(spark, n=400):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(n):
        bad = i % 4 == 0
        parts = words(rng, 30).split()
        if bad:
            parts.insert(rng.randrange(30), rng.choice(["idiot", "moron", "grul" + rng.choice(["on", "er", "th", "ing"])]))
        rows.append((i, " ".join(parts)))
        marks.append((i, int(bad)))
    return table(spark, rows), labelled(spark, marks), dict(marks)


def test_held_out_accuracy_and_disguised_words(spark):
    docs, labels, truth = corpus(spark)
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).select(
        "doc_id", "toxicity.*", folds.held_out(F.col("doc_id")).alias("held")).collect()}
    held = [r for r in got.values() if r["held"]]
    right = sum((r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in held)
    assert len(held) > 50 and right / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    extra = toxicity.score(table(spark, [(1, "on th er 1d10t an"), (2, "on th er an"), (3, "the m o r o n here"), (4, None), (5, "")]), model)
    scores = {r["doc_id"]: r["score"] for r in extra.select("doc_id", "toxicity.score").collect()}
    assert scores[1] >= 0.5 and scores[3] >= 0.5 and max(scores[2], scores[4], scores[5]) < 0.5 and scores[4] == scores[5]


def test_remembered_words_give_the_same_features():
    rng = random.Random(3)
    known = {"onth", "onther*", "thon*", "er", "thonre*", "anon*"}
    model = toxicity.ToxicityModel([], 0.0, {k + "1" if k[-1] == "*" else k: 1.0 for k in known})
    scorer = toxicity.Scorer(model)
    for n in range(1, 200, 3):
        own = set(words(rng, n).split())
        assert scorer.features(own) == toxicity.features(own, known)


def test_held_out_labels_change_nothing(spark):
    docs, labels, _ = corpus(spark, 200)
    flipped = labels.withColumn("toxic", F.when(folds.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.weights == b.weights and a.intercept == b.intercept


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (None, 1, 1), (4, None, None), (5, 0, 0), (999, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model)
    assert scored.count() == docs.count() and set(scored.columns) == set(docs.columns)
    assert scored.where("toxicity.score NOT BETWEEN 0 AND 1").count() == 0
    model = toxicity.fit(empty(spark), labels.limit(0))
    assert toxicity.score(empty(spark), model).collect() == []
    assert toxicity.score(docs, model).where("toxicity.score >= 0.5").count() == 0
