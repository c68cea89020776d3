import random
from collections import Counter

import numpy as np
import pytest

from asphalt.llm import decontaminate as dc
from tests.llm.frames import awkward, empty, table, words


def plain_align(item, passage):
    h = np.zeros((len(item) + 1, len(passage) + 1), dtype=int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            same = 2 if item[i - 1] == passage[j - 1] else -1
            h[i, j] = max(0, h[i - 1, j - 1] + same, h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max() / (2 * max(1, len(item)))


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, score string")


@pytest.mark.parametrize("seed", range(20))
def test_alignment_scores(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 6, rng.integers(1, 25)), rng.integers(0, 6, rng.integers(0, 40))
    score, first, last = dc.align(a, b)
    assert score == pytest.approx(plain_align(a, b)) and 0 <= first <= last <= len(b)
    assert plain_align(a, b[first:last]) == pytest.approx(score)


def edited(rng, text, share):
    return " ".join("zz" + str(rng.randrange(999)) if rng.random() < share else w for w in text.split())


def test_copies_are_found_and_clean_texts_left(spark):
    rng = random.Random(4)
    tests = [words(rng, 40) for _ in range(6)]
    around = lambda t: f"{words(rng, 60)} {t} {words(rng, 60)}"
    rows = [(i, around(t)) for i, t in enumerate(tests)]
    rows += [(10 + i, around(edited(rng, t, 0.2))) for i, t in enumerate(tests)]
    rows += [(20 + i, around(" ".join(t.split()[:7]))) for i, t in enumerate(tests)]  # a short shared phrase isn't a copy
    rows += [(30 + i, words(rng, 200)) for i in range(40)]
    rows += [(100 + i, around(tests[0].upper().replace(" ", ", "))) for i in range(60)]  # a passage that most documents hold
    found = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(table(spark, rows), items(spark, enumerate(tests))).collect()}
    want = {(i, i) for i in range(6)} | {(10 + i, i) for i in range(6)} | {(100 + i, 0) for i in range(60)}
    assert found == want


def test_against_alignment_of_every_pair(spark):
    rng = random.Random(8)
    tests = [words(rng, rng.randint(12, 30)) for _ in range(5)]
    rows = []
    for i in range(60):
        t = rng.choice(tests)
        rows.append((i, f"{words(rng, 20)} {edited(rng, t, rng.random() * 0.6)} {words(rng, 20)}"))
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in dc.contaminated(table(spark, rows), items(spark, enumerate(tests))).collect()}
    grams_of = {i: {n: set(dc.grams(dc.words_of(text), n)) for n in (3, 4)} for i, text in rows}
    held = Counter(g for own in grams_of.values() for g in own[3])
    for i, text in rows:
        doc = dc.words_of(text)
        for j, t in enumerate(tests):
            item = dc.words_of(t)
            score = plain_align(item, doc)
            long = set(dc.grams(item)) & grams_of[i][4]
            short = set(dc.grams(item, 3)) & grams_of[i][3] if len(item) < dc.SHORT_ITEM else set()
            if score >= dc.MIN_SCORE and (long or len(short) > 1 or any(held[g] <= dc.RARE_FLOOR for g in short)):
                assert got[i, j] == pytest.approx(score)
            else:
                assert (i, j) not in got


def test_a_common_seed_still_leads_to_copies(spark):
    rng = random.Random(12)
    own = [f"w{i}" for i in range(16)]
    copy = " ".join(w if i < 4 or i % 3 != 1 else "zz" for i, w in enumerate(own))  # four words together, then two at most
    rows = [(0, f"{words(rng, 30)} {copy} {words(rng, 30)}")]
    rows += [(i, f"{words(rng, 30)} {' '.join(own[:4])} {words(rng, 30)}") for i in range(1, 80)]
    found = [(r["doc_id"], r["item_id"]) for r in dc.contaminated(table(spark, rows), items(spark, [(5, " ".join(own))])).collect()]
    assert found == [(0, 5)]


def test_short_items_are_found_by_three_words(spark):
    rng = random.Random(13)
    own = [f"w{i}" for i in range(15)]
    copy = " ".join("zz" if i % 4 == 3 else w for i, w in enumerate(own))
    rows = [(0, f"{words(rng, 30)} {copy} {words(rng, 30)}"), (1, words(rng, 60))]
    found = [r["doc_id"] for r in dc.contaminated(table(spark, rows), items(spark, [(5, " ".join(own))])).collect()]
    assert found == [0]


@pytest.mark.parametrize(("size", "most_lost"), [(8, 0.05), (12, 0.01), (16, 0.001), (27, 0.001), (28, 0.005), (60, 0.001)])
def test_edited_copies_rarely_lack_a_seed(size, most_lost):
    """Of random copies that score enough, nearly all hold a seed; items of eight words lose the most."""
    rng = random.Random(size)
    own, kept, lost = [f"w{i}" for i in range(size)], 0, 0
    for _ in range(1500):
        share = rng.uniform(0.1, 0.4)
        copy = ["zz" if rng.random() < share else w for w in own]
        if plain_align(own, copy) >= dc.MIN_SCORE:
            kept += 1
            lost += not any(dc.seeds(own) & set(dc.grams(copy, n)) for n in (3, 4))
    assert kept > 300 and lost <= most_lost * kept


def test_blocks_give_the_same(spark):
    rng = random.Random(9)
    tests = [words(rng, 20) for _ in range(7)]
    docs = table(spark, [(i, words(rng, 5) + " " + t) for i, t in enumerate(tests)])
    bench = items(spark, enumerate(tests))
    rows = lambda n: sorted(map(tuple, dc.contaminated(docs, bench, block_items=n).collect()))
    assert rows(2) == rows(100) and len(rows(3)) == 7


def test_awkward_rows(spark):
    docs = awkward(spark)
    long = docs.where("doc_id = 3").first()["text"]
    bench = items(spark, [(1, None), (2, ""), (None, "th er"), (3, " ".join(long.split()[9000:9040])), (3, "ünï çödé ßtraße 漢字 текст")])
    found = sorted((r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, bench).collect())
    assert found == [(3, 3), (3, 3), (8, 3)]
    kept = dc.decontaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3


def test_empty_tables(spark):
    bench = items(spark, [(1, "th er an re st")])
    assert dc.contaminated(empty(spark), bench).collect() == []
    assert dc.contaminated(awkward(spark), items(spark, [])).collect() == []
    assert dc.decontaminated(awkward(spark), items(spark, [])).count() == awkward(spark).count()
