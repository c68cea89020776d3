import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from asphalt.llm import resampling
from tests.llm.frames import awkward, collected, empty, table, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, run=1):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = WORD.findall(lowered)
    return own, [" ".join(own[i:i + n]) for n in range(1, run + 1) for i in range(len(own) - n + 1)]


def expected(rows, target, run=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    """The contract, feature by feature."""
    def counts(texts):
        total = [0] * buckets
        for t in texts:
            for f in plain_features(t, run)[1]:
                total[zlib.crc32(f.encode()) % buckets] += 1
        return total

    s, t = counts(r["text"] for r in rows), counts(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    scored = []
    for r in rows:
        own, feats = plain_features(r["text"], run)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in feats)
        key = "" if r["doc_id"] is None else r["doc_id"]
        h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([r["doc_id"], len(feats), weight, score, len(own) >= min_words])
    able = sorted((x for x in scored if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[2]))
    ranks = {id(x): i + 1 for i, x in enumerate(able[:len(able) * percent // 100])}
    return sorted(((*x[:4], ranks.get(id(x))) for x in scored), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=400), min_size=1, max_size=8), st.sampled_from([4, 5, 64]))
def test_spans_have_their_crc(parts, reach):
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    bounds = np.cumsum([0, *map(len, parts)])
    assert resampling.PositionCrc(reach).of(data, bounds[:-1], bounds[1:]).tolist() == [zlib.crc32(p) for p in parts]


def test_spans_may_overlap_and_be_longer_than_a_chunk(monkeypatch):
    monkeypatch.setattr(resampling, "CHUNK_BYTES", 1000)
    data = np.frombuffer(random.Random(1).randbytes(300_000), dtype=np.uint8)
    starts, ends = np.array([0, 5, 5, 299_999, 70]), np.array([300_000, 250_000, 6, 300_000, 134])
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert resampling.PositionCrc().of(data, starts, ends).tolist() == want


@pytest.mark.parametrize("run", [1, 3])
def test_awkward_rows_against_brute_force(spark, run):
    docs, target = awkward(spark), [words(random.Random(3), 50), None, "", "TH er an 漢字"]
    rows = resampling.resampled(docs, table(spark, enumerate(target)), run=run, percent=30)
    assert got(rows) == expected(collected(docs), target, run, percent=30)


def test_words_of_neighbouring_texts_stay_apart(spark):
    rows = [(i, t) for i, t in enumerate(["ab", "cd", "", None, "ef-", "-gh", "éß", "x" * 1000])]
    docs = table(spark, rows).coalesce(1)
    assert {r["doc_id"]: r["n_features"] for r in resampling.resampled(docs, docs).collect()} == {
        0: 1, 1: 1, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1, 7: 1}


def test_long_words_and_many_groups(spark, monkeypatch):
    monkeypatch.setattr(resampling, "GROUP_BYTES", 2_000)
    rng = random.Random(7)
    rows = [(1, "q" * 2_000_000 + " tail"), (2, words(rng, 60_000)), (3, "é" * 100_001), *[(i, words(rng, 30)) for i in range(4, 40)]]
    docs = table(spark, rows)
    assert got(resampling.resampled(docs, docs, percent=50)) == expected(
        [{"doc_id": i, "text": t} for i, t in rows], [t for _, t in rows], percent=50)


def test_repeated_rows_take_ranks_of_their_own(spark):
    text = words(random.Random(2), 25)
    docs = table(spark, [(7, text)] * 500 + [(None, text)] * 300 + [(i, words(random.Random(i), 30)) for i in range(100, 200)])
    rows = resampling.resampled(docs, table(spark, [(1, text)]), percent=50)
    assert got(rows) == expected(collected(docs), [text], percent=50)
    ranks = sorted(r["rank"] for r in rows.collect() if r["rank"] is not None)
    assert ranks == list(range(1, 451))


def test_empty_tables(spark):
    assert resampling.resampled(empty(spark), awkward(spark)).collect() == []
    docs = awkward(spark)
    assert got(resampling.resampled(docs, empty(spark))) == expected(collected(docs), [])


def test_likelier_documents_are_drawn(spark):
    rng = random.Random(4)
    alike = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(40))) for i in range(40)]
    other = [(100 + i, words(rng, 40)) for i in range(160)]
    drawn = resampling.resampled(table(spark, alike + other), table(spark, [(1, "alpha beta gamma " * 200)]), percent=20)
    ids = [r["doc_id"] for r in drawn.where("rank IS NOT NULL").collect()]
    assert len(ids) == 40 and sum(i < 100 for i in ids) == 40
