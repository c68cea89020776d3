import hashlib
import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from asphalt.llm import fingerprints as fp
from tests.llm.frames import awkward, collected, empty, table, words


def xx(parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p if isinstance(p, bytes) else (p % 2**64).to_bytes(8, "little"), seed=seed)
    return seed


def plain_sketch(text):
    parts = (text or "").lower().split()
    hashed = [xx([w.encode()]) for w in parts]
    if not parts:
        return []
    if len(parts) < 5:
        signed = [h - 2**64 if h >= 2**63 else h for h in hashed]
        found = {xx([" ".join(map(str, signed)).encode()]) % 2**63}
    else:
        found = {xx(hashed[i:i + 5]) % 2**63 for i in range(len(parts) - 4)}
    return sorted(h for h in found if h < 2**63 // 8) or [min(found)]


def plain_pairs(rows):
    order = sorted(rows, key=lambda r: -r["doc_id"])
    for i, r in enumerate(order):
        text, after = r["text"] or "", order[(i + 1) % len(order)]["text"] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = plain_sketch(text), plain_sketch(edited), plain_sketch(after)

        def alike(x, y):
            return len(set(x) & set(y)) / len(set(x) | set(y)) if x or y else 1.0

        yield (r["doc_id"], len(text), hashlib.sha256(edited.encode()).hexdigest(), ",".join(f"{h:x}" for h in a),
               ",".join(f"{h:x}" for h in b), round(alike(a, b), 9), round(alike(a, c), 9))


@pytest.mark.parametrize("bucket_rows", [1, 7, 2000])
def test_awkward_rows_against_plain_code(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(fp, "BUCKET_ROWS", bucket_rows)
    rows = {r["doc_id"]: (r["doc_id"], r["text"]) for r in collected(awkward(spark)) if r["doc_id"] is not None}
    docs = table(spark, list(rows.values()))
    got = Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 9), round(r[6], 9)) for r in fp.edited_pairs(docs).collect())
    assert got == Counter(plain_pairs(collected(docs)))


def test_nulls_and_repeated_rows_stay(spark):
    docs = awkward(spark)
    got = fp.edited_pairs(docs)
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(r["doc_id"] for r in docs.collect())
    assert got.where("near_edited NOT BETWEEN 0 AND 1 OR near_next NOT BETWEEN 0 AND 1").count() == 0


def test_one_and_no_document(spark):
    assert fp.edited_pairs(empty(spark)).collect() == []
    only = fp.edited_pairs(table(spark, [(5, "th er an on")])).first()  # 11 code points: the last 5 become "th er"
    assert only["edited_sha256"] == hashlib.sha256(b"th er th er").hexdigest()
    assert only["near_next"] == 1.0


def test_parts_merge_and_containment_of_unequal_texts(spark):
    rng = random.Random(3)
    whole = words(rng, 8000)
    part = " ".join(whole.split()[:800])
    df = spark.createDataFrame([(whole, part)], "w string, p string").select(
        fp.sketch(F.col("w")).alias("w"), fp.sketch(F.col("p")).alias("p"))
    row = df.select(
        fp.containment(F.col("p"), F.col("w")).alias("inside"), fp.containment(F.col("w"), F.col("p")).alias("part"),
        (fp.merged(F.col("p"), F.col("w")) == F.col("w")).alias("same")).first()
    assert row["inside"] == 1.0 and row["same"] and 0.05 < row["part"] < 0.2


def test_no_python_in_the_plan(spark):
    plan = fp.edited_pairs(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
