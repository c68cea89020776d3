import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from asphalt.llm import sharding
from tests.llm.frames import awkward, empty, table, words


def check(docs, result, shards):
    rows = result.collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    n = docs.count()
    assert len(rows) == n
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    return rows


@pytest.mark.parametrize("bucket_bytes", [500, 5_000, 1 << 25])
def test_awkward_rows(spark, bucket_bytes):
    docs = awkward(spark)
    result = sharding.shuffled_shards(docs, bucket_bytes=bucket_bytes)
    assert result.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    check(docs, result, sharding.SHARDS)


def test_one_id_that_fills_the_table_is_scattered(spark):
    rng = random.Random(3)
    docs = table(spark, [(7, words(rng, 30)) for _ in range(300)] + [(i, "x") for i in range(100)])
    check(docs, sharding.shuffled_shards(docs, bucket_bytes=1000), sharding.SHARDS)


def test_a_crowded_order_does_not_depend_on_the_layout(spark):
    rng = random.Random(5)
    rows = [(7, words(rng, 30)) for _ in range(200)] + [(7, "same")] * 2500 + [(i, "x") for i in range(100)] + [(None, None)] * 20
    docs = table(spark, rows)
    order = lambda df: sorted(
        (r["shard"], r["slot"], repr(r["doc_id"]), repr(r["text"])) for r in sharding.shuffled_shards(df, bucket_bytes=1000).collect())
    first = order(docs)
    assert first == order(docs.repartition(7, "text")) == order(docs.orderBy(F.desc("text")).coalesce(2))
    assert Counter(r[2:] for r in first) == Counter((repr(i), repr(t)) for i, t in rows)
    same = [r[0] for r in first if r[3] == "'same'"]
    assert set(same) == set(range(sharding.SHARDS)) and len(same) == 2500


def test_order_is_shuffled_and_depends_on_the_seed_not_the_layout(spark):
    docs = table(spark, [(i, "x" * (i % 50)) for i in range(2000)])
    order = lambda df: [r["doc_id"] for r in sorted(df.collect(), key=lambda r: (r["shard"], r["slot"]))]
    a = order(sharding.shuffled_shards(docs, bucket_bytes=4000))
    assert a == order(sharding.shuffled_shards(docs.repartition(5, "n_chars"), bucket_bytes=4000))
    assert a != order(sharding.shuffled_shards(docs, bucket_bytes=4000, seed=9))
    runs = sum(abs(x - y) < 20 for x, y in zip(a, a[1:]))
    assert runs < 100  # about 40 by chance


def test_written_shards_read_back(spark, tmp_path):
    docs = awkward(spark)
    sharding.write_shards(sharding.shuffled_shards(docs, 3, bucket_bytes=2000), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    check(docs, back, 3)


def test_digest_and_empty_table(spark):
    import zlib
    docs = awkward(spark)
    for r in sharding.sharded_digest(docs).collect():
        assert r["law"] == "rows" and r["grown_shard"] is None and r["size"] >= 8
    text = docs.where("doc_id = 8").first()["text"].encode()
    r = sharding.sharded_digest(docs).where("doc_id = 8").first()
    assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
    assert sharding.sharded_digest(empty(spark)).collect() == []
