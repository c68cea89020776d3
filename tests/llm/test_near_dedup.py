import random
import sys
import time
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from asphalt.llm import edited_copies, near_dedup
from asphalt.llm.components import components
from asphalt.session import materialise
from tests.llm.frames import awkward, collected, empty, table, words


def plain_simhash(text):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i:i + 3]) for i in range(len(parts) - 2)] or [b" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values):
    """Smallest id reachable over fingerprints within two bits, by looking at all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def expected(rows):
    values = [plain_simhash(r["text"]) for r in rows]
    found = groups(values)
    members = defaultdict(list)
    for r, g in zip(rows, found):
        members[g].append(r["doc_id"])
    ids = {g: min((i for i in m if i is not None), default=None) for g, m in members.items()}
    return Counter((r["doc_id"], f"{v:016x}", ids[g], len(members[g]) - 1) for r, v, g in zip(rows, values, found))


def test_spark_hash_is_the_contract_hash(spark):
    row = spark.createDataFrame([("on th é",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] % 2**64 == xxhash.xxh64_intdigest("on th é".encode(), seed=42)


def test_awkward_rows_against_all_pairs(spark):
    docs = awkward(spark)
    got = Counter(tuple(r) for r in near_dedup.near_duplicates(docs).collect())
    assert got == expected(collected(docs))


def test_empty_table(spark):
    assert near_dedup.near_duplicates(empty(spark)).collect() == []


@pytest.mark.parametrize("short_list", [0, 3, 64])
def test_all_links_connect_however_long_the_lists(spark, short_list):
    rng = random.Random(5)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            value = centre
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "value long")
    links = near_dedup.linked(df, "value", short_list)
    for r in links.collect():
        assert ((r["a"] ^ r["b"]) % 2**64).bit_count() <= 2
    roots = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    got, want = defaultdict(set), defaultdict(set)
    for v in signed:
        got[roots.get(v, v)].add(v)
    for v, g in zip(signed, groups(values)):
        want[g].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_pairs_do_not_grow_with_the_square_of_a_group(spark):
    rng = random.Random(2)
    centre = rng.getrandbits(62)
    values = {centre ^ (1 << i) ^ (1 << j) for i in range(32) for j in range(i)}
    links = near_dedup.linked(spark.createDataFrame([(v,) for v in values], "value long"), "value", 16)
    assert links.count() <= 66 * len(values)


def test_chains_reach_their_smallest_node(spark):
    n = 200
    links = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(1000, 1000)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    assert roots == {i: 0 for i in range(1, n + 1)}


def test_copies_that_differ_in_case_and_space_group(spark):
    text = words(random.Random(1), 50)
    docs = table(spark, [(4, text), (9, text.upper().replace(" ", "\n")), (2, words(random.Random(2), 50))])
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {4: 4, 9: 4, 2: 2}


def edited_docs():
    """Texts with edited copies of all degrees around 0.8, some with a passage that all share, and how they group."""
    rng, rows = random.Random(8), []
    passage = words(rng, 60)
    for n in range(40):
        own = words(rng, rng.choice([8, 40, 150, 600])).split()
        if n % 3 == 0:
            own = own[:len(own) // 2] + passage.split() + own[len(own) // 2:]
        rows.append(" ".join(own))
        for _ in range(4):
            copy = list(own)
            for _ in range(rng.randint(1, max(2, len(own) // 40))):
                copy[rng.randrange(len(copy))] = words(rng, 1)
            rows.append(" ".join(copy[:len(copy) - rng.randrange(1 + len(copy) // 20)]))
    values = [plain_simhash(t) for t in rows]
    sets = [{tuple(p[k:k + 5]) for k in range(max(1, len(p) - 4))} for p in map(str.split, rows)]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            near = (values[i] ^ values[j]).bit_count() <= 2 or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            if near and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return rows, root


def test_edited_copies_group_if_asked_for(spark):
    rows, want = edited_docs()
    docs = table(spark, list(enumerate(rows)))
    found = near_dedup.near_duplicates(docs, similarity=0.8).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(want))
    narrow = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert len(set(want)) < len(set(narrow.values())) - 20


def test_the_stage_drops_edited_copies(spark):
    rows, want = edited_docs()
    kept = corpus_pipeline.near_dedup_stage(spark, table(spark, list(enumerate(rows))), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def test_a_common_passage_makes_no_long_list(spark):
    """Texts with a passage of their own half are listed under their own shingles, which nobody shares."""
    rng = random.Random(3)
    passage = words(rng, 30)
    rows = [(i, f"{words(rng, 40)} {passage} {words(rng, 40)}") for i in range(300)]
    docs = table(spark, rows).select(F.xxhash64("text").alias("key"), near_dedup.signature_column(F.col("text")).alias("s"))
    assert edited_copies.listed(docs.select("key", "s.*"), 0.8).count() == 0


def test_large_group_of_copies_is_not_paired(spark):
    rng = random.Random(4)
    own = words(rng, 100).split()
    rows = []
    for i in range(500):
        copy = list(own)
        copy[rng.randrange(100)] = words(rng, 1)
        rows.append((i, " ".join(copy)))
    found = near_dedup.near_duplicates(table(spark, rows), similarity=0.8)
    assert found.where("component_id = 0").count() == 500


def test_a_crowd_of_texts_that_are_just_not_alike_is_not_paired(spark, monkeypatch):
    """Copies that differ in about a fifth of their shingles from what they come from, and in different ones from each other."""
    rng = random.Random(6)
    rows = []
    for _ in range(2):
        own = words(rng, 120).split()
        for _ in range(250):
            copy = list(own)
            for _ in range(rng.choice([1, 3, 5, 7])):
                copy[rng.randrange(len(copy))] = words(rng, 2).replace(" ", "")
            rows.append(" ".join(copy[rng.randrange(12):len(copy) - rng.randrange(12)]))
    sets = [{tuple(p[k:k + 5]) for k in range(len(p) - 4)} for p in map(str.split, rows)]
    values, root = [plain_simhash(t) for t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            near = (values[i] ^ values[j]).bit_count() <= 2 or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            if near and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    made = []

    def counted(df, kept=edited_copies.materialise):
        if df.columns == ["a", "b"]:
            made.append(kept(df).count())
        return kept(df)

    monkeypatch.setattr(edited_copies, "materialise", counted)
    found = near_dedup.near_duplicates(table(spark, list(enumerate(rows))), similarity=0.8)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == dict(enumerate(root))
    assert 100 < len(set(root)) < 400
    assert made and max(made) < 20 * len(rows), made


def test_shingle_hashes_tell_runs_apart():
    a, b = near_dedup.words_of("a b c d e f"), near_dedup.words_of("A b  c d\ne f")
    assert (edited_copies.shingle_hashes(a) == edited_copies.shingle_hashes(b)).all() and len(edited_copies.shingle_hashes(a)) == 2
    assert len(edited_copies.shingle_hashes([])) == 0 and len(edited_copies.shingle_hashes([b"x"])) == 1
    many = edited_copies.shingle_hashes([str(i).encode() for i in range(10_000)])
    assert len(many) == 9_996 and 30 < len(edited_copies.sketch_of(many)) < 110


def test_edited_copies_of_awkward_and_empty_tables(spark):
    got = near_dedup.near_duplicates(awkward(spark), similarity=0.8)
    assert got.count() == awkward(spark).count() and got.columns == ["doc_id", "fingerprint", "component_id", "links"]
    assert near_dedup.near_duplicates(empty(spark), similarity=0.8).collect() == []


def test_many_sketches_are_not_broadcast(spark):
    """20,000 sketches of 64 numbers are some ten megabytes, which the driver would have to build."""
    rows = spark.range(20_000).select(
        F.col("id").alias("key"), F.lit(64).alias("size"), F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.xxhash64("id", i)).alias("tokens"))
    pairs = spark.range(19_999).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    plan = edited_copies._candidates(pairs, rows, 0.8)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in plan, plan[:500]


def test_stars_need_no_round(spark, monkeypatch):
    kept, module = [], sys.modules[components.__module__]
    monkeypatch.setattr(module, "materialise", lambda df: kept.append(df) or materialise(df))
    stars = [(1, n) for n in range(2, 300)] + [(1000, n) for n in range(1001, 1100)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(stars, "a long, b long"), "a", "b").collect()}
    assert got == {n: root for root, n in stars}
    assert len(kept) == 1


def test_random_links_against_union_by_hand(spark, monkeypatch):
    monkeypatch.setattr(sys.modules[components.__module__], "ROWS_PER_TASK", 50)
    rng = random.Random(6)
    links = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(420)]
    links += [(i, i + 1) for i in range(500, 700)] + [(900, i) for i in range(800, 1000)] + [(950, 2000), (7, 7)]
    least = {n: n for link in links for n in link}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b")
    assert Counter(tuple(r) for r in found.collect()) == Counter((n, r) for n, r in least.items() if n != r)


def test_near_copies_leave_no_shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = files.getAllFiles()
        return {name for i in range(names.size()) if (name := names.apply(i).getName()).startswith("shuffle_")}

    before, setting = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting, None)
    result = near_dedup.near_duplicates(awkward(spark), similarity=0.8)
    for _ in range(40):  # files go in the background
        if not (left := shuffled() - before):
            break
        time.sleep(0.25)
    assert not left
    assert spark.conf.get(setting, None) == was
    assert result.count() == awkward(spark).count()
