"""Registered queries against DuckDB or brute force, the pipeline against its own rules."""

import re
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from asphalt.llm import decontaminate, near_dedup, queries as registered
from tests.compare import connect, difference
from tests.llm.frames import awkward, empty

SMALL = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_every_operator_has_one_query():
    names = [n for n in queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(registered.ORACLE))
def test_against_sql(spark, name):
    assert oracle_sql()[name] == registered.ORACLE[name]
    assert difference(queries()[name](spark, SMALL), connect(SMALL), registered.ORACLE[name]) is None


def test_decontamination_finds_whole_items(spark):
    texts = {r["doc_id"]: decontaminate.words_of((r["text"] or "").lower()) for r in documents(spark).collect()}
    items = {r["item_id"]: decontaminate.words_of(r["text"].lower()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    inside = {(d, i) for d, ws in texts.items() for i, own in items.items() if f" {' '.join(own)} " in f" {' '.join(ws)} "}
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in queries()["op2_benchmark_decontamination"](spark, SMALL).collect()}
    assert inside and inside <= set(got) and all(got[p] == 1.0 for p in inside)


def test_language_and_toxicity_queries(spark):
    rows = queries()["op7_language_spans"](spark, SMALL).join(documents(spark).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 200 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    rows = queries()["op9_toxicity"](spark, SMALL).collect()
    assert len(rows) == 200 and all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_queries_carry_the_contract_columns(spark):
    want = {
        "op1_scaled_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op7_language_spans": "doc_id held_out lang_pred score", "op9_toxicity": "doc_id held_out score predicted",
        "op8_two_pass_shuffle": "doc_id size text_crc32 law shard slot grown_shard",
        "op10_simhash_near_dedup": "doc_id fingerprint component_id", "op11_importance_resampling": "doc_id n_features weight score rank",
        "op13_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    }
    for name, columns in want.items():
        df = queries()[name](spark, SMALL)
        assert set(columns.split()) <= set(df.columns) and df.count() == 200


def test_pipeline_stages(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        ids, before = Counter(r["doc_id"] for r in out.collect()), {r["doc_id"] for r in docs.collect()}
        assert set(ids) <= before
        if name == "near_dedup":
            assert set(ids) == _kept_of_groups(docs.collect()) and set(ids.values()) == {1}
        elif name == "decontamination":
            leaked = {r["doc_id"] for r in decontaminate.contaminated(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
            assert set(ids) == before - leaked
        elif name == "mixing":
            assert set(ids) == before
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == docs.count() and {"shard", "slot"} <= set(last.columns)


def _kept_of_groups(rows):
    """Smallest id of each group: fingerprints within two bits or 0.8 of the five-word shingles, by all pairs."""
    parts = [near_dedup.words_of(r["text"]) for r in rows]
    prints = [near_dedup.simhash(p) for p in parts]
    shingles = [{tuple(p[i:i + 5]) for i in range(max(1, len(p) - 4))} if p else set() for p in parts]
    root = [r["doc_id"] for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            shared = len(shingles[i] & shingles[j])
            near = ((prints[i] ^ prints[j]) % 2**64).bit_count() <= 2 or (
                shared and shared >= 0.8 * (len(shingles[i]) + len(shingles[j]) - shared) - 1e-9)
            if near and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return set(root)


def test_run_applies_the_stages_in_order(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_take_awkward_and_empty_documents(spark):
    for docs in (awkward(spark), empty(spark)):
        rows = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert out.count() <= max(rows, 0) or name == "mixing"
            if name != "sharding":
                assert out.columns == docs.columns
    kept = corpus_pipeline.near_dedup_stage(spark, awkward(spark), SMALL)
    assert kept.where("doc_id = 3").count() == 1 and kept.where("doc_id IN (4, 5, 9)").count() == 1
    assert kept.where("doc_id IS NULL").count() == awkward(spark).where("doc_id IS NULL").count()


def test_missing_training_folder_leaves_the_rest(tmp_path):
    import subprocess
    import sys

    root = Path(__file__).resolve().parents[2]
    for part in ("__spark_entry__.py", "asphalt"):
        (tmp_path / part).symlink_to(root / part) if part.endswith(".py") else _without_llm(root / part, tmp_path / part)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*[n for n in e.queries() if n == 'pipeline' or n[:2] == 'op' and n[2].isdigit()], len(e.queries()) > 80)"],
                          cwd=tmp_path, capture_output=True, text=True, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"})
    assert said.stdout.split() == ["True"], said.stderr


def _without_llm(source, target):
    target.mkdir()
    for part in source.iterdir():
        if part.name not in ("llm", "__pycache__"):
            (target / part.name).symlink_to(part)
