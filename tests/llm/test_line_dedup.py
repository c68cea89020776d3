import random
from collections import defaultdict

from pyspark.sql import functions as F

from asphalt.llm import line_dedup
from tests.llm.frames import awkward, empty, table


def plain(rows):
    """First occurrences stay, by id (null last), hash of the text and position."""
    seen, covered = {}, defaultdict(set)
    for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["h"])):
        lines = (r["text"] or "").split("\n")
        for i in range(len(lines) - 2):
            mark, place = tuple(lines[i:i + 3]), (r["doc_id"], r["h"], i)
            if seen.setdefault(mark, place) != place:
                covered[r["doc_id"], r["h"]].update((i, i + 1, i + 2))
    for r in rows:
        if r["text"] is None:
            yield r["doc_id"], None, 0, 0
            continue
        lines, gone = r["text"].split("\n"), covered[r["doc_id"], r["h"]]
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        yield r["doc_id"], kept if gone else r["text"], len(lines), len(gone)


def compare(docs):
    rows = [r.asDict() for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()]
    got = line_dedup.deduplicated(docs).select("doc_id", "kept_text", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows), key=repr)


def test_awkward_rows(spark):
    docs = awkward(spark)
    compare(docs)
    assert set(docs.columns) <= set(line_dedup.deduplicated(docs).columns)


def test_random_texts_of_few_lines(spark):
    rng = random.Random(2)
    lines = ["a", "b", "c", "", "d "]
    compare(table(spark, [(rng.choice([i, None]) if i % 9 == 0 else i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(150)]))


def test_repeats_within_a_text_and_overlaps(spark):
    docs = table(spark, [(1, "a\nb\nc\na\nb\nc\nd"), (2, "x\nb\nc\nd\ny"), (3, "a\na\na\na\na")])
    got = {r["doc_id"]: r["kept_text"] for r in line_dedup.deduplicated(docs).collect()}
    # a b c | a b c: the second goes; "b c d" was first seen at the end of 1, so it goes from 2
    assert got == {1: "a\nb\nc\nd", 2: "x\ny", 3: "a"}


def test_a_passage_of_a_third_of_all_documents(spark):
    passage = "one line\ntwo line\nthree line\nfour line"
    docs = table(spark, [(i, f"start {i}\n{passage}\nend {i}" if i % 3 else f"only {i}\nmore {i}") for i in range(90)])
    got = line_dedup.deduplicated(docs)
    assert got.where("n_removed = 4").count() == 59 and got.where("kept_text LIKE '%two line%'").count() == 1


def test_empty_table_and_plan(spark):
    assert line_dedup.deduplicated(empty(spark)).collect() == []
    plan = line_dedup.deduplicated(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
