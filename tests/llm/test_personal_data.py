import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from asphalt.llm import personal_data
from tests.llm.frames import awkward, collected, empty, table, words

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_base(text):
    """The contract's rules, character by character."""
    found = []
    for n, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 14 <= len(digits) <= 19 and plain_luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]():
                found.append((m.start(), n, m.end()))
    return sorted(found)


def base_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")
    spans = personal_data._bare(personal_data._described(personal_data._base(F.coalesce("text", F.lit("")))))
    return [[tuple(s) for s in r["s"]] for r in df.select("n", spans.alias("s")).orderBy("n").collect()]


def card(rng, n=16):
    digits = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(digits + d for d in "0123456789" if plain_luhn(digits + d))


def test_base_rules_on_random_signs(spark):
    rng = random.Random(1)
    alphabets = ["a1.@-_+ ", "01. -", "+1 ().-2x", "ab@.\u0001\u0002\u0003é", "0123456789 -+.", "é😀1@a."]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 80))) for a in alphabets for _ in range(400)]
    texts += ["a@b.c_d@e.f", "a@b.c.d..e@f.g", "x@a.b@c.d", "@a.b", "a@.b", "a@b.", "1.2.3.4.5.6.7.8", "256.1.1.1.1", "0255.1.1.001",
              "00000000000000000255.1.1.1", "😀 a@b.c", "+1 (930) 555-2361 4", "4111 1111 1111 1111", "4111-1111 1111-1111", "4111  1111 1111 1111",
              "+1 2345678901", None, ""]
    texts += [f"{card(rng, n)}{sep}{card(rng, 14)}" for n in range(13, 21) for sep in ("", " ", "-", "  ", "x", "\u0002")]
    assert base_of(spark, texts) == [plain_base(t) for t in texts]


def test_long_texts_take_time_in_proportion(spark):
    rng = random.Random(2)
    n = 200_000
    texts = ["1" * n, "a" * n, "a@" + "b." * (n // 2) + "c", "1." * (n // 2), "+" + "1 " * (n // 2), "+1" * (n // 2), "a." * (n // 2), "@" * n,
             "1 " * (n // 2), "(at)" * (n // 4), " at " * (n // 4), "a(at)b(dot)" * (n // 11), "1234 " * (n // 5),
             " ".join(f"u{i}@mail{i}.example.com {card(rng)}, 10.0.{i % 256}.7" for i in range(4_000))]
    start = time.time()
    got = base_of(spark, texts)
    # (the plain rules take the square of a text's length, so expectations are stated)
    want = {2: [(0, 0, n + 3)], 3: [(8 * i, 1, 8 * i + 7) for i in range(n // 8)]}
    assert all(g == want.get(i, []) for i, g in enumerate(got[:13]))
    assert got[13] == plain_base(texts[13]) and len(got[13]) >= 12_000
    found = personal_data.candidates(table(spark, enumerate(texts)))
    assert found.where(F.size("proposed") >= 0).count() == len(texts)
    assert time.time() - start < 100


def corpus(rng):
    """Documents with personal data that base rules see, lookalikes and some that they lose."""
    rows = []
    for i in range(1200):
        kind = i % 6
        data = [f"{words(rng, 1)}{i}@mail{i % 7}.example.com", f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.{i % 256}.9", card(rng),
                f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", "", ""][kind]
        if kind == 4:
            number = card(rng)
            data = number[:-1] + str((int(number[-1]) + 1 + i % 8) % 10)
        rows.append((i, f"{words(rng, 12)} {data} {words(rng, 8)}"))
    pair = (card(rng), card(rng))
    rows.append((5, f"{words(rng, 5)} {pair[0]} {pair[1]} {words(rng, 5)}"))  # the base rule runs on over both
    rows.append((1200, "on +1 (843) 555-7672 170.106.47.1 er"))
    return rows, pair


@pytest.fixture(scope="module")
def found(spark):
    rows, pair = corpus(random.Random(3))
    docs = table(spark, rows)
    return rows, pair, docs, collected(personal_data.span_digests(docs))


def test_digests_hold_the_base_spans(found):
    rows, _, _, got = found
    assert len(got) == len(rows)
    want = sorted(
        (i, *[sum(s[1] == k for s in plain_base(t)) for k in range(4)],
         hashlib.sha256(",".join(f"{list(RULES)[k]}:{a}:{b}" for a, k, b in plain_base(t)).encode()).hexdigest()) for i, t in rows)
    assert sorted((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == want


def test_lost_numbers_are_added_and_lookalikes_left(found):
    rows, pair, _, got = found
    spans = {}
    for r in got:
        spans.setdefault(r["doc_id"], []).append(r["spans"].split(",") if r["spans"] else [])
    merged = next(t for i, t in rows if i == 5 and pair[0] in t)
    at = merged.index(pair[0])
    assert [f"card:{at}:{at + 16}", f"card:{at + 17}:{at + 33}"] in spans[5]
    assert any(s.startswith("phone:3:20") for s in spans[1200][0]) and any(s.startswith("ip:21:") for s in spans[1200][0])
    for i, t in rows[:1200]:
        if i % 6 in (4, 5) and not plain_base(t):
            assert [] in spans[i], t
    for r in got:
        own = r["spans"].split(",") if r["spans"] else []
        keys = [(int(s.split(":")[1]), personal_data.KINDS.index(s.split(":")[0])) for s in own]
        assert keys == sorted(keys)


def test_redacted_texts(spark, found):
    rows, pair, docs, got = found
    out = personal_data.redacted(docs)
    assert out.columns == docs.columns
    texts = [r["text"] for r in out.collect()]
    assert len(texts) == len(rows) and not any(pair[0] in t or "555-" in t or "@" in t for t in texts)
    assert "on [PHONE] [IP] er" in texts


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    got = personal_data.span_digests(docs)
    assert got.count() == docs.count() and {"doc_id", "base_sha256", "spans"} <= set(got.columns)
    assert {r["base_sha256"] for r in got.collect()} == {hashlib.sha256(b"").hexdigest()}
    assert sorted(map(str, personal_data.redacted(docs).collect())) == sorted(map(str, docs.collect()))
    assert personal_data.span_digests(empty(spark)).collect() == []
    assert personal_data.redacted(empty(spark)).collect() == []


def test_masked_spans_may_overlap(spark):
    spans = "array(named_struct('start', 1, 'kind', 2, 'end', 5), named_struct('start', 3, 'kind', 3, 'end', 8), named_struct('start', 4, 'kind', 0, 'end', 6))"
    df = spark.sql(f"SELECT '😀123456789' AS t, {spans} AS s")
    assert df.select(personal_data.masked(F.col("t"), F.col("s"))).first()[0] == "😀[CARD][PHONE]89"


def test_combination_numbers_have_their_values(spark):
    df = spark.range(0, personal_data.COMBINATIONS, 97).withColumnRenamed("id", "n")
    values = personal_data._values(F.col("n").cast("int"))
    assert df.where(personal_data._number(values) != F.col("n")).count() == 0


def test_main_path_has_no_python(spark):
    docs = table(spark, corpus(random.Random(4))[0][:50])
    plan = personal_data.candidates(docs)._jdf.queryExecution().toString() + personal_data.span_digests(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
