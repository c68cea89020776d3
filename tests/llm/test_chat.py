import random

from asphalt.llm import chat

SCHEMA = "pair_id long, is_chosen boolean, turn long, role string, text string, prompt string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def render(ts):
    return "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in ts)


def mask(ts):
    at, found = 0, []
    for r, t in ts:
        start = at + len(f"<|im_start|>{r or ''}\n")
        at = start + len(t or "") + len("<|im_end|>\n")
        if r == "assistant":
            found.append(f"{start}-{at}")
    return ",".join(found)


def plain(rows):
    pairs = {}
    for p, side, n, role, text in rows:
        if p is not None and side is not None:
            pairs.setdefault(p, {True: [], False: []})[side].append((n, role, text))
    for p, sides in pairs.items():
        key = lambda t: tuple((v is not None, v if v is not None else "") for v in t)
        a, b = ([(r, t) for _, r, t in sorted(sides[s], key=key)] for s in (True, False))
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        yield p, n, render(a[:n]), len(a), render(a[n:]), mask(a[n:]), len(b), render(b[n:]), mask(b[n:])


def compare(spark, rows):
    got = [tuple(r) for r in chat.preference_pairs(turns(spark, rows)).collect()]
    assert sorted(got) == sorted(plain(rows))
    return {g[0]: g for g in got}


def test_shared_prefix_is_the_prompt(spark):
    rows = [(1, True, 0, "user", "Hi"), (1, True, 1, "assistant", "Good"), (1, False, 0, "user", "Hi"), (1, False, 1, "assistant", "Bad é")]
    got = compare(spark, rows)[1]
    completion, spans = got[7], got[8]
    assert got[1] == 1 and got[2] == "<|im_start|>user\nHi<|im_end|>\n"
    start, end = map(int, spans.split("-"))
    assert completion[start:end] == "Bad é<|im_end|>\n"


def test_awkward_turns(spark):
    long = "x y " * 50_000
    compare(spark, [
        (None, True, 0, "user", "a"), (1, None, 0, "user", "a"),
        (2, True, 0, "user", "only chosen"), (3, False, 0, "assistant", ""),
        (4, True, 0, "user", "same"), (4, False, 0, "user", "same"),
        (5, True, 0, None, None), (5, False, 0, None, None), (5, True, 1, "assistant", None), (5, False, 1, "assistant", ""),
        (6, True, None, "user", "no turn"), (6, True, 1, "user", "q"), (6, False, 1, "user", "q"),
        (7, True, 0, "user", "twice"), (7, True, 0, "user", "twice"), (7, False, 0, "user", "twice"),
        (8, True, 0, "user", long), (8, False, 0, "user", long), (8, False, 1, "assistant", long),
        (9, True, 0, "user", "b"), (9, True, 0, "system", "a"), (9, False, 0, "system", "a"),
    ])


def test_random_conversations(spark):
    rng = random.Random(1)
    compare(spark, [
        (p, side, n, rng.choice(["user", "assistant"]), rng.choice("ab"))
        for p in range(60) for side in (True, False) for n in range(rng.randint(0, 5))])


def test_empty_table_and_plan(spark):
    pairs = chat.preference_pairs(turns(spark, []))
    assert pairs.collect() == []
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def plain_swapped(rows):
    """Pairs of (pair, side, turn, role, text) from turns (conversation, turn, role, text), by dictionaries."""
    whole = {}
    for c, *t in rows:
        if c is not None:
            whole.setdefault(c, []).append(tuple(t))
    key = lambda t: tuple((v is not None, v if v is not None else "") for v in t)
    for ts in whole.values():
        ts.sort(key=key)
    last = {c: max((i for i, t in enumerate(ts) if t[1] == "assistant"), default=None) for c, ts in whole.items()}
    for c, ts in whole.items():
        for i, (n, role, text) in enumerate(ts):
            yield c, True, i, role, text
            if i != last[c]:
                yield c, False, i, role, text
            elif last.get(c + 1) is not None:
                yield c, False, i, role, whole[c + 1][last[c + 1]][2]


def compare_swapped(spark, rows):
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "conv_id long, turn long, role string, text string, pair_id int, chosen string")
    got = [tuple(r) for r in chat.swapped_answer_pairs(df).collect()]
    assert sorted(got) == sorted(plain(list(plain_swapped(rows))))
    return {g[0]: g for g in got}


def test_last_answers_are_swapped(spark):
    q = [(0, "user", "q"), (1, "assistant", "a"), (2, "user", "thanks")]
    got = compare_swapped(spark, [
        *[(1, *t) for t in q], (2, 0, "user", "other"), (2, 1, "assistant", "b"), (2, 2, "assistant", "c"),
        (3, 0, "user", "no answer"), (4, 0, "assistant", None), (5, 0, "assistant", "twice"), (5, 0, "assistant", "twice"),
        (6, 0, "assistant", "twice"), (7, None, "assistant", "x"), (7, 3, None, None), (None, 0, "assistant", "lost"),
        (9, 0, "user", "x y " * 50_000), (9, 1, "assistant", "")])
    assert got[1][1] == 1 and got[1][4].startswith("<|im_start|>assistant\na<") and "\nc<" in got[1][7]
    assert (got[2][1], got[2][6]) == (2, 2)  # the next conversation has no answer
    assert got[3][1] == 1 and got[3][4] == got[3][7] == ""


def test_swapped_answers_of_random_conversations(spark):
    rng = random.Random(2)
    compare_swapped(spark, [
        (c, n, rng.choice(["user", "assistant"]), rng.choice("abc")) for c in range(80) for n in range(rng.randint(0, 5))])


def test_swapped_pairs_of_an_empty_table_and_plan(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    pairs = chat.swapped_answer_pairs(df)
    assert pairs.collect() == []
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_turns_of_swapped_pairs_move_once(spark):
    rows = [(c, n, ["user", "assistant"][n], f"{c} {n}") for c in range(50) for n in range(2)]
    pairs = chat.swapped_answer_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert len(pairs.collect()) == 50
    assert "ReusedExchange" in pairs._jdf.queryExecution().executedPlan().toString()
