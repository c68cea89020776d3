"""Small document tables with everything that may go wrong in them."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, shard int, "
          "component_id string, fingerprint string, toxicity int, language int, epoch string, kept_text int, row int, bucket int")
EXTRA = (0.5, 7, "x", "y", 1, 2, "e", 3, 4, 5)
SYLLABLES = ["on", "th", "er", "an", "re", "st", "ou", "ing", "ly", "ed", "ha", "ti"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def table(spark, rows):
    """Documents from (doc_id, text[, lang[, source]]) with columns whose names clash with those of operators."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), *EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(spark, seed=1):
    """Nulls in every column, empty and very long texts, copies, near copies and repeated rows."""
    rng = random.Random(seed)
    base, long = words(rng, 120), words(rng, 20_000)
    rows = [
        (0, ""), (1, None), (2, "a"), (None, "th er an"), (None, None), (3, long), (3, long), (4, base), (5, base), (6, base + " end"),
        (7, " \t\n "), (8, "ünï çödé ßtraße 漢字 текст"), (9, base.upper()), (10, None, None, None), (11, words(rng, 40), None, "t"),
        (12, "one\ntwo\nthree\nfour"), (13, "zero\none\ntwo\nthree\nend"), (14, "\n\n\n\n"), (15, "1234 5678"),
    ]
    rows += [(100 + i, words(rng, rng.randint(1, 60)), "en", f"s{i % 4}") for i in range(60)]
    return table(spark, rows)


def empty(spark):
    return table(spark, [])


def collected(df):
    return [r.asDict() for r in df.collect()]
