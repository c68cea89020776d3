"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent and normalised: 1 keeps
the natural mixture, 0 makes all sources equal. The exponent is bisected to the
wanted entropy, then raised as far as a limit on repetition asks for. Each
source gets its weight's part of the token budget as a stream of epochs; an
epoch is a seeded permutation of the source's blocks, the last one is cut where
the source's tokens are used up.

A source has about as many blocks as a block has rows, the square root of the
source's rows, so both the block table and a single block stay small against
the source, however large it is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asphalt.llm.columns import packed, unpacked
from asphalt.session import materialise

# Sources are named data sets: their totals reach the driver, so more than this is refused.
MAX_SOURCES = 100_000
STEPS = 60
DIGITS = 9


@dataclass(frozen=True)
class Target:
    """What the mixture has to meet.

    ``evenness`` is the wanted entropy as a part of the largest possible, ``repeats`` the epochs that no source may
    exceed, ``budget`` the tokens of the mixture. Without a budget it is the least with which no source is cut short.
    """

    evenness: float = 0.95
    repeats: float = 4.0
    budget: int | None = None


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that tells a null source from any name."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def draw(seed: int, *parts: Column) -> Column:
    """Seeded hash of 32 bits that other SQL engines can compute as well."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def tempered(tokens: list[int], exponent: float) -> list[float]:
    total = sum(tokens)
    raised = [(t / total) ** exponent if t else 0.0 for t in tokens]
    return [r / sum(raised) for r in raised]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def _bisect(meets_above: bool, meets) -> float:
    """The edge of what ``meets`` holds for between 0 and 1, on the side where it holds."""
    low, high = 0.0, 1.0
    if meets(high if not meets_above else low):
        return high if not meets_above else low
    for _ in range(STEPS):
        middle = (low + high) / 2
        if meets(middle) == meets_above:
            high = middle
        else:
            low = middle
    return high if meets_above else low


def solve(tokens: list[int], target: Target) -> tuple[float, list[float], int]:
    """Exponent, weights and budget for the sources' token counts.

    The exponent is the largest that reaches the entropy, but no smaller than
    the least that keeps to the repetition limit; 1 if a limit can't be met.
    """
    if not any(tokens):
        return 1.0, [0.0] * len(tokens), 0
    wanted = target.evenness * math.log(sum(t > 0 for t in tokens))

    def budget_of(weights: list[float]) -> int:
        if target.budget is not None:
            return target.budget
        return math.ceil(max(t / round(w, DIGITS) for t, w in zip(tokens, weights) if round(w, DIGITS) > 0))

    def repeats(weights: list[float]) -> float:
        return max(budget_of(weights) * w / t for t, w in zip(tokens, weights) if t)

    even = _bisect(False, lambda x: entropy(tempered(tokens, x)) >= wanted)
    spare = _bisect(True, lambda x: repeats(tempered(tokens, x)) <= target.repeats)
    exponent = max(even, spare)
    weights = [round(w, DIGITS) for w in tempered(tokens, exponent)]
    return exponent, weights, budget_of(weights)


def source_plan(docs: DataFrame, target: Target, source_column: str = "source", text_column: str = "text") -> list[tuple]:
    """A row for each source: (key, blocks, tokens, weight, whole epochs, tokens of the cut epoch)."""
    sums = docs.groupBy(source_key(F.col(source_column)).alias("key")).agg(
        F.count("*").alias("rows"), F.sum(token_count(F.col(text_column))).alias("tokens"))
    rows = sorted(sums.limit(MAX_SOURCES + 1).collect(), key=lambda r: r["key"])
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return planned([(r["key"], r["rows"], r["tokens"]) for r in rows], target)


def planned(sources: list[tuple[str, int, int]], target: Target) -> list[tuple]:
    """The plan for (key, rows, tokens) of the sources.

    A weight may round to 0 beside very large sources; without a budget such a source goes through once all the same.
    """
    _, weights, budget = solve([tokens for _, _, tokens in sources], target)
    plan = []
    for (key, rows, tokens), w in zip(sources, weights):
        blocks = math.isqrt(rows - 1) + 1
        if not tokens:
            plan.append((key, blocks, 0, w, 1, 0))
            continue
        granted = int(w * budget)
        if target.budget is None:
            granted = max(granted, tokens)
        plan.append((key, blocks, tokens, w, granted // tokens, granted % tokens))
    return plan


def mixed(
    docs: DataFrame, target: Target | None = None, id_column: str = "doc_id", source_column: str = "source",
    text_column: str = "text", seed: int = 3,
) -> DataFrame:
    """Rows of the mixture, each as often as its source's epochs reach it.

    Adds ``epoch`` (from 0), ``turn`` (the block's place in the epoch's
    permutation, from 1), ``block`` and ``tokens``. Within a block rows stand in
    the order of their seeded hash. Sources without a token have no weight and
    go through once, as do null sources if they have none; a null text has no
    token. Repeated rows are rows of their own. Columns with the names of the
    added ones are replaced, others stay. An empty table gives an empty result.
    """
    target = target or Target()
    spark, names = docs.sparkSession, docs.columns
    plan = source_plan(docs, target, source_column, text_column)
    sources = F.broadcast(spark.createDataFrame(  # MAX_SOURCES rows at most
        plan, "key string, blocks long, all_tokens long, weight double, whole long, rest long"))
    rows = docs.select(
        packed(docs).alias("row"), source_key(F.col(source_column)).alias("key"),
        F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    placed = rows.join(sources.select("key", "blocks"), "key").withColumns({
        "block": F.pmod(draw(seed, F.coalesce(F.col("id").cast("string"), F.lit("null"))), F.col("blocks")),
        "tokens": token_count(F.col("text")),
    })

    totals = placed.groupBy("key", "block").agg(F.sum("tokens").alias("block_tokens")).join(sources, "key")
    epochs = totals.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole")))).where(
        "epoch < whole OR rest > 0").withColumn("drawn", draw(seed, F.col("key"), F.col("epoch"), F.col("block")))
    order = Window.partitionBy("key", "epoch").orderBy("drawn", "block")
    before = F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("block_tokens")
    turns = epochs.withColumns({"turn": F.row_number().over(order).cast("long"), "start": before})
    left = F.when(F.col("epoch") == F.col("whole"), F.col("rest") - F.col("start"))
    turns = materialise(turns.select("key", "block", "epoch", "turn", "block_tokens", left.alias("left")).where("left IS NULL OR left > 0"))

    added = ["epoch", "turn", "block", "tokens"]
    entire = placed.join(turns.where("left IS NULL OR left >= block_tokens"), ["key", "block"])
    cut = placed.join(turns.where("left < block_tokens"), ["key", "block"])  # one block a source
    inside = Window.partitionBy("key", "block", "epoch").orderBy(
        draw(seed + 1, F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("epoch")), "id", F.xxhash64("text"))
    used = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = cut.withColumn("used", used).where("used <= left")
    return entire.select("row", *added).unionByName(cut.select("row", *added)).select(*unpacked(names, "row", added))


ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key,
    COALESCE(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0)::BIGINT AS tokens, text FROM documents),
s AS (SELECT key, count(*) AS n_rows, sum(tokens)::BIGINT AS tok FROM d GROUP BY key),
t AS (SELECT sum(tok)::DOUBLE AS total, ln(count(*) FILTER (tok > 0)) * 0.95 AS wanted FROM s),
p AS (SELECT key, n_rows, tok, tok / total AS share, wanted FROM s, t WHERE tok > 0),
even AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN (low + high) / 2 ELSE low END, CASE WHEN ok THEN high ELSE (low + high) / 2 END
  FROM (SELECT step, low, high, (
    SELECT -sum(w * ln(w)) FROM (SELECT pow(share, (low + high) / 2) / sum(pow(share, (low + high) / 2)) OVER () AS w FROM p)
  ) >= (SELECT wanted FROM t) AS ok FROM even WHERE step < 60)),
spare AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN low ELSE (low + high) / 2 END, CASE WHEN ok THEN (low + high) / 2 ELSE high END
  FROM (SELECT step, low, high, (
    SELECT max(b * w / tok) FROM (SELECT tok, w, ceil(max(tok / round(w, 9)) OVER ()) AS b FROM (
      SELECT tok, pow(share, (low + high) / 2) / sum(pow(share, (low + high) / 2)) OVER () AS w FROM p))
  ) <= 4.0 AS ok FROM spare WHERE step < 60)),
x AS (
  SELECT greatest(
    CASE WHEN (SELECT -sum(share * ln(share)) FROM p) >= (SELECT wanted FROM t) THEN 1.0
      ELSE (SELECT low FROM even WHERE step = 60) END,
    CASE WHEN (SELECT max(b * w / tok) FROM (SELECT tok, 1.0 / count(*) OVER () AS w,
        ceil(max(tok / round(1.0 / n, 9)) OVER ()) AS b FROM (SELECT tok, count(*) OVER () AS n FROM p))) <= 4.0 THEN 0.0
      ELSE (SELECT high FROM spare WHERE step = 60) END) AS exponent),
w AS (SELECT key, tok, round(pow(share, exponent) / sum(pow(share, exponent)) OVER (), 9) AS weight FROM p, x),
g AS (SELECT key, tok, floor(weight * max(ceil(tok / weight)) OVER ())::BIGINT AS granted FROM w),
plan AS (
  SELECT s.key, ceil(sqrt(n_rows))::BIGINT AS blocks, COALESCE(granted // g.tok, 1) AS whole, COALESCE(granted % g.tok, 0) AS rest
  FROM s LEFT JOIN g ON s.key = g.key),
placed AS (
  SELECT doc_id, source, d.key, tokens, text,
    ('0x' || substr(md5('3:' || COALESCE(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT % blocks AS block
  FROM d JOIN plan ON d.key = plan.key),
e AS (
  SELECT key, block, block_tokens, whole, rest, unnest(range(0, whole + 1)) AS epoch FROM (
    SELECT key, block, sum(tokens)::BIGINT AS block_tokens FROM placed GROUP BY key, block) JOIN plan USING (key)),
turns AS (
  SELECT *, row_number() OVER o AS turn,
    rest - (sum(block_tokens) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - block_tokens) AS remaining
  FROM (SELECT *, ('0x' || substr(md5('3:' || key || ':' || epoch || ':' || block), 1, 8))::BIGINT AS drawn
    FROM e WHERE epoch < whole OR rest > 0)
  WINDOW o AS (PARTITION BY key, epoch ORDER BY drawn, block)),
used AS (
  SELECT doc_id, source, tokens, epoch, turn, block, whole, remaining,
    sum(tokens) OVER (PARTITION BY key, block, epoch ORDER BY
      ('0x' || substr(md5('4:' || COALESCE(doc_id::VARCHAR, 'null') || ':' || epoch), 1, 8))::BIGINT, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
  FROM placed JOIN turns USING (key, block))
SELECT doc_id, source, tokens, epoch, turn, block FROM used
WHERE epoch < whole OR (remaining > 0 AND used <= remaining)
"""
