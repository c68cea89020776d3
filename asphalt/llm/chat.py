"""Preference pairs: two conversations that begin alike and end differently.

A pair's chosen and rejected conversation are compared turn by turn. Their
longest common prefix is rendered once as the prompt; what follows on each side
is that side's completion, with a mask that marks the characters of the
assistant's words, which are those to learn from.

Turns are matched by (pair, place) before anything is gathered, so only
rendered results meet in a row. Everything is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNED_ROLE = "assistant"
# The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def preference_pairs(
    turns: DataFrame, learned_role: str = LEARNED_ROLE, pair: str = "pair_id", chosen: str = "is_chosen",
    turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Rendered pairs from a table of turns, one row a pair.

    Returns ``pair_id``, ``n_prompt_turns``, ``prompt``, and of each side its
    number of turns, its completion and the spans [from, to) of characters in
    it that are learned. Turns of a side are numbered by their order; equal
    turn numbers are ordered by role and text. Turns are equal if role and text
    are, nulls too; a null role or text is rendered as empty. A pair with one
    side only has an empty common prefix and an empty completion on the other.
    Two equal conversations are all prompt. A pair becomes one row, so its turns
    have to fit one as a text does. Rows without a pair or a side are
    left out, repeated rows are turns of their own; other columns are ignored.
    """
    rows = turns.select(
        F.col(pair).alias("pair_id"), F.col(chosen).cast("boolean").alias("side"), F.col(turn).alias("turn"),
        F.col(role).alias("role"), F.col(text).alias("text")).where("pair_id IS NOT NULL AND side IS NOT NULL")
    turn_of = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    sides = rows.groupBy("pair_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("side"), turn_of))).alias("chosen"),
        F.sort_array(F.collect_list(F.when(~F.col("side"), turn_of))).alias("rejected"))
    return _rendered(sides, learned_role)


def _rendered(sides: DataFrame, learned_role: str) -> DataFrame:
    """Pairs whose sides are arrays of turns (pair_id, chosen, rejected) as prompt, completions and masks."""
    differs = F.filter(
        F.sequence(F.lit(0), F.least(F.size("chosen"), F.size("rejected"))),
        lambda i: ~(F.struct(F.get("chosen", i)["role"], F.get("chosen", i)["text"]).eqNullSafe(
            F.struct(F.get("rejected", i)["role"], F.get("rejected", i)["text"])))
        | (i == F.least(F.size("chosen"), F.size("rejected"))))
    split = sides.withColumn("common", F.array_min(differs))

    def rendered(turns: Column) -> Column:
        return F.transform(turns, lambda t: F.concat(
            _header(F.coalesce(t["role"], F.lit(""))), F.coalesce(t["text"], F.lit("")), F.lit(CLOSE)))

    def spans(turns: Column) -> Column:
        """Where the learned role's words stand, its closing mark included, by adding up lengths."""
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("found"))

        def step(state: Column, t: Column) -> Column:
            head = F.length(_header(F.coalesce(t["role"], F.lit(""))))
            body = F.length(F.coalesce(t["text"], F.lit(""))) + len(CLOSE)
            begin = state["at"] + head
            end = begin + body
            return F.struct(end.alias("at"), F.when(
                t["role"] == learned_role, F.concat(state["found"], F.array(F.array(begin, end)))
            ).otherwise(state["found"]).alias("found"))

        return F.aggregate(turns, start, step, lambda state: state["found"])

    def rest(side: str) -> Column:
        return F.slice(F.col(side), F.col("common") + 1, F.size(side))

    return split.select(
        "pair_id", F.col("common").alias("n_prompt_turns"),
        F.array_join(rendered(F.slice("chosen", F.lit(1), F.col("common"))), "").alias("prompt"),
        *[c for side in ("chosen", "rejected") for c in (
            F.size(side).alias(f"n_{side}_turns"),
            F.array_join(rendered(rest(side)), "").alias(f"{side}_completion"),
            F.array_join(F.transform(spans(rest(side)), lambda s: F.array_join(s.cast("array<string>"), "-")), ",").alias(f"{side}_mask"),
        )],
    )


def swapped_answer_pairs(
    turns: DataFrame, learned_role: str = LEARNED_ROLE, conversation: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Every conversation against itself with its last answer replaced by that of the conversation with the next id.

    Returns the columns of ``preference_pairs``, one row a conversation; ids are
    whole numbers. An answer is the last turn of the learned role; of turns that
    tie in number, role and text one is replaced. Where no conversation has the
    next id, or it has no answer, the rejected side goes without its last
    answer. A conversation without an answer is all prompt. A null answer is
    rendered as empty. Rows without an id are left out, an empty table gives an
    empty result. Turns are moved once; only last answers are moved again.
    """
    rows = turns.select(F.col(conversation).alias("pair_id"), F.struct(
        F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")).alias("t")).where("pair_id IS NOT NULL")
    whole = rows.groupBy("pair_id").agg(F.sort_array(F.collect_list("t")).alias("chosen"))
    whole = whole.withColumn("last", F.array_max(F.transform("chosen", lambda t, i: F.when(t["role"] == learned_role, i))))
    # An id is never null here; saying so keeps the join from filtering one branch, which would move the turns twice.
    before = F.coalesce(F.col("pair_id") - 1, F.lit(0))
    answers = whole.where("last IS NOT NULL").select(
        before.alias("pair_id"), F.struct(F.get("chosen", F.col("last"))["text"].alias("text")).alias("other"))
    met = whole.join(answers, "pair_id", "left")
    own = F.get("chosen", F.col("last"))
    swapped = F.struct(own["turn"].alias("turn"), own["role"].alias("role"), F.col("other.text").alias("text"))
    none = F.slice("chosen", 1, 0)
    rejected = F.concat(
        F.slice("chosen", F.lit(1), F.col("last")), F.when(F.col("other").isNotNull(), F.array(swapped)).otherwise(none),
        F.slice("chosen", F.col("last") + 2, F.size("chosen")))
    sides = met.select("pair_id", "chosen", F.when(F.col("last").isNull(), F.col("chosen")).otherwise(rejected).alias("rejected"))
    return _rendered(sides, learned_role)


ORACLE = """
WITH base AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
ends AS (SELECT conv_id, max(k) AS k FROM base WHERE role = 'assistant' GROUP BY conv_id),
answers AS (SELECT base.conv_id, base.k, text FROM base JOIN ends ON base.conv_id = ends.conv_id AND base.k = ends.k),
s AS (
  SELECT conv_id AS pair_id, TRUE AS side, k, role, text FROM base
  UNION ALL
  SELECT base.conv_id, FALSE, base.k, role, CASE WHEN a.k IS NULL THEN base.text ELSE o.text END
  FROM base LEFT JOIN answers a ON base.conv_id = a.conv_id AND base.k = a.k
    LEFT JOIN answers o ON o.conv_id = base.conv_id + 1
  WHERE a.k IS NULL OR o.conv_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY k) - 1 AS i FROM s),
m AS (
  SELECT pair_id, i, count(*) FILTER (side) AS c, count(*) FILTER (NOT side) AS r,
    max(role) FILTER (side) IS NOT DISTINCT FROM max(role) FILTER (NOT side)
      AND max(text) FILTER (side) IS NOT DISTINCT FROM max(text) FILTER (NOT side) AS same FROM n GROUP BY ALL),
f AS (
  SELECT pair_id, COALESCE(min(i) FILTER (NOT (c = 1 AND r = 1 AND same)), max(i) + 1) AS common,
    sum(c)::BIGINT AS n_c, sum(r)::BIGINT AS n_r FROM m GROUP BY pair_id),
t AS (
  SELECT n.pair_id, side, i, common, role, '<|im_start|>' || COALESCE(role, '') || chr(10) AS head,
    COALESCE(text, '') || '<|im_end|>' || chr(10) AS body FROM n JOIN f ON n.pair_id = f.pair_id),
z AS (
  SELECT *, COALESCE(sum(length(head) + length(body)) OVER (
    PARTITION BY pair_id, side, i < common ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM t),
g AS (
  SELECT pair_id,
    COALESCE(string_agg(head || body, '' ORDER BY i) FILTER (side AND i < common), '') AS prompt,
    COALESCE(string_agg(head || body, '' ORDER BY i) FILTER (side AND i >= common), '') AS chosen_completion,
    COALESCE(string_agg(head || body, '' ORDER BY i) FILTER (NOT side AND i >= common), '') AS rejected_completion,
    COALESCE(string_agg((start + length(head)) || '-' || (start + length(head) + length(body)), ',' ORDER BY i)
      FILTER (side AND i >= common AND role = 'assistant'), '') AS chosen_mask,
    COALESCE(string_agg((start + length(head)) || '-' || (start + length(head) + length(body)), ',' ORDER BY i)
      FILTER (NOT side AND i >= common AND role = 'assistant'), '') AS rejected_mask
  FROM z GROUP BY pair_id)
SELECT g.pair_id, common AS n_prompt_turns, prompt, n_c AS n_chosen_turns, chosen_completion, chosen_mask,
  n_r AS n_rejected_turns, rejected_completion, rejected_mask
FROM g JOIN f ON g.pair_id = f.pair_id
"""
