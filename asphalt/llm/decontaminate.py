"""Benchmark decontamination: rare word n-grams as seeds, alignment as the proof.

Every document is read once for the word n-grams that it shares with a test
item. Four words in a row are a seed however many documents hold them, as a
passage that very many documents copy has to be found as well. Copies of short
items that are edited a lot keep no four words together, so those items have
three-word seeds too; these are counted over all documents and the rare ones
seed by themselves, common ones if a document has two of an item.
The text around the seeds of an item is then aligned with the item by
Smith-Waterman on words, so copies with replaced, added or dropped words score
by what they share. The benchmark is worked through in blocks, so all
that tasks hold of it is bounded; no pairs are made that share no seed.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asphalt.llm.batches import text_batches
from asphalt.session import materialise

SEED_WORDS = 4
SHORT_WORDS = 3  # of the seeds that are added
SHORT_ITEM = 28  # for items of fewer words
RARE_SHARE = 1e-3  # of the documents may hold a short n-gram that is a seed by itself, or
RARE_FLOOR = 10  # so many, if that is more
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, 1
BLOCK_ITEMS = 20_000
BLOCK_WORDS = 2_000_000

words_of = re.compile(r"\w+").findall


def grams(words: list[str], n: int = SEED_WORDS) -> list[str]:
    """Word n-grams joined by spaces; a shorter text is one n-gram itself."""
    if len(words) < n:
        return [" ".join(words)] if words else []
    return [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment of two word sequences: (score, first and last+1 aligned word of the passage).

    The score is divided by that of the item with itself. Of equal scores the
    first in the passage counts. A row is computed at once: running maxima give
    what gaps along the passage carry on.
    """
    columns = np.arange(len(passage) + 1, dtype=np.int64)
    row, start = np.zeros(len(passage) + 1, dtype=np.int64), columns.copy()
    best, best_from, best_to = 0, 0, 0
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, MISMATCH)
        above = row[1:] - GAP
        take = diagonal >= above
        reached = np.concatenate(([0], np.maximum(np.maximum(diagonal, above), 0)))
        begins = np.concatenate(([0], np.where(take, start[:-1], start[1:])))
        begins = np.where(reached > 0, begins, columns)
        carried = reached + GAP * columns
        top = np.maximum.accumulate(carried)
        source = np.maximum.accumulate(np.where(carried == top, columns, 0))
        row = top - GAP * columns
        start = begins[source]
        at = int(row.argmax())
        if row[at] > best:
            best, best_from, best_to = int(row[at]), int(start[at]), at
    return best / (MATCH * max(1, len(item))), best_from, best_to


def seeds(words: list[str]) -> set[str]:
    """The n-grams by which an item is found."""
    found = set(grams(words))
    return found | set(grams(words, SHORT_WORDS)) if SEED_WORDS <= len(words) < SHORT_ITEM else found


@dataclass
class Block:
    """A bounded part of the benchmark as words and n-grams."""

    items: dict[int, list[str]]

    def seeds(self) -> set[str]:
        return {g for words in self.items.values() for g in seeds(words)}


def blocks(benchmark: DataFrame, id_column: str, text_column: str, size: int = BLOCK_ITEMS) -> Iterator[Block]:
    """The benchmark's items in blocks of bounded rows and words; items without a word are left out."""
    held: dict[int, list[str]] = {}
    count = 0
    for row in benchmark.select(id_column, text_column).distinct().toLocalIterator():
        words = words_of(row[1].lower()) if row[1] else []
        if row[0] is None or not words:
            continue
        if held and (len(held) >= size or count + len(words) > BLOCK_WORDS or row[0] in held):
            yield Block(held)
            held, count = {}, 0
        held[row[0]] = words
        count += len(words)
    if held:
        yield Block(held)


def _found(docs: DataFrame, block: Block) -> DataFrame:
    """Documents that share an n-gram with the block: (doc_id, text, found: n-grams)."""
    spark = docs.sparkSession
    by_words: dict[int, set[tuple[str, ...]]] = defaultdict(set)
    for g in block.seeds():
        parts = tuple(g.split(" "))
        by_words[len(parts)].add(parts)
    shared = spark.sparkContext.broadcast(dict(by_words))  # bounded by BLOCK_WORDS

    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for texts in batches:
            rows = []
            for text in texts:
                hits: set[str] = set()
                words = words_of(text.lower()) if text else []
                for n, wanted in known.items():
                    hits.update(" ".join(g) for g in zip(*(words[i:] for i in range(n))) if g in wanted)
                rows.append(sorted(hits) or None)
            yield pd.Series(rows, dtype=object)

    return docs.withColumn("found", found(F.col("text"))).where(F.col("found").isNotNull())


def seeded(found: list[str], holders: dict[str, list[int]], common: set[str]) -> dict[int, set[str]]:
    """Items that a document's n-grams give reason to align: item -> shared n-grams.

    One is reason enough unless it is short and common; two of an item are always.
    """
    shared: dict[int, set[str]] = defaultdict(set)
    for g in found:
        for item in holders[g]:
            shared[item].add(g)
    return {i: own for i, own in shared.items() if not own <= common or len(own) > 1}


def matches(text: str, items: dict[int, list[str]], wanted: dict[int, set[str]], least: float) -> list[tuple]:
    """Aligned items of one text: (item, score, first word, last word + 1), the best passage of each item."""
    if not wanted:
        return []
    words = words_of(text.lower())
    holders: dict[str, list[int]] = defaultdict(list)
    for item, own in wanted.items():
        for g in own:
            holders[g].append(item)
    spots: dict[int, list[int]] = defaultdict(list)
    for n in {g.count(" ") + 1 for g in holders}:
        for at, g in enumerate(zip(*(words[i:] for i in range(n)))):
            for item in holders.get(" ".join(g), ()):
                spots[item].append(at)
    ids: dict[str, int] = {}
    coded = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    result = []
    for item, places in sorted(spots.items()):
        own = items[item]
        target = np.array([ids.get(w, -1) for w in own], dtype=np.int64)
        reach, best = 2 * len(own), (0.0, 0, 0)
        stretches: list[list[int]] = []
        for at in sorted(places):
            low, high = max(0, at - reach), min(len(words), at + reach)
            if stretches and low <= stretches[-1][1]:
                stretches[-1][1] = high
            else:
                stretches.append([low, high])
        for low, high in stretches:
            found, first, last = align(target, coded[low:high])
            if found > best[0]:
                best = (found, low + first, low + last)
        if best[0] >= least:
            result.append((item, *best))
    return result


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", min_score: float = MIN_SCORE, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Pairs of a document and a test item that it copies: (doc_id, item_id, score, first_word, last_word).

    ``score`` is the alignment's share of a whole copy's, at least
    ``min_score``; words of the passage are counted from 0, the last exclusive.
    Null and empty texts match nothing; items without id or word are left out.
    Repeated documents give repeated rows. Other columns are ignored; an empty
    table on either side gives an empty result. Of an item's equally good
    passages the first counts. Very long texts are aligned around seeds only.
    """
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    item_kind = dict(benchmark.dtypes)[item_column]
    schema = f"doc_id {dict(docs.dtypes)[id_column]}, item_id {item_kind}, score double, first_word long, last_word long"
    result, documents = spark.createDataFrame([], schema), None
    for block in blocks(benchmark, item_column, item_text, block_items):
        documents = rows.count() if documents is None else documents
        candidates = materialise(_found(rows, block))
        counts = candidates.select(F.explode("found").alias("g")).where(
            F.size(F.split("g", " ")) == SHORT_WORDS).groupBy("g").agg(F.count("*").alias("n"))
        rare = max(RARE_FLOOR, int(RARE_SHARE * documents))
        common = {r["g"] for r in counts.where(F.col("n") > rare).collect()}  # the block's n-grams at most
        holders: dict[str, list] = defaultdict(list)
        for item, words in block.items.items():
            common -= {" ".join(words)}  # a whole item is a seed however common
            for g in seeds(words):
                holders[g].append(item)
        shared = spark.sparkContext.broadcast((block.items, dict(holders), common))  # bounded by BLOCK_WORDS

        @F.pandas_udf(f"array<struct<item_id: {item_kind}, score: double, first_word: long, last_word: long>>")
        def aligned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            items, *known = shared.value
            for texts, found in batches:
                yield pd.Series([
                    [dict(zip(("item_id", "score", "first_word", "last_word"), m))
                     for m in matches(t, items, seeded(f, *known), min_score)] for t, f in zip(texts, found)
                ], dtype=object)

        hits = candidates.select("doc_id", F.explode(aligned("text", "found")).alias("m")).select("doc_id", "m.*")
        result = result.unionByName(hits)
    return result


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that copy no test item, with all their columns."""
    leaked = contaminated(docs, benchmark, **options).select("doc_id").distinct()
    key = F.col(f"docs.{options.get('id_column', 'doc_id')}")
    return docs.alias("docs").join(leaked.alias("leaked"), key.eqNullSafe(F.col("leaked.doc_id")), "left_anti")
