"""Near-duplicate documents by SimHash, found through a byte-position index.

Two fingerprints of 64 bits that differ in at most two bits agree in at least
six of their eight bytes. The index lists fingerprints under what they hold at
byte positions. Single bytes make lists of 1/256 of all rows, so an entry of
this index holds four positional bytes: the eight positions form four pairs,
and fingerprints that agree in six bytes agree in two whole pairs at least,
hence meet in one of the six lists of each. Pairs that meet are tallied by
their shared positional bytes, those below the guaranteed minimum go, and the
rest is verified bit by bit.

A list that is longer than ``short_list`` isn't paired, as its pairs grow with
the square of its length. Its members instead name their pivots: themselves
and every value one bit away. Values that share a pivot are within two bits of
each other and any two within two bits share one, so this is exact as well; a
pivot has 65 members at most.

Edited copies differ in more bits than any byte index could guarantee a match
for. On request texts that share enough of their five-word shingles are linked
as well (``edited_copies``).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asphalt.llm.batches import text_batches
from asphalt.llm.components import components
from asphalt.llm.edited_copies import edited_links, shingle_hashes, sketch_of
from asphalt.session import materialise, read_by, scan_tasks, shuffles_dropped

MAX_BITS = 2
SHARED_BYTES = 8 - MAX_BITS
SHORT_LIST = 64
SEED = 42

_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]
_STEP = 255  # sums of that many flags fit a lane of eight bits


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []


def simhash(parts: list[bytes], words: int = 3) -> int:
    """Fingerprint of the words of a text as a signed long; 0 without words."""
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    flags = _LANES[hashes.view(np.uint8)].reshape(-1, 8)
    sums = np.add.reduceat(flags, np.arange(0, len(hashes), _STEP), axis=0)
    counts = sums.view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, words: int = 3) -> Column:
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(words_of(t), words) for t in texts], dtype="int64")

    return fingerprint(text)


def signature_column(text: Column, words: int = 3) -> Column:
    """Fingerprint, number of distinct five-word shingles and their sketch."""
    @F.pandas_udf("value long, size int, tokens array<long>")
    def signature(texts: pd.Series) -> pd.DataFrame:
        found = []
        for t in texts:
            parts = words_of(t)
            hashes = shingle_hashes(parts)
            found.append((simhash(parts, words), len(hashes), sketch_of(hashes)))
        return pd.DataFrame(found, columns=["value", "size", "tokens"])

    return signature(text)


def _byte(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(F.lit(255))


def shared_bytes(a: Column, b: Column) -> Column:
    """The tally: at how many of the eight positions both hold the same byte."""
    return sum(((_byte(a, i) == _byte(b, i)).cast("int") for i in range(8)), F.lit(0))


def postings(fingerprints: DataFrame, column: str) -> DataFrame:
    """Index entries (entry, positional bytes, fingerprint): six of each fingerprint."""
    pairs = [F.shiftrightunsigned(F.col(column), 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    entries = [
        F.struct(F.lit(n).alias("entry"), F.shiftleft(pairs[i], 16).bitwiseOR(pairs[j]).alias("bytes"))
        for n, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return fingerprints.select(F.explode(F.array(*entries)).alias("e"), F.col(column)).select("e.entry", "e.bytes", column)


def linked(fingerprints: DataFrame, column: str, short_list: int = SHORT_LIST, tasks: int | None = None) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within two bits of each other."""
    entries = postings(fingerprints, column)
    sizes = entries.groupBy("entry", "bytes").agg(F.count("*").alias("members")).where("members > 1")
    listed = read_by(materialise(entries.join(sizes, ["entry", "bytes"])), tasks)

    short = listed.where(F.col("members") <= short_list).drop("members")
    a = short.withColumnRenamed(column, "a")
    b = short.withColumnRenamed(column, "b")
    pairs = (
        a.join(b, ["entry", "bytes"]).where(F.col("a") < F.col("b"))
        .where(shared_bytes(F.col("a"), F.col("b")) >= SHARED_BYTES)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
        .select("a", "b")
    )

    crowded = listed.where(F.col("members") > short_list).select(column).distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    pivots = crowded.select(F.col(column), F.explode(flips).alias("flip")).select(
        column, F.col(column).bitwiseXOR(F.col("flip")).alias("pivot"))
    met = pivots.groupBy("pivot").agg(F.sort_array(F.collect_list(column)).alias("all")).where(F.size("all") > 1)
    stars = met.select(F.col("all")[0].alias("a"), F.explode("all").alias("b")).where("a != b")
    return pairs.unionByName(stars)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, short_list: int = SHORT_LIST,
    similarity: float | None = None,
) -> DataFrame:
    """Fingerprint and group of every row: (doc_id, fingerprint, component_id, links).

    Links join fingerprints within two bits; a group is what links reach, named
    by its smallest id. ``links`` counts the rows of the group besides this one.
    A null text counts as empty; texts without a word have fingerprint zero and
    are linked like any other. Repeated rows stay and share their group. A row
    whose id is null stays; its group is null only if no member has an id.
    Other columns are ignored. An empty table gives an empty result.

    With ``similarity`` links also join texts that share that part of their
    five-word shingles.
    """
    text_batches(docs.sparkSession)
    text = F.col(text_column)
    tasks = scan_tasks(docs)
    with shuffles_dropped(docs.sparkSession):
        if similarity is None:
            rows = materialise(docs.select(F.col(id_column).alias("doc_id"), fingerprint_column(text, words).alias("value")))
        else:
            signed = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("key"), signature_column(text, words).alias("s"))
            rows = materialise(signed.select("doc_id", "key", "s.*"))
        values = read_by(materialise(rows.groupBy("value").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))), tasks)
        links = linked(values.select("value"), "value", short_list, tasks)
        if similarity is not None:
            sketches = read_by(materialise(rows.where("size > 0").groupBy("key").agg(*[F.first(c).alias(c) for c in ("value", "size", "tokens")])), tasks)
            links = edited_links(sketches, docs.select(F.xxhash64(text).alias("key"), text.alias("text")), links, similarity)
        roots = components(links, "a", "b")
    placed = values.join(roots.withColumnRenamed("node", "value"), "value", "left").withColumn(
        "root", F.coalesce("root", "value"))
    groups = placed.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("rows").alias("size"))
    groups = placed.select("value", "root").join(groups, "root").select("value", "component_id", "size")
    return rows.select("doc_id", "value").join(groups, "value").select(
        "doc_id", F.lpad(F.lower(F.hex("value")), 16, "0").alias("fingerprint"), "component_id",
        (F.col("size") - 1).alias("links"))
