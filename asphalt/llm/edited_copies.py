"""Links between texts that share most of their five-word shingles.

Every text has a sketch: of its distinct shingle hashes those below a limit that
leaves about ``SKETCH`` of them, whatever its length. Hashes of a shorter text
have the larger limit, so what two texts share below the smaller limit is in
both sketches. Texts of up to ``SKETCH`` shingles keep all.

Sketch hashes are counted over all texts and put in order of rarity. Two texts
that share at least a given part of their sketches share one of the rarest
hashes of each, as many as the other part and one more: only these are listed.
So common passages stay out of the lists unless a text has little else.

A sampled sketch has to allow for chance, so it takes more of the rarest than
the similarity alone would ask for. Texts that come to common hashes that way
are listed again by all their shingles, where no such allowance is needed.

A list isn't paired. Members of a short one are compared with the likeliest of a
few pivots first, the same few for lists with the same members; links merge, and
then only members that still are in different groups meet.

A long list is a crowd around common shingles, where most pairs are somewhat
alike. Its members are compared with each of a few pivots on all shingles. Then they
are listed again under what tells them from the most central pivot, their rarest
differences first: texts of which one isn't alike to the pivot can only be alike
if they differ from it in the same way to a known extent. That loses no pair,
and what is just theirs keeps most texts out of these lists.

Candidates whose sketches disagree too much go; the others are verified on all
shingles. Shingles are compared by 32-bit hashes, two of which in a pair of
400 shingles are equal by chance once in 25,000 pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asphalt.llm.components import components
from asphalt.session import broadcast_if_small, materialise, read_by, scan_tasks

WORDS = 5
SKETCH = 64
# A sampled sketch shares less than this part of itself with that of a text alike to 0.8 about once in 20,000 pairs.
SHARED = 0.6
PIVOTS = 16  # of a list with more members
CENTRES = 4  # pivots of a long list, of which one is the centre
COMMON = 64  # a hash that more texts share is left to the listing by all shingles
# Broadcasts pass through the driver, which builds them, so they are kept well below what its heap has left.
KEY_BYTES = 2 << 20
ARRAY_BYTES = 256 << 10  # counted by the column type: arrays of numbers take some fifty times as much
LOOSE = 0.2  # sketches may look less alike than the texts by so much
SEED = 42
_HALF = 1 << 63


def shingle_hashes(parts: list[bytes], words: int = WORDS) -> np.ndarray:
    """Distinct hashes of the runs of ``words`` words, sorted; fewer words are one run, none give none."""
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    own = np.array([digest(p, SEED) for p in parts], dtype=np.uint64)
    run = min(words, len(own))
    mixed = np.zeros(len(own) - run + 1, dtype=np.uint64)
    for i in range(run):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + own[i:len(own) - run + 1 + i]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return np.unique((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(1))


def sketch_of(hashes: np.ndarray) -> np.ndarray:
    """The hashes below the limit of a text that has so many."""
    if len(hashes) <= SKETCH:
        return hashes.view(np.int64)
    return hashes[:np.searchsorted(hashes, np.uint64(_HALF * SKETCH // len(hashes)))].view(np.int64)


def _limit(size: Column) -> Column:
    return F.when(size <= SKETCH, F.lit(_HALF - 1)).otherwise(F.floor(F.lit(float(_HALF)) * SKETCH / size).cast("long"))


def shingles_column(text: Column) -> Column:
    """All distinct shingles of a text as 32-bit hashes."""
    @F.pandas_udf("array<int>")
    def shingles(texts: pd.Series) -> pd.Series:
        hashed = (shingle_hashes(t.encode("utf-8", "replace").lower().split() if t else []) for t in texts)
        return pd.Series([np.unique(h.astype(np.uint32)).view(np.int32) for h in hashed], dtype=object)

    return shingles(text)


def _likeness(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return shared / F.greatest(F.size(a) + F.size(b) - shared, F.lit(1.0))


def listed(sketches: DataFrame, similarity: float, sampled: bool = True) -> DataFrame:
    """Texts under their rarest hashes that other texts have too: (token, members, key).

    ``members`` counts the texts that have the hash. Without ``sampled`` the
    tokens are all shingles of a text.
    """
    entries = sketches.select("key", "size", F.size("tokens").alias("of"), F.explode("tokens").alias("token"))
    counts = entries.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    common = entries.join(counts, "token").groupBy("key", "size", "of").agg(
        F.sort_array(F.collect_list(F.struct("members", "token"))).alias("common"))  # of one text
    # Hashes that no other text has are the rarest; they take their places without being listed.
    part = F.lit(similarity)
    if sampled:
        part = F.when(F.col("size") <= SKETCH, part).otherwise(F.lit(SHARED * similarity / 0.8))
    places = F.col("of") - F.ceil(F.col("of") * part - 1e-9).cast("int") + 1 - (F.col("of") - F.size("common"))
    rarest = common.where(places > 0).select("key", F.explode(F.slice("common", F.lit(1), places)).alias("c"))
    return rarest.select("c.token", "c.members", "key")


def _all_listed(sketches: DataFrame, docs: DataFrame, similarity: float, tasks: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lists (token, key) that bring together any two texts that may be alike, short ones and long ones.

    The third table holds all shingles (key, size, tokens) of the texts in long lists, and of some others.
    """
    first = read_by(materialise(listed(sketches, similarity)), tasks)
    crowded = broadcast_if_small(read_by(materialise(first.where(F.col("members") > COMMON).select("key").distinct()), tasks), KEY_BYTES)
    short = first.where(F.col("members") <= COMMON).select("token", "key")
    whole = docs.join(crowded, "key", "left_semi").select("key", shingles_column(F.col("text")).cast("array<long>").alias("all"))
    whole = read_by(materialise(whole.groupBy("key").agg(F.first("all").alias("tokens"))), tasks).withColumn("size", F.size("tokens"))
    again = read_by(materialise(listed(whole, similarity, sampled=False).select("token", "key")), tasks)
    lengths = read_by(materialise(again.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")), tasks)
    met = again.join(lengths, "token")
    few = met.where(F.col("members") <= PIVOTS).select("token", "key")
    return short.unionByName(few), read_by(materialise(met.where(F.col("members") > PIVOTS).select("token", "key")), tasks), whole


def _pivots(lists: DataFrame) -> DataFrame:
    """Some members of every list, the same for lists with the same members: (token, pivots)."""
    seeded = [F.min(F.struct(F.xxhash64("key", F.lit(i)), F.col("key").alias("key")))["key"] for i in range(PIVOTS)]
    stars = lists.groupBy("token").agg(F.count("*").alias("members"), F.array_distinct(F.array(*seeded)).alias("pivots")).where("members > 1")
    return stars.select("token", F.when(F.col("members") > PIVOTS, F.col("pivots")).otherwise(F.slice("pivots", 1, 1)).alias("pivots"))


def _beside_pivots(homes: DataFrame, whole: DataFrame, tasks: int | None = None) -> DataFrame:
    """All shingles of pivots and members (pivot, key): (pivot, key, size, tokens, pivot_size, pivot_tokens)."""
    homes = read_by(materialise(homes.where("pivot != key").distinct()), tasks)
    asked = broadcast_if_small(read_by(materialise(homes.select("pivot").distinct()), tasks), KEY_BYTES)
    of_pivots = read_by(materialise(whole.join(asked, F.col("key") == F.col("pivot")).select(
        "pivot", F.col("size").alias("pivot_size"), F.col("tokens").alias("pivot_tokens"))), tasks)
    return homes.join(whole, "key").join(broadcast_if_small(of_pivots, ARRAY_BYTES), "pivot")


def _alike(shared: Column, size_a: Column, size_b: Column, similarity: float) -> Column:
    return shared * (1 + similarity) >= (size_a + size_b) * similarity - 1e-9


def _long_stars(lists: DataFrame, whole: DataFrame, similarity: float, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of long lists' members with their pivots, and the most central pivot of each member's lists (pivot, key)."""
    stars = read_by(materialise(_pivots(lists).select("token", F.slice("pivots", 1, CENTRES).alias("pivots"))), tasks)
    compared = _beside_pivots(lists.join(stars, "token").select(F.explode("pivots").alias("pivot"), "key"), whole, tasks)
    shared = F.size(F.array_intersect("tokens", "pivot_tokens"))
    compared = read_by(materialise(compared.select("pivot", "key", "size", "pivot_size", shared.alias("shared"))), tasks)
    found = compared.where(_alike(F.col("shared"), F.col("size"), F.col("pivot_size"), similarity))
    central = compared.groupBy("pivot").agg(F.avg(F.col("shared") / (F.col("size") + F.col("pivot_size"))).alias("central"))
    best = stars.select("token", F.explode("pivots").alias("pivot")).join(central, "pivot").groupBy("token").agg(
        F.max_by("pivot", F.struct("central", "pivot")).alias("pivot"))
    return found.select(F.col("pivot").alias("a"), F.col("key").alias("b")), lists.join(best, "token").select("pivot", "key")


def _apart_in_long_lists(homes: DataFrame, whole: DataFrame, rooted: DataFrame, similarity: float, tasks: int | None = None) -> DataFrame:
    """Links (a, b) between different groups of a pivot's members; ``rooted`` has their groups (key, root).

    Two texts differ by what one of their differences from the pivot has and the
    other hasn't. If one of them isn't alike to the pivot, they can be alike only
    if the differences share something: half of what both sizes exceed the
    allowed difference by. So differences are listed under their rarest tokens
    instead of texts, and a meeting counts only if what follows the token in
    both is enough.
    """
    part = (1 - similarity) / (1 + similarity)  # of both sizes is the largest difference of alike texts
    split = rooted.join(homes.distinct(), "key").groupBy("pivot").agg(F.count_distinct("root").alias("groups")).where("groups > 1")
    homes = homes.distinct().join(split.select("pivot"), "pivot", "left_semi")
    beside = _beside_pivots(homes, whole, tasks).join(rooted, "key")
    other = F.concat(F.array_except("tokens", "pivot_tokens"), F.array_except("pivot_tokens", "tokens"))
    unlike = read_by(materialise(beside.select("pivot", "key", "root", "size", other.alias("other")).withColumn("of", F.size("other"))), tasks)
    least = unlike.groupBy("pivot").agg(F.min("of").alias("least"))
    entries = unlike.select("pivot", "key", F.explode("other").alias("token"))
    counts = entries.groupBy("pivot", "token").agg(F.count("*").alias("members")).where("members > 1")
    common = entries.join(counts, ["pivot", "token"]).groupBy("pivot", "key").agg(
        F.sort_array(F.collect_list(F.struct("members", "token"))).alias("common"))  # of one text
    told = unlike.drop("other").join(common, ["pivot", "key"]).join(least, "pivot")
    allowed = F.col("size") * part * (1 + 1 / similarity)
    need = F.greatest(F.lit(1), F.ceil((F.col("of") + F.col("least") - allowed) / 2 - 1e-9).cast("int"))
    places = F.size("common") - need + 1
    rarest = told.where(places > 0).select(
        "pivot", "key", "root", "size", "of", F.size("common").alias("shared"), F.posexplode(F.slice("common", F.lit(1), places)).alias("place", "c"))
    lists = read_by(materialise(rarest.select("pivot", "c.token", "key", "root", "size", "of", (F.col("shared") - F.col("place")).alias("rest"))), tasks)
    apart = _outside(lists, ["pivot", "token"], tasks)
    x = apart.select("pivot", "token", *[F.col(c).alias(f"x_{c}") for c in ("key", "root", "size", "of", "rest", "outside")])
    sizes = F.least("x_size", "size") >= F.greatest("x_size", "size") * similarity - 1e-9
    enough = 2 * F.least("x_rest", "rest") >= F.col("x_of") + F.col("of") - (F.col("x_size") + F.col("size")) * part - 1e-9
    once = ~F.col("outside") | (F.col("x_key") < F.col("key"))
    met = x.where("x_outside").join(apart, ["pivot", "token"]).where((F.col("x_root") != F.col("root")) & once & sizes & enough)
    pairs = read_by(materialise(met.select(F.least("x_key", "key").alias("a"), F.greatest("x_key", "key").alias("b")).distinct()), tasks)
    a, b = (whole.select(F.col("key").alias(c), F.col("size").alias(f"size_{c}"), F.col("tokens").alias(f"tokens_{c}")) for c in "ab")
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return pairs.join(a, "a").join(b, "b").where(_alike(shared, F.col("size_a"), F.col("size_b"), similarity)).select("a", "b")


def _outside(rooted: DataFrame, by: list[str], tasks: int | None = None) -> DataFrame:
    """Members of lists that have several groups, and whether they are outside the list's largest one."""
    groups = rooted.groupBy(*by, "root").agg(F.count("*").alias("n")).groupBy(*by).agg(
        F.max_by("root", F.struct("n", "root")).alias("largest"), F.count("*").alias("groups")).where("groups > 1")
    return read_by(materialise(rooted.join(groups, by).withColumn("outside", F.col("root") != F.col("largest")).drop("largest", "groups")), tasks)


def _candidates(pairs: DataFrame, sketches: DataFrame, similarity: float, tasks: int | None = None) -> DataFrame:
    """Pairs that their sizes and sketches don't rule out: (a, b, likely)."""
    pairs = read_by(materialise(pairs.distinct()), tasks)
    asked = broadcast_if_small(read_by(materialise(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()), tasks), KEY_BYTES)
    own = broadcast_if_small(read_by(materialise(sketches.join(asked, "key", "left_semi").select("key", "size", "tokens")), tasks), ARRAY_BYTES)
    a, b = (own.select(F.col("key").alias(c), F.col("size").alias(f"size_{c}"), F.col("tokens").alias(f"tokens_{c}")) for c in "ab")
    sizes = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * similarity - 1e-9
    met = pairs.join(a, "a").join(b, "b").where(sizes).withColumn("limit", F.least(_limit(F.col("size_a")), _limit(F.col("size_b"))))
    below = [F.filter(f"tokens_{c}", lambda t: t < F.col("limit")) for c in "ab"]
    whole = F.greatest("size_a", "size_b") <= SKETCH
    likely = _likeness(*below)
    return met.select("a", "b", "size_a", "size_b", likely.alias("likely"), whole.alias("whole")).where(
        F.col("likely") >= F.when(F.col("whole"), similarity - 1e-9).otherwise(similarity - LOOSE))


def _verified(pairs: DataFrame, docs: DataFrame, similarity: float, tasks: int | None = None) -> DataFrame:
    """Pairs (a, b) of text keys that share ``similarity`` of all their shingles; ``docs`` has (key, text)."""
    pairs = read_by(materialise(pairs.select("a", "b", "whole")), tasks)
    open_pairs = pairs.where("NOT whole").select("a", "b")
    wanted = broadcast_if_small(read_by(materialise(open_pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()), tasks), KEY_BYTES)
    texts = docs.join(wanted, "key", "left_semi").select("key", shingles_column(F.col("text")).alias("all"))
    sets = broadcast_if_small(read_by(materialise(texts.groupBy("key").agg(F.first("all").alias("all"))), tasks), ARRAY_BYTES)
    a, b = (sets.select(F.col("key").alias(c), F.col("all").alias(f"all_{c}")) for c in "ab")
    met = open_pairs.join(a, "a").join(b, "b").where(_likeness(F.col("all_a"), F.col("all_b")) >= similarity - 1e-9)
    return pairs.where("whole").select("a", "b").unionByName(met.select("a", "b"))


def edited_links(sketches: DataFrame, docs: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of fingerprints that together with ``links`` connect all texts alike to ``similarity``.

    ``sketches`` has one row a text (key, value, size, tokens), ``docs`` the
    texts (key, text), repeated ones too.
    """
    tasks = scan_tasks(docs)
    short, long, whole = _all_listed(sketches, docs, similarity, tasks)
    lists = read_by(materialise(short.join(_pivots(short), "token")), tasks)
    starred = lists.select(F.explode("pivots").alias("a"), F.col("key").alias("b")).where("a != b")
    likeliest = _candidates(starred, sketches, similarity, tasks).groupBy("b").agg(
        F.max_by(F.struct("a", "whole"), F.struct("likely", "a")).alias("best")).select("best.a", "b", "best.whole")
    found, homes = _long_stars(long, whole, similarity, tasks)
    found = read_by(materialise(_verified(likeliest, docs, similarity, tasks).unionByName(found)), tasks)

    values = sketches.select("key", "value")

    def renamed(pairs: DataFrame, names: DataFrame, name: str) -> DataFrame:
        a, b = (names.select(F.col("key").alias(c), F.col(name).alias(f"name_{c}")) for c in "ab")
        return pairs.join(a, "a").join(b, "b").select(F.col("name_a").alias("a"), F.col("name_b").alias("b"))

    roots = components(links.unionByName(renamed(found, values, "value")), "a", "b")
    rooted = read_by(materialise(values.join(roots.withColumnRenamed("node", "value"), "value", "left").select(
        "key", F.coalesce("root", "value").alias("root"))), tasks)
    # Members of a list's largest group meet those outside it, and these each other where their groups differ.
    split = _outside(lists.select("token", "key").join(sketches.select("key", "size"), "key").join(rooted, "key"), ["token"], tasks)
    x = split.where("outside").select("token", *[F.col(c).alias(f"x_{c}") for c in ("key", "root", "size")])
    sizes = F.least("x_size", "size") >= F.greatest("x_size", "size") * similarity - 1e-9
    once = ~F.col("outside") | (F.col("x_key") < F.col("key"))
    rest = x.join(split, "token").where((F.col("x_root") != F.col("root")) & once & sizes).select(
        F.least("x_key", "key").alias("a"), F.greatest("x_key", "key").alias("b"))
    rest = _verified(_candidates(rest, sketches, similarity, tasks), docs, similarity, tasks)
    rest = rest.unionByName(_apart_in_long_lists(homes, whole, rooted, similarity, tasks))
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(renamed(rest, rooted, "root"))
