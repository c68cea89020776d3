"""Document fingerprints: threshold-scaled sketches of word shingles.

A fingerprint holds every shingle hash below a fixed part of the hash range. So
the same shingle is in all fingerprints or in none, fingerprints of parts merge
by union, and the shared part of two fingerprints estimates resemblance and
containment however unequal the documents are. A text none of whose hashes is
that small keeps its smallest, so that short texts can still be compared.

Everything is built-in functions. A shingle's hash is built from the hashes of
its words, which spares joining strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asphalt.llm.columns import packed

WORDS = 5
SCALE = 8  # one hash of so many is kept
BUCKET_ROWS = 2_000
# Bounds of neighbouring ids reach the driver, this many at most; beyond, ranges grow.
MAX_BUCKETS = 65_536
_RANGE = 1 << 63


def sketch(text: Column, words: int = WORDS, scale: int = SCALE) -> Column:
    """Sorted distinct kept shingle hashes of a text, as unsigned 63-bit numbers.

    Words are lower-case and split at white space. Texts of fewer words are one
    shingle; without a word the fingerprint is empty. A null text counts as empty.
    """
    parts = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\r\\f\\x0B]+"), lambda w: w != "")
    hashed = F.transform(parts, lambda w: F.xxhash64(w))

    def hashes(h: Column) -> Column:
        rolled = F.transform(
            F.sequence(F.lit(0), F.size(h) - words),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)]).bitwiseAND(F.lit(_RANGE - 1)))
        return F.when(F.size(h) >= words, rolled).when(
            F.size(h) > 0, F.array(F.xxhash64(F.concat_ws(" ", F.transform(h, lambda x: x.cast("string")))).bitwiseAND(F.lit(_RANGE - 1)))
        ).otherwise(F.array().cast("array<long>"))

    def kept(h: Column) -> Column:
        small = F.filter(h, lambda x: x < F.lit(_RANGE // scale))
        return F.when((F.size(small) > 0) | (F.size(h) == 0), F.array_sort(F.array_distinct(small))).otherwise(
            F.array(F.array_min(h)))

    # a one-element array hands each step's result to the next once
    return F.transform(F.transform(F.array(hashed), hashes), kept)[0]


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Fingerprint of two parts together."""
    both = F.array_sort(F.array_union(a, b))
    small = F.filter(both, lambda x: x < F.lit(_RANGE // scale))
    return F.when(F.size(small) > 0, small).otherwise(F.slice(both, 1, 1))


def _shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)).cast("double")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of all shingles that both have; 1 for two texts without a word."""
    shared = _shared(a, b)
    total = F.size(a) + F.size(b) - shared
    return F.when(total > 0, shared / total).otherwise(F.lit(1.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 if ``a`` has none."""
    return F.when(F.size(a) > 0, _shared(a, b) / F.size(a)).otherwise(F.lit(1.0))


def as_text(sketched: Column) -> Column:
    """Kept hashes as hexadecimal numbers with a comma between."""
    return F.array_join(F.transform(sketched, lambda h: F.lower(F.hex(h))), ",")


def fingerprints(docs: DataFrame, text_column: str = "text", words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """All rows with ``fingerprint`` (array of longs); a column of that name is replaced."""
    return docs.withColumn("fingerprint", sketch(F.col(text_column), words, scale))


def _bounds(ids: DataFrame, rows: int) -> tuple[list[int], int | None]:
    """Ids that split the table into ranges of about ``BUCKET_ROWS`` rows, each the last of its range; the largest id."""
    buckets = min(MAX_BUCKETS, -(-rows // BUCKET_ROWS))
    shares = [i / buckets for i in range(1, buckets)]
    picked = F.percentile_approx("key", shares, max(10_000, 4 * buckets)) if shares else F.lit(None)
    found = ids.agg(picked.alias("bounds"), F.max("key").alias("top")).first()
    top = found["top"]
    return sorted({b for b in found["bounds"] or [] if b != top} | ({top} if top is not None else set())), top


def with_next(docs: DataFrame, id_column: str, values: dict[str, Column]) -> DataFrame:
    """Rows with values of the next row in descending order of ids, after the last those of the first.

    Ids are split at ids of the table into ranges of bounded rows. The row that
    follows a range's last is the highest of the range below, which visits the
    range as a guest; so text moves once and no task holds more than a range.
    Rows that share an id are ordered by their values; null ids come last.
    """
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(-_RANGE).cast("long"))
    rows = docs.select(packed(docs).alias("row"), key.alias("key"), *[c.alias(n) for n, c in values.items()])
    ids = docs.select(key.alias("key"))
    bounds, top = _bounds(ids, ids.count())
    if top is None:
        bounds, top = [0], 0
    spots = F.lit(bounds).cast("array<long>")
    # binary search: how many bounds lie below the key
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    below = F.aggregate(
        F.lit(steps).cast("array<int>"), F.lit(0),
        lambda n, step: F.when(F.coalesce(F.get(spots, n + step - 1) < F.col("key"), F.lit(False)), n + step).otherwise(n))
    homes = rows.withColumn("home", below)
    own = F.struct(F.col("home").alias("range"), F.lit(0).alias("wrapped"), F.lit(True).alias("own"))
    guest = F.struct((F.col("home") + 1).alias("range"), F.lit(0).alias("wrapped"), F.lit(False).alias("own"))
    first = F.struct(F.lit(0).alias("range"), F.lit(1).alias("wrapped"), F.lit(False).alias("own"))
    is_bound = F.get(spots, F.col("home")) == F.col("key")
    visits = F.filter(F.array(
        own, F.when(is_bound & (F.col("key") != top), guest), F.when(F.col("key") == top, first)), lambda v: v.isNotNull())
    placed = homes.select("*", F.explode(visits).alias("visit")).select("row", "key", *values, "visit.*")
    order = Window.partitionBy("range").orderBy("wrapped", F.desc("key"), *[F.xxhash64(n) for n in values])
    following = {f"next_{n}": F.lead(n).over(order) for n in values}
    return placed.select("row", "own", *values, *[c.alias(n) for n, c in following.items()]).where("own").drop("own")


def edited_pairs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    The edited form has the last half of the code points replaced by as many of
    the next document's, or by all of them if there are fewer. A null text is
    empty. Every row gives one row, repeated rows too. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = with_next(docs.select(id_column, text_column), id_column, {"text": text, "print": sketch(text)})
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), chars - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select(
        F.col("row").getField(id_column).alias("doc_id"), chars.cast("long").alias("n_chars"), edited.alias("edited"),
        "print", "next_print")
    rows = rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "print", "next_print",
        sketch(F.col("edited")).alias("edited_print"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
        containment(F.col("edited_print"), F.col("print")).alias("edited_in_text"),
    )
