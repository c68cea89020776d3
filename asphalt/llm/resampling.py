"""Resampling documents towards a target distribution, by hashed word features.

Features are runs of words, counted in as many buckets as ``buckets`` says. A
bucket's gain is the logarithm of how much likelier it is in the target than in
the corpus, a document's weight the sum of its features' gains; Gumbel noise by
a hash of the id turns the largest scores into a weighted sample.

A feature's bucket is its CRC-32 modulo the number of buckets. The CRC is
linear: each byte contributes a value that depends on the byte and its distance
from the span's end only, and the contributions are combined by exclusive or.
So one table of byte by distance serves a whole batch: look up, then
``bitwise_xor.reduceat`` over the spans. A constant per length stands for the
initial register. Spans longer than the table are cut into blocks from their
end, which are folded one after the other by the same table.

Each pass over the texts leaves bucket sums per task, not features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asphalt.llm.batches import text_batches
from asphalt.operators.ordering import running_totals
from asphalt.session import materialise

RUN = 1  # words of the longest feature
BUCKETS = 10_000
MIN_WORDS = 20
DRAWN_PERCENT = 10
SEED = 2024

REACH = 64  # distances that the table has
CHUNK_BYTES = 1 << 19  # bytes looked up at once
GROUP_BYTES = 4 << 20  # texts taken together
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)


def _table(reach: int) -> np.ndarray:
    """Contribution of byte b at distance d from a span's end to its CRC register: row d, column b."""
    rows = np.zeros((reach, 256), dtype=np.uint32)
    value = np.arange(256, dtype=np.uint32)
    for d in range(reach):
        for _ in range(8):
            value = (value >> 1) ^ np.where(value & 1, np.uint32(_POLYNOMIAL), np.uint32(0))
        rows[d] = value
    return rows


class PositionCrc:
    """CRC-32 of many spans of one byte array."""

    def __init__(self, reach: int = REACH) -> None:
        self.reach = max(4, reach)
        self.table = _table(self.reach)
        self.flat = self.table.ravel()
        # The initial register after as many zero bytes as the index says.
        self.constants = np.zeros(self.reach + 1, dtype=np.uint32)
        register = int(_ONES)
        for length in range(self.reach + 1):
            self.constants[length] = register
            register = (register >> 8) ^ int(self.table[0][register & 255])

    def _advanced(self, register: np.ndarray) -> np.ndarray:
        """Registers after a whole block of zero bytes: their four bytes count as the block's first ones."""
        out = np.zeros_like(register)
        for k in range(4):
            out ^= self.table[self.reach - 1 - k][(register >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def _blocks(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Contributions of blocks no longer than the table, combined per block; none is empty."""
        found = np.zeros(len(starts), dtype=np.uint32)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(starts):
            until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_BYTES, side="right")))
            size, first = sizes[at:until], np.concatenate(([0], np.cumsum(sizes[at:until])))
            place = np.arange(first[-1], dtype=np.int64)
            position = place + np.repeat(starts[at:until] - first[:-1], size)
            distance = np.repeat(first[1:] - 1, size) - place
            values = self.flat[(distance << 8) + data[position]]
            found[at:until] = np.bitwise_xor.reduceat(values, first[:-1])
            at = until
        return found

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 of ``data[start:end]`` for each span, as unsigned 32-bit numbers; empty spans give 0."""
        sizes = ends - starts
        crc = np.zeros(len(starts), dtype=np.uint32)
        short = np.flatnonzero((sizes > 0) & (sizes <= self.reach))
        if len(short):
            crc[short] = self._blocks(data, starts[short], sizes[short]) ^ self.constants[sizes[short]] ^ _ONES
        long = np.flatnonzero(sizes > self.reach)
        if len(long):
            count = -(-sizes[long] // self.reach)
            head = sizes[long] - (count - 1) * self.reach
            first = np.concatenate(([0], np.cumsum(count)))
            within = np.arange(first[-1]) - np.repeat(first[:-1], count)
            block_sizes = np.where(within == 0, np.repeat(head, count), self.reach)
            block_starts = np.repeat(starts[long] + head - self.reach, count) + within * self.reach
            block_starts[first[:-1]] = starts[long]
            raw = self._blocks(data, block_starts, block_sizes)
            register = raw[first[:-1]] ^ self.constants[head]
            for step in range(1, int(count.max())):
                more = np.flatnonzero(count > step)
                register[more] = self._advanced(register[more]) ^ raw[first[more] + step]
            crc[long] = register ^ _ONES
        return crc


_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class Features:
    """Buckets of all features of a group of texts."""

    def __init__(self, run: int, buckets: int) -> None:
        self.run, self.buckets, self.crc = run, buckets, PositionCrc()

    def of(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bucket of each feature, text of each feature, words of each text) of the texts between ``bounds``."""
        texts = len(bounds) - 1
        lower = _LOWER[data]
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = _IS_WORD[lower]
        begins, stops = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
        cuts = bounds[1:-1]
        touching = cuts[inside[cuts] & inside[cuts + 1]]  # the next text begins where a word of the last one ends
        begins[touching] = stops[touching] = True
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
        text = np.searchsorted(bounds, starts, side="right") - 1
        words = np.bincount(text, minlength=texts)
        if self.run > 1:  # words of a feature are joined by one space, whatever stood between them
            sizes = ends - starts
            at = np.concatenate(([0], np.cumsum(sizes + 1)))
            joined = np.full(at[-1], 0x20, dtype=np.uint8)
            joined[np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)), sizes)] = lower[inside[1:-1]]
            lower, starts, ends = joined, at[:-1], at[:-1] + sizes
        found, owner = [], []
        for n in range(1, self.run + 1):
            if n > len(starts):
                break
            last = slice(n - 1, None)
            first = slice(None, len(starts) - n + 1)
            whole = text[first] == text[last]
            found.append(self.crc.of(lower, starts[first][whole], ends[last][whole]) % np.uint32(self.buckets))
            owner.append(text[first][whole])
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), words
        return np.concatenate(found).astype(np.int64), np.concatenate(owner), words


def _groups(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Stretches (from, to, bytes, bounds) of an Arrow text column of a few MB each, or of one longer text."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return
    bounds = np.frombuffer(offsets, dtype=np.int64, count=column.offset + len(column) + 1)[column.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        until = max(at + 1, int(np.searchsorted(bounds, bounds[at] + GROUP_BYTES, side="right")) - 1)
        own = bounds[at:until + 1]
        yield at, until, raw[own[0]:own[-1]], own - own[0]
        at = until


def bucket_counts(texts: DataFrame, text_column: str = "text", run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """Features per bucket of a whole table: (bucket, n), buckets without any left out.

    A task adds its texts up and gives a row a bucket, so what is shuffled depends on
    tasks and buckets, not on texts. Null and empty texts have no feature.
    """
    text_batches(texts.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(run, buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, data, bounds in _groups(batch.column(0)):
                total += np.bincount(features.of(data, bounds)[0], minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own], pa.int64())], ["bucket", "n"])

    partial = texts.select(F.col(text_column).alias("text")).mapInArrow(counted, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Gain of every bucket in thousandths, from two results of ``bucket_counts``: (bucket, gain)."""
    s, t = (c.withColumnRenamed("n", name) for c, name in ((corpus, "s"), (target, "t")))
    both = corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left")
    both = both.na.fill(0, ["s", "t"])
    all_s, all_t = (c.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar() for c in (corpus, target))

    def smooth(count, more: int):
        return (count + more).cast("double")

    odds = (smooth(F.col("t"), 1) * smooth(all_s, buckets)) / (smooth(F.col("s"), 1) * smooth(all_t, buckets))
    return both.select("bucket", F.floor(F.lit(1000) * F.log(odds)).cast("long").alias("gain"))


def weighted(
    docs: DataFrame, gains: DataFrame, id_column: str = "doc_id", text_column: str = "text", run: int = RUN, buckets: int = BUCKETS,
) -> DataFrame:
    """Words, features and weight of every row: (id, n_words, n_features, weight).

    The gains are one number a bucket, handed to all tasks.
    """
    text_batches(docs.sparkSession)
    values = np.zeros(buckets, dtype=np.int64)
    for r in gains.collect():  # as many rows as buckets
        values[r["bucket"]] = r["gain"]
    shared = docs.sparkSession.sparkContext.broadcast(values)
    kind = dict(docs.dtypes)[id_column]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, gain = Features(run, buckets), shared.value
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for at, until, data, bounds in _groups(batch.column(1)):
                found, owner, words = features.of(data, bounds)
                n_words[at:until] = words
                n_features[at:until] = np.bincount(owner, minlength=until - at)
                own = np.zeros(until - at, dtype=np.int64)
                np.add.at(own, owner, gain[found])
                weight[at:until] = own
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)], ["id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        scored, f"id {kind}, n_words long, n_features long, weight long")


def noisy(weight, key, seed: int = SEED):
    """Weight with Gumbel noise in thousandths, by the SHA-256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    uniform = (h + 0.5) / F.lit(4294967296.0)
    return weight + F.floor(F.lit(-1000) * F.log(-F.log(uniform))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", target_text: str = "text",
    run: int = RUN, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED,
) -> DataFrame:
    """Every row's weight and score, and its rank in the sample: (doc_id, n_features, weight, score, rank).

    Of the documents with at least ``min_words`` words ``percent`` in a hundred
    (rounded down) are drawn: the highest scores, ties to the smaller id, rows
    without an id last. Undrawn rows have no rank. Null and empty texts have
    no feature and weight 0. Repeated rows each take a rank of their own. Texts are
    read whole; a very long one is taken by itself, in blocks. Other columns are
    ignored. With an empty target all its counts are 0; an empty table gives an
    empty result.

    Ranks come from ranges of the order, not from one task; equal rows are one row there.
    """
    counts = materialise(bucket_counts(docs, text_column, run, buckets))
    wanted = materialise(bucket_counts(target, target_text, run, buckets))
    scored = weighted(docs, bucket_gains(counts, wanted, buckets), id_column, text_column, run, buckets)
    rows = scored.select(
        F.col("id").alias("doc_id"), "n_features", "weight", noisy(F.col("weight"), F.col("id"), seed).alias("score"),
        (F.col("n_words") >= min_words).alias("eligible"))
    names = ["eligible", "score", "doc_id", "n_features", "weight"]
    same = rows.groupBy(*names).agg(F.count("*").alias("copies"))
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    placed = running_totals(same, order, {
        "rows": F.col("copies"), "eligible": F.when(F.col("eligible"), F.col("copies")).otherwise(0)})
    first, last = F.col("cum_rows") - F.col("copies") + 1, F.col("cum_rows")
    each = placed.withColumn("place", F.explode(F.sequence(first, last)))
    drawn = F.col("eligible") & (F.col("place") * 100 <= F.col("all_eligible") * percent)
    return each.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("place")).cast("long").alias("rank"))


# The registered query's parameters, on distinct words: CRC-32 byte by byte in SQL.
ORACLE = f"""
WITH RECURSIVE steps AS (
  SELECT 0 AS k, CAST(range AS UBIGINT) AS b, CAST(range AS UBIGINT) AS c FROM range(256)
  UNION ALL
  SELECT k + 1, b, CASE WHEN c % 2 = 1 THEN xor(c // 2, {_POLYNOMIAL}::UBIGINT) ELSE c // 2 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
texts AS (SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark),
found AS (
  SELECT side, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
  FROM texts),
letters AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM found),
bytes AS (SELECT w, list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || substring(x, CAST(2 * i + 1 AS INT), 2) AS UBIGINT)) AS bs FROM letters),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::UBIGINT, bs),
      lambda r, b: xor(r // 256, t[CAST(xor(r % 256, b) AS INT) + 1])), 4294967295::UBIGINT) % {BUCKETS} AS bucket
  FROM bytes, crc),
placed AS (SELECT side, doc_id, bucket FROM found JOIN hashed USING (w)),
totals AS (SELECT CAST(count(*) FILTER (side = 0) AS DOUBLE) AS s, CAST(count(*) FILTER (side = 1) AS DOUBLE) AS t FROM placed),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((count(*) FILTER (side = 1) + 1)::DOUBLE * (any_value(totals.s) + {BUCKETS}))
    / ((count(*) FILTER (side = 0) + 1)::DOUBLE * (any_value(totals.t) + {BUCKETS})))) AS BIGINT) AS gain
  FROM placed, totals GROUP BY bucket),
weights AS (
  SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, COALESCE(n, 0) AS n_features, COALESCE(weight, 0) AS weight,
    COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substring(sha256('{SEED}:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weights USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= {MIN_WORDS})
SELECT s.doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= r.n * {DRAWN_PERCENT} // 100 THEN place END AS rank
FROM scored s LEFT JOIN ranked r USING (doc_id)
"""
