"""Odds ratios that stay finite under separation: logistic regression with the bias-reducing penalty.

The penalty is half the logarithm of the information's determinant (Firth). Rows
collapse to weighted patterns of their columns first, which are packed into
blocks of numbers once and kept. An iteration reads the blocks twice: once for likelihood, score and information at the coefficients,
once for the leverages under that information. Each task leaves one row of sums,
whose size depends on the number of columns alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

ROUNDS = 50
TOLERANCE = 1e-8
LARGEST_STEP = 5.0
HALVINGS = 10
ROWS_AT_ONCE = 8_192
SUMS = 64  # rows of sums that reach the driver at once, or four a core


@dataclass(frozen=True)
class PenalisedFit:
    """Coefficients and their standard errors, the intercept first."""

    beta: np.ndarray
    errors: np.ndarray
    rounds: int


def patterns(rows: DataFrame, x: Column, label: str) -> DataFrame:
    """Rows by their columns: (x array<double>, n, y) with an intercept in front; rows without a label are left out."""
    known = rows.where(F.col(label).isNotNull())
    return known.select(F.concat(F.array(F.lit(1.0)), x).alias("x"), F.col(label).cast("double").alias("label")).groupBy("x").agg(
        F.count("*").cast("double").alias("n"), F.sum("label").alias("y"))


def _blocks(table: DataFrame) -> RDD:
    """Patterns (x, n, y) as arrays of up to ``ROWS_AT_ONCE`` of them, kept: no pass converts their values again."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                piece = batch.slice(at, ROWS_AT_ONCE)
                columns = [piece.column(0).flatten(), piece.column(1), piece.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.to_numpy(zero_copy_only=False).tobytes()], pa.binary()) for c in columns], ["x", "n", "y"])

    def arrays(row: Row) -> tuple[np.ndarray, ...]:
        x, n, y = map(np.frombuffer, row)
        return x.reshape(len(n), -1), n, y

    packed = table.select("x", "n", "y").mapInArrow(pack, "x binary, n binary, y binary").rdd
    tasks = max(SUMS, 4 * packed.context.defaultParallelism)
    return packed.coalesce(tasks).map(arrays).persist(StorageLevel.MEMORY_AND_DISK)


def _summed(blocks: RDD, part) -> np.ndarray:
    """Sum over all patterns of what ``part`` makes of a block (x, n, y): a vector."""
    def sums(own: Iterator[tuple]) -> Iterator[np.ndarray]:
        found = [part(*block) for block in own]
        if found:
            yield np.sum(found, axis=0)

    return np.sum(blocks.mapPartitions(sums).collect(), axis=0)  # columns squared at most from each task


def _curve(x: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    linear = x @ beta
    return linear, 1.0 / (1.0 + np.exp(-np.clip(linear, -500, 500)))


def fit(table: DataFrame, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> PenalisedFit:
    """Coefficients from ``patterns``.

    Steps are halved until the penalised likelihood no longer falls. Columns
    must not depend linearly on each other. An empty table is refused.
    """
    blocks = _blocks(table)
    try:
        return _newton(blocks, rounds, tolerance)
    finally:
        blocks.unpersist()


def _newton(blocks: RDD, rounds: int, tolerance: float) -> PenalisedFit:
    width = max(blocks.map(lambda block: block[0].shape[1]).collect(), default=None)
    if width is None:
        raise ValueError("no rows to fit")

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Penalised likelihood, score and information."""
        def part(x, n, y):
            linear, p = _curve(x, beta)
            likelihood = y @ linear - n @ np.logaddexp(0.0, linear)
            information = x.T @ (x * (n * p * (1 - p))[:, None])
            return np.concatenate([[likelihood], x.T @ (y - n * p), information.ravel()])

        sums = _summed(blocks, part)
        information = sums[1 + width:].reshape(width, width)
        sign, size = np.linalg.slogdet(information)
        if sign <= 0:
            raise ValueError("columns depend linearly on each other")
        return sums[0] + size / 2, sums[1:1 + width], information

    beta = np.zeros(width)
    height, score, information = at(beta)
    done = 0
    for done in range(1, rounds + 1):
        inverse = np.linalg.inv(information)

        def leverage(x, n, y, beta=beta, inverse=inverse):
            _, p = _curve(x, beta)
            weights = n * p * (1 - p) * ((x @ inverse) * x).sum(axis=1)
            return x.T @ (weights * (0.5 - p))

        step = inverse @ (score + _summed(blocks, leverage))
        step *= min(1.0, LARGEST_STEP / max(np.abs(step).max(), 1e-300))
        for _ in range(HALVINGS):
            tried = at(beta + step)
            if tried[0] >= height - 1e-12 * abs(height):
                break
            step = step / 2
        beta = beta + step
        height, score, information = tried
        if np.abs(step).max() < tolerance:
            break
    return PenalisedFit(beta, np.sqrt(np.diag(np.linalg.inv(information))), done)


def ratios(rows: DataFrame, columns: Sequence[str], label: str, bound: float = 1.959964) -> DataFrame:
    """Odds ratio and interval of each numeric column: (element, odds_ratio, lo, hi). Missing values count as 0."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    return table_of(rows.sparkSession, columns, fit(patterns(rows, x, label)), bound)


def table_of(spark, columns: Sequence[str], fitted: PenalisedFit, bound: float = 1.959964) -> DataFrame:
    """The ratios of the first coefficients after the intercept, under the names of ``columns``."""
    found = [(c, *map(float, np.exp([b, b - bound * e, b + bound * e])))
             for c, b, e in zip(columns, fitted.beta[1:], fitted.errors[1:])]
    return spark.createDataFrame(found, "element string, odds_ratio double, lo double, hi double")
