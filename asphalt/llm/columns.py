"""Carrying rows with any columns through an operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(docs: DataFrame) -> Column:
    """All columns of a table as one value, so that no name clashes with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def unpacked(names: Sequence[str], row: str, results: Sequence[str]) -> list[Column]:
    """The packed columns, then the results; an input column with the name of a result is left out."""
    taken = {r.lower() for r in results}
    return [F.col(row).getField(c).alias(c) for c in names if c.lower() not in taken] + [F.col(r) for r in results]
