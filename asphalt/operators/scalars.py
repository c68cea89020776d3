"""One-row results used next to every row of another table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_row(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """Attach the only row of ``row`` as a struct.

    It is a scalar subquery, computed once and read as a constant: no join.
    """
    return df.withColumn(name, row.select(F.struct(*row.columns)).scalar())
