"""Learning folds and bounded samples by a hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1_000_000


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves no remainder mod 5; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def kept_share(doc_id: Column, share: Column | float, seed: int) -> Column:
    """True for about ``share`` of the ids, the same ones in every layout of the table."""
    part = F.pmod(F.xxhash64(F.lit(seed), doc_id), F.lit(_PARTS))
    return part < (F.lit(share) if isinstance(share, (int, float)) else share) * _PARTS


def bounded_share(rows: DataFrame, bound: int) -> float:
    """Share of the rows that leaves about ``bound`` of them."""
    return min(1.0, bound / max(1, rows.count()))
