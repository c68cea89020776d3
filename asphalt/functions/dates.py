"""Calendar fields and calendar events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from asphalt import labels


def calendar_fields(moment: Column) -> dict[str, Column]:
    """Hour (0 when unknown), day of week (1 = Sunday), month and year."""
    return {
        "hour": F.coalesce(F.hour(moment), F.lit(0)),
        "dow": F.dayofweek(moment),
        "month": F.month(moment),
        "year": F.year(moment),
    }


def event_window(moment: Column) -> Column:
    """Name of the holiday period a moment falls in, on a month-day number such as 1224. The periods."""
    day = F.month(moment) * 100 + F.dayofmonth(moment)
    return (
        F.when((day >= 1224) | (day <= 102), labels.EVENT_YEAR_END)
        .when(day.between(1122, 1128), labels.EVENT_THANKSGIVING)
        .when(day.between(703, 705), labels.EVENT_JULY_4)
        .when(day.between(525, 531), labels.EVENT_MEMORIAL)
        .otherwise(labels.EVENT_NORMAL)
    )
