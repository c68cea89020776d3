"""Keyword buckets and label lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Buckets in order of precedence, each with the words that select it.
WEATHER_BUCKETS = [
    ("Snow", ["snow", "sleet", "wintry", "ice"]),
    ("Rain", ["rain", "drizzle", "shower", "thunder"]),
    ("Fog", ["fog", "mist", "haze"]),
    ("Cloud", ["cloud", "overcast"]),
    ("Clear", ["clear", "fair"]),
]
WEATHER_OTHER = "Other"


def keyword_bucket(text: Column, buckets: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Label of the first bucket with a word found in ``text``, ignoring case.

    The text is a lambda's variable: written out, it would be compiled once per
    word, and beyond some size the JVM only interprets the code of a whole stage.
    """
    def label(lowered: Column) -> Column:
        found = (F.when(reduce(Column.__or__, [lowered.contains(word) for word in words]), F.lit(name))
                 for name, words in buckets)
        return F.coalesce(*found, F.lit(default))

    return F.transform(F.array(F.lower(text)), label)[0]


def weather_bucket(text: Column) -> Column:
    return keyword_bucket(text, WEATHER_BUCKETS, WEATHER_OTHER)


def label_of(key: Column, labels: Mapping[str, str]) -> Column:
    """Readable name of a code; an unknown code is shown as it is."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), key)
