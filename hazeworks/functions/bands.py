"""AQI bands, built from the category dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeworks.schemas import CATEGORY_ROWS, DEFAULT_CATEGORY


def _first_match(conditions) -> Column:
    first, *rest = conditions
    chain = reduce(lambda acc, c: acc.when(*c), rest, F.when(*first))
    return chain.otherwise(DEFAULT_CATEGORY)


def category_of(aqi: Column) -> Column:
    """Band by upper edge: negative is the lowest band, null and the open end are the last one."""
    return _first_match([(aqi <= high, F.lit(name)) for name, _, high, _ in CATEGORY_ROWS[:-1]])


def category_of_range(aqi: Column) -> Column:
    """Band by inclusive range: negatives, the gaps between bands and null get the default.

    The dimension is six fixed rows, so the range lookup is a CASE inside the scan's code
    generation instead of a nested-loop join.
    """
    return _first_match([(aqi.between(low, high), F.lit(name)) for name, low, high, _ in CATEGORY_ROWS])
