"""The first rows of an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def first_rows(rows: DataFrame, order: list[Column | str], count: int) -> DataFrame:
    """The first `count` rows: every task keeps at most that many, one task merges them.

    Meant for counts that fit one task with ease (thousands), not for cutting a table in half.

    `coalesce(1)` changes nothing in the result of a top-k. It keeps the optimizer from moving later
    projections below the limit, where they would turn the top-k into a sort of the whole table.
    """
    return rows.orderBy(*order).limit(count).coalesce(1)
