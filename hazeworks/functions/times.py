"""Time parsing and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_instant(name: str, data_type: T.DataType) -> Column:
    """ISO-8601 text (with or without offset) to timestamp, bad text to null; typed input is kept."""
    if isinstance(data_type, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name)


def time_text(column: Column) -> Column:
    return F.date_format(column, "HH:mm:ss")


def date_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def file_stamp(column: Column) -> Column:
    return F.date_format(column, "yyyyMMdd_HHmmss")
