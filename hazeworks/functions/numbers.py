"""Number parsing that yields null instead of an ANSI error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_int(column: Column) -> Column:
    """Integer part of a number or numeric text. Text goes through double: '99.9' gives 99."""
    return column.try_cast("double").try_cast("int")


def to_float(column: Column) -> Column:
    return column.try_cast("float")


def to_number(name: str, data_type: T.DataType) -> Column:
    """Numeric coercion for analysis: integers stay as they are, anything else becomes double."""
    if isinstance(data_type, T.IntegralType):
        return F.col(name)
    return F.col(name).try_cast("double")
