"""JSON and CSV outputs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeworks.functions import value_text

# Fixed value: how an export is stamped.
EXPORT_NAME = "export_%Y%m%d_%H%M%S"


def write_raw(raw: DataFrame, path: str) -> None:
    """Raw readings as JSON Lines, replacing what was there; nulls are written out."""
    raw.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def stringify(readings: DataFrame) -> DataFrame:
    """Every value as text, null as null."""
    return readings.select(*[value_text(f.name, f.dataType).alias(f.name) for f in readings.schema])


def write_clean_text(readings: DataFrame, path: str) -> None:
    write_raw(stringify(readings), path)


def export_rows(readings: DataFrame) -> DataFrame:
    """Rows as a CSV shows them: times (a fraction only where there is one) and fractions as plain text."""
    def shown(field: T.StructField):
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.FloatType, T.DoubleType)):
            return value_text(f"`{field.name}`", field.dataType).alias(field.name)
        return F.col(f"`{field.name}`")

    return readings.select(*[shown(field) for field in readings.schema])


def export_csv(readings: DataFrame, directory: str, now: datetime | None = None) -> str:
    """UTF-8 CSV with header, null as empty, quotes doubled. Returns the written folder."""
    path = f"{directory.rstrip('/')}/{(now or datetime.now(timezone.utc)).strftime(EXPORT_NAME)}"
    (
        export_rows(readings).write.option("header", True).option("encoding", "UTF-8")
        .option("nullValue", "").option("emptyValue", "").option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
