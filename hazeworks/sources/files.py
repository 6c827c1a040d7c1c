"""Raw and clean readings in files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeworks.functions import to_float, to_instant, to_int
from hazeworks.schemas import CLEAN, CLEAN_TEXT, RAW, RAW_TEXT


def read_raw(spark: SparkSession, path: str, *, array_files: bool = False) -> DataFrame:
    """Raw readings, one JSON object per line. Pollutants may be quoted; text that is no number is null.

    `array_files` reads files that hold one JSON array each. Such a file cannot be split over tasks;
    use it for small exchanges and JSON Lines for volume.
    """
    return typed_raw(spark.read.schema(RAW_TEXT).option("multiLine", array_files).json(path))


def typed_raw(text: DataFrame) -> DataFrame:
    """Raw readings whose numbers were read as text."""
    return text.select(*[F.col(f.name).try_cast(f.dataType.simpleString()).alias(f.name) for f in RAW])


def read_clean_text(spark: SparkSession, path: str) -> DataFrame:
    """Clean readings whose values were all written as text, back in their types."""
    text = spark.read.schema(CLEAN_TEXT).json(path)

    def typed(field: T.StructField):
        if isinstance(field.dataType, T.IntegerType):
            return to_int(F.col(field.name))
        if isinstance(field.dataType, T.FloatType):
            return to_float(F.col(field.name))
        if isinstance(field.dataType, T.TimestampType):
            return to_instant(field.name, T.StringType())
        return F.col(field.name)

    return text.select(*[typed(field).alias(field.name) for field in CLEAN])
