"""Text expressions: display names, labels and the text form of values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeworks.schemas import NOT_AVAILABLE, UNKNOWN

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Upper-, lower- and titlecase letters, as Java's character classes name them.
_CASED = r"[\p{javaUpperCase}\p{javaLowerCase}\p{javaTitleCase}]"
_WORD_START = rf"(?<!{_CASED})(?={_CASED})"
# A Unicode noncharacter: reserved, so station names cannot hold it. The space ends a word.
_MARK = "\ufdd0 "


def strip(column: Column) -> Column:
    """Trim all Unicode whitespace (`trim` alone removes the ASCII space only)."""
    return F.btrim(column, F.lit(WHITESPACE))


def title_case(column: Column) -> Column:
    """Capitalise after *every* uncased character, not only after a space as `initcap` does."""
    marked = F.regexp_replace(column, _WORD_START, _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def display_name(column: Column) -> Column:
    """Readable place name: '??' dropped, double spaces halved once, stripped, title-cased."""
    halved = F.replace(F.replace(column, F.lit("??"), F.lit("")), F.lit("  "), F.lit(" "))
    return title_case(F.coalesce(F.nullif(strip(halved), F.lit("")), F.lit(UNKNOWN)))


def shout(column: Column) -> Column:
    """Upper-case label, 'N/A' for null or empty."""
    return F.when(F.length(column) > 0, F.upper(column)).otherwise(NOT_AVAILABLE)


def label_unit(label: Column) -> Column:
    """The unit in a label such as 'Ozone (ppb)'; a label without parenthesis is its own unit."""
    return F.rtrim(F.substring_index(label, "(", -1), F.lit(")"))


def _decimal_text(plain: Column) -> Column:
    return F.regexp_replace(plain.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")


def _double_text(value: Column) -> Column:
    # Java switches to exponents below 1e-3 and from 1e7 on, Python below 1e-4 and from 1e16 on.
    size = F.abs(value)
    java = value.cast("string")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    exponent = F.substring_index(java, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa, F.lit("e"), F.when(exponent < 0, "-").otherwise("+"),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    plain_in_java = (size >= 1e-3) & (size < 1e7) | (size == 0)
    return (
        F.when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when(plain_in_java, java)
        .when((size >= 1e-4) & (size < 1e16), _decimal_text(value))
        .otherwise(scientific)
    )


def value_text(name: str, data_type: T.DataType) -> Column:
    """The text Python's str() gives for a value; null stays null."""
    column = F.col(name)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.when(column.isNotNull(), _double_text(column.cast("double")))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        micros = F.date_format(column, "SSSSSS")
        fraction = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))
        return F.concat(F.date_format(column, "yyyy-MM-dd HH:mm:ss"), fraction)
    return column.cast("string")
