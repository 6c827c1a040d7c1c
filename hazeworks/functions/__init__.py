"""Column expressions; all of them compile to JVM code, none is a Python UDF."""

from hazeworks.functions.bands import category_of, category_of_range
from hazeworks.functions.numbers import to_float, to_int, to_number
from hazeworks.functions.text import display_name, label_unit, shout, strip, value_text
from hazeworks.functions.times import date_text, file_stamp, time_text, to_instant

__all__ = [
    "category_of", "category_of_range", "date_text", "display_name", "file_stamp", "label_unit",
    "shout", "strip", "time_text", "to_float", "to_instant", "to_int", "to_number", "value_text",
]
