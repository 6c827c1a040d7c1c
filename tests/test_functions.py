"""Scalar expressions against Python's own behaviour and the documented edges."""

from __future__ import annotations

import math
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeworks.functions import (
    category_of, category_of_range, date_text, display_name, file_stamp, label_unit, shout, strip,
    time_text, to_float, to_instant, to_int, to_number, value_text,
)
from hazeworks.schemas import POLLUTANT_ROWS


def evaluate(spark, values, expression, data_type="string"):
    """Expression results by position, evaluated on a parallel frame (not constant-folded)."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {data_type}")
    return [r["o"] for r in rows.select("i", expression.alias("o")).orderBy("i").collect()]


#: Stored text and the name it is shown as.
SHOWN = {
    None: 'Unknown',
    '': 'Unknown',
    ' ': 'Unknown',
    '??': 'Unknown',
    '  ??  ': 'Unknown',
    'a????b   c': 'Ab  C',
    "st.john's": "St.John'S",
    'x (trường quốc tế)': 'X (Trường Quốc Tế)',
    '首尔abc': '首尔Abc',
    'o3no2': 'O3No2',
    '\tpadded\xa0': 'Padded',
    '\u2003wide\u3000': 'Wide',
    'already Titled': 'Already Titled',
    'ALL CAPS (ÉCOLE)': 'All Caps (École)',
    'straße': 'Straße',
    'ßtart': 'Sstart',
    'ǆungla': 'ǅungla',
    'ﬁne': 'Fine',
    'ΟΔΟΣ': 'Οδος',
    'İstanbul': 'İstanbul',
    'o’neill': 'O’Neill',
    'kemayoran, indonesia': 'Kemayoran, Indonesia',
    'hongkong (香港)': 'Hongkong (香港)',
    'x\ufeffy': 'X\ufeffY',
}


def test_display_names(spark):
    assert evaluate(spark, list(SHOWN), display_name(F.col("v"))) == list(SHOWN.values())


def test_letters_are_capitalised_after_anything_that_is_no_letter(spark):
    # Letters up to Latin Extended-A, Greek and Cyrillic: their case mappings are old and stable.
    letters = [chr(c) for c in [*range(0x41, 0x180), *range(0x391, 0x530)] if chr(c).isalpha() and chr(c).lower() != chr(c).upper()]
    for after in " -'(7.":
        shown = evaluate(spark, [f"x{after}{c}{c}" for c in letters], display_name(F.col("v")))
        for c, name in zip(letters, shown):
            assert name == f"X{after}" + (c + c).title()


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(
    st.text(alphabet=st.sampled_from(list("abcXYZ ?.,'()-0189éΣ首尔\t ")), max_size=24), min_size=1, max_size=40))
def test_display_name_of_random_text(spark, texts):
    shown = evaluate(spark, texts, display_name(F.col("v")))
    for text, name in zip(texts, shown):
        assert name and name == name.strip()
        letters = [c for c in text.lower() if c.isalnum()]
        assert [c for c in name.lower() if c.isalnum()] in (letters, list("unknown"))
        for before, c in zip(" " + name, name):
            if c.isalpha() and c.lower() != c.upper():
                # the end of a word may be lower-cased in a way of its own
                assert c.isupper() != (before.isalpha() and before.lower() != before.upper())
    again = evaluate(spark, shown, display_name(F.col("v")))
    assert all(b == a or "?" in a or "  " in a for a, b in zip(shown, again))


def test_strip_removes_what_python_removes(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [f"{s}a{s}b{s}" for s in spaces]
    assert evaluate(spark, texts, strip(F.col("v"))) == [t.strip() for t in texts]


BANDS = {
    -1: "Good", 0: "Good", 50: "Good", 51: "Moderate", 100: "Moderate",
    101: "Unhealthy for Sensitive Groups", 150: "Unhealthy for Sensitive Groups",
    151: "Unhealthy", 200: "Unhealthy", 201: "Very Unhealthy", 300: "Very Unhealthy",
    301: "Hazardous", 501: "Hazardous", None: "Hazardous",
}


def test_band_edges(spark):
    assert evaluate(spark, list(BANDS), category_of(F.col("v")), "int") == list(BANDS.values())


def test_range_bands_differ_outside_the_ranges(spark):
    values = [-1.0, 0.0, 49.5, 50.0, 50.5, 51.0, 300.0, 300.5, 301.0, 500.0, 501.0, None]
    assert evaluate(spark, values, category_of_range(F.col("v")), "double") == [
        "Hazardous", "Good", "Good", "Good", "Hazardous", "Moderate", "Very Unhealthy", "Hazardous",
        "Hazardous", "Hazardous", "Hazardous", "Hazardous"]


def test_bad_numbers_become_null(spark):
    texts = ["-", "99.9", "", " 7 ", "3000000000", "-3.7", "x1", None]
    assert evaluate(spark, texts, to_int(F.col("v"))) == [None, 99, None, 7, None, -3, None, None]
    floats = evaluate(spark, ["71.7", "-", "", None], to_float(F.col("v")))
    assert floats[0] == pytest.approx(71.7, rel=1e-6) and floats[1:] == [None, None, None]


def test_to_number_keeps_integers(spark):
    assert evaluate(spark, [7, None], to_number("v", T.IntegerType()), "int") == [7, None]
    assert evaluate(spark, ["7.5", "-"], to_number("v", T.StringType())) == [7.5, None]


def test_times(spark):
    texts = ["2026-05-14T21:00:00+07:00", "2025-03-04T18:00:00+06:30", "2026-05-14T14:00:00", "x", None]
    instant = to_instant("v", T.StringType())
    both = F.struct(date_text(instant), time_text(instant), file_stamp(instant))
    assert [tuple(r) for r in evaluate(spark, texts, both)] == [
        ("2026-05-14", "14:00:00", "20260514_140000"), ("2025-03-04", "11:30:00", "20250304_113000"),
        ("2026-05-14", "14:00:00", "20260514_140000"), (None, None, None), (None, None, None)]


def test_labels(spark):
    assert evaluate(spark, ["pm25", "", None], shout(F.col("v"))) == ["PM25", "N/A", "N/A"]
    labels = [label for _, _, label in POLLUTANT_ROWS] + ["plain", "two (a) (b)"]
    expected = [label.split("(")[-1].rstrip(")") for label in labels]
    assert evaluate(spark, labels, label_unit(F.col("v"))) == expected


def test_value_text_matches_python_for_numbers(spark):
    rng = random.Random(5)
    values = [rng.random() * 10 ** rng.randint(-12, 15) for _ in range(3000)]
    values += [struct.unpack("f", struct.pack("f", rng.random() * 500))[0] for _ in range(3000)]
    values += [0.0, -0.0, 1.0, -2.5, 100.0, 1e7, 123456789.0, 1e15, 1e16, 1e-4, 6.25e-4, 1e-5, 5e-7,
               math.inf, -math.inf, math.nan, None]
    expected = [None if v is None else str(v) for v in values]
    assert evaluate(spark, values, value_text("v", T.DoubleType()), "double") == expected


def test_value_text_widens_floats_and_keeps_fractions(spark):
    widened = struct.unpack("f", struct.pack("f", 71.7))[0]
    assert evaluate(spark, [71.7, 34.0], value_text("v", T.FloatType()), "float") == [str(widened), "34.0"]
    times = spark.sql("SELECT * FROM VALUES (TIMESTAMP'2026-05-14 14:00:00'), (TIMESTAMP'2026-05-14 14:00:00.5') AS t(v)")
    assert [r[0] for r in times.select(value_text("v", T.TimestampType())).collect()] == [
        "2026-05-14 14:00:00", "2026-05-14 14:00:00.500000"]
