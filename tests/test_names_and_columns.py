import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.functions import columns as c
from starmill.functions.names import name_collisions, normal_name, normal_names, normalise_columns


@pytest.mark.parametrize("name, expected", [
    ("Last Update", "last_update"), ("CustomerID", "customerid"), ("  Film Title", "film_title"),
    ("a - b", "a_b"), ("price($)", "price"), ("already_ok", "already_ok"), ("x\ty", "x_y"),
])
def test_normal_name(name, expected):
    assert normal_name(name) == expected


def test_collisions_get_a_number():
    assert normal_names(["a b", "a-b", "A B", "c"]) == ["a_b", "a_b_2", "a_b_3", "c"]
    assert normal_names(["a b", "a-b", "a_b_2"]) == ["a_b", "a_b_3", "a_b_2"]
    assert name_collisions(["a b", "a-b", "c"]) == {"a_b": ["a b", "a-b"]}


@given(st.lists(st.text(max_size=8), max_size=8))
def test_normal_names_are_unique(names):
    out = normal_names(names)
    assert len(set(out)) == len(names)


def test_normalise_columns_keeps_position(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a b", "a-b", "Last.Update"])
    assert normalise_columns(df).columns == ["a_b", "a_b_2", "lastupdate"]
    assert normalise_columns(df).first() == (1, 2, 3)


def one(spark, value, *exprs, type_="string"):
    df = spark.createDataFrame([(value,)], f"x {type_}")
    return tuple(df.select(*[e(F.col("x")) for e in exprs]).first())


def test_trim_keeps_tabs_unless_asked(spark):
    assert one(spark, " \tx ", c.trimmed, lambda x: c.trimmed(x, whitespace=True)) == ("\tx", "x")


@pytest.mark.parametrize("value, blank", [("", True), (" \t\n", True), ("x", False), (None, False)])
def test_blank(spark, value, blank):
    assert one(spark, value, c.is_blank) == (blank,)


@pytest.mark.parametrize("value, bad", [("a@b", False), ("ab", True), ("", True), (None, True)])
def test_email(spark, value, bad):
    assert one(spark, value, c.lacks_at_sign) == (bad,)


@pytest.mark.parametrize("value, expected", [
    ("2006-02-15 04:34:33", dt.datetime(2006, 2, 15, 4, 34, 33)),
    ("2006-02-15T04:34:33.000Z", dt.datetime(2006, 2, 15, 4, 34, 33)),
    ("bad", None), ("NaT", None), ("None", None), ("", None), (None, None), ("2006-02-31", None),
])
def test_parsed_time(spark, value, expected):
    assert one(spark, value, c.parsed_time) == (expected,)


def test_markers_become_null(spark):
    assert one(spark, "NaT", c.blank_to_null, lambda x: c.blank_to_null(x, ["NaT", "None"])) == ("NaT", None)


def test_day_parts(spark):
    day = dt.datetime(2005, 5, 28, 23, 59, 59)
    assert one(spark, day, c.date_id, c.day_label, type_="timestamp") == (20050528, "2005-05-28")
    assert one(spark, None, c.date_id, c.day_label, type_="timestamp") == (None, "no-date")


@pytest.mark.parametrize("stamp, inside", [
    ("2024-01-09 23:59:59.999999", False), ("2024-01-10 00:00:00", True), ("2024-01-10 23:59:59.999999", True),
    ("2024-01-11 00:00:00", False),
])
def test_day_is_half_open(spark, stamp, inside):
    assert one(spark, stamp, lambda x: c.in_days(x.cast("timestamp"), "2024-01-10")) == (inside,)


def test_numbers_as_text(spark):
    assert one(spark, 1234567.891, c.money_text, type_="double") == ("1,234,567.89",)
    assert one(spark, 7, c.chunk_label, type_="int") == ("0007",)
    assert one(spark, 123456, c.chunk_label, type_="int") == ("123456",)


def test_paths(spark):
    path = "historical-data/2024-06-14/film/film_chunk0000.csv"
    assert one(spark, path, lambda x: c.path_part(x, 1), lambda x: c.path_part(x, -2), lambda x: c.path_part(x, 9),
               c.is_csv) == ("2024-06-14", "film", None, True)


@pytest.mark.parametrize("text, expected", [
    ("2024-02-29", "2024-02-29"), ("2023-02-29", None), ("no-date", None), ("2024-6-1", None), (None, None)])
def test_valid_day(spark, text, expected):
    assert one(spark, text, c.valid_day) == (expected,)
