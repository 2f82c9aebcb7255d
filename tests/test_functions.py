"""Column functions: quote strip, split, positional get, key, lenient casts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ferryline.functions import (
    cast_as,
    field_at,
    first_field,
    json_path,
    lenient_int,
    lenient_timestamp,
    split_fields_array,
    strip_quotes,
)


def one(spark, value, col):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(col.alias("r")).first()["r"]


def test_strip_quotes_deletes_every_quote(spark):
    assert one(spark, 'a,"b, c",d""', strip_quotes("v")) == "a,b, c,d"


def test_split_keeps_empty_and_trailing_fields(spark):
    assert one(spark, "a,b,,", split_fields_array("v")) == ["a", "b", "", ""]
    assert one(spark, "", split_fields_array("v")) == [""]


def test_get_past_end_is_null_not_error(spark):
    arr = split_fields_array("v")
    assert one(spark, "x", field_at(arr, 3)) is None
    assert one(spark, "x", field_at(arr, 0)) == "x"
    assert one(spark, None, field_at(arr, 0)) is None


def test_key_is_first_field_of_raw_line(spark):
    assert one(spark, '"A, B",c', first_field("v")) == '"A'
    assert one(spark, "only", first_field("v")) == "only"
    assert one(spark, "", first_field("v")) == ""


@pytest.mark.parametrize(
    "text,expected",
    [
        ("", None),
        (" In", None),
        ("x", None),
        ("VMC", None),
        ("78", 78),
        (" 7 ", 7),
        ("3.9", 3),
        ("-2", -2),
        ("-2.7", -2),
        ("99999999999", None),
        ("1948-10-24", None),
        (".5", 0),
        (".", 0),
        ("5.", 5),
        ("+", None),
        ("3.9x", None),
        ("1.2.3", None),
        ("7 .5", None),
        ("\t8\n", 8),
        (None, None),
    ],
)
def test_lenient_int(spark, text, expected):
    assert one(spark, text, lenient_int("v")) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("1948-10-24", dt.datetime(1948, 10, 24)),
        ("1998-10-03 12:34:56", dt.datetime(1998, 10, 3, 12, 34, 56)),
        ("", None),
        (" In", None),
        ("78", None),
        ("24-10-1948", None),
        (None, None),
    ],
)
def test_lenient_timestamp(spark, text, expected):
    assert one(spark, text, lenient_timestamp("v")) == expected


def test_cast_as_dispatch(spark):
    assert one(spark, " 5 ", cast_as("v", "int")) == 5
    assert one(spark, " 5 ", cast_as("v", "string")) == " 5 "


def test_json_path(spark):
    assert one(spark, '{"a": {"b": 1}, "c": null}', json_path("v", "$.a")) == '{"b":1}'
    assert one(spark, '{"a": {"b": 1}, "c": null}', json_path("v", "$.c")) is None
    assert one(spark, '{"a": 1}', json_path("v", "$.zz")) is None
    assert one(spark, "not json", json_path("v", "$.a")) is None


def test_plain_cast_would_raise_under_ansi(spark):
    # the reason lenient casts exist: the same input with a plain cast fails
    df = spark.createDataFrame([(" In",)], "v string")
    with pytest.raises(Exception):
        df.select(F.col("v").cast("int")).collect()
