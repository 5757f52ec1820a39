from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandkit.functions import columns, dates, encode, scalars, text


def one(df, column):
    return df.select(column.alias("v")).collect()[0]["v"]


def values(df, column):
    return [r["v"] for r in df.select(column.alias("v")).collect()]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([("curry rice",), ("fried fish",), (None,), ("",)], "t string")


def test_flags_treat_null_as_false(words):
    col = F.col("t")
    assert values(words, text.contains_flag(col, "curry")) == [1, 0, 0, 0]
    assert values(words, scalars.member_flag(col, ["", "x"])) == [0, 0, 0, 1]
    assert values(words, scalars.presence_flag(col)) == [1, 1, 0, 1]
    assert values(words, scalars.presence_flag(col, non_empty=True)) == [1, 1, 0, 0]
    assert values(words, scalars.all_flag(col.contains("fish"), col.isNotNull())) == [0, 1, 0, 0]
    assert values(words, text.any_of_flag(col, ["rice", "fish"])) == [1, 1, 0, 0]


def test_tags_are_empty_not_null(words):
    tags = text.keyword_tags(F.col("t"), {"a": "cur+y", "b": "rice|fish"})
    assert values(words, tags) == [["a", "b"], ["b"], [], []]


def test_case_label_order_and_absent(words):
    label = scalars.case_label(F.col("t"), [("rice", "R"), ("curry", "C")], "other", "none")
    assert values(words, label) == ["R", "other", "none", "other"]


def test_round_even_and_clip(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (None,)], "x double")
    assert values(df, scalars.round_even(F.col("x"))) == [0, 2, 2, 0, None]
    assert values(df, scalars.clip(F.col("x"), 0.0, 2.0)) == [0.5, 1.5, 2.0, 0.0, None]


def test_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "a int, b int")
    assert values(df, scalars.percent(F.col("a"), F.col("b"))) == [25.0, None]


def test_sentinel_policies(spark):
    df = spark.createDataFrame([("--",), ("1.5",), ("trace",), (None,)], "p string")
    assert values(df, scalars.sentinel_number(F.col("p"), ["--"], "zero")) == [0.0, 1.5, None, None]
    assert values(df, scalars.sentinel_number(F.col("p"), ["--"], "null")) == [None, 1.5, None, None]
    with pytest.raises(ValueError):
        scalars.sentinel_number(F.col("p"), ["--"], "other")


def test_map_values_policies(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert values(df, scalars.map_values(F.col("k"), {"a": 1})) == [1, None, None]
    assert values(df, scalars.map_values(F.col("k"), {"a": 1}, 9)) == [1, 9, 9]
    with pytest.raises(Exception, match="unmapped value: z"):
        values(df, scalars.map_values(F.col("k"), {"a": 1}, scalars.RAISE))


def test_replace_first_is_literal(spark):
    df = spark.createDataFrame([("a.b.c",), ("x\na.a",), ("none",)], "t string")
    assert values(df, scalars.replace_first(F.col("t"), ".", "$1")) == ["a$1b.c", "x\na$1a", "none"]


def test_strict_cast_raises(spark):
    df = spark.createDataFrame([("--",)], "p string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(df, F.col("p").cast("double"))


def test_dates(spark):
    df = spark.createDataFrame([("2014-10-1",), ("2014-10-01",)], "d string")
    day = dates.parse_date(F.col("d"))
    assert values(df, day) == [dt.date(2014, 10, 1)] * 2
    assert values(df, dates.weekday(day)) == [2, 2]
    assert values(df, dates.iso_weekday(day)) == [3, 3]
    assert values(df, dates.unpadded_date(day)) == ["2014-10-1"] * 2
    assert values(df, dates.add_days(day, 31)) == [dt.date(2014, 11, 1)] * 2
    new_year = F.lit("2021-01-03").cast("date")
    assert one(df, dates.iso_week(new_year)) == 53


def test_columns_by_schema(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "i int, s string, d double")
    assert columns.numeric_columns(df) == ["i", "d"]
    assert columns.feature_columns(df, ["s"]) == ["i", "d"]
    assert columns.available(df, ["d", "missing", "i"]) == ["d", "i"]
    added = columns.add_missing(df, {"d": 0, "lag_1": None})
    assert added.collect()[0].asDict() == {"i": 1, "s": "a", "d": 2.0, "lag_1": None}


def test_one_hot_unseen_and_null(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    hot = encode.one_hot(F.col("k"), ["a", "b"], "k")
    assert [tuple(r) for r in df.select(*[c.alias(n) for n, c in hot.items()]).collect()] == [
        (1, 0), (0, 0), (0, 0),
    ]
