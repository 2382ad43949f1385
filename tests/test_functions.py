"""Column functions on the edge cases the driver tables lack."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farebox.functions import (
    between_closed,
    decimal_text,
    double_text,
    hours_between,
    in_month,
    in_range_of_days,
    json_fields,
    message_text,
    minute_boundaries,
    on_day,
    parse_event_time,
    row_id,
    surrogate_key,
    tip_bucket,
    tip_bucket_rank,
    vendor_name,
)
from farebox.functions.hashing import SURROGATE_NULL


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_row_ids(spark):
    df = spark.createDataFrame([("1", "23", None), ("12", "3", None)], "a string, b string, c string")
    got = df.select(
        row_id("a", "b", "c").alias("separated"), row_id("a", "b", sep="").alias("joined"),
        F.hex(row_id("a", "b", sep="", as_bytes=True)).alias("bytes"), surrogate_key("a", "c").alias("surrogate"),
    ).collect()
    assert [r.separated for r in got] == [md5("1-23-"), md5("12-3-")]
    assert {r.joined for r in got} == {md5("123")}  # the known weakness of the unseparated form
    assert got[0].bytes.lower() == md5("123")
    assert got[0].surrogate == md5(f"1-{SURROGATE_NULL}")


@pytest.mark.parametrize("value, text", [
    (12.5, "12.5"), (10.0, "10"), (0.0, "0"), (1e7, "10000000"), (12345678.25, "12345678.25"), (0.0001, "0.0001"),
    (-3.0, "-3"), (68423.46, "68423.46"), (None, None),
])
def test_double_text(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(double_text("x")).first()[0] == text


def test_decimal_text(spark):
    assert spark.sql("select 12.500000000 as x, 100.000 as y, 0.10 as z").select(
        decimal_text("x"), decimal_text("y"), decimal_text("z")).first() == ("12.5", "100", "0.1")


@pytest.mark.parametrize("start, end, minutes", [
    ("2024-01-01 10:00:59", "2024-01-01 10:01:01", 1), ("2024-01-01 10:01:01", "2024-01-01 10:00:59", -1),
    ("2024-01-01 10:00:00", "2024-01-01 10:00:59", 0), ("2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
])
def test_minute_boundaries(spark, start, end, minutes):
    df = spark.sql(f"select timestamp_ntz '{start}' as a, timestamp_ntz '{end}' as b")
    assert df.select(minute_boundaries("a", "b")).first()[0] == minutes


def test_hours_drop_fractions_of_seconds(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00.9' as a, timestamp_ntz '2024-01-01 01:30:00.1' as b")
    assert df.select(hours_between("a", "b")).first()[0] == 1.5


def test_time_predicates(spark):
    df = spark.sql("""select explode(array(timestamp_ntz '2024-03-01 00:00:00', timestamp_ntz '2024-03-15 00:00:00',
        timestamp_ntz '2024-03-15 00:00:01', timestamp_ntz '2024-03-16 00:00:00', timestamp_ntz '2023-12-31 23:59:59')) as t""")
    assert df.where(between_closed("t", "2024-03-01", "2024-03-15")).count() == 2
    assert df.where(in_range_of_days("t", "2024-03-01", "2024-03-15")).count() == 3
    assert df.where(on_day("t", "2024-03-15")).count() == 2
    assert df.where(in_month("t", "12-2023")).count() == 1
    assert df.where(in_month("t", "03-2024")).count() == 4


def test_bad_event_time_is_null(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("yesterday",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_event_time("t").cast("timestamp_ntz")).collect()]
    assert got == [datetime(2024, 1, 1, 10), None, None]


def test_vendor_names(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "v int")
    assert [r[0] for r in df.select(vendor_name("v")).collect()] == [
        "Creative Mobile Technologies", "VeriFone Inc.", None, "Unknown/Other", None]


def test_tip_classes(spark):
    tips = [0.0, -1.0, 1.99, 2.0, 5.0, 10.0, 20.0, None]
    df = spark.createDataFrame([(t,) for t in tips], "tip double")
    got = df.select(tip_bucket("tip"), tip_bucket_rank("tip")).collect()
    assert [tuple(r) for r in got] == [
        ("0", 0), ("0–2", 1), ("0–2", 1), ("2–5", 2), ("5–10", 3), ("10–20", 4), ("20+", 5), ("20+", 5)]


def test_json_fields_tell_missing_from_null(spark):
    docs = ['{"brand": "A", "price": 1.5}', '{"brand": null, "price": 2}', '{"price": 3}']
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    assert [tuple(r) for r in df.select(*json_fields("doc", ["brand", "price"])).collect()] == [
        ("A", "1.5"), (None, "2"), ("N/A", "3")]


def test_message_keeps_null_fields(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(message_text("a", "b")).first()[0] == '{"a":1,"b":null}'


def test_ids_differ_at_the_extremes(spark):
    numbers = [1e27, 2e27, float("nan"), float("inf"), float("-inf"), 1e-13, 2e-13, 1.23456789012345e-5, 1.23456789012346e-5, 1e7, 12345678.5, 0.0, 1e-3]
    df = spark.createDataFrame([(n,) for n in numbers] + [(None,)], "n double")
    texts = [r[0] for r in df.select(double_text("n")).collect()]
    assert len({*texts}) == len(numbers) + 1 and texts[-1] is None
    assert texts[9:13] == ["10000000", "12345678.5", "0", "0.001"]
    assert df.select(row_id(double_text("n"))).distinct().count() == len(numbers) + 1
