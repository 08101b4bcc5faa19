import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.coerce import coerce

UTC = "2023-11-14 22:13:20"


def run(spark, kind, target, values):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", kind)])
    frame = spark.createDataFrame(list(enumerate(values)), schema)
    got = coerce(F.col("x"), kind, target)
    value = F.date_format(got.value, "yyyy-MM-dd HH:mm:ss.SSS") if target.startswith("timestamp") else got.value
    out = frame.select("i", value.alias("v"), got.refused.alias("r")).orderBy("i").collect()
    return [(r["v"], r["r"]) for r in out]


def check(spark, kind, target, cases):
    got = run(spark, kind, target, [c[0] for c in cases])
    want = [(c[1], c[2] if len(c) > 2 else False) for c in cases]
    for case, g, w in zip(cases, got, want):
        assert g == w, f"{case[0]!r} as {target}: {g} != {w}"


def test_integers_from_text(spark):
    check(spark, T.StringType(), "bigint", [
        ("", None), (None, None), ("42", 42), ("3.7", 3), ("-3.7", -3), ("-0.5", 0), ("abc", None),
        ("9007199254740993", 9007199254740993), ("9223372036854775807", 2**63 - 1),
        ("9223372036854775808", None, True), ("1e3", 1000), ("1e30", None, True), ("1e400", None),
        ("0x1F", 31), ("0b101", 5), ("0o17", 15), ("-0x1F", None), ("  ", 0), ("\t 7\n", 7),
        (" 8﻿", 8), ("1d", None), ("12abc", None), ("Infinity", None), ("NaN", None),
        (".5", 0), ("5.", 5), ("1_000", None), ("3.9999999999999999999", 4),
    ])


def test_narrow_integers_refuse_what_does_not_fit(spark):
    check(spark, T.StringType(), "smallint", [("32767", 32767), ("32768", None, True), ("", None)])
    check(spark, T.LongType(), "integer", [(2**31, None, True), (5, 5)])


def test_integers_from_numbers_and_flags(spark):
    check(spark, T.DoubleType(), "bigint", [
        (3.7, 3), (-3.7, -3), (float("nan"), None), (float("inf"), None), (1e30, None, True), (None, None),
    ])
    check(spark, T.BooleanType(), "bigint", [(True, 1), (False, None), (None, None)])
    check(spark, T.BinaryType(), "bigint", [(bytearray(b"12"), 12), (bytearray(b""), None)])


def test_doubles(spark):
    check(spark, T.StringType(), "double precision", [
        ("", None), ("1.5", 1.5), ("1d", None), ("1f", None), ("Infinity", None), ("1e400", None),
        ("  ", 0.0), ("-.37", -0.37), ("0x10", 16.0), ("abc", None),
    ])
    check(spark, T.BooleanType(), "double precision", [(True, 1.0), (False, 0.0)])
    check(spark, T.StringType(), "real", [("1e39", None, True), ("1.5", 1.5)])


def test_decimals_are_exact(spark):
    check(spark, T.StringType(), "numeric(10,2)", [
        ("1.005", Decimal("1.01")), ("1e3", Decimal("1000.00")), ("0x10", Decimal("16.00")), ("-1.005", Decimal("-1.01")), ("123456789", None, True), ("", None), ("x", None),
    ])
    check(spark, T.StringType(), "numeric", [("12345678901234567890.5", Decimal("12345678901234567890.5"))])


def test_booleans(spark):
    check(spark, T.StringType(), "boolean", [
        ("1", True), ("0", False), ("false", False), (" YES ", True), ("n", False), ("", None), ("2", None),
        ("on", None), (None, None),
    ])
    check(spark, T.LongType(), "boolean", [(1, True), (0, False), (2, True), (-1, True), (None, None)])
    check(spark, T.BooleanType(), "boolean", [(True, True)])


def test_timestamps(spark):
    check(spark, T.StringType(), "timestamp with time zone", [
        ("1700000000", UTC + ".000"), ("1700000000000", UTC + ".000"), ("1700000000.5", UTC + ".500"),
        ("-1", "1969-12-31 23:59:59.000"), ("", None), (None, None), ("99999999999", "5138-11-16 09:46:39.000"),
        ("100000000000", "1973-03-03 09:46:40.000"), ("9000000000000000", None),
        ("2024-01-02 03:04:05", "2024-01-02 03:04:05.000"),
        ("2024-01-02T03:04:05.123Z", "2024-01-02 03:04:05.123"),
        ("2024-01-02 03:04:05+02", "2024-01-02 01:04:05.000"), ("2024-01-02", "2024-01-02 00:00:00.000"),
        ("now", None, True), ("03:04:05", None, True), ("2024-02-30", None, True), ("  ", None, True),
    ])
    check(spark, T.LongType(), "timestamp", [(1700000000, UTC + ".000"), (1700000000000, UTC + ".000")])
    check(spark, T.BooleanType(), "timestamp", [(True, None, True)])


def test_dates(spark):
    check(spark, T.LongType(), "date", [(1700000000, dt.date(2023, 11, 14))])
    check(spark, T.StringType(), "date", [
        ("1700000000", dt.date(2023, 11, 14)), ("2024-01-02 23:30:00-05", dt.date(2024, 1, 2)), ("", None),
        ("2024-13-01", None, True),
    ])


def test_bytes(spark):
    check(spark, T.StringType(), "bytea", [("hi", bytearray(b"hi")), ("é", bytearray("é".encode())), (None, None)])
    check(spark, T.BinaryType(), "bytea", [(bytearray([1, 2]), bytearray([1, 2]))])
    check(spark, T.DoubleType(), "bytea", [(1.0, bytearray(b"1"))])


def test_text(spark):
    check(spark, T.StringType(), "text", [("a\0b", "ab"), ("", ""), (None, None)])
    check(spark, T.BinaryType(), "text", [(bytearray(b"x"), "x"), (bytearray(b"a\xff"), "a�")])
    check(spark, T.LongType(), "character varying", [(5, "5")])
    check(spark, T.BooleanType(), "text", [(True, "true")])
    check(spark, T.DoubleType(), "text", [
        (1.0, "1"), (-0.0, "0"), (0.1, "0.1"), (1e20, "100000000000000000000"), (1e21, "1e+21"),
        (1.5e-7, "1.5e-7"), (1e-6, "0.000001"), (123456789.5, "123456789.5"), (100.25, "100.25"),
        (float("inf"), "Infinity"), (float("nan"), "NaN"),
    ])


def test_json(spark):
    check(spark, T.StringType(), "jsonb", [
        ('{"a":1}', '{"a":1}'), ("", None), ('{"a":1,"a":2}', '{"a":1,"a":2}'), ("{'a':1}", None, True),
        ('{"a":1}}', None, True), ("1],[2", None, True), ("nope", None, True), ("null", "null"),
    ])
    nested = T.StructType([T.StructField("a", T.IntegerType())])
    check(spark, nested, "jsonb", [((1,), '{"a":1}')])
    check(spark, T.BinaryType(), "jsonb", [(bytearray(b"[1]"), "[1]")])


def test_uuid(spark):
    plain = "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"
    check(spark, T.StringType(), "uuid", [
        (plain, plain), ("{" + plain.upper() + "}", plain), (plain.replace("-", ""), plain), ("x", None, True),
    ])


@pytest.mark.parametrize("target", ["bigint", "text", "boolean", "bytea", "timestamp with time zone", "jsonb"])
def test_null_stays_null(spark, target):
    assert run(spark, T.StringType(), target, [None]) == [(None, False)]
