import pytest
from helpers import one
from pyspark.sql import functions as F

from quayside.functions import dates, jsons, scalars


def value(spark, column):
    return one(spark.range(1).select(column))[0]


@pytest.mark.parametrize("start, modifiers, want", [
    ("2024-01-31 00:00:00", ["+1 month"], "2024-02-29 00:00:00"),
    ("2024-03-15 10:20:30", ["-7 days"], "2024-03-08 10:20:30"),
    ("2024-03-15 10:20:30", ["start of month", "-1 day"], "2024-02-29 00:00:00"),
    ("2024-03-15 10:20:30", ["localtime", "utc", "+1 hour"], "2024-03-15 11:20:30"),
    ("2024-03-15 10:20:30", ["1.5 months"], "2024-04-30 10:20:30"),
    ("2024-03-15 10:20:30", ["+1.3 years"], "2025-07-15 10:20:30"),
    ("2024-03-15 10:20:30", ["- 2  Minutes"], "2024-03-15 10:18:30"),
    ("2024-03-15 10:20:30", ["Start of Year"], "2024-01-01 00:00:00"),
])
def test_modifiers(spark, start, modifiers, want):
    got = dates.strftime("%Y-%m-%d %H:%M:%S", dates.datetime(*modifiers, now=start))
    assert value(spark, got) == want


@pytest.mark.parametrize("modifier", ["weekday 0", "start of week", "7days", "+1 week", "julianday"])
def test_unknown_modifier(modifier):
    with pytest.raises(dates.UnsupportedModifier):
        dates.datetime(modifier, now="2024-01-01")


def test_strftime(spark):
    at = "2024-03-05 07:08:09.123456"
    for fmt, want in {
        "%Y-%m-%dT%H:%M:%fZ": "2024-03-05T07:08:09.123Z",
        "%e|%j|%I|%p|%W": "5|065|07|AM|10",
        "it's 100%% of %d": "it's 100% of 05",
        "%s": 1709622489,
        "": "",
    }.items():
        assert value(spark, dates.strftime(fmt, at)) == want
    with pytest.raises(dates.UnsupportedModifier):
        dates.strftime("%w", at)


def test_epoch_and_julian_day(spark):
    assert value(spark, dates.unixepoch("2023-11-14 22:13:20.9")) == 1700000000
    assert value(spark, dates.julianday("1970-01-01")) == 2440587.5
    assert value(spark, F.abs(dates.unixepoch() - F.unix_seconds(F.current_timestamp()))) == 0


def test_json_paths(spark):
    assert jsons.json_path('$."a key".b[0]') == "$['a key']['b'][0]"
    for bad in ("name", "$.a[#-1]", "$.", "$x"):
        with pytest.raises(ValueError):
            jsons.json_path(bad)
    doc = F.lit('{"plan":"pro","tags":["a","b"],"n":null,"a key":{"b":1}}')
    assert value(spark, jsons.json_extract(doc, "$.plan")) == "pro"
    assert value(spark, jsons.json_extract(doc, "$.tags[1]")) == "b"
    assert value(spark, jsons.json_extract(doc, "$.n")) is None
    assert value(spark, jsons.json_extract(doc, '$."a key".b')) == "1"
    assert value(spark, jsons.json_array_length(doc, "$.tags")) == 2
    assert value(spark, jsons.json_array_length(doc, "$.plan")) is None


def test_json_builders(spark):
    made = jsons.json_object(F.lit("a"), F.lit(1), F.lit("b"), F.lit(None), F.lit("a"), F.lit('x"y'))
    assert value(spark, made) == '{"a":1,"b":null,"a":"x\\"y"}'
    assert value(spark, jsons.json_array(F.lit(1), F.lit("x"), F.lit(None), F.lit(True))) == '[1,"x",null,true]'
    assert value(spark, jsons.json_array()) == "[]"


@pytest.mark.parametrize("part, want", [
    ({"a": 1}, True), ({"a": "1"}, False), ({"b": {"c": [2]}}, True), ({"b": {"c": [4]}}, False),
    ({"t": True}, True), ({"n": None}, True), ({"none": None}, False), ({}, True), ({"a": 1.0}, True),
])
def test_json_contains(spark, part, want):
    doc = F.lit('{"a":1,"b":{"c":[1,2,"x"]},"t":true,"n":null}')
    assert value(spark, jsons.json_contains(doc, part)) is want


def test_scalars(spark):
    assert value(spark, scalars.hex_text(F.lit(12))) == "3132"
    assert value(spark, scalars.hex_text(F.lit(bytearray([255, 0])))) == "FF00"
    assert value(spark, scalars.instr(F.lit("hello"), F.lit("l"))) == 3
    assert value(spark, scalars.scalar_max(F.lit(1), F.lit(None), F.lit(3))) == 3
    assert value(spark, scalars.cast_as(F.lit(-3.7), "INTEGER")) == -3
    assert value(spark, scalars.like(F.lit("ABC"), "a%")) is True
    assert value(spark, scalars.like(F.lit("a_c"), "A!_c", "!")) is True
    assert value(spark, scalars.regexp(F.lit("xAy"), "A")) is True
    ids = spark.range(100).select(scalars.random_hex(40).alias("h")).distinct()
    assert ids.where(F.col("h").rlike("^[0-9a-f]{80}$")).count() == 100
