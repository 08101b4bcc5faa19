import pytest
from helpers import one
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quayside.functions import dates, sql_names


@pytest.fixture(scope="module")
def sql(spark):
    sql_names.register(spark)
    return lambda text: one(spark.sql(f"select {text}"))[0]


@pytest.mark.parametrize("modifiers", [
    [], ["+1 month"], ["-7 days"], ["start of month", "-1 day"], ["1.5 months"], ["+1.3 years"], ["- 2  Minutes"],
    ["localtime", "UTC", "Start of Year", "0.25 hours"],
])
def test_same_as_the_column_functions(spark, sql, modifiers):
    at = "2024-01-31 10:20:30.123456"
    listed = "".join(f", '{m}'" for m in modifiers)
    for fmt in ("%Y-%m-%dT%H:%M:%fZ", "%e|%j|%I %p|%W", "it''s 100%% of %d%m", "%s", "", "plain"):
        column = dates.strftime(fmt.replace("''", "'"), at, *modifiers).cast("string")
        assert sql(f"strftime('{fmt}', '{at}'{listed})") == one(spark.range(1).select(column))[0]
    assert sql(f"unixepoch('{at}'{listed})") == one(spark.range(1).select(dates.unixepoch(at, *modifiers)))[0]
    assert sql(f"julianday('{at}'{listed})") == one(spark.range(1).select(dates.julianday(at, *modifiers)))[0]
    same = one(spark.range(1).select(dates.datetime(*modifiers, now=at).cast("string")))[0]
    assert sql(f"cast(datetime('{at}'{listed}) as string)") == same


def test_now(sql):
    assert abs(sql("unixepoch() - unix_seconds(current_timestamp())")) <= 1
    assert sql("datetime('now', '-7 days') < datetime('now')") is True
    assert abs(sql("julianday('now') - julianday()")) < 1


def test_unknown_words_are_errors(sql):
    for text in ("datetime('now', 'weekday 0')", "strftime('%w', 'now')"):
        with pytest.raises(PySparkException, match="not supported"):
            sql(text)


def test_json_and_random(spark, sql):
    assert sql("""json_extract('{"a key":{"b":[1,"x"]}}', '$."a key".b[1]')""") == "x"
    assert sql("length(hex(randomblob(40)))") == 80
    ids = spark.range(50).select(F.expr("lower(hex(randomblob(16)))").alias("i"))
    assert ids.distinct().where("i rlike '^[0-9a-f]{32}$'").count() == 50


def test_literal_modifiers_are_folded(spark, sql):
    text = spark.sql("select * from (select timestamp_ntz'2024-01-01' at) where at > datetime('now', '-7 days')")
    assert "rlike" not in text._jdf.queryExecution().optimizedPlan().toString().lower()


def test_paths_that_are_not_supported_are_errors(sql):
    for path in ("$.a[#-1]", "a", "$..a", "$.a[x]", "$.a["):
        with pytest.raises(PySparkException, match="JSON path not supported"):
            sql(f"""json_extract('{{"a":[1]}}', '{path}')""")
    assert sql("""json_extract('{"a":[1]}', '$.a[0]')""") == "1" and sql("json_extract('[3]', '$[0]')") == "3"
    assert sql("json_extract('[3]', cast(null as string))") is None and sql("json_extract('{}', '$')") == "{}"


def test_dates_with_modifiers(sql):
    assert str(sql("date_of('2024-03-31 10:00:00', '-1 month')")) == "2024-02-29"
    assert sql("date_of('now') = current_date()") is True
