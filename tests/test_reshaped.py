"""Publishing in another shape, and copies of values that do not fit."""

import pytest

from quayside.plans.copyjob import RejectedValues, copy_tables
from quayside.sources import publish
from quayside.tables import Field, Table


def test_other_buckets_and_added_columns_lose_nothing(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS n")
    base = str(tmp_path / "reshaped")
    publish(rows, "reshaped", base, bucket_by=["id"], buckets=4)
    for state, options in (
        (rows, {"bucket_by": ["id"], "buckets": 8}),
        (rows, {}),  # keeps its eight buckets
        (rows.selectExpr("*", "'new' AS note"), {}),
    ):
        publish(state, "reshaped", base, **options)
        table = spark.table("reshaped")
        assert table.columns == state.columns
        assert table.count() == table.groupBy("id").count().count() == 1000
        assert table.join(rows, "id").count() == 1000
    with pytest.raises(ValueError, match="lose columns"):
        publish(rows, "reshaped", base)
    spark.sql("DROP TABLE reshaped")


def test_copies_refuse_or_report_what_does_not_fit(spark, tmp_path):
    table = Table("dated", (Field("id", "INTEGER"), Field("at", "DATETIME")), pk=("id",))
    rows = [("1", "2024-01-02"), ("2", "not a date"), ("3", "0xFFFFFFFFFFFFFFFFFF")]
    source = spark.createDataFrame(rows, "id string, at string")
    base = str(tmp_path / "dated")
    with pytest.raises(RejectedValues):
        copy_tables(spark, {"dated": source}, [table], base)
    assert not spark.catalog.tableExists("dated")
    (report,) = copy_tables(spark, {"dated": source}, [table], base, rejects="keep")
    assert (report.rows, report.rejected) == (1, 2)
    assert spark.read.parquet(f"{base}/dated-rejects").count() == 2
    spark.sql("DROP TABLE dated")
    twice = spark.createDataFrame([("1", None), ("1", None)], "id string, at string")
    with pytest.raises(Exception, match="dated"):
        copy_tables(spark, {"dated": twice}, [table], str(tmp_path / "again"))


def test_long_literals_and_array_text(spark):
    from pyspark.sql import functions as F

    from quayside.functions import coerce
    from quayside.functions.jsons import json_array_length

    frame = spark.createDataFrame([("0x" + "F" * 18,), ("0xff",), ("0b" + "1" * 70,)], "s string")
    whole = [r[0] for r in frame.select(coerce.to_float(F.col("s"), frame.schema["s"].dataType).value).collect()]
    assert whole == [float(16**18 - 1), 255.0, float(2**70 - 1)]
    docs = spark.createDataFrame([('{"a":"[1,2]"}',), ('{"a":[1,2]}',), ("{}",)], "j string")
    assert [r[0] for r in docs.select(json_array_length(F.col("j"), "$.a")).collect()] == [None, 2, None]
