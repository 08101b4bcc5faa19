import pytest
from helpers import one, rows
from pyspark.sql import functions as F

from quayside.operators import align
from quayside.tables import Expr, Field, ForeignKey, Table, spark_type, target_type


@pytest.mark.parametrize("declared, target", [
    ("INTEGER", "bigint"), ("int", "bigint"), ("UNSIGNED BIG INT", "bigint"), ("TINYINT(1)", "bigint"),
    ("TEXT", "text"), ("VARCHAR(255)", "text"), ("NATIVE  CHARACTER(70)", "text"), ("CLOB", "text"), ("", "text"),
    ("POINTER", "bigint"), ("CHARINT", "bigint"), ("BLOB", "bytea"), ("VARBINARY(3)", "bytea"),
    ("REAL", "double precision"), ("FLOAT", "double precision"), ("DOUBLE", "double precision"),
    ("double precision", "double precision"), ("BOOLEAN", "boolean"), ("bool", "boolean"), ("DATE", "date"),
    ("DATETIME", "timestamptz"), ("TIMESTAMP", "timestamptz"), ("TIME", "time"), ("UUID", "uuid"),
    ("NUMERIC", "numeric"), ("DECIMAL(10, 2)", "numeric(10, 2)"), ("JSON", "text"), ("JSONB", "jsonb"),
    ("INTERVAL", "interval"), ("TEXT[]", "text[]"), ("WIDGET", "text"),
    ("timestamp with time zone", "timestamp with time zone"),
])
def test_declared_types(declared, target):
    assert target_type(declared) == target
    assert target_type(target) == target


def test_json_targets_and_spark_types(spark):
    assert target_type("JSON", json="jsonb") == "jsonb"
    assert spark_type("numeric(10, 2)").simpleString() == "decimal(10,2)"
    assert spark_type("numeric").simpleString() == "decimal(38,18)"
    assert spark_type("timestamptz").simpleString() == "timestamp"
    assert spark_type("bytea").simpleString() == "binary"
    assert spark_type("time").simpleString() == "string"


USERS = Table(
    "users",
    (
        Field("id", "INTEGER", not_null=True),
        Field("email", "TEXT", not_null=True),
        Field("is_admin", "BOOLEAN", default=0),
        Field("joined_at", "INTEGER", default=Expr("(strftime('%s', 'now'))")),
        Field("avatar", "BLOB"),
        Field("created_at", "TEXT", default=Expr("(datetime('now'))")),
        Field("rowid", "INTEGER"),
        Field("shout", "TEXT", generated=lambda: F.upper("email")),
    ),
    pk=("id",),
    unique=(("email",),),
)


def test_identity_and_promotion():
    assert USERS.identity == "id"
    assert USERS.target("created_at") == "timestamptz"
    assert Field("at", "TEXT", default=Expr("CURRENT_TIMESTAMP")).target(promote_text_timestamps=False) == "text"
    assert Field("at", "TEXT", default="datetime('now')").target() == "text"
    assert Table("t", (Field("k", "TEXT"),), pk=("k",)).identity is None
    assert Table("t", (Field("a", "INT"), Field("b", "INT")), pk=("a", "b")).identity is None


def test_align_types_defaults_and_generated(spark):
    source = spark.createDataFrame(
        [("1", "a@x", "yes", "ignored", "7"), ("2", None, "2", "ignored", "8")],
        "id string, email string, is_admin string, shout string, k string",
    )
    assert align.missing_columns(source, USERS, row_key="k") == ["joined_at", "avatar", "created_at"]
    got = align.align(source, USERS, now="2023-11-14 22:13:20", row_key="k")
    assert got.columns == USERS.columns
    assert [f.dataType for f in got.schema] == [f.dataType for f in USERS.schema()]
    a, b = sorted(rows(got.withColumn("created_at", F.col("created_at").cast("string"))))
    assert a == (1, "a@x", True, 1700000000, None, "2023-11-14 22:13:20", 7, "A@X")
    assert b == (2, None, None, 1700000000, None, "2023-11-14 22:13:20", 8, None)


def test_a_present_null_is_not_defaulted(spark):
    source = spark.createDataFrame([(1, None)], "id int, is_admin string")
    got = align.align(source, Table("t", (Field("id", "INT"), Field("is_admin", "BOOL", default=1))))
    assert rows(got) == [(1, None)]


def test_rejects(spark):
    table = Table("t", (Field("id", "INT"), Field("at", "DATETIME"), Field("day", "DATE")))
    source = spark.createDataFrame(
        [("1", "2024-01-01", ""), ("2", "soon", "later"), ("99999999999999999999", "", "")],
        "id string, at string, day string",
    )
    good, bad = align.split_rejects(align.align(source, table, with_rejects=True))
    assert [r["id"] for r in good.collect()] == [1]
    found = sorted(rows(bad.select("column", "type", "value")))
    assert found == [
        ("at", "timestamptz", "soon"), ("day", "date", "later"), ("id", "bigint", "99999999999999999999"),
    ]


@pytest.mark.parametrize("text, want", [
    ("CURRENT_TIMESTAMP", "2024-02-01 00:00:00"),
    ("(datetime( 'now' ))", "2024-02-01 00:00:00"),
    ("(strftime('%Y-%m-%dT%H:%M:%fZ','now'))", "2024-02-01 00:00:00"),
    ("(datetime('now', '+7 days', 'start of month'))", "2024-02-01 00:00:00"),
    ("(unixepoch())", "1706745600"),
    ("(date('now', '-1 day'))", "2024-01-31"),
    ("CURRENT_DATE", "2024-02-01"),
    ("CURRENT_TIME", "00:00:00"),
    ("(strftime('%d/%m', 'now', '+1 day'))", "02/02"),
])
def test_default_expressions(spark, text, want):
    assert one(spark.range(1).select(Expr(text).column("2024-02-01").cast("string"))) == (want,)


def test_random_defaults(spark):
    low, up, raw = (Expr(t).column() for t in ("(lower(hex(randomblob(8))))", "hex(randomblob(8))", "randomblob(8)"))
    ok = low.rlike("^[0-9a-f]{16}$") & up.rlike("^[0-9A-F]{16}$") & (F.octet_length(raw) == 8)
    assert one(spark.range(1).select(ok)) == (True,)


def test_formatted_default_on_a_timestamp_is_the_moment(spark):
    field = Field("at", "DATETIME", default=Expr("(strftime('%d.%m.%Y', 'now'))"))
    got = align.add_column(spark.range(1), field, now="2024-02-01 05:06:07")
    assert one(got.select(F.col("at").cast("string"))) == ("2024-02-01 05:06:07",)


def test_unknown_default_expression():
    with pytest.raises(ValueError, match="not supported"):
        Expr("abs(random())").column()


def test_unnest_pads_with_null(spark):
    data = spark.sql("select 1 as k, array(1, 2) as a, array('x') as b")
    assert sorted(rows(align.unnest(data, "a", "b", keep=("k",)))) == [(1, 1, "x"), (1, 2, None)]


def test_foreign_key_declaration():
    key = ForeignKey(("user_id",), "users", ("id",))
    assert key.parent == "users"
