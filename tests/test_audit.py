import pytest
from helpers import rows
from pyspark.sql import functions as F

from quayside.operators import audit
from quayside.operators.present import present, type_words
from quayside.tables import Field, ForeignKey, Table


@pytest.fixture
def posts(spark):
    return spark.createDataFrame(
        [(1, 1, "s", 0, "t"), (2, 1, "s", 1, None), (3, 9, "q", 7, "t"), (4, None, "s", None, "t"), (5, None, "s", 1, "t")],
        "id int, user_id int, slug string, published int, title string",
    )


def test_unique_names_every_column_and_exempts_null(posts):
    got = rows(audit.unique_violations(posts, "posts", ["user_id", "slug"]))
    assert got == [
        ("UNIQUE constraint failed: posts.user_id, posts.slug", "posts", "user_id, slug", '["1","s"]', 2)
    ]


def test_unique_without_case(spark):
    data = spark.createDataFrame([("A",), ("a",), ("b",)], "name string")
    assert rows(audit.unique_violations(data, "u", ["name"])) == []
    assert [r[3:] for r in rows(audit.unique_violations(data, "u", ["name"], nocase=["name"]))] == [('["a"]', 2)]


def test_not_null(posts):
    got = rows(audit.not_null_violations(posts, "posts", ["id", "title", "user_id"]))
    assert sorted(got) == [
        ("NOT NULL constraint failed: posts.title", "posts", "title", 1),
        ("NOT NULL constraint failed: posts.user_id", "posts", "user_id", 2),
    ]


def test_foreign_keys(spark, posts):
    users = spark.createDataFrame([(1,)], "id int")
    got = rows(audit.fk_violations(posts, "posts", ["user_id"], users, ["id"]))
    assert got == [("FOREIGN KEY constraint failed", "posts", "user_id", '["9"]', 1)]


def test_foreign_key_to_itself(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 8), (4, 4)], "id int, parent int")
    got = rows(audit.fk_violations(tree, "tree", ["parent"], tree, ["id"]))
    assert [r[3:] for r in got] == [('["8"]', 1)]


def test_checks_pass_on_null(posts):
    checks = {"posts.flag": F.col("published").isin(0, 1), "any": F.col("id") > 0}
    assert rows(audit.check_violations(posts, "posts", checks)) == [
        ("CHECK constraint failed: posts.flag", "posts", "posts.flag", 1)
    ]
    assert [r["id"] for r in audit.check_failures(posts, checks["posts.flag"]).collect()] == [3]


def test_whole_audit(spark, posts):
    table = Table(
        "posts",
        (Field("id", "INT"), Field("user_id", "INT"), Field("slug", "TEXT"), Field("published", "INT"),
         Field("title", "TEXT", not_null=True)),
        pk=("id",), unique=(("user_id", "slug"),),
        foreign_keys=(ForeignKey(("user_id",), "users", ("id",)),),
        checks={"flag": F.col("published").isin(0, 1)},
    )
    users = spark.createDataFrame([(1,)], "id int")
    messages = sorted(r["message"] for r in audit.audit(posts, table, {"users": users}).collect())
    assert [m.split(" constraint")[0] for m in messages] == ["CHECK", "FOREIGN KEY", "NOT NULL", "UNIQUE"]


def test_verify(spark):
    a, b = spark.range(5), spark.range(4)
    report = audit.verify_counts({"x": a, "y": a, "z": a}, {"x": a, "y": b})
    assert sorted(rows(report)) == [("x", 5, 5, True), ("y", 5, 4, False), ("z", 5, None, False)]
    assert not audit.all_ok(report)
    assert audit.all_ok(audit.verify_counts({"x": a}, {"x": a}))


def test_present(spark):
    data = spark.sql(
        "select 5L as n, 1.50 as d, timestamp'2024-01-02 03:04:05.6789' as at, date'2024-01-02' as day, null as v"
    )
    assert rows(present(data)) == [(5, 1.5, "2024-01-02T03:04:05.678Z", "2024-01-02", None)]
    text = present(data, int_mode="string", timestamps="date")
    assert [f.dataType.simpleString() for f in text.schema][:4] == ["string", "string", "timestamp", "date"]
    assert rows(text.select("n", "d")) == [("5", "1.50")]
    assert type_words(data) == ["INTEGER", "REAL", "DATETIME", "DATE", ""]
    with pytest.raises(ValueError):
        present(data, int_mode="float")
