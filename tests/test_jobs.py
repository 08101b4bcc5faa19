import importlib
import re
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from quayside.operators import load
from quayside.plans.copyjob import ConstraintFailed, RejectedValues, copy_tables, load_order, report_frame, verify_tables
from quayside.sources import current_version, jdbc_options, key_slices, latest, publish, read_loose, remainder_predicates
from quayside.sources.snapshots import ConcurrentPublish
from quayside.streaming import catch_up
from quayside.tables import Expr, Field, ForeignKey, Table


def unique(name):
    return f"{name}_{uuid.uuid4().hex[:8]}"


def test_slices():
    s = key_slices(1, 100_000, workers=8)
    assert (s.count, s.width) == (8, 12500)
    assert key_slices(1, 100, workers=8).count == 1
    assert key_slices(5, 5, workers=8) == (5, 5, 1, 1)


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "t", key_slices(1, 100_000, 4), "id", user="u")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"
    assert options["lowerBound"] == "1" and options["upperBound"] == "100001"
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")


def test_remainder_predicates_cover_every_row_once(spark):
    data = spark.sql("select id - 5 as k from range(11) union all select null")
    parts = [data.where(p).count() for p in remainder_predicates("k", 3)]
    assert sum(parts) == 12 and len(parts) == 3
    either = " or ".join(f"({p})" for p in remainder_predicates("k", 3))
    assert data.where(either).count() == 12


def test_loose_files_are_all_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,,yes\n2.5,x,"a,b"\n')
    frame = read_loose(spark, str(tmp_path), "csv", ["a", "b", "c"])
    assert {f.dataType.simpleString() for f in frame.schema} == {"string"}
    assert sorted(rows(frame)) == [("1", None, "yes"), ("2.5", "x", "a,b")]
    with pytest.raises(ValueError, match="column names"):
        read_loose(spark, str(tmp_path), "csv")


def test_publish_switches_states(spark, tmp_path):
    name = unique("t")
    base = str(tmp_path / name)
    assert current_version(spark, name) == (0, -1)
    assert publish(spark.range(10), name, base) == 10
    before = spark.table(name)
    assert publish(spark.table(name).where("id < 4"), name, base, cluster_by=["id"]) == 4
    assert latest(spark, name).count() == 4
    assert before.count() == 10, "a reader of the old state is not disturbed"
    assert current_version(spark, name) == (2, -1)


def test_bucketed_states_join_without_a_shuffle(spark, tmp_path):
    source, target = unique("s"), unique("t")
    old = spark.range(100).select("id", F.lit("a").alias("v"), F.lit("kept").alias("own"))
    for _ in range(2):
        publish(old, target, str(tmp_path / "t"), bucket_by=["id"], buckets=4)
    publish(spark.range(50, 150).select("id", F.lit("b").alias("v")), source, str(tmp_path / "s"),
            bucket_by=["id"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = load.upsert_mirror(spark.table(source), spark.table(target), ["id"], check_keys=False)
        assert "Exchange" not in plan(merged)
        assert merged.count() == 100 and merged.where("own = 'kept'").count() == 50
        assert current_version(spark, target)[0] == 2
        publish(merged, target, str(tmp_path / "t"), bucket_by=["id"], buckets=4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert latest(spark, target).count() == 100
    guarded = load.upsert_mirror(spark.table(source), spark.table(target), ["id"])
    assert "hashpartitioning" not in plan(guarded)


def test_of_two_racing_writers_one_fails(spark, tmp_path):
    name = unique("t")
    publish(spark.range(3), name, str(tmp_path))
    ready = threading.Barrier(2)

    def write(rows):
        publish(rows, name, str(tmp_path), before_commit=lambda _: ready.wait(60))

    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(write, spark.range(n)) for n in (5, 7)]
    failed = [j.exception() for j in jobs]
    assert sorted(type(e) for e in failed if e) == [ConcurrentPublish]
    assert latest(spark, name).count() == (7 if failed[0] else 5) and current_version(spark, name) == (2, -1)


def test_a_commit_the_catalog_missed_is_shown(spark, tmp_path, monkeypatch):
    """A writer that dies between its commit and the catalog's change."""
    publishing = importlib.import_module("quayside.sources.publish")
    name = unique("t")
    publish(spark.range(3), name, str(tmp_path))
    monkeypatch.setattr(publishing, "align_catalog", lambda *_: None)
    publish(spark.range(8), name, str(tmp_path))
    monkeypatch.undo()
    assert spark.table(name).count() == 3
    assert latest(spark, name).count() == 8 and spark.table(name).count() == 8


def test_partitions_and_buckets_are_kept(spark, tmp_path):
    by_day, by_key = unique("days"), unique("keys")
    data = spark.range(40).selectExpr("id", "concat('d', id % 4, \"'=/\") as day")
    publish(data, by_day, str(tmp_path / "d"), partition_by=["day"])
    publish(data, by_key, str(tmp_path / "k"), bucket_by=["id"], buckets=3)
    for name, base in ((by_day, "d"), (by_key, "k")):
        publish(latest(spark, name).where("id < 10 and day <> \"d3'=/\""), name, str(tmp_path / base))
        assert sorted(r["id"] for r in spark.table(name).collect()) == [0, 1, 2, 4, 5, 6, 8, 9]
    assert spark.sql(f"show partitions {by_day}").count() == 3
    wider = latest(spark, by_day).withColumn("more", F.lit(1))
    publish(wider, by_day, str(tmp_path / "d"))
    assert spark.table(by_day).where("more = 1").count() == 8 and spark.sql(f"show partitions {by_day}").count() == 3
    assert "Exchange" not in plan(spark.table(by_key).groupBy("id").count())


@pytest.mark.parametrize("mode", ["upsert", "truncate"])
def test_a_copy_over_a_followed_table_shows_its_rows(spark, tmp_path, mode):
    name = unique("kv")
    base, inbox = str(tmp_path / name), str(tmp_path / "in")
    publish(spark.range(20).selectExpr("id as k", "'old' as v"), name, base)

    def follow(*arriving):
        schema = "k long, v string, seq int"
        spark.createDataFrame(list(arriving), schema).coalesce(1).write.mode("append").parquet(inbox)
        changes = spark.readStream.schema(schema).parquet(inbox)
        catch_up(changes, name, base, ["k"], "seq", str(tmp_path / "c"), parts=4).awaitTermination()

    follow((3, "streamed", 5))
    target = Table(name, (Field("k", "INTEGER"), Field("v", "TEXT")), pk=("k",))
    source = spark.createDataFrame([(i, "new") for i in (1, 3, 25, 26, 27)], "k long, v string")
    (report,) = copy_tables(spark, {name: source}, [target], str(tmp_path), mode=mode)
    assert (report.rows, report.inserted, report.updated, report.removed) == (5, 3, 2, 18)
    want = [(1, "new"), (3, "new"), (25, "new"), (26, "new"), (27, "new")]
    assert sorted(rows(latest(spark, name))) == want
    assert sorted(rows(spark.table(name).select("k", "v"))) == want
    follow((3, "late", 4), (25, "next", 1), (30, "fresh", 1))  # 3 was replaced at 5 already
    want[2:3] = [(25, "next")]
    assert sorted(rows(latest(spark, name))) == [*want, (30, "fresh")]
    assert sorted(rows(spark.table(name).select("k", "v"))) == [*want, (30, "fresh")]


def test_a_followed_table_can_gain_columns_and_lose_its_layout(spark, tmp_path):
    name = unique("kv")
    base, inbox = str(tmp_path / name), str(tmp_path / "in")
    publish(spark.range(9).selectExpr("id as k", "1 as v"), name, base)
    spark.createDataFrame([(2, 5, 1)], "k long, v int, seq int").write.parquet(inbox)
    changes = spark.readStream.schema("k long, v int, seq int").parquet(inbox)
    catch_up(changes, name, base, ["k"], "seq", str(tmp_path / "c"), parts=3).awaitTermination()
    publish(latest(spark, name).withColumn("w", F.lit("x")), name, base)
    assert latest(spark, name).where("w = 'x'").count() == 9 and latest(spark, name).columns == ["k", "v", "w"]
    with pytest.raises(ValueError, match="lose columns"):
        publish(spark.range(3).selectExpr("id as k"), name, base)
    publish(latest(spark, name), name, base, bucket_by=["k"], buckets=2)
    assert spark.table(name).columns == ["k", "v", "w"] and spark.table(name).where("v = 5").count() == 1


def test_a_failed_write_changes_nothing(spark, tmp_path):
    name = unique("t")
    publish(spark.range(3), name, str(tmp_path))
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error("no")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        publish(broken, name, str(tmp_path))
    assert latest(spark, name).count() == 3 and current_version(spark, name)[0] == 1


def declared(suffix):
    users, posts = f"users_{suffix}", f"posts_{suffix}"
    return [
        Table(users, (
            Field("id", "INTEGER"), Field("email", "TEXT", not_null=True), Field("is_admin", "BOOLEAN", default=0),
            Field("joined_at", "INTEGER"), Field("created_at", "TEXT", default=Expr("(datetime('now'))")),
        ), pk=("id",), unique=(("email",),)),
        Table(posts, (
            Field("id", "INTEGER"), Field("user_id", "INTEGER"), Field("title", "TEXT"), Field("score", "REAL"),
            Field("published_at", "DATETIME"),
        ), pk=("id",), foreign_keys=(ForeignKey(("user_id",), users, ("id",)),)),
        Table(f"tags_{suffix}", (Field("post_id", "INTEGER"), Field("tag", "TEXT")), pk=("post_id", "tag"),
              foreign_keys=(ForeignKey(("post_id",), posts, ("id",)),)),
        Table(f"audit_{suffix}", (Field("id", "INTEGER"), Field("what", "TEXT")), pk=("id",)),
        Table(f"nopk_{suffix}", (Field("a", "INTEGER"),)),
    ]


def sources(spark, suffix):
    i = F.col("id")
    numbers = spark.range(1, 1001)
    return {
        f"users_{suffix}": spark.range(1, 251).select(
            "id", F.concat(F.lit("u"), i, F.lit("@x.io")).alias("email"), (i % 7 == 0).cast("int").alias("is_admin"),
            (i + 1700000000).cast("string").alias("joined_at"),
        ),
        f"posts_{suffix}": numbers.select(
            "id", (i % 250 + 1).alias("user_id"),
            F.concat(F.lit("Post "), i, F.lit("\twith tab\nand newline")).alias("title"), (i / 10).alias("score"),
            F.when(i % 2 == 0, (i + 1705000000).cast("string")).otherwise(F.lit("2024-01-02 03:04:05")).alias("published_at"),
        ),
        f"tags_{suffix}": spark.range(6).select((i % 3 + 1).alias("post_id"), F.chr(i / 3 + 97).alias("tag")),
        f"audit_{suffix}": spark.createDataFrame([(1, "boot"), (2, "tick")], "id int, what string"),
        f"only_here_{suffix}": spark.range(1),
    }


def test_copy_scenario(spark, tmp_path):
    suffix = uuid.uuid4().hex[:8]
    tables, given, base = declared(suffix), sources(spark, suffix), str(tmp_path)
    users, posts, tags, audit, only = (f"{n}_{suffix}" for n in ("users", "posts", "tags", "audit", "only_here"))

    def run(**options):
        return copy_tables(spark, given, tables, base, **options)

    assert {(r.mode, r.rows) for r in run(dry_run=True)} == {("dry-run", 0)}
    reports = run(exclude=[only.upper()])
    assert [(r.table, r.mode, r.rows) for r in reports] == [
        (audit, "load", 2), (users, "load", 250), (posts, "load", 1000), (tags, "load", 6),
    ]
    seven = spark.table(users).where("email = 'u7@x.io'").first()
    assert seven["is_admin"] is True and seven["joined_at"] == 1700000007 and seven["created_at"] is not None
    post = spark.table(posts).where("id = 2").select("title", F.unix_seconds("published_at")).first()
    assert tuple(post) == ("Post 2\twith tab\nand newline", 1705000002)

    again = run(include=[users, "nowhere", only])
    assert [(r.mode, r.skipped) for r in again] == [
        ("skipped", "not in the source"), ("skipped", "no target table"), ("skipped", "already has rows"),
    ]
    assert report_frame(spark, again).count() == 3
    assert verify_tables(spark, given, exclude=[only]).where("not ok").count() == 0
    with pytest.raises(load.Referenced):
        run(mode="truncate", include=[users])
    assert [(r.mode, r.rows) for r in run(mode="truncate", include=[audit])] == [("truncate", 2)]

    stamps = spark.table(users).select("id", "created_at").where("id = 5").first()
    email = F.when(F.col("id") == 5, F.lit("changed@x.io")).otherwise(F.col("email"))
    more = spark.createDataFrame([(251, "u251@x.io", 0, "1")], given[users].schema)
    given[users] = given[users].where("id <> 250").withColumn("email", email).unionAll(more)
    (report,) = run(mode="upsert", include=[users])
    assert (report.mode, report.rows, report.inserted, report.updated, report.removed) == ("upsert", 250, 1, 249, 1)
    assert report.defaulted == ("created_at",) and report.next_identity == 252
    now = latest(spark, users)
    five = now.where("id = 5").first()
    assert five["email"] == "changed@x.io" and five["created_at"] == stamps["created_at"]
    assert now.where("id = 250").count() == 0 and now.where("id = 251").count() == 1
    given[users] = given[users].where("id <> 251")
    assert not verify_tables(spark, given, include=[users]).first()["ok"]
    given[f"nopk_{suffix}"] = spark.range(1)
    with pytest.raises(load.NoKey, match=re.escape(f"nopk_{suffix}: no primary key")):
        run(mode="upsert", include=[f"nopk_{suffix}"])


def test_constraints_hold_before_the_switch(spark, tmp_path):
    suffix, base = uuid.uuid4().hex[:8], str(tmp_path)
    parent, child = f"parent_{suffix}", f"child_{suffix}"
    tables = [
        Table(parent, (Field("id", "INTEGER"), Field("email", "TEXT", not_null=True), Field("flag", "BOOLEAN"), Field("n", "INT")),
              pk=("id",), unique=(("email",),), checks={"flag": "flag in (0, 1)", "small": F.col("n") < 100}),
        Table(child, (Field("rowid", "INTEGER"), Field("parent", "INTEGER"), Field("up", "INTEGER")), pk=("rowid",),
              foreign_keys=(ForeignKey(("parent",), parent, ("id",)), ForeignKey(("up",), child, ("rowid",)))),
    ]

    def run(people, links=(), **more):
        given = {parent: spark.createDataFrame(people, "id string, email string, flag string, n string")}
        if links:
            given[child] = spark.createDataFrame(list(links), "at int, parent int, up int")
        return copy_tables(spark, given, tables, base, mode=more.pop("mode", "upsert"), row_keys={child: "at"}, **more)

    assert [r.rows for r in run([("1", "a", "yes", "5")])] == [1]
    for people, error, text in (
        ([("1", None, "0", "5")], RejectedValues, f"NOT NULL constraint failed: {parent}.email"),
        ([("1", "a", "0", "500")], RejectedValues, "CHECK constraint failed: small"),
        ([("1", "a", "0", "5"), ("2", "a", "0", "5")], ConstraintFailed, f"UNIQUE constraint failed: {parent}.email"),
        ([("1", "a", "0", "5"), ("1", "b", "0", "5")], ConstraintFailed, f"UNIQUE constraint failed: {parent}.id"),
        ([("x", "a", "0", "5")], RejectedValues, f"NOT NULL constraint failed: {parent}.id"),
    ):
        with pytest.raises(error, match=re.escape(text)):
            run(people)
    assert rows(latest(spark, parent)) == [(1, "a", True, 5)]
    with pytest.raises(ConstraintFailed, match="FOREIGN KEY"):
        run([("1", "a", "0", "5")], [(7, 1, None), (8, 2, None)])
    with pytest.raises(ConstraintFailed, match="FOREIGN KEY"):
        run([("1", "a", "0", "5")], [(7, 1, 9)])
    reports = run([("1", "a", "0", "5"), ("2", None, "0", "5"), ("3", "c", "maybe", "5")],
                  [(7, 1, 7), (8, 2, None), (9, 3, 7), (10, None, 8), (11, None, None)], rejects="keep")
    assert [(r.table, r.rows, r.inserted, r.updated, r.rejected, r.next_identity) for r in reports] == [
        (parent, 2, 1, 1, 1, 4), (child, 3, 3, 0, 2, 12),
    ]
    assert sorted(r[0] for r in rows(latest(spark, child))) == [7, 9, 11]
    kept = spark.read.parquet(f"{base}/{child}-rejects").select("rowid", "column", "type").collect()
    assert sorted(tuple(r) for r in kept) == [(8, "parent", "foreign key"), (10, "up", "foreign key")]


def test_keys_without_case(spark, tmp_path):
    name, base = unique("names"), str(tmp_path)
    table = Table(name, (Field("name", "TEXT", nocase=True), Field("n", "INTEGER")), pk=("name",))

    def run(*data, mode="upsert"):
        return copy_tables(spark, {name: spark.createDataFrame(list(data), "name string, n int")}, [table], base, mode=mode)

    run(("Ann", 1), ("bob", 2))
    (report,) = run(("ANN", 5), ("Cy", 6))
    assert (report.inserted, report.updated, report.removed) == (1, 1, 1)
    assert sorted(rows(latest(spark, name))) == [("ANN", 5), ("Cy", 6)]
    with pytest.raises(ConstraintFailed, match=re.escape(f"UNIQUE constraint failed: {name}.name")):
        run(("x", 1), ("X", 2), mode="truncate")
    held = spark.createDataFrame([("AB", 1)], "name string, n int").withColumn("name", F.col("name").cast(table.type_of("name")))
    more = spark.createDataFrame([("ab", 2), ("c", 3), ("C", 4), (None, 5), (None, 6)], "name string, n int")
    more = more.withColumn("name", F.col("name").cast(table.type_of("name")))
    assert sorted(r["n"] for r in load.insert_ignore(more, held, [["name"]], "n").collect()) == [1, 3, 5, 6]
    assert sorted(r["n"] for r in load.insert_ignore(more, held, [["name"], ["n"]], "n").collect()) == [1, 3, 5, 6]


def test_load_order_with_a_cycle():
    def table(name, *parents):
        keys = tuple(ForeignKey(("x",), p, ("id",)) for p in parents)
        return Table(name, (Field("id", "INT"),), ("id",), foreign_keys=keys)

    order = load_order([table("c", "a"), table("a", "b"), table("b", "a", "b"), table("d", "d", "elsewhere")])
    assert sorted(order) == ["a", "b", "c", "d"] and order.index("c") > order.index("a")


def test_streaming_catch_up(spark, tmp_path):
    name = unique("kv")
    base, inbox = str(tmp_path / "table"), str(tmp_path / "in")
    publish(spark.createDataFrame([("a", "1"), ("b", "1")], "k string, v string"), name, base)

    def arrive(data):
        spark.createDataFrame(data, "k string, v string, seq int").coalesce(1).write.mode("append").parquet(inbox)

    def follow():
        changes = spark.readStream.schema("k string, v string, seq int").parquet(inbox)
        catch_up(changes, name, base, ["k"], "seq", str(tmp_path / "checkpoint")).awaitTermination()
        return sorted(rows(latest(spark, name)))

    arrive([("a", "2", 1), ("a", "3", 2), ("c", None, 3)])
    assert follow() == [("a", "3"), ("b", "1"), ("c", None)]
    version = current_version(spark, name)
    assert version == (2, 0)
    assert follow() == [("a", "3"), ("b", "1"), ("c", None)] and current_version(spark, name) == version
    arrive([("b", "9", 4)])
    assert follow() == [("a", "3"), ("b", "9"), ("c", None)]
    kept = {f: f.stat().st_mtime for f in (tmp_path / "table").glob("v-2-*/_part=*/*.parquet")}
    arrive([("c", "late", 2), ("d", "new", 1)])
    assert follow() == [("a", "3"), ("b", "9"), ("c", None), ("d", "new")]
    arrive([("d", "later", 9)])
    assert follow() == [("a", "3"), ("b", "9"), ("c", None), ("d", "later")]
    # The last batch wrote the part of its only key and no other.
    assert len(list((tmp_path / "table").glob("v-5-*/_part=*"))) == 1
    assert kept == {f: f.stat().st_mtime for f in kept}
