import random

import pytest
from helpers import bag, one, plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quayside.operators import identity, load, paging


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


USERS = "id bigint, email string, name string, note string"


@pytest.fixture
def users(spark):
    return frame(spark, [(1, "a", "A", "keep"), (2, "b", "B", "keep"), (3, "c", "C", "keep")], USERS)


def test_upsert_mirrors_source(spark, users):
    source = frame(spark, [(2, "b2", None), (4, "d", "D")], "id bigint, email string, name string")
    got = load.upsert_mirror(source, users, ["id"], defaults={"note": F.lit("new")})
    want = [(2, "b2", None, "keep"), (4, "d", "D", "new")]
    assert sorted(rows(got)) == want
    again = load.upsert_mirror(source, got, ["id"], defaults={"note": F.lit("new")})
    assert sorted(rows(again)) == want
    assert one(load.upsert_changes(source, users, ["id"])) == (1, 1, 2)
    assert sorted(r[0] for r in rows(load.stale_rows(source, users, ["id"]))) == [1, 3]


def test_upsert_keeps_identity_columns(spark, users):
    source = frame(spark, [(2, "x"), (9, "y")], "id bigint, email string")
    got = load.upsert_mirror(source, users.select("id", "email"), ["id"], identity=["email"])
    assert sorted(rows(got)) == [(2, "b"), (9, "y")]


def test_upsert_does_not_read_a_target_with_nothing_to_keep(spark, users):
    source = frame(spark, [(2, "x")], "id bigint, email string")
    got = load.upsert_mirror(source, users.select("id", "email"), ["id"])
    assert rows(got) == [(2, "x")]
    assert "Join" not in plan(got)


def test_upsert_refuses_bad_keys(spark, users):
    with pytest.raises(load.NoKey, match="t: no primary key"):
        load.upsert_mirror(users, users, [], table="t")
    twice = users.unionAll(users)
    with pytest.raises(PySparkException, match="not unique"):
        load.upsert_mirror(twice, users, ["id"]).collect()
    unset = frame(spark, [(None, "x")], "id bigint, email string")
    with pytest.raises(PySparkException, match="NULL"):
        load.upsert_mirror(unset, users, ["id"]).collect()


def test_load_if_empty(spark, users):
    empty = users.where("false")
    assert load.load_if_empty(users.select("id", "email"), empty).count() == 3
    assert bag(load.load_if_empty(users.limit(1), users)) == bag(users)


def test_truncate_never_cascades(spark, users):
    with pytest.raises(load.Referenced, match="posts"):
        load.truncate_reload(users, users, "users", ["posts"])
    assert load.truncate_reload(users.limit(1), users, "users", ["users"]).count() == 1


def test_insert_ignore_one_key(spark):
    target = frame(spark, [("a", 0, 1)], "k string, seq int, v int")
    source = frame(
        spark, [("a", 1, 10), ("b", 2, 20), ("b", 3, 30), (None, 4, 40), (None, 5, 50)], "k string, seq int, v int"
    )
    got = load.insert_ignore(source, target, [["k"]], "seq")
    assert sorted(r[2] for r in rows(got)) == [1, 20, 40, 50]


def serial_ignore(source, target, keys, seq):
    """Row by row, as a database does it."""
    held = [{tuple(r[k] for k in key) for r in target} for key in keys]
    out = []
    for r in sorted(source, key=lambda r: r[seq]):
        values = [tuple(r[k] for k in key) for key in keys]
        if any(None not in v and v in h for v, h in zip(values, held)):
            continue
        for v, h in zip(values, held):
            h.add(v)
        out.append(r[seq])
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_insert_ignore_several_keys(spark, seed):
    rng = random.Random(seed)

    def row(i):
        return {"seq": i, "a": rng.choice([None, *range(6)]), "b": rng.choice([None, 0, 0, 0, 1, 2, 3, 4]),
                "c": rng.randrange(3)}

    source = [row(i) for i in range(60)]
    target = [row(1000 + i) for i in range(3)]
    keys = [["a"], ["b", "c"]]
    schema = "seq int, a int, b int, c int"
    data = [[tuple(r[k] for k in ("seq", "a", "b", "c")) for r in side] for side in (source, target)]
    got = load.accepted_rows(frame(spark, data[0], schema), frame(spark, data[1], schema), keys, "seq")
    assert sorted(r["seq"] for r in got.collect()) == serial_ignore(source, target, keys, "seq")


def test_insert_ignore_follows_long_chains(spark):
    source = spark.range(1, 1201).select("id", F.expr("(id + 1) div 2").alias("a"), F.expr("id div 2").alias("b"))
    got = load.accepted_rows(source, source.where("false"), [["a"], ["b"]], "id")
    assert sorted(r["id"] for r in got.collect()) == list(range(1, 1201, 2))


def test_other_unique_keys_must_hold(spark, users):
    source = frame(spark, [(1, "b", 1)], "id bigint, email string, seq int")
    with pytest.raises(PySparkException, match="UNIQUE constraint failed: users.email"):
        load.insert_replace(
            source, users, "seq", pk=["id"], unique=[["email"]], listed=["id", "email"], table="users"
        ).collect()
    mirrored = frame(spark, [(1, "x"), (2, "x")], "id bigint, email string")
    with pytest.raises(PySparkException, match="UNIQUE constraint failed: users.email"):
        load.upsert_mirror(mirrored, users, ["id"], unique=[["email"]], table="users").collect()


def test_insert_replace(spark, users):
    source = frame(
        spark, [(1, "first", 1), (1, None, 2), (7, "g", 3)], "id bigint, email string, seq int"
    )
    got = load.insert_replace(
        source, users, "seq", pk=["id"], listed=["id", "email"], defaults={"name": F.lit("?")}
    )
    assert sorted(rows(got)) == [
        (1, None, "A", "keep"), (2, "b", "B", "keep"), (3, "c", "C", "keep"), (7, "g", "?", None),
    ]


def test_insert_replace_by_unique_key(spark):
    target = frame(spark, [(1, "theme", "dark"), (1, None, "old")], "user_id int, key string, value string")
    source = frame(
        spark, [(1, "theme", "light", 1), (1, None, "new", 2)], "user_id int, key string, value string, seq int"
    )
    got = load.insert_replace(source, target, "seq", unique=[["user_id", "key"]])
    assert sorted(rows(got), key=str) == [(1, "theme", "light"), (1, None, "new"), (1, None, "old")]


def test_insert_replace_edge_cases(spark, users):
    keys_only = frame(spark, [(1, 1), (8, 2)], "id bigint, seq int")
    got = load.insert_replace(keys_only, users, "seq", pk=["id"], listed=["id"])
    assert sorted(r[0:2] for r in rows(got)) == [(1, "a"), (2, "b"), (3, "c"), (8, None)]
    with pytest.raises(load.NoKey, match="nokeys: no primary key or unique index"):
        load.insert_replace(keys_only, users, "seq", table="nokeys")
    with pytest.raises(PySparkException, match="NOT NULL constraint failed: t.id"):
        unset = frame(spark, [(None, 1)], "id bigint, seq int")
        load.insert_replace(unset, users, "seq", pk=["id"], table="t").collect()


def test_insert_abort(spark, users):
    with pytest.raises(load.Conflict, match="UNIQUE constraint failed: users.id"):
        load.insert_abort(users.limit(1), users, [["id"]], table="users")
    more = frame(spark, [(9, "z", None, None)], USERS)
    assert load.insert_abort(more, users, [["id"], ["email"]]).count() == 4


def test_update_and_delete_leave_null_conditions_alone(spark):
    data = frame(spark, [(1, "x"), (2, None)], "id int, s string")
    changed = load.update_where(data, F.col("s") == "x", {"s": F.lit("y")})
    assert sorted(rows(changed)) == [(1, "y"), (2, None)]
    assert rows(load.delete_where(data, F.col("s") == "x")) == [(2, None)]


def test_next_identity(spark):
    for ids, want in (([], 1), ([-5], 1), ([3, 10], 11), ([None], 1)):
        data = frame(spark, [(i,) for i in ids], "id bigint")
        assert one(identity.next_identity(data, "id")) == (want,)


@pytest.mark.parametrize("slices", [1, 2, 7, 40])
def test_row_positions_are_exact(spark, slices):
    values = random.Random(slices).sample(range(-10_000, 10_000), 500)
    data = frame(spark, [(v,) for v in values], "k bigint").repartition(5)
    got = dict(rows(identity.row_positions(data, "k", slices=slices)))
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}


def test_assign_identity(spark):
    data = frame(spark, [(None, 1.5), (7, 2.5), (None, 0.5)], "id bigint, at double")
    got = identity.assign_identity(data, "id", "at", first=11)
    assert sorted(rows(got)) == [(7, 2.5), (11, 0.5), (12, 1.5)]
    assert identity.assign_identity(data.where("false"), "id", "at").count() == 0


def test_pages(spark):
    data = spark.range(1000).repartition(7)
    ids = [r[0] for r in rows(paging.offset_page(data, "id", 10, 5))]
    assert ids == [10, 11, 12, 13, 14]
    deep = [r[0] for r in rows(paging.offset_page(data, "id", 500, 5, shallow=10))]
    assert deep == [500, 501, 502, 503, 504]
    texts = data.select(F.lpad(F.col("id").cast("string"), 4, "0").alias("t"))
    by_text = [r[0] for r in rows(paging.offset_page(texts, "t", 500, 5, shallow=10))]
    assert by_text == ["0500", "0501", "0502", "0503", "0504"]
    assert paging.offset_page(data, "id", 990, -1, shallow=10).count() == 10
    assert [r[0] for r in rows(paging.keyset_page(data, "id", 41, 2))] == [42, 43]
    assert paging.limit(data, -1).count() == 1000


@pytest.mark.parametrize("n", [2, 1500])
def test_top_n_per_key_is_exact_on_both_ways(spark, n):
    data = spark.range(4000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    got = paging.top_n_per_key(data, ["k"], [F.col("id").desc()], n)
    want = sum(sorted((i for i in range(4000) if i % 3), reverse=True)[:n]) + sum(
        sorted(range(0, 4000, 3), reverse=True)[:n]
    )
    assert one(got.agg(F.sum("id"))) == (want,)


def test_top_n_is_cut_before_the_shuffle(spark):
    data = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(paging.top_n_per_key(data, ["k"], [F.col("id").desc()], 2))
    assert "WindowGroupLimit" in text and "Partial" in text
