"""Plan checks: what must not appear in any query, and what must reach the scan."""

import re
from pathlib import Path

import pytest
from helpers import plan
from pyspark.sql import functions as F

from quayside.plans.catalog import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test data not present")
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")


@pytest.fixture(scope="module")
def plans(spark):
    """Plans without small-table broadcasts, as they would be for large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = {name: plan(run(spark, str(DATA))) for name, run in QUERIES.items()}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_nothing_unwanted(plans, name):
    for word in UNWANTED:
        assert word not in plans[name]
    assert not re.search(r"Window [^\n]*\n(?:(?!Exchange)[^\n]*\n)*[^\n]*SinglePartition", plans[name])


@pytest.mark.parametrize("name, condition", [
    ("keyset_page", "GreaterThan(o_orderkey,100)"),
    ("upsert_mirror", "Not(EqualTo(o_orderpriority,5-LOW))"),
    ("param_positional", "GreaterThan(o_totalprice,100000.0)"),
    ("recent_filter", "GreaterThan(ts,2024-01-11T00:00)"),
    ("recent_view", "GreaterThan(ts,2024-01-25T00:00)"),
])
def test_filters_reach_the_scan(plans, name, condition):
    assert condition in plans[name]


@pytest.mark.parametrize("name, schema", [
    ("unique_violations", "struct<l_orderkey:bigint,l_linenumber:int>"),
    ("key_bounds", "struct<o_orderkey:bigint>"),
    ("insert_abort_conflicts", "struct<o_custkey:bigint,o_orderpriority:string>"),
    ("strftime", "struct<event_id:bigint,ts:timestamp_ntz>"),
    ("search_and", "struct<doc_id:bigint,text:string>"),
])
def test_only_needed_columns_are_read(plans, name, schema):
    assert f"ReadSchema: {schema}" in plans[name]


@pytest.mark.parametrize("name", ["insert_ignore", "insert_replace", "topn_per_key"])
def test_hot_keys_are_cut_before_the_shuffle(plans, name):
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*WindowGroupLimit[^\n]*Partial", plans[name])


@pytest.mark.parametrize("name, exchanges", [
    ("typed_load", 0), ("coerce_rejects", 0), ("search_not", 0), ("search_cover_rank", 0), ("present_iso", 0),
    ("unique_violations", 1), ("group_concat", 1), ("upsert_changes", 2), ("inverted_index", 1),
])
def test_number_of_shuffles(plans, name, exchanges):
    assert len(re.findall(r"Exchange (?:hash|range|Single)", plans[name])) == exchanges


def test_children_are_counted_before_the_join(plans):
    text = plans["fk_violations"]
    assert text.index("LeftAnti") < text.index("HashAggregate(keys=[o_custkey")


def test_a_skewed_anti_join_is_split_at_run_time(spark):
    """Several keys: the undecided rows of a hot key meet the taken keys in several tasks."""
    from quayside.operators.load import _without

    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
    }
    kept = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        live = spark.range(600_000).select(
            F.when(i % 3 == 0, F.lit(7)).otherwise(i % 40000).alias("k"), (i % 500).alias("j"),
            F.sha2(i.cast("string"), 256).alias("text"),
        ).repartition(10)
        taken = spark.range(10_000, 15_000).select(i.alias("k"), i.alias("j"))
        left = _without(_without(live, taken, ["k"]), taken, ["j"]).agg(F.max("text"))
        left.collect()
        assert "skew=true" in plan(left)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_a_hot_key_of_a_third_of_all_rows(spark):
    """Row loads and reports stay exact when one key and NULL hold most rows."""
    from quayside.operators import audit, load

    n = 60_000
    i = F.col("id")
    source = spark.range(n).select(
        F.when(i % 3 == 0, F.lit(-1)).when(i % 3 == 1, F.lit(None)).otherwise(i).alias("k"), i.alias("seq")
    )
    target = spark.createDataFrame([(2, -5), (None, -6)], "k bigint, seq bigint")
    got = load.insert_ignore(source, target, [["k"]], "seq")
    assert got.count() == 2 + n // 3 + 1 + n // 3 - 1
    replaced = load.insert_replace(source, target, "seq", unique=[["k"]])
    assert replaced.where("k = -1").first()["seq"] == n - 3
    assert replaced.count() == 2 + n // 3 + 1 + n // 3 - 1
    report = audit.fk_violations(source, "s", ["k"], target, ["k"]).orderBy(F.col("n").desc()).first()
    assert (report["key"], report["n"]) == ('["-1"]', n // 3)
