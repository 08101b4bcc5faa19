import random

import pytest

from quayside.operators import greedy


def serial(source, keys):
    held, out = [set() for _ in keys], []
    for r in sorted(source, key=lambda r: r["seq"]):
        values = [tuple(r[k] for k in key) for key in keys]
        if not any(None not in v and v in h for v, h in zip(values, held, strict=True)):
            out.append(r["seq"])
            for v, h in zip(values, held, strict=True):
                h.add(v)
    return out


def chosen(spark, source, keys, schema="seq long, a int, b int, c int"):
    data = spark.createDataFrame([tuple(r.values()) for r in source], schema).repartition(5)
    return sorted(r["seq"] for r in greedy.accepted(data, keys, "seq").collect())


@pytest.mark.parametrize("seed", range(6))
def test_rows_one_after_the_other(spark, seed):
    r = random.Random(seed)
    span = [3, 8, 25, 60, 60, 200][seed]
    pick = lambda: r.choice([None, *range(span)])
    order = r.sample(range(1000), 150)
    source = [{"seq": n, "a": pick(), "b": pick(), "c": pick()} for n in order]
    for keys in ([["a"], ["b"]], [["a"], ["b"], ["c"]], [["a", "b"], ["c"]]):
        assert chosen(spark, source, keys) == serial(source, keys)


def test_paths_that_join(spark):
    """Combs of chains: the ends of several paths meet in rows with several open claims."""
    r, source, n = random.Random(9), [], 0
    for tooth in range(12):
        for i in range(r.randrange(5, 40)):
            source.append({"seq": n, "a": tooth * 1000 + (i + 1) // 2, "b": tooth * 1000 + i // 2, "c": None})
            n += 1
        source[-1]["c"] = tooth // 3
    for i in range(12):
        source.append({"seq": n, "a": i * 1000 + r.randrange(3), "b": (i + 1) * 1000 + r.randrange(20), "c": i // 3})
        n += 1
    keys = [["a"], ["b"], ["c"]]
    assert chosen(spark, source, keys) == serial(source, keys)


def test_a_million_links_in_few_jobs(spark):
    chain = spark.range(1, 1_000_001).selectExpr("id as seq", "(id + 1) div 2 as a", "id div 2 as b")
    spark.sparkContext.setJobGroup("chain", "chain")
    try:
        got = greedy.accepted(chain, [["a"], ["b"]], "seq")
        assert got.count() == 500_000 and got.where("seq % 2 = 0").isEmpty()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 120


def test_orders_that_are_no_numbers(spark):
    r = random.Random(2)
    source = [{"seq": f"{r.random():.9f}", "a": r.randrange(9), "b": r.randrange(30), "c": None} for _ in range(120)]
    assert chosen(spark, source, [["a"], ["b"]], "seq string, a int, b int, c int") == serial(source, [["a"], ["b"]])
    assert chosen(spark, [], [["a"], ["b"]]) == []


def test_stored_rows_are_made_once(spark):
    """A checkpoint computes its rows once to count and once to write them."""
    made = spark.sparkContext.accumulator(0)

    def work(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    data = spark.range(100).selectExpr("id as seq", "id % 7 as a", "id % 5 as b").mapInArrow(work, "seq bigint, a bigint, b bigint")
    assert greedy.numbered(data, "seq").count() == 100
    assert made.value == 100


def test_rows_that_files_do_not_hold(spark):
    data = spark.range(20).selectExpr("id as seq", "id % 4 as a", "id % 3 as b", "null as none")
    assert sorted(r["seq"] for r in greedy.accepted(data, [["a"], ["b"]], "seq").collect()) == [0, 1, 2]
