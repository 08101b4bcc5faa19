import json

import pytest
from helpers import one, rows
from pyspark.sql import functions as F

from quayside.operators import grouping


@pytest.fixture
def skewed(spark):
    """One key holds most rows; one key is NULL."""
    data = spark.range(3000).select(
        F.when(F.col("id") % 10 == 0, F.lit("b")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.lit("a")).alias("k"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 4 != 0, F.col("id")).alias("v"),
    )
    return data.repartition(6)


def expected(frame):
    groups = {}
    for k, seq, v in sorted(rows(frame), key=lambda r: r[1]):
        groups.setdefault(k, []).append(v)
    return groups


@pytest.mark.parametrize("part_bytes", [grouping.PART_BYTES, 3000, 100])
def test_group_concat_whole_and_split(skewed, part_bytes):
    got = dict(rows(grouping.group_concat(skewed, ["k"], F.col("v"), ["seq"], "; ", part_bytes=part_bytes)))
    want = {k: "; ".join(str(v) for v in vs if v is not None) for k, vs in expected(skewed).items()}
    assert got == want


@pytest.mark.parametrize("part_bytes", [grouping.PART_BYTES, 500])
def test_json_arrays_keep_nulls(skewed, part_bytes):
    got = dict(rows(grouping.json_group_array(skewed, ["k"], F.col("v"), ["seq"], part_bytes=part_bytes)))
    assert {k: json.loads(t) for k, t in got.items()} == expected(skewed)


@pytest.mark.parametrize("part_bytes", [grouping.PART_BYTES, 500])
def test_json_objects_keep_repeated_keys(skewed, part_bytes):
    got = dict(rows(grouping.json_group_object(
        skewed, ["k"], F.lit("x"), F.col("v"), ["seq"], part_bytes=part_bytes)))
    pairs = {k: json.loads(t, object_pairs_hook=list) for k, t in got.items()}
    assert pairs == {k: [("x", v) for v in vs] for k, vs in expected(skewed).items()}


@pytest.mark.parametrize("part_bytes", [grouping.PART_BYTES, 200])
def test_without_keys_and_without_rows(spark, skewed, part_bytes):
    whole = grouping.group_concat(skewed, [], F.col("v"), ["seq"], part_bytes=part_bytes)
    assert one(whole)[0].startswith("1,2,3,5,6,7,9,")
    nothing = skewed.where("false")
    assert one(grouping.group_concat(nothing, [], F.col("v"), ["seq"])) == (None,)
    assert one(grouping.json_group_array(nothing, [], F.col("v"), ["seq"])) == (None,)
    assert rows(grouping.group_concat(nothing, ["k"], F.col("v"), ["seq"])) == []


def test_many_large_groups(skewed, monkeypatch):
    monkeypatch.setattr(grouping, "FEW_KEYS", 1)
    got = dict(rows(grouping.group_concat(skewed, ["k"], F.col("v"), ["seq"], part_bytes=100)))
    assert got == dict(rows(grouping.group_concat(skewed, ["k"], F.col("v"), ["seq"])))


def test_distinct_and_only_nulls(spark):
    data = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "y"), ("b", None)], "k string, v string")
    got = sorted(rows(grouping.group_concat_distinct(data, ["k"], F.col("v"), "|")))
    assert got == [("a", "x|y"), ("b", None)]


def test_parts_join_to_the_whole(skewed):
    parts = grouping.group_concat_parts(skewed, ["k"], F.col("v"), ["seq"], ",", part_bytes=1000)
    texts = {}
    for k, part, text in sorted(rows(parts), key=lambda r: r[1]):
        texts.setdefault(k, []).append(text)
    whole = dict(rows(grouping.group_concat(skewed, ["k"], F.col("v"), ["seq"])))
    assert {k: ",".join(t) for k, t in texts.items()} == whole
    assert len(texts["a"]) > 3


def test_a_text_beyond_one_cell_is_refused(skewed, monkeypatch):
    monkeypatch.setattr(grouping, "CELL_BYTES", 1000)
    for few in (grouping.FEW_KEYS, 1):
        monkeypatch.setattr(grouping, "FEW_KEYS", few)
        with pytest.raises(grouping.TextTooLarge, match="parts"):
            grouping.group_concat(skewed, ["k"], F.col("v"), ["seq"], part_bytes=500)


def test_separator_is_taken_literally(spark):
    data = spark.createDataFrame([(1, "a"), (2, "b")], "seq int, v string")
    for separator in ("'", "\\", "\n", "", "''\\'"):
        assert one(grouping.group_concat(data, [], F.col("v"), ["seq"], separator)) == (f"a{separator}b",)


def test_parts_are_cut_by_bytes(spark):
    """Sizes from nothing to a hundred times the others': no part holds more than its size and one value."""
    data = spark.range(4000).selectExpr("id % 3 as k", "id", "repeat('x', int(if(id % 97 = 0, 3000, id % 40))) as v").repartition(7)
    parts = rows(grouping.group_concat_parts(data, ["k"], F.col("v"), ["id"], "|", part_bytes=2000))
    texts = {}
    for k, part, text in sorted(parts):
        values = text.split("|")
        cost = sum(max(len(v) + 1, grouping.VALUE_BYTES) for v in values[:-1])
        assert cost < 2000
        texts.setdefault(k, []).extend(values)
    want = {}
    for k, n, v in sorted(rows(data), key=lambda r: r[1]):
        want.setdefault(k, []).append(v)
    assert texts == want


def test_tiny_values_are_a_large_group_too(spark):
    data = spark.range(200_000).selectExpr("id", "'' as v")
    parts = grouping.json_group_array_parts(data, [], F.col("v"), ["id"], part_bytes=1 << 20)
    sizes = [len(json.loads(t)) for _, t in rows(parts)]
    assert sum(sizes) == 200_000 and max(sizes) <= (1 << 20) // grouping.VALUE_BYTES + 1
    whole = grouping.group_concat(data, [], F.col("v"), ["id"], ",", part_bytes=1 << 20)
    assert one(whole) == ("," * 199_999,)


def test_json_objects_in_parts(skewed):
    parts = grouping.json_group_object_parts(skewed, ["k"], F.lit("x"), F.col("v"), ["seq"], part_bytes=900)
    pairs = {}
    for k, _, text in sorted(rows(parts), key=lambda r: r[1]):
        pairs.setdefault(k, []).extend(json.loads(text, object_pairs_hook=list))
    assert pairs == {k: [("x", v) for v in vs] for k, vs in expected(skewed).items()}
    assert rows(grouping.json_group_object_parts(skewed.where("false"), ["k"], F.lit("x"), F.col("v"), ["seq"])) == []


@pytest.mark.parametrize("json_form", [False, True])
def test_small_parts_make_no_more_slices(spark, monkeypatch, json_form):
    """Slices are tasks and go by bytes; parts of the same rows are the same however many slices there are."""
    data = spark.range(20_000).selectExpr("id % 3 as k", "id", "repeat('x', int(id % 50)) as v").repartition(3)
    form = grouping.json_group_array_parts if json_form else grouping.group_concat_parts
    asked, deal = [], type(data).repartitionByRange

    def counted(self, n, *columns):
        asked.append(n)
        return deal(self, n, *columns)

    monkeypatch.setattr(type(data), "repartitionByRange", counted)
    few = sorted(rows(form(data, ["k"], F.col("v"), ["id"], part_bytes=1000)))
    assert asked == [1] and len(few) > 500
    monkeypatch.setattr(grouping, "SLICE_BYTES", 50_000)
    assert sorted(rows(form(data, ["k"], F.col("v"), ["id"], part_bytes=1000))) == few
    assert 10 < asked[1] < 20
