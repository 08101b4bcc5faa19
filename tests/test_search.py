import random
import time

import pyarrow.parquet as pq
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from quayside import session
from quayside.operators import search
from quayside.plans import catalog


@pytest.fixture
def docs(spark):
    data = [
        (1, "Hello", "World of Spark", 5), (2, "hello-hello", None, 6), (3, "Été à Köln", "of the world", 7),
        (4, "the old of new", "", 8), (5, None, None, 9),
    ]
    frame = spark.createDataFrame(data, "id int, title string, body string, n int")
    return search.add_search_column(frame, "title", "body")


def test_words(docs):
    got = dict(rows(docs.select("id", "search")))
    assert got == {
        1: ["hello", "world", "of", "spark"], 2: ["hello", "hello"], 3: ["été", "à", "köln", "of", "the", "world"],
        4: ["the", "old", "of", "new"], 5: [],
    }
    assert docs.select(search.terms("title", F.col("n")).alias("t")).first()["t"] == ["hello", "5"]


@pytest.mark.parametrize("query, ids", [
    ("hello", [1, 2]), ("HELLO world", [1]), ("of -the", [1]), ('"of the"', [3]), ('"the of"', []),
    ("hello or köln", [1, 2, 3]), ("hello -world or the", [2, 3, 4]), ('-"of the" of', [1, 4]), ("", []), ("-hello", [3, 4, 5]),
    ("hello-hello", [2]),
])
def test_web_queries(docs, query, ids):
    assert sorted(r["id"] for r in search.search(docs, query).collect()) == ids


def test_rank_by_frequency_then_id(docs):
    got = [(r["id"], r["rank"]) for r in search.ranked(docs, "hello or of", "id").collect()]
    assert got == [(1, 2), (2, 2), (3, 1), (4, 1)]


def covers(words, wanted):
    """All shortest spans by brute force."""
    spans = [
        (a, b) for a in range(len(words)) for b in range(a, len(words)) if set(wanted) <= set(words[a : b + 1])
    ]
    least = [s for s in spans if not any(o != s and s[0] <= o[0] and o[1] <= s[1] for o in spans)]
    return sum(0.1 / (1 + sum(w not in wanted for w in words[a : b + 1])) for a, b in least)


@pytest.mark.parametrize("query", ["a", "a b", "c a b"])
def test_cover_density(spark, query):
    rng = random.Random(query)
    texts = [(i, " ".join(rng.choice("abcdxyz") for _ in range(rng.randrange(25)))) for i in range(40)]
    frame = search.add_search_column(spark.createDataFrame(texts, "id int, text string"), "text")
    got = dict(rows(frame.select("id", search.cover_density(F.col("search"), query))))
    for i, text in texts:
        assert got[i] == pytest.approx(covers(text.split(), query.split())), text


def test_index_finds_what_the_scan_finds(spark):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choices(["all", "b", "c", "d"], [6, 1, 1, 1], k=6))) for i in range(300)]
    frame = search.add_search_column(spark.createDataFrame(texts, "id int, text string"), "text")
    index = search.inverted_index(frame, "id", block=32)
    assert index.agg(F.max("n")).first()[0] <= 32
    for words in (["all"], ["all", "b"], ["b", "c", "d"], ["none"], ["all", "none"]):
        got = sorted(r["id"] for r in search.index_lookup(index, words).collect())
        assert got == sorted(r["id"] for r in search.search(frame, " ".join(words)).collect())


def test_index_search_equals_the_scan(spark):
    texts = ["red fish blue fish", "blue red", "fish red blue", "one two", "", "red one"]
    frame = search.add_search_column(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string"), "text")
    index = search.inverted_index(frame, "id", block=2)
    for query in ('"red fish"', "red -fish", "blue or one", '"fish red" or two -blue', "-red", "red or -fish", "none", ""):
        want = sorted(r["id"] for r in search.search(frame, query).collect())
        got = sorted(r["id"] for r in search.index_search(index, frame, query, "id").collect())
        assert got == want, query


QUERIES = (
    "w1", "w1 w2", "w1 w2 w3", '"w1 w2"', '"w2 w1 w1"', "w1 -w2", '"w1 w2" -"w2 w3" w4', 'w9 or "w3 w1" or w8 -w1',
    "w77", "w1 w77", '"w1 w77"', "",
)


@pytest.fixture(scope="module")
def places(spark):
    r = random.Random(4)
    texts = [(i * 3 - 40, " ".join(f"w{min(9, int(r.paretovariate(0.8)))}" for _ in range(r.randint(0, 60)))) for i in range(300)]
    rows = search.add_search_column(spark.createDataFrame(texts, "id long, text string"), "text").cache()
    return rows, search.positional_index(rows, "id", block=32).cache()


@pytest.mark.parametrize("query", QUERIES)
def test_an_index_with_places_answers_as_the_rows_do(places, query):
    rows, index = places
    want = sorted(r["id"] for r in search.search(rows, query).collect())
    assert sorted(r["id"] for r in search.index_matches(index, query).collect()) == want
    for method in ("frequency", "cover"):
        ranked = [(r["id"], round(r["rank"], 9)) for r in search.ranked(rows, query, "id", method=method).collect()]
        assert [(r["id"], round(r["rank"], 9)) for r in search.index_ranked(index, query, method=method).collect()] == ranked
        for limit in (1, 7, 1000):
            got = [(r["id"], round(r["rank"], 9)) for r in search.index_ranked(index, query, method=method, limit=limit).collect()]
            assert got == ranked[:limit]


def test_only_the_words_files_are_read(spark, places, tmp_path):
    index = places[1]
    with pytest.raises(ValueError, match="wants no word"):
        search.index_matches(index, "w1 or -w2")
    index.write.parquet(str(tmp_path / "index"))
    text = plan(search.index_matches(spark.read.parquet(str(tmp_path / "index")), '"w1 w2" -w3'))
    assert "PushedFilters: [In(term, [w1,w2,w3])]" in text.replace('"', "")


def test_blocks_below_the_reach_are_skipped(spark):
    """One block of long matches; the others can hold none of the best."""
    rows = spark.range(4000).selectExpr("id", "split(if(id < 40, repeat('a b ', 30), 'a b c'), ' ') as search")
    index = search.positional_index(rows, "id", block=64)
    best = search.index_ranked(index, "a b", limit=10)
    assert [r["id"] for r in best.collect()] == list(range(10))


def test_a_block_of_frequent_words_is_joined_in_proportion(spark):
    """Two words with 160,000 places each in one block; pairs of places would be 27 billion."""
    rows = spark.range(4000, 8000).selectExpr("id", "split(if(id % 2 = 0, repeat('a b ', 40), repeat('b c a ', 40)), ' ') as search")
    index = search.positional_index(rows, "id").cache()
    index.count()
    begun = time.monotonic()
    found = {r["id"] for r in search.index_matches(index, '"a b"').where("id < 4010 or id > 7990").collect()}
    assert found == {*range(4000, 4010), *range(7991, 8000)}
    assert {r["id"] for r in search.index_matches(index, '"b a"').where("id < 4010").collect()} == set(range(4000, 4010, 2))
    assert time.monotonic() - begun < 60


def test_lists_of_a_block_at_a_time_are_held(spark):
    """Lists kept in a hash table would be those of up to 128 blocks, each with a list per word."""
    index = spark.createDataFrame([], "term string, block long, n int, top int, hits array<struct<id: long, at: int>>")
    text = plan(search.index_matches(index, '"w1 w2" -w3'))
    assert "ObjectHashAggregate" not in text and "SortAggregate" in text


def test_long_lists_are_stored_in_small_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(session.UNEVEN_ROWS, "parquet.block.size", str(1 << 18))
    docs = spark.range(20).selectExpr("id * 4096 as doc_id", "repeat('a ', 20000) as text")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        lists = catalog.stored_places(spark, str(tmp_path))
        assert lists.select("block", F.size("hits"), "n", "top").orderBy("block").collect() == [(i, 20000, 1, 20000) for i in range(20)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    made = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in lists.inputFiles()]
    groups = [m.row_group(i).num_rows for m in made for i in range(m.num_row_groups)]
    assert sum(groups) == 20 and max(groups) <= 10


def test_places_of_odd_ids(spark):
    texts = [(None, "a b a"), (5, "a"), (5, "a a"), (-1, "a"), (2**63 - 1, "a")]
    frame = search.add_search_column(spark.createDataFrame(texts, "id long, text string"), "text")
    got = {(r["term"], r["block"]): (r["n"], r["top"], [tuple(h) for h in r["hits"]]) for r in search.positional_index(frame, "id").collect()}
    assert got == {
        ("a", None): (1, 2, [(None, 0), (None, 2)]), ("b", None): (1, 1, [(None, 1)]),
        ("a", 0): (1, 3, [(5, 0), (5, 0), (5, 1)]), ("a", -1): (1, 1, [(-1, 0)]),
        ("a", 2**51 - 1): (1, 1, [(2**63 - 1, 0)]),
    }
