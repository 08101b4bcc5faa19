"""Ranked search against the score of every document for every query."""

import random
import re
from collections import Counter
from math import floor, log

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest_llm import prose
from quayside.llm import common, lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_terms(text):
    return TERM.findall((text or "").translate(FOLD))


def slow_search(docs, queries, best=10):
    """Rows (item, rank, document, score); every distinct query is ranked by itself."""
    bags = [(i, Counter(slow_terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, words = len(bags), sum(x[2] for x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in dict.fromkeys(q for q in queries if q[1] is not None):
        scored = []
        for i, bag, size in bags:
            m = 100 - 75 + (75 * size * n) // words
            score = sum(
                floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in slow_terms(text)
                if t in bag
            )
            if score > 0:
                scored.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(scored)[:best], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=str)


def skewed(r, words):
    """Words of which few are very common, as in prose."""
    return " ".join(f"w{int(r.paretovariate(0.7)) % 400}" for _ in range(words))


def found(spark, docs, queries, **more):
    blocks = lexical.index(docs, block_docs=more.pop("block_docs", lexical.BLOCK_DOCS))
    rows = spark.createDataFrame(queries, "item_id bigint, text string, doc_id string")
    return sorted((tuple(x) for x in lexical.search(blocks, rows, **more).collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    made = [skewed(r, r.randint(1, 120)) for _ in range(400)] + [None, "", " \n.,", "Ünï w1 W1", "w1", "w1", "É é w2-w3"]
    made += [made[5]] * 30  # copies: ties beyond the last rank
    made.append(skewed(r, 5000))
    r.shuffle(made)
    return made


@pytest.mark.parametrize("short", [0.0, 1 / 16, 2.0])
def test_every_document_for_every_query(spark, frame, texts, short):
    r = random.Random(12)
    queries = [(i, skewed(r, r.randint(1, 40)), "x") for i in range(25)]
    queries += [(25, texts[7] or "w9 w1", "x"), (26, None, "x"), (27, "", "x"), (28, "none of these", "x"), (29, "É w3 w3 w3", "x")]
    queries += [queries[0], (1, "w1 w2 w2", "x")]  # a repeated query, a second text under one key
    docs = frame(texts).repartition(2, "doc_id")
    want = slow_search(list(enumerate(texts)), [q[:2] for q in queries])
    assert found(spark, docs, queries, block_docs=16, short=short) == want
    assert found(spark, docs, queries, query_bytes=1500, short=short) == want  # many groups of queries


def test_blocks_are_given_up_without_loss(spark, frame):
    texts = [f"rare{i % 7} common common" if i % 50 == 0 else "common filler " * (1 + i % 3) for i in range(2000)]
    docs = frame(texts).coalesce(1)
    queries = [(0, "rare0 common", None), (1, "common", None), (2, "filler rare3", None)]
    want = slow_search(list(enumerate(texts)), [q[:2] for q in queries], best=3)
    assert found(spark, docs, queries, block_docs=32, best=3) == want


def test_odd_tables(spark, frame):
    queries = [(None, "a b", None), (3, "a", None)]
    texts = ["a b", "a", "b b b", None, prose(1, 50)]
    assert found(spark, frame([]), queries) == []
    assert found(spark, frame(["", None, "..."]), queries) == []
    docs = [(n, t, None, None, None, None, None, None) for n, t in [(1, "a b"), (1, "a b"), (None, "a b"), (0, "a b")]]
    want = slow_search([(d[0], d[1]) for d in docs], [q[:2] for q in queries])
    assert found(spark, frame(docs), queries) == want
    blocks = lexical.index(frame(texts))
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = lexical.search(blocks, none)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.collect() == []


def test_terms():
    text = "One,two_THREE naïve 4x4 日本 \x7fA\x00b É"
    assert [t.decode() for t in lexical.terms(text)] == slow_terms(text)


def test_blocks_are_written_and_read_one_at_a_time(frame):
    """A block may take megabytes; neither the writer nor a reader of the index may gather those of a whole task."""
    blocks = lexical.index(frame([prose(i, 30) for i in range(60)]).coalesce(1), block_docs=4)
    assert blocks.count() == 15
    made = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in blocks.inputFiles()]
    assert [m.row_group(i).num_rows for m in made for i in range(m.num_row_groups)] == [1] * 15


def test_large_rows_reach_workers_in_batches_of_bounded_size(spark):
    rows = spark.range(0, 40, 1, 1).selectExpr("cast(repeat('x', 1 << 20) as binary) as b")
    common.small_batches(rows)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    assert max(r["n"] for r in rows.mapInArrow(sizes, "n bigint").collect()) <= 9
