"""Periodic runs against their definition, spelled out place by place."""

import random
import zlib
from hashlib import sha256

import pytest

from quayside.llm import catalog, periodic


def slow_runs(words, times=4, least=6):
    n, found = len(words), set()
    for q in range(1, n // times + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e - s + q >= max(least, times * q):
                found.add((s, e - s + q, q))
            s = e + 1
    smallest = {}
    for s, n_, q in found:
        smallest[s, n_] = min(q, smallest.get((s, n_), q))
    return sorted(((s, n_, q) for (s, n_), q in smallest.items()), key=lambda r: (r[0], r[2]))


def slow_row(number, text, plant=True):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    n = len(words)
    if plant and number is not None and n and zlib.crc32(str(number).encode()) % 10 == 0:
        g = zlib.crc32(str(number).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (number, n, len(runs), *top, sha256(listed.encode()).hexdigest(), sha256(left.encode()).hexdigest())


def woven(r):
    """Random words over a small alphabet with periodic stretches, some inside others."""
    words = []
    while len(words) < r.randint(0, 120):
        root = [r.choice("abc") for _ in range(r.randint(1, 7))]
        words += root * r.randint(1, 7) + root[: r.randint(0, len(root))]
        if r.random() < 0.3:
            words += words[-r.randint(1, 40) :] * r.randint(1, 4)
    return words


def test_runs_against_all_lags():
    r, seen = random.Random(5), 0
    for _ in range(600):
        words = woven(r)
        want = slow_runs(words)
        assert periodic.runs(words) == want
        seen += len(want)
    assert seen > 500


def test_other_bounds():
    r = random.Random(6)
    for times, least in ((3, 4), (3, 12), (5, 6), (7, 20)):
        for _ in range(100):
            words = woven(r)
            assert periodic.runs(words, times, least) == slow_runs(words, times, least)
    with pytest.raises(ValueError):
        periodic.runs(["a"] * 9, times=2)


def test_long_texts_in_little_time():
    n = 200_000
    assert periodic.runs(["a"] * n) == [(0, n, 1)]
    root = [str(i) for i in range(n // 5)]
    assert periodic.runs(root * 5) == [(0, n, n // 5)]
    assert periodic.runs([str(i) for i in range(n)]) == []
    # Fibonacci words are full of repetitions, but of none that is fourfold.
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    assert periodic.runs(list(b)) == []


def test_report_of_every_kind_of_row(frame):
    r = random.Random(7)
    texts = [None, "", " \t\n", "a", "x " * 6, "x " * 5, "  " * 7, "é é " * 9, "A a " * 4]
    texts += [" ".join(woven(r)) for _ in range(80)]
    rows = [(i, t, None, None, None, None, None, None) for i, t in enumerate(texts)]
    rows += [rows[-1], (None, "z " * 8, None, None, None, None, None, None)]
    got = periodic.run_report(frame(rows), plant=True).collect()
    assert sorted(map(tuple, got), key=str) == sorted((slow_row(i, t) for i, t, *_ in rows), key=str)
    assert sum(x["n_runs"] > 0 for x in got) > 30
    assert periodic.run_report(frame([]), plant=True).collect() == []


def test_collapse_keeps_first_roots_and_other_columns(frame):
    docs = frame(["u " * 9 + "v", "no run  here", None, "", "p q " * 4 + "r"])
    out = {x["doc_id"]: x for x in periodic.collapse(docs).collect()}
    assert [out[i]["text"] for i in range(5)] == ["u v", "no run  here", None, "", "p q r"]
    assert docs.columns == list(out[0].asDict())
    spans = periodic.run_spans(docs).collect()
    assert sorted(map(tuple, spans)) == [(0, 0, 9, 1), (4, 0, 8, 2)]


def test_query_against_the_definition(spark):
    d = "/root/testdata/sf0.001"
    got = catalog.QUERIES["op13_periodic"](spark, d).collect()
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    short = {x["doc_id"]: x["text"] for x in docs if len((x["text"] or "").split()) < 1500}
    assert len(got) == len(docs) and len(short) > 100
    want = {i: slow_row(i, t) for i, t in short.items()}
    assert {x["doc_id"]: tuple(x) for x in got if x["doc_id"] in short} == want
