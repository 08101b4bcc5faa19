"""The n-gram join against all pairs."""

import random
import re

import numpy as np
import pytest

from conftest_llm import prose
from quayside.llm import jaccard

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_set(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate(FOLD)) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow_pairs(sets):
    """All linked pairs of different sets."""
    ordered = sorted(sets, key=len)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if 100 * len(a) < 80 * len(b):
                break
            if 100 * len(a & b) >= 80 * len(a | b):
                yield a, b


def slow_groups(docs):
    sets = [(i, frozenset(slow_set(t))) for i, t in docs]
    root = {s: s for _, s in sets}

    def top(s):
        while root[s] != s:
            s = root[s]
        return s

    for a, b in slow_pairs({s for _, s in sets if s}):
        root[top(a)] = top(b)
    least = {}
    for i, s in sets:
        if s and i is not None:
            least[top(s)] = min(i, least.get(top(s), i))
    return sorted(((i, len(s), least.get(top(s)) if s else i) for i, s in sets), key=str)


def edited(r, text, edits):
    words = text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
    return " ".join(words)


def corpus(r):
    texts = [None, "", " \t ", "one", "One", "ONE two", "one two three four", "One two three four five", "one two three four five"]
    shared = prose(9, 60)
    for seed in range(30):
        first = prose(1000 + seed, r.choice([3, 5, 6, 8, 10, 12, 14, 18, 24, 40, 100, 300]))
        texts += [first, *(edited(r, first, r.randint(0, 4)) for _ in range(3))]
        texts += [first + " " + prose(5000 + seed, k) for k in (1, 2, 3, 5)]
        texts += [prose(3000 + seed, 12) + " " + shared, shared + " " + prose(4000 + seed, 5)]
    r.shuffle(texts)
    return texts


def groups(docs):
    return sorted((tuple(x) for x in jaccard.similar_groups(docs).collect()), key=str)


@pytest.mark.parametrize("bounds", [(1, 24), (1, 1), (14, 14)])
def test_groups_against_all_pairs(frame, monkeypatch, bounds):
    monkeypatch.setattr(jaccard, "LIGHTEST", bounds[0])
    monkeypatch.setattr(jaccard, "LIGHTER", bounds[1])
    texts = corpus(random.Random(3))
    want = slow_groups(list(enumerate(texts)))
    assert groups(frame(texts)) == want
    assert 100 < len({g for _, _, g in want}) < len(texts) - 60


@pytest.mark.parametrize("bounds", [(1, 1), (13, 13)])
def test_every_link(frame, monkeypatch, bounds):
    monkeypatch.setattr(jaccard, "LIGHTEST", bounds[0])
    monkeypatch.setattr(jaccard, "LIGHTER", bounds[1])
    texts = corpus(random.Random(4))
    own, links = jaccard.members(frame(texts))
    by_node = {}
    for x in own.collect():
        if x["node"] is not None:
            by_node.setdefault(x["node"], frozenset(slow_set(texts[x["doc_id"]])))
        else:
            assert not slow_set(texts[x["doc_id"]])
    got = {frozenset((by_node[a], by_node[b])) for a, b in links.collect()}
    assert got == {frozenset(p) for p in slow_pairs(set(by_node.values()))}
    assert links.count() == len(got) > 50


def test_a_hot_group_at_the_bound(frame):
    """Thousands of edits of one text, many pairs just above and just below the bound, and one hot opening."""
    r = random.Random(5)
    first = prose(77, 104)  # 100 shingles
    texts = [edited(r, first, r.choice([0, 1, 2, 3, 4])) for _ in range(700)]
    texts += [" ".join(first.split()[:64]) + " " + prose(8000 + i, 30) for i in range(200)]
    want = slow_groups(list(enumerate(texts)))
    assert groups(frame(texts).repartition(13)) == want


def test_chains_are_followed(frame):
    words = prose(5, 400).split()
    texts = [" ".join(words[i * 8 : i * 8 + 120]) for i in range(35)]  # neighbours share 108 of 124
    got = groups(frame(texts))
    assert got == slow_groups(list(enumerate(texts)))
    assert {g for _, _, g in got} == {0}


def test_odd_rows(frame):
    docs = [(None, "a b c d e f"), (3, "A b c d e F"), (3, "a b c d e f"), (None, None), (1, None), (None, "zz"), (2, "")]
    docs = [(i, t, None, None, None, None, None, None) for i, t in docs]
    assert groups(frame(docs)) == slow_groups([d[:2] for d in docs])
    assert groups(frame([])) == []
    assert groups(frame([None, ""])) == [(0, 0, 0), (1, 0, 1)]


def test_bounds_are_the_definition():
    for s in range(1, 60):
        for t in range(s, 80):
            least = next((c for c in range(s + 1) if 100 * c >= 80 * (s + t - c)), None)
            assert (t in jaccard.partners(s)) == (least is not None) == (s in jaccard.partners(t))
            if least is not None:
                assert jaccard.need(s, t) == least
                assert jaccard.prefix(s) + least > s and jaccard.prefix(t) + least > t
    long = " ".join(str(i % 5000) for i in range(300_000)).encode()
    assert len(jaccard.Shingler()(long)) == 5000
    assert not np.intersect1d(jaccard.Shingler()(b"a b c d"), jaccard.Shingler()(b"a b c d e")).size


def test_one_of_each_group_stays(frame):
    texts = corpus(random.Random(8))
    docs = frame(texts)
    named = {g for i, n, g in slow_groups(list(enumerate(texts))) if n}
    want = named | {min(i for i, t in enumerate(texts) if not slow_set(t))}
    kept = jaccard.drop_similar(docs)
    assert kept.columns == docs.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(want)


def test_the_stage_finds_copies_beyond_two_bits(spark, frame):
    import corpus_pipeline
    from quayside.llm import simhash

    first = prose(5, 400)
    texts = [first, *(edited(random.Random(i), first, 4) for i in range(6)), prose(6, 400)]
    prints = [simhash.fingerprint(t.encode()) for t in texts[:7]]
    assert any(min((p ^ q).bit_count() for q in prints if q != p) > simhash.RADIUS for p in prints)
    kept = corpus_pipeline.near_dedup(spark, frame(texts), "")
    assert sorted(x["doc_id"] for x in kept.collect()) == [0, 7]


def test_keeping_of_odd_rows(frame):
    assert jaccard.drop_similar(frame([])).count() == 0
    lone = frame([(None, "a b c d", None, None, None, "", "", 0)] * 2)
    assert jaccard.drop_similar(lone).count() == 1
    docs = frame([(2, prose(1, 50), None, None, None, "", "", 0), (None, prose(1, 50), None, None, None, "", "", 0)])
    assert [x["doc_id"] for x in jaccard.drop_similar(docs).collect()] == [2]


def test_the_stage_takes_both_kinds_of_links(spark, frame):
    """0 and 1 by fingerprints alone, 1 and 2 by shingles alone: one group."""
    import corpus_pipeline
    from quayside.llm import simhash

    core, tail = "a b c ", prose(2, 60)
    texts = [core * 200 + prose(1, 8), core * 200 + tail, core * 2 + tail, prose(3, 80)]
    prints = [simhash.fingerprint(t.encode()) for t in texts]
    apart = [[(p ^ q).bit_count() for q in prints] for p in prints]
    assert apart[0][1] <= simhash.RADIUS < min(apart[0][2], apart[1][2])
    sets = [slow_set(t) for t in texts]
    alike = [[len(x & y) / len(x | y) for y in sets] for x in sets]
    assert alike[1][2] >= 0.8 > max(alike[0][1], alike[0][2])
    assert sorted(x["doc_id"] for x in corpus_pipeline.near_dedup(spark, frame(texts), "").collect()) == [0, 3]
