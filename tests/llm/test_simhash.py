import random
import re

import numpy as np
import xxhash

from conftest_llm import prose
from quayside.llm import simhash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """Smallest index reachable over links of at most two bits."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 2 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_fingerprints():
    for text in (None, "", "  ", "one", "One two", "É É É", prose(1, 200), "a b c " * 40, "x\x0by\tz\nq"):
        assert simhash.fingerprint(text.encode() if text is not None else None) == slow_fingerprint(text)


def test_bit_planes_find_what_distances_say():
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(30)]
    fps = sorted({b ^ sum(1 << r.randrange(64) for _ in range(r.randint(0, 2))) for b in base for _ in range(9)})
    links = list(simhash.bucket_links([np.array(fps, np.uint64)]))
    at = {f: i for i, f in enumerate(fps)}
    want = slow_components(fps)
    got = list(range(len(fps)))
    for a, b in links:
        got[at[a]] = at[b]
    assert got == want
    for a, b in links:
        assert a > b


def test_components_against_all_pairs(spark):
    r = random.Random(5)
    fps = {r.getrandbits(64) for _ in range(150)}
    seed = r.getrandbits(64)
    chain = seed
    for _ in range(40):  # a chain of small steps, and a dense ball around its start
        chain ^= 1 << r.randrange(64)
        fps |= {chain, seed ^ (1 << r.randrange(64))}
    fps = sorted(simhash.signed(f) for f in fps)
    frame = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    unsigned = [f & (1 << 64) - 1 for f in fps]
    want = {f: fps[i] for f, i in zip(fps, slow_components(unsigned), strict=True)}
    for bucket in (1024, 3):  # both ways of comparing
        edges = simhash.links(frame.repartition(5), bucket)
        assert all((a ^ b).bit_count() >= 1 for a, b in edges.collect())
        found = {r["node"]: r["label"] for r in simhash.components(edges).collect()}
        assert {f: found.get(f, f) for f in fps} == want


def test_documents(frame):
    long = prose(9, 3000)
    texts = [None, "", prose(1, 80), prose(1, 80), long, long + " tail", prose(2, 90), "  "]
    docs = frame(texts).union(frame([(None, prose(1, 80), None, None, None, "", "", 0)]))
    docs = docs.union(frame([(6, prose(2, 90), "en", "s0", 1, "x", "y", 1)]))
    got = simhash.simhash(docs).collect()
    assert len(got) == 10
    fps = [slow_fingerprint(t) for t in [*texts, texts[2], texts[6]]]
    ids = [*range(8), None, 6]
    label = slow_components(fps)
    want = sorted((str(i), f"{f:016x}", min(x for x, g in zip(ids, label, strict=True) if g == n and x is not None))
                  for i, f, n in zip(ids, fps, label, strict=True))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == want
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({w[2] for w in want})


def test_empty_and_null_ids(frame):
    assert simhash.simhash(frame([])).count() == 0
    assert simhash.drop_near_copies(frame([])).count() == 0
    lone = frame([(None, "a b c d", None, None, None, "", "", 0)] * 2)
    assert {r["component_id"] for r in simhash.simhash(lone).collect()} == {None}
    assert simhash.drop_near_copies(lone).count() == 1
