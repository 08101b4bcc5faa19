"""Passages of 50 words and more that an earlier document already has."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import by_marks, map_rows, marks, null_safe, stored

LENGTH = 50
GRAM = 10


def grams(words: list[bytes], size: int) -> np.ndarray:
    """Mixed 64-bit hashes of all runs of ``size`` words."""
    one = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + one[i : i + n]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def cells(words: list[bytes], length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, bytes, int, int]]:
    """The windows of a text, gathered by their anchors: ``anchor, cell, start, count``.

    The anchor of a window is its run of ``gram`` words of the least hash (winnowing): equal
    windows have equal anchors wherever they stand. Neighbouring windows that share an anchor form
    a cell, named by a 128-bit hash of all its words.
    """
    n = len(words) - length + 1
    if n < 1:
        return []
    hashes = grams(words, gram)
    span = length - gram + 1
    chosen = np.empty(n, np.int64)
    for start in range(0, n, 1 << 15):
        stop = min(n, start + (1 << 15))
        views = np.lib.stride_tricks.sliding_window_view(hashes[start : stop + span - 1], span)
        chosen[start:stop] = np.arange(start, stop) + views.argmin(axis=1)
    firsts = np.concatenate([[0], np.nonzero(np.diff(chosen))[0] + 1])
    ends = np.append(firsts[1:], n)
    anchors = hashes[chosen[firsts]].view(np.int64).tolist()
    digest = xxhash.xxh3_128_digest
    return [
        (a, digest(b" ".join(words[s : e + length - 1])), s, e - s)
        for a, s, e in zip(anchors, firsts.tolist(), ends.tolist(), strict=True)
    ]


def seeds(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document its word count, the checksum of its words joined, and its cells; no text."""
    kind = docs.schema[key].dataType.simpleString()

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, h, t in rows:
            words = (t or b"").split()
            found = cells(words, length, gram) if k is not None else []
            sha = hashlib.sha256(b" ".join(words)).hexdigest()
            yield k, h, len(words), sha, [{"anchor": a, "cell": c, "start": s, "n": n} for a, c, s, n in found]

    schema = (
        f"`{key}` {kind}, h bigint, n_words bigint, sha string, "
        "cells array<struct<anchor:bigint,cell:binary,start:bigint,n:bigint>>"
    )
    return map_rows(docs.select(key, F.xxhash64(text).alias("h"), F.col(text).cast("binary").alias("t")), work, schema)


def merged(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeats(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Maximal repeats per document: ``doc_id, h, spans`` of words that an earlier document has.

    Seed: documents meet on anchors. Extend: a cell whose words an earlier document has as a cell
    is repeated as a whole, to both sides of its anchor; that settles the inside of long repeats
    at a row per anchor. Where an anchor has several cells, at the edges of repeats, each different
    cell is read once, in its first document, and its windows are compared one by one. Adjacent
    spans are joined, which leaves the maximal repeats.

    Every step is a minimum per key with map-side combining, or a join that run-time skew
    handling may split; no group of documents is gathered or paired.
    """
    every = found.select(key, "h", F.explode("cells").alias("c")).select(key, "h", "c.*")
    # Equal windows have equal anchors, so a cell that is alone under its anchor has no repeats. Stored, so that
    # nothing but this join depends on its keys.
    shared = every.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor")
    each = stored(every.join(shared, "anchor", "left_semi"), "shared")
    owners = stored(
        each.groupBy("cell").agg(
            F.min("anchor").alias("anchor"), F.min(F.struct(key, "h", "start", "n")).alias("own"), F.max(key).alias("last")
        ),
        "cells",
    )
    several = owners.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor")
    edge = owners.join(several, "anchor", "left_semi").select("cell", "own.*")
    listed = edge.groupBy(key, "h").agg(F.collect_list(F.struct("cell", "start", "n")).alias("cells"))
    texts = docs.select(key, F.xxhash64(text).alias("h"), F.col(text).cast("binary").alias("t"))
    opened = texts.join(listed, [key, "h"])
    kind = docs.schema[key].dataType.simpleString()

    def windows(rows: Iterator[tuple]) -> Iterator[tuple]:
        digest = xxhash.xxh3_128_digest
        for k, _, t, parts in rows:
            words = t.split()
            for c in parts:
                s = c["start"]
                for i in range(c["n"]):
                    yield k, c["cell"], i, digest(b" ".join(words[s + i : s + i + length]))

    single = stored(map_rows(opened, windows, f"`{key}` {kind}, cell binary, i int, w binary"), "windows")
    first = single.groupBy("w").agg(F.min(key).alias("least"), F.max(key).alias("last")).where("least < last")
    late = single.join(first.drop("last"), "w").where(F.col("least") < F.col(key))
    partly = late.groupBy("cell").agg(F.collect_set("i").alias("offsets"))
    known = owners.join(partly, "cell", "left").select(
        "cell", F.col("own")[key].alias("owner"), "offsets", "last"
    )
    known = known.where((F.col("last") > F.col("owner")) | F.col("offsets").isNotNull()).drop("last")
    # Stored, so that nothing but the join itself depends on its keys and skewed ones can be split.
    known = stored(known, "known")
    met = each.join(known, "cell").where((F.col(key) > F.col("owner")) | F.col("offsets").isNotNull())
    starts = F.when(F.col(key) > F.col("owner"), F.array(F.struct(F.col("start").alias("a"), F.expr(f"start + n + {length - 1}").alias("b"))))
    some = F.transform("offsets", lambda i: F.struct((F.col("start") + i).alias("a"), (F.col("start") + i + length).alias("b")))
    spans = met.select(key, "h", F.explode(F.coalesce(starts, some)).alias("s"))
    # A list per document is bounded by its words.
    return spans.groupBy(key, "h").agg(F.collect_set("s").alias("spans"))


def kept_words(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
               gram: int = GRAM) -> DataFrame:
    """What is left of every document: ``doc_id, n_words, n_removed, kept_sha256``.

    A word goes when a run of ``length`` words over it also starts in a document with a smaller
    id. NULL and empty texts have no words. A document with a NULL id keeps all words and is no
    evidence against others; rows with equal ids are not compared with each other. Texts shorter
    than ``length`` words stay. Other columns are not read.
    """
    found = stored(seeds(docs, key, text, length, gram), "seeds")
    spans = repeats(docs, found, key, text, length)
    kind = docs.schema[key].dataType.simpleString()

    def measure(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, h, pairs in rows:
            whole = merged([(s["a"], s["b"]) for s in pairs])
            yield k, h, sum(b - a for a, b in whole), [{"a": a, "b": b} for a, b in whole]

    schema = f"`{key}` {kind}, h bigint, n_removed bigint, gone array<struct<a:bigint,b:bigint>>"
    measured = stored(map_rows(spans, measure, schema), "repeats")
    rows = null_safe(found.drop("cells"), measured.drop("gone"), [key, "h"], "left")
    partial = null_safe(rows, measured.select(key, "h", "gone"), [key, "h"]).where("n_removed < n_words")
    partial = partial.select(key, "h", "gone").dropDuplicates([key, "h"])
    texts = docs.select(key, F.xxhash64(text).alias("h"), F.col(text).cast("binary").alias("t"))

    def keep(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, h, t, gone in rows:
            words, at, out = t.split(), 0, []
            for g in gone:
                out += words[at : g["a"]]
                at = g["b"]
            yield k, h, hashlib.sha256(b" ".join(out + words[at:])).hexdigest()

    # Texts that are kept or dropped as a whole are not moved.
    spot = F.xxhash64(F.col(key), "h")
    some = by_marks(texts, spot, stored(marks(partial.select(spot.alias("spot"))), "marks"))
    changed = map_rows(some.join(partial, [key, "h"]), keep, f"`{key}` {kind}, h bigint, changed string")
    final = null_safe(rows, changed.dropDuplicates([key, "h"]), [key, "h"], "left")
    empty = F.when(F.col("n_removed") == F.col("n_words"), F.sha2(F.lit("").cast("binary"), 256))
    return final.select(
        key,
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("changed", F.when(F.col("n_removed") > 0, empty), "sha").alias("kept_sha256"),
    )
