"""Ranked lexical search over blocks of documents: short lists summed first, long ones skipped over.

The index is a table of blocks. A block holds some thousand documents by ascending key and, for every
term in them, its posting list (place of the document in the block, occurrences). It is written once
from one pass over the texts; searches read no text. A search

1. adds up documents, words and document frequencies from the blocks (one number per block and term
   travels, not one per posting);
2. lets each task rank its blocks for every query. Within a block the short lists of a query are
   materialised as summed accumulators (term at a time). These accumulators then count as *one* list
   with a known bound beside the long lists, and documents are taken in order: lists are sorted by
   their greatest contribution, those whose bounds together stay below the tenth best score so far
   bring no documents of their own and are only probed, by skipping, for the documents the others
   bring, and these are given up as soon as their bounds no longer reach the tenth best score;
3. keeps the best of each task per query and ranks those.

Pruning is exact: a document goes only when its bound is *below* the score to beat, so equal scores
still meet and are decided by the key. Scores are whole numbers; sums do not depend on their order.

Queries are taken in groups of bounded text, which is all that tasks are sent (``QUERY_BYTES``); each
group reads the blocks once. Nothing else is broadcast, and the driver sees the frequencies of one
group's terms.

NULL and empty texts have no terms: such documents are never counted or found, such queries find
nothing. Repeated rows of documents count and rank each by itself. Repeated queries, by key and text,
are one; several texts under one key are ranked apart. Equal scores: ascending key, NULL last. Texts are
indexed whole. Only the named columns are read, so extra ones may bear any name. Empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from math import floor, log

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import map_rows, stored

BEST = 10
BLOCK_DOCS = 4096  # documents of a block, at most
BLOCK_WORDS = 1 << 20  # words after which a block is closed
SHORT = 1 / 16  # a list of up to this share of a block's documents is short
QUERY_BYTES = 4 << 20  # text of the queries ranked in one pass

# Letters, digits and everything beyond ASCII are parts of terms; only A-Z are folded.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms(text: bytes | str | None) -> list[bytes]:
    """The terms of a text in order, with repeats."""
    return (text.encode() if isinstance(text, str) else text or b"").translate(_FOLD).split()


# --- the index


def index(docs: DataFrame, key: str = "doc_id", text: str = "text", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Blocks of posting lists over all documents that have a term, written to the shared folder."""
    kind = docs.schema[key].dataType.simpleString()

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        held = _Block()
        for number, whole in rows:
            held.add(number, terms(whole))
            if len(held.keys) >= block_docs or held.size >= BLOCK_WORDS:
                yield held.row()
                held = _Block()
        if held.keys:
            yield held.row()

    schema = f"keys array<{kind}>, n_docs bigint, n_words bigint, lengths binary, terms binary, ends binary, places binary, counts binary"
    return stored(map_rows(docs.select(key, F.col(text).cast("binary")), work, schema, given=1), "index", large=True)


class _Block:
    """Documents on their way into a block."""

    def __init__(self) -> None:
        self.keys: list = []
        self.lengths: list[int] = []
        self.ids: list[np.ndarray] = []
        self.known: dict[bytes, int] = {}
        self.size = 0

    def add(self, key, words: list[bytes]) -> None:
        if not words:
            return
        known = self.known
        self.ids.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
        self.keys.append(key)
        self.lengths.append(len(words))
        self.size += len(words)

    def row(self) -> tuple:
        order = sorted(range(len(self.keys)), key=lambda i: (self.keys[i] is None, self.keys[i]))
        n = len(order)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        pairs = np.concatenate(self.ids) * n + np.repeat(place, self.lengths)
        pairs, counts = np.unique(pairs, return_counts=True)
        ends = np.searchsorted(pairs, np.arange(1, len(self.known) + 1) * n)
        return (
            [self.keys[i] for i in order],
            n,
            self.size,
            np.array([self.lengths[i] for i in order], np.int64).tobytes(),
            b" ".join(self.known),
            ends.astype(np.int64).tobytes(),
            (pairs % n).astype(np.int32).tobytes(),
            counts.astype(np.int32).tobytes(),
        )


# --- statistics


def totals(blocks: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their words."""
    n, words = blocks.agg(F.sum("n_docs"), F.sum("n_words")).first()
    return n or 0, words or 0


def frequencies(blocks: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """In how many documents each wanted term occurs; terms that do not are left out."""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for held, ends in rows:
            last, found = 0, []
            for term, end in zip(held.split(), np.frombuffer(ends, np.int64).tolist(), strict=True):
                if term in wanted:
                    found.append((term, end - last))
                last = end
            yield from found

    counted = map_rows(blocks.select("terms", "ends"), work, "term binary, n bigint", taken=1)
    return {bytes(t): n for t, n in counted.groupBy("term").agg(F.sum("n")).collect()}


def weight(df: int, documents: int) -> int:
    return floor(1000 * log((2 * documents + 2) / (2 * df + 1)))


# --- ranking


@dataclass
class Best:
    """The best documents of one query so far."""

    size: int
    rows: list[tuple] = field(default_factory=list)  # score, key

    @property
    def beat(self) -> int:
        """The score a document must reach to count."""
        return self.rows[-1][0] if len(self.rows) == self.size else 1

    def put(self, rows: Iterable[tuple]) -> None:
        ordered = sorted([*self.rows, *rows], key=lambda r: (-r[0], r[1] is None, r[1]))
        self.rows = ordered[: self.size]


class Lists:
    """The posting lists of one block with the contributions of a weighted vocabulary."""

    def __init__(self, row: tuple, weights: dict[bytes, int], documents: int, words: int) -> None:
        self.keys, lengths, held, ends, places, counts = row
        self.n = len(self.keys)
        self.ends = np.frombuffer(ends, np.int64)
        self.places = np.frombuffer(places, np.int32)
        self.counts = np.frombuffer(counts, np.int32)
        self.weights = weights
        self.at = {t: i for i, t in enumerate(held.split()) if t in weights}
        # Python's whole numbers, as the product may pass 64 bits before the division.
        self.m = np.array([25 + 75 * n * documents // words for n in np.frombuffer(lengths, np.int64).tolist()], np.int64)
        self.made: dict[bytes, tuple] = {}

    def get(self, term: bytes) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Places, contributions and the greatest of them."""
        if term not in self.at:
            return None
        if term not in self.made:
            i = self.at[term]
            part = slice(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))
            places, tf = self.places[part], self.counts[part].astype(np.int64)
            gain = self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * self.m[places]))
            self.made[term] = places, gain, int(gain.max())
        return self.made[term]

    def search(self, query: list[tuple[bytes, int]], best: Best, short: float = SHORT) -> None:
        """Put the block's best documents for ``term, repeats`` into ``best``."""
        lists = [(*held, times) for term, times in query if (held := self.get(term))]
        if sum(x[2] * x[3] for x in lists) < best.beat:
            return
        # Term at a time: the short lists become one summed list with one bound.
        summed, some = np.zeros(self.n, np.int64), False
        long = []
        for places, gain, top, times in lists:
            if len(places) <= short * self.n:
                summed[places] += gain * times
                some = True
            else:
                long.append((top * times, places, gain, times))
        if some:
            places = np.flatnonzero(summed)
            if len(places):
                gain = summed[places]
                long.append((int(gain.max()), places, gain, 1))
        # Document at a time: lists that cannot reach the score to beat together are only probed.
        long.sort(key=lambda x: x[0])
        bounds = np.cumsum([x[0] for x in long], dtype=np.int64).tolist()
        probed = sum(b < best.beat for b in bounds)
        score, seen = np.zeros(self.n, np.int64), np.zeros(self.n, bool)
        for _, places, gain, times in long[probed:]:
            score[places] += gain * times
            seen[places] = True
        docs = np.flatnonzero(seen)
        score = score[docs]
        for i in range(probed - 1, -1, -1):
            alive = score + bounds[i] >= best.beat
            docs, score = docs[alive], score[alive]
            if not len(docs):
                return
            _, places, gain, times = long[i]
            at = np.minimum(np.searchsorted(places, docs), len(places) - 1)
            hit = places[at] == docs
            score[hit] += gain[at[hit]] * times
        alive = score >= best.beat
        docs, score = docs[alive], score[alive]
        if len(docs) > best.size:
            least = np.partition(score, -best.size)[-best.size]
            docs, score = docs[score >= least], score[score >= least]
            order = np.lexsort((docs, -score))[: best.size]  # places follow the keys
            docs, score = docs[order], score[order]
        if len(docs):
            best.put((s, self.keys[d]) for s, d in zip(score.tolist(), docs.tolist(), strict=True))


def search(
    blocks: DataFrame,
    queries: DataFrame,
    best: int = BEST,
    key: str = "item_id",
    text: str = "text",
    found: str = "doc_id",
    query_bytes: int = QUERY_BYTES,
    short: float = SHORT,
) -> DataFrame:
    """Rows ``key, rank, found, score`` with the ``best`` documents of every query."""
    asked = queries.select(F.col(key).alias("q"), F.col(text).alias("t")).where("t is not null").distinct()
    documents, words = totals(blocks)
    kinds = queries.schema[key].dataType.simpleString(), blocks.schema["keys"].dataType.elementType.simpleString()
    schema = f"q {kinds[0]}, ask bigint, d {kinds[1]}, score bigint"
    parts = [
        _ranked(blocks, group, schema, best, documents, words, short) for group in _groups(asked, query_bytes)
    ]
    if parts:
        near = reduce(DataFrame.unionAll, parts)
    else:
        near = blocks.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("q", "ask").orderBy(F.desc("score"), F.asc_nulls_last("d"))
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select(F.col("q").alias(key), "rank", F.col("d").alias(found), "score")


def _groups(asked: DataFrame, query_bytes: int) -> Iterator[list[tuple]]:
    """The queries, a group of bounded text at a time; a longer query is a group of its own."""
    size = F.octet_length("t") + 64
    # One line per thousandth of a group says where groups end; whole texts come group by group.
    asked = asked.withColumn("h", F.xxhash64("q", "t"))
    total = asked.agg(F.sum(size)).first()[0] or 0
    cells = 1 + 4 * (total // query_bytes)
    sized = asked.groupBy(F.pmod("h", F.lit(cells)).alias("cell")).agg(F.sum(size).alias("n")).orderBy("cell").collect()
    group, held = [], 0
    for cell, n in sized:
        if group and held + n > query_bytes:
            yield _texts(asked, cells, group)
            group, held = [], 0
        group.append(cell)
        held += n
    if group:
        yield _texts(asked, cells, group)


def _texts(asked: DataFrame, cells: int, group: list[int]) -> list[tuple]:
    rows = asked.where(F.pmod("h", F.lit(cells)).isin(group)).select("q", "h", F.col("t").cast("binary")).collect()
    return [(q, h, sorted(Counter(terms(t)).items())) for q, h, t in rows]


def _ranked(blocks, group, schema, best, documents, words, short) -> DataFrame:
    df = frequencies(blocks, {t for _, _, query in group for t, _ in query})
    weights = {t: weight(n, documents) for t, n in df.items()}
    asked = [(q, h, [(t, n) for t, n in query if t in weights]) for q, h, query in group]

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        tops = [Best(best) for _ in asked]
        for row in rows:
            lists = Lists(row, weights, documents, words)
            for (_, _, query), top in zip(asked, tops, strict=True):
                lists.search(query, top, short)
        for (q, h, _), top in zip(asked, tops, strict=True):
            for score, number in top.rows:
                yield q, h, number, score

    columns = ["keys", "lengths", "terms", "ends", "places", "counts"]
    return map_rows(blocks.select(*columns), work, schema, taken=1)
