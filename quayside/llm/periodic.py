"""Periodic runs of words: stretches that repeat one root at least four times over.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are the same)
and a length of at least ``max(6, 4 q)`` that no neighbouring word extends. Its words match those
``q`` further over at least ``max(5, 3 q)`` positions, so runs are found by seeds on diagonals:

* lags are taken in classes ``2**j <= q < 2**(j + 1)``; every run of a class has a match of at
  least ``k = max(5, 3 * 2**j)`` words, and the k-grams of that length are indexed, named exactly by
  doubling (a name is the rank of a pair of shorter names), never hashed;
* as ``k > q``, the root of a run occurs in each of its k-grams, and the next occurrence of a k-gram
  is exactly ``q`` later. So next occurrences within one document are all the pairs there are to
  look at, and a word repeated ten thousand times gives no more pairs than it has places;
* a pair is extended to both sides along its diagonal, and a table with the furthest place covered
  per lag keeps every other pair of the same stretch from being extended again.

A class without a repeated k-gram ends the search: longer ones repeat even less. A document of ``n``
words takes ``O(n log n)`` steps and memory; documents are independent, so nothing is shuffled and a
lost executor costs the documents it held.

NULL and empty texts have no words and no run. Repeated rows each give their row. Equal exponents: the
smallest start, then the smallest period. Texts are read whole, however long; the memory of a task is
that of its longest text. Only words and their places matter, so extra columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import map_rows, rewrite_text

TIMES = 4  # a run holds its root at least this often
LEAST = 6  # words of the shortest run


def numbered(words: list) -> np.ndarray:
    """Words as whole numbers, equal ones alike."""
    known: dict = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def paired(names: np.ndarray, apart: int) -> np.ndarray:
    """Names of the pairs of names ``apart`` places from each other."""
    if len(names) <= apart:
        return np.zeros(0, np.int64)
    both = names[:-apart] * (int(names.max()) + 1) + names[apart:]
    return np.unique(both, return_inverse=True)[1].astype(np.int64)


def next_seen(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of names that occur again, and how far off their next occurrence is; in order of places."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    places, apart = order[:-1][same], (order[1:] - order[:-1])[same]
    by = np.argsort(places, kind="stable")
    return places[by], apart[by]


def _matching(a: np.ndarray, b: np.ndarray, back: bool = False) -> int:
    """How many leading (with ``back``: trailing) items of equally long arrays agree, seen in growing pieces."""
    size, done, step = len(a), 0, 16
    if back:
        a, b = a[::-1], b[::-1]
    while done < size:
        unlike = np.flatnonzero(a[done : done + step] != b[done : done + step])
        if len(unlike):
            return done + int(unlike[0])
        done, step = min(size, done + step), step * 4
    return size


def _guaranteed(low: int, times: int, least: int) -> int:
    """Words that match along the diagonal in any run with a lag from ``low`` to below ``2 * low``."""
    return max((times - 1) * low, least - 2 * low + 1)


def runs(words: list, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` by start, then period. ``times`` is three or more."""
    if times < 3:
        raise ValueError("the next occurrence of a seed tells the period only from three repetitions on")
    n = len(words)
    if n < least:
        return []
    ids = numbered(words)
    found, covered, grams, held, low = [], {}, ids, 1, 1
    while low * times <= n:
        high = 2 * low  # lags of this class are below it
        k = _guaranteed(low, times, least)
        if held > k:
            grams, held = ids, 1
        while 2 * held <= k:
            grams, held = paired(grams, held), 2 * held
        seeds = grams if held == k else paired(grams, k - held)
        places, apart = next_seen(seeds)
        if not len(places) and _guaranteed(high, times, least) >= k:
            break
        fit = (apart >= low) & (apart < high)
        for i, q in zip(places[fit].tolist(), apart[fit].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            right = i + _matching(ids[i : n - q], ids[i + q :])
            left = i - _matching(ids[:i], ids[q : i + q], back=True)
            covered[q] = right
            if right - left + q >= max(least, times * q):
                found.append((left, right - left + q, q))
        low = high
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_places(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first root only."""
    keep = np.ones(n, bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return keep


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exponent, compared as fractions."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def planted(words: list, number: int | None) -> list:
    """Words with a periodic tail where the document's number calls for one (the test bed of the query)."""
    n = len(words)
    if number is None or not n:
        return words
    h = zlib.crc32(str(number).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def words_of(text: bytes | str | None) -> list[bytes]:
    """Words between the six ASCII blanks; other spaces belong to words."""
    return (text.encode() if isinstance(text, str) else text or b"").split()


SCHEMA = (
    "{key}, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def run_report(docs: DataFrame, key: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """Per document its number of runs, the strongest one and digests of all runs and of what is kept.

    Without a run the four columns of the strongest are NULL; the digests never are.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for number, whole in rows:
            words = words_of(whole)
            if plant:
                words = planted(words, number)
            found = runs(words)
            best = strongest(found)
            top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
            left = words
            if found:
                left = [words[i] for i in np.flatnonzero(kept_places(len(words), found)).tolist()]
            yield number, len(words), len(found), *top, sha256(listed.encode()).hexdigest(), sha256(
                b" ".join(left)
            ).hexdigest()

    return map_rows(docs.select(key, F.col(text).cast("binary")), work, SCHEMA.format(key=f"`{key}` {kind}"))


def run_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per run: the key, its first word's number, its length in words and its period."""
    kind = docs.schema[key].dataType.simpleString()

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for number, whole in rows:
            for run in runs(words_of(whole)):
                yield number, *run

    schema = f"`{key}` {kind}, start bigint, length bigint, period bigint"
    return map_rows(docs.select(key, F.col(text).cast("binary")), work, schema)


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every run cut to its first root; texts without a run stay as they are.

    A changed text has its words joined by one blank. NULL stays NULL; all other columns pass unread.
    """

    def work(batches: Iterator[list]) -> Iterator[list]:
        for texts in batches:
            made = []
            for whole in texts:
                words = words_of(whole)
                found = runs(words)
                if found:
                    whole = b" ".join(words[i] for i in np.flatnonzero(kept_places(len(words), found)).tolist()).decode()
                made.append(whole)
            yield made

    return rewrite_text(docs, work, text)
