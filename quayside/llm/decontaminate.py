"""Benchmark passages in training text, found by a broadcast set of word n-grams."""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import DROP, map_rows, stored

N = 10
BLOCK_BYTES = 16 << 20  # benchmark text held by a task at a time, about 0.3 GB as windows
DROP_SHARE = 0.5  # documents with at least this share of benchmark words go, others lose the words

# Word characters are digits, letters a-z after lower-casing, and all beyond ASCII.
_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_LOWER = bytes(range(256)).lower()
_TABLE = bytes(c if c in _WORD else 0x20 for c in _LOWER)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


def spans(text: bytes) -> list[tuple[int, int]]:
    """Byte spans of the words of a text."""
    flat, found, at = text.translate(_TABLE), [], 0
    for w in flat.split():
        at = flat.index(w, at)
        found.append((at, at + len(w)))
        at += len(w)
    return found


class Grams:
    """The windows of some items: word numbers, and for each window the items that have it.

    A window is the bytes of its word numbers, four to a word.
    """

    def __init__(self, items: list[tuple[str | None, bytes | None]], n: int = N):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[bytes, tuple | set] = {}  # most have one item, for which a set is large
        for item, text in items:
            ids = array("I", [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)])
            size, flat, owner = min(n, len(ids)), ids.tobytes(), (item,)
            for i in range(len(ids) - size + 1 if ids else 0):
                window = flat[4 * i : 4 * (i + size)]
                known = self.windows.setdefault(window, owner)
                if isinstance(known, set):
                    known.add(item)
                elif known != owner:
                    self.windows[window] = {*known, item}
        self.sizes = sorted({len(w) // 4 for w in self.windows})

    def hits(self, parts: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Word spans of the windows that occur, merged, and the items they belong to."""
        if not self.sizes:
            return [], set()
        ids = list(map(self.vocabulary.get, parts))
        found: list[tuple[int, int]] = []
        items: set = set()
        start, least = 0, self.sizes[0]
        # Only runs of words that the benchmark knows can hold one of its windows.
        for end in [i for i, x in enumerate(ids) if x is None] + [len(ids)]:
            flat = array("I", ids[start:end]).tobytes() if end - start >= least else b""
            for size in self.sizes if flat else ():
                for i in range(end - start - size + 1):
                    owners = self.windows.get(flat[4 * i : 4 * (i + size)])
                    if owners:
                        found.append((start + i, start + i + size))
                        items.update(owners)
            start = end + 1
        return merged(found), items


def merged(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", limit: int = BLOCK_BYTES):
    """The benchmark as named broadcast sets, each made of at most about ``limit`` bytes of text; and whether it is the last.

    The size is checked first. A benchmark above it is dealt by hash into several blocks, made one
    at a time, so neither the driver nor a task ever holds more than one.
    """
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    count = 1 if size <= limit else -(-2 * size // limit)  # twice as many: dealing is uneven
    spark = benchmark.sparkSession
    for k in range(count):
        part = rows if count == 1 else rows.where(F.pmod(F.xxhash64("t"), F.lit(count)) == k)
        held = [tuple(r) for r in part.collect()]
        made = spark.sparkContext.broadcast([(i, bytes(t or b"")) for i, t in held])
        yield (uuid.uuid4().hex, made), k == count - 1


_MADE: dict = {}


def _grams(block, n: int) -> Grams:
    """One set per worker process and named block."""
    name, held = block
    if (name, n) not in _MADE:
        _MADE.clear()
        _MADE[name, n] = Grams(held.value, n)
    return _MADE[name, n]


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", n: int = N,
         limit: int = BLOCK_BYTES) -> DataFrame:
    """Hits per document: ``doc_id, n_words, hits`` (word spans) and ``items`` (sorted ids as text).

    A NULL or empty text has no words and no hits; a NULL item id adds hits but no name. An item
    of fewer than ``n`` words is one window; repeated items and documents each count. Other
    columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, t binary, n_words bigint, hits array<struct<a:bigint,b:bigint>>, items array<string>"
    empty = F.array().cast("array<string>")
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    found = docs.select(
        F.col(key), F.col(text).cast("binary").alias("t"), F.lit(0).cast("bigint").alias("n_words"),
        none.alias("hits"), empty.alias("items"),
    )
    for number, (block, _) in enumerate(blocks(benchmark, text=text, limit=limit)):

        def scan(rows: Iterator[tuple], block=block) -> Iterator[tuple]:
            grams = _grams(block, n)
            for k, t, _, hits, items in rows:
                parts = words(t)
                more, names = grams.hits(parts)
                hits = merged([(h["a"], h["b"]) for h in hits] + more)
                names = sorted({*items, *(x for x in names if x is not None)})
                yield k, t, len(parts), [{"a": a, "b": b} for a, b in hits], names

        found = map_rows(stored(found, "grams") if number else found, scan, schema)
    return found.drop("t")


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest of :func:`find`: counts, and the checksum of the item names."""
    found = find(docs, benchmark, **options)
    key = found.columns[0]
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda s, h: s + h["b"] - h["a"])
    return found.select(
        key,
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def cut(text: str | None, found: list[tuple[int, int]], share: float = DROP_SHARE) -> object:
    """The text without the given spans of words, or ``DROP`` when they make up most of it."""
    if not text or not found:
        return text
    raw = text.encode()
    places, out, at = spans(raw), [], 0
    if sum(b - a for a, b in found) >= share * len(places):
        return DROP
    for a, b in found:
        out.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = N,
                  share: float = DROP_SHARE, limit: int = BLOCK_BYTES) -> DataFrame:
    """Documents without benchmark passages: spans are cut, documents mostly made of them dropped.

    The hits of all blocks are found in the unchanged text, each pass adding those of its block;
    the last one decides once per document. Clean documents, NULL and empty texts pass unchanged,
    as do all other columns; only a column ``n_chars`` follows the text.
    """
    kinds, place, last = docs.schema, docs.columns.index(text), len(docs.columns)
    marked = docs.withColumn("__hits", F.array().cast("array<bigint>"))  # ends of spans, two by two
    for number, (block, final) in enumerate(blocks(benchmark, text=text, limit=limit)):

        def run(batches: Iterator[pa.RecordBatch], block=block, final=final) -> Iterator[pa.RecordBatch]:
            grams = _grams(block, n)
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    piece = batch.slice(start, 512)
                    texts, before = piece.column(place).to_pylist(), piece.column(last).to_pylist()
                    hits = [
                        merged([*zip(h[::2], h[1::2], strict=True), *grams.hits(words(t.encode() if t else None))[0]])
                        for t, h in zip(texts, before, strict=True)
                    ]
                    if final:
                        made = [cut(t, h, share) for t, h in zip(texts, hits, strict=True)]
                        keep = pa.array([x is not DROP for x in made])
                        column = pa.array([None if x is DROP else x for x in made], type=piece.schema.field(place).type)
                        piece = piece.set_column(place, piece.schema.field(place), column).filter(keep)
                        yield piece.select(list(range(last)))
                    else:
                        field = piece.schema.field(last)
                        column = pa.array([[x for ab in h for x in ab] for h in hits], type=field.type)
                        yield piece.set_column(last, field, column)

        marked = (stored(marked, "decontaminate") if number else marked).mapInArrow(run, kinds if final else marked.schema)
    docs = marked
    if "n_chars" in docs.columns:
        length = F.length(text).cast(kinds["n_chars"].dataType)
        docs = docs.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))
    return docs
