"""Documents packed into fixed-length sequences by first-fit decreasing."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import kept, map_rows, stored

LENGTH = 2048
END = 1
GROUP = 1024  # pieces packed together, on average
CACHE = 500_000  # words whose ids a worker keeps, twice at most
EARLY = 1 << 14  # of them so many are kept at first sight
SEEN = 1 << 20  # slots that remember which words were asked for once
# A word, perhaps after a space, and a stop: tokens of their own whatever stands around them.
_SIMPLE = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
# The printable stand-ins of bytes in byte-level vocabularies: themselves, or the next free from U+0100.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class _Ids(dict):
    """Ids of words after ``lead`` as little-endian bytes, kept from the second time they are asked for.

    Most words of a corpus come once, and kept they would be most of the store. The first few are kept
    at once. Two words may share a slot of ``seen``, by which one of them is kept a time too early.
    """

    def __init__(self, model, lead: str = "", plain: _Ids | None = None):
        super().__init__()
        self.tokenize, self.split = model.model.tokenize, model.pre_tokenizer.pre_tokenize_str
        self.lead, self.plain = lead, self if plain is None else plain
        self.old: dict[str, bytes] = {}
        self.seen = bytearray(SEEN)

    def __missing__(self, word: str) -> bytes:
        made = self.old.pop(word, None)
        if made is None:
            made = self._made(word)
            spot = hash(word) & (SEEN - 1)
            if len(self) >= EARLY and not self.seen[spot]:
                self.seen[spot] = 1
                return made
        self[word] = made
        return made

    def _made(self, word: str) -> bytes:
        chunk = self.lead + word
        simple = _SIMPLE.fullmatch(chunk)
        if simple is None:
            return b"".join(self._raw(part) for part, _ in self.split(chunk))
        if simple[2]:
            return self[word[:-1]] + self.plain[simple[2]]
        if chunk.isascii():
            return self._raw(chunk.replace(" ", _BYTES[0x20]))
        return self._raw(chunk.encode().decode("latin-1").translate(_BYTES))

    def _raw(self, part: str) -> bytes:
        return array("I", [t.id for t in self.tokenize(part)]).tobytes()

    def turn(self) -> None:
        """Forget what has not been asked for since the last turn."""
        self.old.clear()  # first, so that three generations are never held
        self.old.update(self)
        self.clear()
        self.seen = bytearray(SEEN)


class ChunkTokenizer:
    """Ids of texts as little-endian bytes, with the ids of words between single spaces kept.

    The byte-level pre-tokenizer always starts a token at a space or line end between two other
    characters, so a text without runs of white space and without special tokens is the sum of
    its chunks: a line's first word, and each further one with the space before it. Other texts are
    encoded whole. Words that come again are kept, and of those the ones in use survive when the store is full.
    """

    def __init__(self, path: str, cache: int = CACHE):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.cache, self.known = cache, _Ids(self.model)
        self.spaced = _Ids(self.model, " ", self.known)

    def _encode(self, text: str) -> bytes:
        return array("I", self.model.encode(text, add_special_tokens=False).ids).tobytes()

    def _by_words(self, text: str) -> bool:
        """Whether single spaces and line ends are all the white space, none at either end, without special tokens."""
        words = text.split()
        gaps = len(words) - 1
        single = gaps == text.count(" ") + text.count("\n") and gaps + sum(map(len, words)) == len(text)
        return single and not any(s in text for s in self.special)

    def _line(self, line: str) -> bytes:
        first, space, rest = line.partition(" ")
        if not space:
            return self.known[first]
        return self.known[first] + b"".join(map(self.spaced.__getitem__, rest.split(" ")))

    def __call__(self, texts: list[str]) -> list[bytes]:
        out, end = [], self.known["\n"]
        for text in texts:
            if self._by_words(text):
                out.append(end.join(map(self._line, text.split("\n"))))
            else:
                out.append(self._encode(text))
            if len(self.known) + len(self.spaced) > self.cache:
                self.known.turn()
                self.spaced.turn()
        return out


def tokenizer(path: str) -> ChunkTokenizer:
    return kept(f"tokenizer {path}", lambda: ChunkTokenizer(path))


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH, key: str = "doc_id", text: str = "text",
           ids: bool = True) -> DataFrame:
    """Tokenised documents cut every ``length`` ids, an end id closing each: a row per piece.

    ``doc_id, start, length, ids_crc32, doc_tokens, ids`` (little-endian 32-bit ids). Without ``ids``
    that column is left out and the ids stay in the worker.
    ``vocabulary`` is a tokenizer file at the same path on every machine.
    """
    kind = docs.schema[key].dataType.simpleString()
    end = END.to_bytes(4, "little")

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        encode = tokenizer(vocabulary)

        def flush(held: list[tuple]) -> Iterator[tuple]:
            for (k, _), made in zip(held, encode([t or "" for _, t in held]), strict=True):
                made += end
                total = len(made) // 4
                for start in range(0, total, length):
                    part = made[4 * start : 4 * (start + length)]
                    row = k, start, len(part) // 4, zlib.crc32(part), total
                    yield (*row, part) if ids else row

        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row[1] or "")
            if size > 1 << 20 or len(held) == 256:
                yield from flush(held)
                held, size = [], 0
        yield from flush(held)

    schema = f"`{key}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    schema += ", ids binary" if ids else ""
    return map_rows(docs.select(key, text), work, schema, keeps=f"tokenizer {vocabulary}")


class Bins:
    """Open bins under a tournament tree: each inner node holds the larger room of its two sides.

    The first bin with enough room is found from the root by always trying the left side first.
    """

    def __init__(self, capacity: int, items: int):
        self.leaves = 1 << max(0, items - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Bin number and offset for the next item; as many bins as items are at hand."""
        node, room = 1, self.room
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        left = room[node]
        room[node] = left - size
        spot = node
        while spot > 1:
            spot //= 2
            room[spot] = max(room[2 * spot], room[2 * spot + 1])
        return node - self.leaves, left


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each item, in the order given; ties keep that order."""
    bins, out = Bins(capacity, len(sizes)), [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        number, left = bins.place(sizes[i])
        out[i] = (number, capacity - left)
    return out


def packed(parts: DataFrame, length: int = LENGTH, key: str = "doc_id", group: int = GROUP, seed: int = 7) -> DataFrame:
    """Give every piece a sequence and an offset in it: columns ``sequence_id, offset`` are added.

    Pieces are dealt into random groups of about ``group`` by a seeded hash; each group is packed
    on its own in one task, with bounded memory, and the same again when a task is repeated. Only
    (key, start, length, checksum, size) travel, not the ids. Whole pieces fill a sequence of
    their own like any other item.
    """
    rows = parts.select(key, "start", "length", "ids_crc32", "doc_tokens")
    groups = max(1, rows.count() // group)
    number = F.pmod(F.xxhash64(F.col(key), "start", "ids_crc32", F.lit(seed)), F.lit(groups))
    dealt = rows.withColumn("g", number).repartition("g").sortWithinPartitions(
        "g", F.col("length").desc(), key, "start", "ids_crc32"
    )

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        def flush(held: list[tuple]) -> Iterator[tuple]:
            for row, (b, at) in zip(held, first_fit_decreasing([r[2] for r in held], length), strict=True):
                yield *row[:-1], (row[-1] << 32) + b, at

        held: list[tuple] = []
        for row in rows:
            if held and held[-1][-1] != row[-1]:
                yield from flush(held)
                held = []
            held.append(row)
        if held:
            yield from flush(held)

    kind = parts.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint"
    )
    return map_rows(dealt, work, schema)


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, key: str = "doc_id", text: str = "text",
         group: int = GROUP) -> DataFrame:
    """Where every id of every document goes: one row per piece, without the ids.

    A NULL or empty text is its end id alone. Repeated rows, also of one id, are packed one by one.
    """
    parts = pieces(docs, vocabulary, length, key, text, ids=False)
    return packed(stored(parts, "pieces"), length, key, group)


def sequences(docs: DataFrame, vocabulary: str, length: int = LENGTH, pad: int = 0, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` (padded to ``length``).

    Keys and starts must tell pieces apart, so ids of documents must be unique here.
    """
    parts = stored(pieces(docs, vocabulary, length, key, text), "pieces")
    where = packed(parts, length, key).select(key, "start", "sequence_id", "offset")
    placed = parts.select(key, "start", "ids").join(where, [key, "start"])
    # A sequence is at most `length` pieces, so gathering it is bounded.
    gathered = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for sequence, found in rows:
            ids = np.frombuffer(b"".join(p["ids"] for p in found), "<u4").astype(int).tolist()
            yield sequence, ids + [pad] * (length - len(ids))

    return map_rows(gathered, work, "sequence_id bigint, ids array<int>")
