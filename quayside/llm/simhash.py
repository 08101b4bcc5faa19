"""Near copies by SimHash fingerprints, compared in vertical bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import components, map_rows, null_safe, stored

RADIUS = 2  # the blocks and stars below are laid out for it
WORDS = 3
SEED = 42
BLOCKS = 4  # of 16 bits; two fingerprints within the radius agree on two of them
BUCKET = 1024  # fingerprints compared plane by plane in one task; larger buckets go by stars


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """64 bits, as an unsigned number: 1 where over half of the shingle hashes have a 1."""
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), SEED)
    digest = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False))
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(parts) - words + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 4096):
        piece = hashes[start : start + 4096]
        ones += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row ``key, fp`` (signed long) per document; a NULL text counts as empty: fingerprint 0."""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k, t in rows:
            yield k, signed(fingerprint(t))

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key), F.col(text).cast("binary").alias("t"))
    return map_rows(narrow, work, f"`{key}` {kind}, fp bigint")


def planes(fps: np.ndarray) -> np.ndarray:
    """Blocks of 64 fingerprints turned on their side: ``[block, bit]`` holds that bit of all 64."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    turned = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(turned).view(np.uint64)[..., 0]


def within(queries: np.ndarray, block_of: np.ndarray, vertical: np.ndarray, radius: int) -> tuple:
    """For each query and block, the mask of the block's 64 fingerprints within the radius.

    Distances are held as carry-save counters, one bit of each count per word: a plane's
    differences are added to 64 counts with a few logic operations. Counts stop at the first power
    of two above the radius. After every eight planes the pairs of query and block whose counts
    all exceed the radius are abandoned. Returns the rows left and their masks.
    """
    depth = (radius + 1).bit_length()
    alive = np.arange(len(queries))
    counts = [np.zeros(len(queries), np.uint64) for _ in range(depth)]
    over = np.zeros(len(queries), np.uint64)
    for bit in range(64):
        flip = np.uint64(0) - ((queries[alive] >> np.uint64(bit)) & np.uint64(1))
        carry = vertical[block_of[alive], bit] ^ flip
        for level in range(depth):
            counts[level], carry = counts[level] ^ carry, counts[level] & carry
        over |= carry
        if bit % 8 == 7:
            far = over | _exceeds(counts, radius)
            stay = far != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not stay.all():
                alive, over, counts = alive[stay], over[stay], [c[stay] for c in counts]
    return alive, ~(over | _exceeds(counts, radius))


def _exceeds(counts: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count, given bit by bit, is above the radius."""
    above = np.zeros_like(counts[0])
    equal = ~above
    for level in range(len(counts) - 1, -1, -1):
        if radius >> level & 1:
            equal &= counts[level]
        else:
            above |= equal & counts[level]
            equal &= ~counts[level]
    return above


def bucket_links(buckets: list[np.ndarray], radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """Per bucket a star for each set of fingerprints joined within the radius: ``(other, least)``."""
    sizes = np.array([len(b) for b in buckets])
    padded = [np.concatenate([b, np.full(-len(b) % 64, b[0], np.uint64)]) for b in buckets]
    vertical = planes(np.concatenate(padded))
    blocks = (sizes + 63) // 64
    first_block = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    members = np.concatenate(buckets)
    # One row per member and block of its bucket.
    owner = np.repeat(np.arange(len(buckets)), sizes)
    reach = blocks[owner]
    query = np.repeat(np.arange(len(members)), reach)
    ordinal = np.arange(len(query)) - np.repeat(np.cumsum(reach) - reach, reach)
    label = np.arange(len(members))
    for start in range(0, len(query), 1 << 16):
        part = query[start : start + (1 << 16)]
        block = ordinal[start : start + (1 << 16)] + first_block[owner[part]]
        rows, masks = within(members[part], block, vertical, radius)
        lanes = np.unpackbits(masks.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(lanes)
        a = part[rows[row]]
        place = (block[rows[row]] - first_block[owner[a]]) * 64 + lane
        real = place < sizes[owner[a]]
        a, b = a[real], first[owner[a[real]]] + place[real]
        while True:
            low = np.minimum(label[a], label[b])
            if np.array_equal(label[a], low) and np.array_equal(label[b], low):
                break
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            label = label[label]
    while not np.array_equal(label[label], label):
        label = label[label]
    for i in np.nonzero(label != np.arange(len(members)))[0]:
        yield int(members[i]), int(members[label[i]])


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a, b`` that join all distinct fingerprints ``fp`` within the radius.

    Two fingerprints at most two bits apart agree on two of four 16-bit blocks, so each is filed
    under its six pairs of blocks. A bucket of up to ``bucket`` fingerprints is compared in bit
    planes in one task. In a larger one every fingerprint is filed again under itself and each of
    its neighbours at one free bit: two that share such a key are at most two bits apart, and
    any two that close share one, so the groups, of at most 33, are stars of true links. Both
    ways give the same components; nothing is compared all against all and no bucket is cut.
    """
    pairs = list(combinations(range(BLOCKS), 2))
    block = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF) for i in range(BLOCKS)]
    keys = [F.struct(F.lit(n).alias("pair"), (block[i] * 65536 + block[j]).alias("key")) for n, (i, j) in enumerate(pairs)]
    filed = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.pair", "k.key")
    sizes = filed.groupBy("pair", "key").count().where("count > 1")
    shared = filed.join(sizes, ["pair", "key"])
    plain = (
        shared.where(F.col("count") <= bucket).groupBy("pair", "key").agg(F.collect_list("fp").alias("members"))
    )

    def compare(rows: Iterator[tuple]) -> Iterator[tuple]:
        held, n = [], 0
        for (members,) in rows:
            held.append(np.sort(np.array(members, np.int64).view(np.uint64)))
            n += len(members)
            if n >= 8192:
                yield from ((signed(a), signed(b)) for a, b in bucket_links(held))
                held, n = [], 0
        if held:
            yield from ((signed(a), signed(b)) for a, b in bucket_links(held))

    near = map_rows(plain.select("members"), compare, "a bigint, b bigint")
    free = [[16 * b + i for b in range(BLOCKS) if b not in p for i in range(16)] for p in pairs]
    flips = F.lit([[signed(1 << bit) for bit in bits] for bits in free]).cast("array<array<bigint>>")
    around = F.transform(F.get(flips, F.col("pair")), lambda f: F.col("fp").bitwiseXOR(f))
    large = shared.where(F.col("count") > bucket)
    at = large.select("pair", "fp", F.explode(F.concat(F.array("fp"), around)).alias("spot"))
    stars = at.groupBy("pair", "spot").agg(F.collect_list("fp").alias("members")).where("size(members) > 1")
    star = stars.select(F.explode("members").alias("a"), F.array_min("members").alias("b"))
    return near.union(star.where("a <> b"))


def near_groups(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row ``fp, component_id`` per distinct fingerprint: the smallest key reachable from it."""
    fps = prints.groupBy("fp").agg(F.min(key).alias("least"))
    found = components(links(fps.select("fp")))
    labelled = fps.join(found, fps.fp == found.node, "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return labelled.join(least, "label").select("fp", "component_id", "label")


def simhash(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint and component of every document: ``doc_id, fingerprint, component_id``.

    Empty and NULL texts have fingerprint 0 and are linked like any other. Rows with a NULL id
    take part; a component of such rows only has a NULL id. Repeated rows each get a row. Other
    columns are not read.
    """
    prints = stored(with_fingerprints(docs, key, text), "simhash")
    groups = near_groups(prints, key)
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(groups, "fp").select(F.col(key), shown.alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Keep one document of each component: the one with the smallest id (NULL ids last).

    All columns stay. Of repeated rows one stays.
    """
    prints = stored(with_fingerprints(docs.withColumn("__h", F.md5(F.coalesce(text, F.lit("")))).select(
        F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("__h").alias("hash")).alias("row"),
        F.col(text),
    ), "row", text), "simhash")
    groups = near_groups(prints, "row")
    stay = groups.select(
        F.col("component_id.id").alias("__id"), F.col("component_id.hash").alias("__hash")
    ).distinct()
    marked = docs.withColumn("__h", F.md5(F.coalesce(text, F.lit(""))))
    on = [marked[key].eqNullSafe(stay["__id"]), marked["__h"] == stay["__hash"]]
    kept = marked.join(stay, on).dropDuplicates(["__id", "__hash"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def grouped_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, hash, group`` of every document (hash: ``xxhash64`` of its text), once: groups are the components."""
    whole = F.col(f"`{text}`")
    row = F.struct(F.col(f"`{key}`").alias("key"), F.xxhash64(whole).alias("hash")).alias("row")
    prints = stored(with_fingerprints(docs.select(row, whole), "row", text), "simhash")
    groups = near_groups(prints, "row")
    return prints.join(groups, "fp").select("row.key", "row.hash", F.col("label").alias("group")).distinct()
