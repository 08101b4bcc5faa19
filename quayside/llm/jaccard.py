"""Jaccard join of documents over word n-grams, light sets by subsets and heavy ones by inverted lists.

Documents of one set of shingles are one class; what follows works on classes (``node``). Two sets of
sizes ``s <= t`` link when they share at least ``need(s, t)`` shingles.

*Light sets* (smaller than a boundary) list, for every size ``t`` that a light partner may have, all
their subsets of ``need(s, t)`` shingles. Two sets of these sizes that have a subset in common are a
link without further looks, so a subset's holders form a star around one holder of the smaller size:
as many links as holders, however many there are.

*Heavy sets* scan inverted lists. A list holds the sets that have its shingle in their prefix, the
rarest fifth (``1 - least``) of a set in one global order, in which any link has its first common
shingle. The order is by a counting sketch of fixed size, then by hash; it decides the cost and never
the result. Three bounds make hot lists short: the smaller set of a link has that shingle among its
rarest ninth, sizes differ by a quarter at most (lists are cut into bands of sizes), and the words after
that shingle must suffice.

*The boundary* is chosen by cost from exact counts: subsets that light sets of each size would list,
against entries in the lists that sets of each size would scan.

*Connected sets* are not compared again. Short lists give all their pairs. Each longer one first compares
its sets with one of its own, drawn by hash, and true links make groups. Then long lists that still hold several groups are scanned for pairs of
different groups, leaving out the pairs within the largest. A list of a hundred thousand copies of one
text thus costs a hundred thousand comparisons. Every pair that could still join two groups is looked
at, so the groups are exact. ``links`` without this shortcut gives every link between classes.

Candidates are first compared by parity bitmaps, which differ in no more places than their sets differ
in shingles, and then verified by the number of 64-bit hashes that two sets share; classes and subsets go by
128 bits. Words are split at ASCII blanks and only A-Z are folded; fewer words than ``words`` make one
shingle. NULL and texts without words have the empty set and link with nothing, each is a group of its
own. Repeated rows are one class and each give their row. A NULL key takes part; a group is named after
its smallest key (NULL if it has none). Texts are read whole. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import by_marks, components, map_rows, marks, release, small_batches, stored

WORDS = 5
LEAST = (80, 100)  # shared : all, as whole numbers so that the bound is exact
SLOTS = 1 << 18  # counters of the sketch that orders shingles
LIGHTEST, LIGHTER = 1, 24  # the boundary lies between; larger subsets are too many for any corpus
SEED = 42
LANES = 8  # 64-bit words of a set's parity bitmap
SHORT = 16  # entries of a list whose pairs are all made at once

_SHIFT = np.uint64(64 - SLOTS.bit_length() + 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_KNOWN = 1 << 17  # word hashes remembered by a task


# --- sets


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of texts; remembers hashes of words."""

    def __init__(self, words: int = WORDS) -> None:
        self.words, self.known = words, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        parts = (text or b"").lower().split()
        if not parts:
            return np.zeros(0, np.uint64)
        known, digest = self.known, xxhash.xxh64_intdigest
        for w in set(parts).difference(known):
            known[w] = digest(w, SEED)
        hashed = np.fromiter((known[w] for w in parts), np.uint64, len(parts))
        if len(known) > _KNOWN:
            known.clear()
        size = min(self.words, len(parts))
        last = len(parts) - size + 1
        made = np.full(last, size, np.uint64)
        for j in range(size):
            made = (made ^ (made >> np.uint64(29))) * _FACTOR + hashed[j : j + last]
        return np.unique((made ^ (made >> np.uint64(32))) * _FACTOR)


def need(s: int, t: int, least: tuple[int, int] = LEAST) -> int:
    """Shingles that sets of ``s`` and ``t`` must share."""
    num, den = least
    return -(-num * (s + t) // (num + den))


def partners(s: int, least: tuple[int, int] = LEAST) -> range:
    """Sizes a set of ``s`` can link with."""
    num, den = least
    return range(-(-num * s // den), den * s // num + 1)


def prefix(s: int, least: tuple[int, int] = LEAST) -> int:
    """Shingles of a set of ``s`` of which any link shares one."""
    return s - (-(-least[0] * s // least[1])) + 1 if s else 0


def subsets_listed(s: int, below: int, least: tuple[int, int] = LEAST) -> int:
    """Subsets a light set of ``s`` lists when sets ``below`` that size are light."""
    return sum(comb(s, need(s, t, least)) for t in partners(s, least) if t < below)


# --- classes


@dataclass
class Classes:
    """Documents by set. Whole sets are made where they are needed, from the texts of ``docs``."""

    rows: DataFrame  # row, key, hash, print, size
    nodes: DataFrame  # node, print, size, least (key), key and hash of the text it is read from
    prefixes: DataFrame  # node, size, tokens: the rarest shingles in order, of a set that may be light all
    docs: DataFrame
    key: str
    text: str
    words: int
    repeated: bool  # some rows have both key and text in common

    def places(self, node: str, number: str, hashed: str) -> DataFrame:
        """Columns ``node``, and key and hash of the text it is read from."""
        return self.nodes.select(F.col("node").alias(node), F.col("from.key").alias(number), F.col("from.hash").alias(hashed))

    def texts(self, wanted: DataFrame) -> DataFrame:
        """``key, hash, text`` of the wanted nodes, a text each, and of few others, which are not moved."""
        spots = self.places("node", "key", "spot").join(wanted.select("node"), "node", "left_semi").select("spot")
        own = F.col(f"`{self.key}`").alias("key"), F.col(f"`{self.text}`").alias("text")
        docs = self.docs.select(*own).withColumn("hash", F.xxhash64("text"))
        found = by_marks(docs, F.col("hash"), stored(marks(spots), "marks"))
        found = found.select("key", "hash", F.col("text").cast("binary").alias("text"))
        return found.dropDuplicates(["key", "hash"]) if self.repeated else found


def classes(docs: DataFrame, key: str, text: str, words: int, least: tuple[int, int]) -> Classes:
    kind = docs.schema[key].dataType.simpleString()
    whole = F.col(f"`{text}`")
    counts = sketch(docs.select(whole.cast("binary")), words).tobytes()
    given = docs.select(F.monotonically_increasing_id(), F.col(f"`{key}`"), F.xxhash64(whole), whole.cast("binary"))

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        sets, n = Shingler(words), np.frombuffer(counts, np.uint32)
        for row, number, hashed, whole in rows:
            held = sets(whole)
            size = len(held)
            # Hashes are sorted, so a stable sort by count is the order by count, then hash.
            order = np.argsort(n[(held >> _SHIFT).astype(np.int64)], kind="stable")
            first = held[order[: size if size < LIGHTER else prefix(size, least)]]
            yield row, number, hashed, xxhash.xxh128_digest(held.tobytes(), SEED), size, first.tobytes(), bitmap(held)

    schema = f"row bigint, key {kind}, hash bigint, print binary, size bigint, tokens binary, bits array<bigint>"
    made = stored(map_rows(given, work, schema, given=512), "prefixes")
    nodes = made.where("size > 0").groupBy("print", "size")
    nodes = nodes.agg(F.min(F.struct("row", "key", "hash", "bits")).alias("from"), F.min("key").alias("least"))
    nodes = stored(nodes.withColumn("node", F.col("from.row")), "classes")
    prefixes = made.where("size > 0").select(F.col("row").alias("node"), "size", "tokens")
    prefixes = prefixes.join(nodes.select("node"), "node", "left_semi")
    repeated = not made.where("size > 0").groupBy("key", "hash").count().where("count > 1").isEmpty()
    return Classes(made.select("row", "key", "hash", "print", "size"), nodes, prefixes, docs, key, text, words, repeated)


def bitmap(held: np.ndarray) -> list[int]:
    """Per slot whether an odd number of a set's hashes fall into it.

    Two such bitmaps differ in no more places than their sets differ in hashes.
    """
    odd = np.bincount(((held >> np.uint64(20)) & np.uint64(64 * LANES - 1)).astype(np.int64), minlength=64 * LANES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def sketch(texts: DataFrame, words: int) -> np.ndarray:
    """How often shingles of each slot occur in sets, at most ``2**32 - 1``; of one size for any corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sets, n = Shingler(words), np.zeros(SLOTS, np.int64)
        for batch in batches:
            for whole in batch.column(0):
                slots = (sets(whole.as_py()) >> _SHIFT).astype(np.int64)
                np.add.at(n, slots, 1)
        some = np.flatnonzero(n)
        for start in range(0, len(some), 1 << 16):
            part = some[start : start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(n[part])], ["slot", "n"])

    small_batches(texts)
    counted = texts.mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    out = np.zeros(SLOTS, np.uint32)
    for slot, n in counted.collect():
        out[slot] = min(n, 0xFFFFFFFF)
    return out


# --- light sets


def light_keys(prefixes: DataFrame, below: int, least: tuple[int, int]) -> DataFrame:
    """Rows ``subset, node, smaller``; sharing a subset is a link if one of the two is ``smaller``."""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for node, size, held in rows:
            parts = sorted(held[i : i + 8] for i in range(0, 8 * size, 8))
            for t in partners(size, least):
                if t < below:
                    sizes = b"%d,%d," % (min(size, t), max(size, t))
                    for chosen in combinations(parts, need(size, t, least)):
                        yield xxhash.xxh128_digest(sizes + b"".join(chosen), SEED), node, size <= t

    return map_rows(prefixes.where(F.col("size") < below), work, "subset binary, node bigint, smaller boolean")


def light_stars(keys: DataFrame) -> DataFrame:
    """Links ``a, b`` that join all holders of each subset, one per holder."""
    centre = keys.groupBy("subset").agg(F.min(F.when(F.col("smaller"), F.col("node"))).alias("b"), F.count("*").alias("n"))
    centre = centre.where("b is not null and n > 1").select("subset", "b")
    return keys.join(centre, "subset").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def light_links(keys: DataFrame) -> DataFrame:
    """Every link ``a, b`` between light sets."""
    a = keys.where("smaller").select("subset", F.col("node").alias("a"))
    b = keys.select("subset", F.col("node").alias("b"), F.col("smaller").alias("also"))
    both = a.join(b, "subset").where("a <> b and (not also or a < b)")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


# --- heavy sets


def postings(prefixes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Rows ``token, node, size, at``: the prefix of every set with its places in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            rows = 0
            for node, size, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                first = np.frombuffer(held.as_buffer(), np.int64)[: prefix(size, least)]
                out.append((first, node, size, len(first)))
                rows += len(first)
                if rows >= 1 << 16:
                    yield _entries(out)
                    out, rows = [], 0
            if out:
                yield _entries(out)

    return prefixes.select("node", "size", "tokens").mapInArrow(run, "token bigint, node bigint, size bigint, at bigint")


def _entries(out: list[tuple]) -> pa.RecordBatch:
    tokens, nodes, sizes, lengths = zip(*out, strict=True)
    columns = [
        np.concatenate(tokens),
        np.repeat(np.array(nodes, np.int64), lengths),
        np.repeat(np.array(sizes, np.int64), lengths),
        np.concatenate([np.arange(n, dtype=np.int64) for n in lengths]),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "node", "size", "at"])


def boundary(shared: DataFrame, nodes: DataFrame, least: tuple[int, int]) -> int:
    """The size from which sets are heavy: the cheapest by subsets listed plus list entries scanned."""
    small = F.col("size") < LIGHTER
    sets = dict(nodes.where(small).groupBy("size").count().collect())
    scans = dict(shared.where(small).groupBy("size").agg(F.sum("n")).collect())

    def cost(x: int) -> int:
        listed = sum(n * subsets_listed(s, x, least) for s, n in sets.items() if s < x)
        return listed + sum(n * prefix(s, least) + scans.get(s, 0) for s, n in sets.items() if s >= x)

    return min(range(LIGHTEST, LIGHTER + 1), key=lambda x: (cost(x), x))


def verified(pairs: DataFrame, c: Classes, least: tuple[int, int]) -> DataFrame:
    """Those of the stored pairs ``a, b`` that are links.

    Texts travel, as they take less than half of what their sets would. Pairs of one ``b`` come one
    after the other, so its set is made once.
    """
    (num, den), words = least, c.words
    texts = c.texts(pairs.select(F.explode(F.array("a", "b")).alias("node")))
    # Pairs get the places of their texts, so that each text is moved once from where it is read.
    placed = pairs.join(c.places("a", "__ka", "__ha"), "a").join(c.places("b", "__kb", "__hb"), "b")

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        sets, held, y = Shingler(words), None, None
        for a, one, b, other in rows:
            if b != held:
                held, y = b, sets(other)
            x = sets(one)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if den * both >= num * (len(x) + len(y) - both):
                yield a, b

    one, other = texts.withColumnRenamed("text", "one"), texts.withColumnRenamed("text", "other")
    first = placed.join(one, (F.col("__ha") == one["hash"]) & F.col("__ka").eqNullSafe(one["key"])).drop("key", "hash")
    rows = first.join(other, (F.col("__hb") == other["hash"]) & F.col("__kb").eqNullSafe(other["key"]))
    return map_rows(rows.select("a", "one", "b", "other"), work, "a bigint, b bigint", taken=64)


def _fits(least: tuple[int, int], s: str, i: str, t: str, j: str) -> Column:
    """Whether sets of sizes s, t whose first common shingle is at i, j can link."""
    num, den = least
    room = F.least(F.col(s) - F.col(i), F.col(t) - F.col(j))
    sized = F.greatest(s, t) * num <= F.least(s, t) * den
    return sized & (room * (num + den) >= (F.col(s) + F.col(t)) * num)


def met(short: DataFrame, heavy: int, least: tuple[int, int]) -> DataFrame:
    """Pairs ``a, b`` of the sets of each short list that may be links; a list is a bounded array."""
    num, den = least
    lists = short.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("size", "node", "at"))).alias("m"))

    def fits(x: Column, y: Column) -> Column:
        room = F.least(x["size"] - x["at"], y["size"] - y["at"])
        total = x["size"] + y["size"]
        return (y["size"] >= heavy) & (y["size"] * num <= x["size"] * den) & (room * (num + den) >= total * num)

    def pairs(x: Column, i: Column) -> Column:
        after = F.filter(F.slice("m", i + 2, F.size("m")), lambda y: fits(x, y))
        return F.transform(after, lambda y: F.struct(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")))

    return lists.select(F.inline(F.flatten(F.transform("m", pairs)))).distinct()


def drawn(long: DataFrame, heavy: int, least: tuple[int, int]) -> DataFrame:
    """Pairs ``a, b`` of each list's sets with one of the list, within bands of sizes."""
    lead = long.groupBy("token", "band").agg(
        F.min(F.struct(F.xxhash64("node", "token"), F.col("node").alias("b"), F.col("size").alias("t"), F.col("at").alias("j"))).alias("x")
    )
    pairs = long.join(lead.select("token", "band", "x.b", "x.t", "x.j"), ["token", "band"])
    pairs = pairs.where(f"node <> b and greatest(size, t) >= {heavy}").where(_fits(least, "size", "at", "t", "j"))
    return pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()


def _near_bits(least: tuple[int, int], s: str, t: str) -> Column:
    """Whether bitmaps ``x0 …`` and ``y0 …`` allow a link of sets of sizes s, t."""
    num, den = least
    apart = sum((F.bit_count(F.col(f"x{i}").bitwiseXOR(F.col(f"y{i}"))) for i in range(LANES)), F.lit(0))
    total = F.col(s) + F.col(t)
    return (total - apart) * (num + den) >= total * (2 * num)


def _bits(c: Classes, node: str, size: str, lane: str) -> DataFrame:
    lanes = [F.get("from.bits", F.lit(i)).alias(f"{lane}{i}") for i in range(LANES)]
    return c.nodes.select(F.col("node").alias(node), F.col("size").alias(size), *lanes)


def allowed(pairs: DataFrame, c: Classes, least: tuple[int, int]) -> DataFrame:
    """Those of the pairs ``a, b`` that their bitmaps allow to be links."""
    seen = pairs.join(_bits(c, "a", "s", "x"), "a").join(_bits(c, "b", "t", "y"), "b")
    return seen.where(_near_bits(least, "s", "t")).select("a", "b")


def scanned(long: DataFrame, c: Classes, heavy: int, least: tuple[int, int]) -> DataFrame:
    """Pairs ``a, b`` of sets of different groups (``label``) that meet in a list and may be links.

    Bitmaps are part of the join, so that pairs that cannot be links are not made.
    """
    num, den = least
    each = long.groupBy("token", "label").agg(F.count("*").alias("n"))
    lists = each.groupBy("token").agg(F.max_by("label", F.struct("n", "label")).alias("major"), F.count("*").alias("labels"))
    rows = long.join(lists.where("labels > 1").select("token", "major"), "token")
    rows = rows.join(_bits(c, "node", "_size", "x").drop("_size"), "node")
    lanes = [f"x{i}" for i in range(LANES)]
    # The smaller set of a link has the shingle among its rarest (den - num) / (den + num).
    core = (F.col("size") - F.col("at")) * (num + den) >= 2 * num * F.col("size")
    small = rows.where(core).select(
        "token", F.explode(F.array("band", F.col("band") + 1)).alias("band"), F.col("node").alias("a"), F.col("size").alias("s"),
        F.col("at").alias("i"), F.col("label").alias("l"), (F.col("label") == F.col("major")).alias("m"), *lanes,
    )
    large = rows.select(
        "token", "band", F.col("node").alias("b"), F.col("size").alias("t"), F.col("at").alias("j"), F.col("label").alias("k"),
        (F.col("label") == F.col("major")).alias("o"), *[F.col(x).alias(x.replace("x", "y")) for x in lanes],
    )
    fit = _fits(least, "s", "i", "t", "j") & F.expr(f"l <> k and (s < t or (s = t and a < b)) and t >= {heavy}")
    fit = fit & _near_bits(least, "s", "t")
    found = [
        x.join(y, ["token", "band"]).where(fit).select("a", "b")
        for x, y in ((small.where("not m"), large), (small.where("m"), large.where("not o")))
    ]
    both = found[0].unionAll(found[1])
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def inverted(c: Classes, least: tuple[int, int]) -> DataFrame:
    """Lists of two and more sets: ``token, node, size, at, n, band``."""
    entries = postings(c.prefixes, least)
    lists = entries.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    num, den = least
    band = F.floor(F.log(F.col("size").cast("double")) / float(np.log(den / num)) + 1e-9)
    return stored(entries.join(lists, "token").withColumn("band", band), "lists")


# --- the join


def links(c: Classes, least: tuple[int, int] = LEAST) -> DataFrame:
    """Every link ``a, b`` between classes (``a < b``)."""
    shared = inverted(c, least)
    heavy = boundary(shared, c.nodes, least)
    short, long = shared.where(F.col("n") <= SHORT), shared.where(F.col("n") > SHORT)
    near = allowed(met(short, heavy, least), c, least).unionAll(scanned(long.withColumn("label", F.col("node")), c, heavy, least))
    pairs = stored(near.distinct(), "pairs")
    keys = light_keys(c.prefixes, heavy, least)
    return light_links(keys).unionAll(verified(pairs, c, least))


def labels(c: Classes, least: tuple[int, int] = LEAST) -> DataFrame:
    """Groups of classes connected by links: ``node, label`` for every class that has a link."""
    shared = inverted(c, least)
    heavy = boundary(shared, c.nodes, least)
    short, long = shared.where(F.col("n") <= SHORT), shared.where(F.col("n") > SHORT)
    near = met(short, heavy, least).unionAll(drawn(long, heavy, least)).distinct()
    first = stored(allowed(near, c, least), "drawn")
    stars = light_stars(light_keys(c.prefixes, heavy, least))
    known = stored(stars.unionAll(verified(first, c, least)), "links")
    groups = stored(components(known), "groups")
    marked = long.join(groups, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rest = stored(scanned(marked, c, heavy, least).join(first, ["a", "b"], "left_anti"), "pairs")
    more = stored(verified(rest, c, least), "links")
    if more.isEmpty():
        return groups
    return components(known.unionAll(more))


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, least: tuple[int, int] = LEAST
) -> DataFrame:
    """Per document ``key, n_shingles, component_id``: the smallest key that links lead to, its own included."""
    c = classes(docs, key, text, words, least)
    named = c.nodes.join(labels(c, least), "node", "left").withColumn("label", F.coalesce("label", "node"))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(names, "label").select("print", "component_id")
    some = c.rows.where("size > 0").join(named, "print").select("key", "size", "component_id")
    out = some.unionAll(c.rows.where("size = 0").select("key", "size", F.col("key").alias("component_id")))
    return out.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), "component_id")


def members(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, least: tuple[int, int] = LEAST
) -> tuple[DataFrame, DataFrame]:
    """The whole join: ``key, node`` per document (NULL for an empty set), and all links ``a, b`` of nodes."""
    c = classes(docs, key, text, words, least)
    own = c.rows.where("size > 0").join(c.nodes.select("print", "node"), "print").select(F.col("key").alias(key), "node")
    none = c.rows.where("size = 0").select(F.col("key").alias(key), F.lit(None).cast("bigint").alias("node"))
    return own.unionAll(none), links(c, least)


def joined_by(placed: DataFrame, also: DataFrame) -> DataFrame:
    """``label, key, hash`` with the labels connected that a group of ``also`` (``key, hash, group``) has in common."""
    placed = stored(placed, "placed")
    other = also.select(F.col("key").alias("__key"), F.col("hash").alias("__hash"), "group")
    own = placed.join(other, (placed["hash"] == other["__hash"]) & placed["key"].eqNullSafe(other["__key"]))
    own = stored(own.select("label", "group").distinct(), "shared")
    first = own.groupBy("group").agg(F.min("label").alias("b"))
    found = components(own.join(first, "group").select(F.col("label").alias("a"), "b")).withColumnRenamed("label", "root")
    named = placed.join(found, placed["label"] == found["node"], "left")
    return named.select(F.coalesce("root", "label").alias("label"), "key", "hash")


def drop_similar(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, least: tuple[int, int] = LEAST,
    also: DataFrame | None = None,
) -> DataFrame:
    """Keep one document of each group that links connect: the one of the smallest key (NULL last).

    Texts without words are one group here. All columns stay; of repeated rows one does. ``also`` are
    further groups of the documents (``key, hash, group``, hash: ``xxhash64`` of the text), which
    connect like links.
    """
    c = classes(docs, key, text, words, least)
    named = c.nodes.join(labels(c, least), "node", "left").select("print", F.coalesce("label", "node").alias("label"))
    placed = c.rows.where("size > 0").join(named, "print").select("label", "key", "hash")
    placed = placed.unionAll(c.rows.where("size = 0").select(F.lit(-1).cast("bigint").alias("label"), "key", "hash"))
    if also is not None:
        placed = joined_by(placed, also)
    times = stored(placed.groupBy("label", "key", "hash").agg(F.count("*").alias("times")), "times")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "hash", "times")).alias("x")
    stay = stored(times.groupBy("label").agg(first).select("x.key", "x.hash", "x.times"), "stay")
    stay = stay.select(F.col("key").alias("__key"), F.col("hash").alias("__stays"), F.col("times").alias("__times"))
    goes = times.join(stay, (times["hash"] == stay["__stays"]) & times["key"].eqNullSafe(stay["__key"]), "left_anti")
    unsure = goes.select("key", "hash").unionAll(stay.where("__times > 1").select("__key", "__stays"))
    held = stored(marks(unsure.select(F.xxhash64("key", "hash").alias("spot"))), "marks")
    seen = docs.withColumn("__hash", F.xxhash64(F.col(f"`{text}`")))
    spot, columns = F.xxhash64(F.col(f"`{key}`"), "__hash"), [F.col(f"`{x}`") for x in docs.columns]
    # A row that is surely alone or the first of its group stays where it is; only the others' texts are moved.
    sure = by_marks(seen, spot, held, there=False).select(*columns)
    rest = by_marks(seen, spot, held)
    kept = rest.join(stay, (rest["__hash"] == stay["__stays"]) & rest[key].eqNullSafe(stay["__key"]))
    once = kept.where("__times = 1").select(*columns)
    return sure.unionAll(once).unionAll(kept.where("__times > 1").dropDuplicates(["__key", "__stays"]).select(*columns))
