"""Shards that each hold the same mixture of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARDS = 8
SLICES = 1024  # at least
SLICE_ROWS = 1 << 20  # rows a slice holds, on average, at most
SEED = 17


def _digits(parts: int, *columns: Column) -> Column:
    """A seeded number from 0 to ``parts`` - 1 that follows from the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")


def interleaved(rows: DataFrame, source: str, order: list[str], slices: int = SLICES, seed: int = SEED) -> DataFrame:
    """Add ``position``, 0 to n-1: the order of the rows' fractional ranks within their source.

    Rows of a source are shuffled by a seeded hash and ranked; rank over source size, shifted by a
    random start of the source, is the fractional rank. Each stretch of positions so holds every
    source in its share of all rows, to within a row.

    Ranks and positions are counted in slices, of the hash and of the fractional rank, and moved
    by the sizes of the slices before: a source with a third of all rows spreads over ``slices``
    tasks like the rest. Only the columns of ``rows`` travel, twice.
    """
    mixed = F.xxhash64(F.lit(seed), *order)
    base = rows.withColumn("__h", mixed).withColumn("__s", _digits(slices, F.lit(seed), F.col("__h")))
    own = Window.partitionBy("__source").orderBy("__s")
    sizes = base.groupBy(F.col(source).alias("__source"), "__s").agg(F.count("*").alias("__c"))
    # At most `slices` rows per source.
    starts = sizes.select(
        F.col("__source"),
        F.col("__s").alias("__slice"),
        (F.sum("__c").over(own) - F.col("__c")).alias("__before"),
        F.sum("__c").over(Window.partitionBy("__source")).alias("__n"),
    )
    within = Window.partitionBy(F.col(source), "__s").orderBy("__h", *order)
    ranked = base.withColumn("__r", F.row_number().over(within))
    on = ranked[source].eqNullSafe(starts["__source"]) & (ranked["__s"] == starts["__slice"])
    begin = _digits(1 << 20, F.lit(seed + 1), F.col(source)) / float(1 << 20)
    place = (F.col("__before") + F.col("__r") - 1 + begin) / F.col("__n")
    spread = ranked.join(starts, on).withColumn("__f", place)
    spread = spread.withColumn("__t", F.least(F.floor(F.col("__f") * slices), F.lit(slices - 1)).cast("int"))
    spread = spread.select(*rows.columns, "__h", "__f", "__t")
    # At most `slices` rows in all, one for a million documents.
    counts = spread.groupBy("__t").agg(F.count("*").alias("__c"))
    offsets = counts.select(
        F.col("__t").alias("__slice"), (F.sum("__c").over(Window.orderBy("__t")) - F.col("__c")).alias("__before")
    )
    at = Window.partitionBy("__t").orderBy("__f", source, "__h", *order)
    numbered = spread.withColumn("__r", F.row_number().over(at))
    moved = numbered.join(F.broadcast(offsets), F.col("__t") == F.col("__slice"))
    return moved.select(*rows.columns, (F.col("__before") + F.col("__r") - 1).alias("position"))


def shards(docs: DataFrame, count: int = SHARDS, key: str = "doc_id", text: str = "text", source: str = "source",
           slices: int = SLICES, seed: int = SEED) -> DataFrame:
    """Shard and slot of every document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The positions of :func:`interleaved` are cut into ``count`` runs whose lengths differ by at
    most one (law ``rows``). Slots run from 0 in each shard. A NULL source is a source; a NULL text
    has size 1 and checksum 0. Rows equal in id, size and checksum are interchangeable. With fewer
    rows than shards some shards are empty.
    """
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(whole) + 1).cast("bigint").alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.col(source).alias("source"),
    )
    total = docs.agg(F.count("*")).first()[0]
    slices = max(slices, -(-total // SLICE_ROWS))
    placed = interleaved(rows, "source", ["doc_id", "size", "text_crc32"], slices, seed)
    # Whole-number division: positions may pass what a double holds exactly.
    shard = F.expr(f"(position * {count}L) div {max(1, total)}L")
    first = F.expr(f"(shard * {max(1, total)}L + {count - 1}L) div {count}L")
    return placed.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("position") - first).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
