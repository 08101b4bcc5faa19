"""Row numbers without a single-task window."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_BUCKET = "_bucket"
_COUNTED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Keys drawn per slice where the cut points come from a sample.
DRAWN = 32


def next_identity(rows: DataFrame, column: str) -> DataFrame:
    """One row with the next value of an identity column: largest plus one, or 1."""
    top = F.coalesce(F.max(column), F.lit(0))
    return rows.agg(F.when(top > 0, top + 1).otherwise(1).cast("bigint").alias("next_value"))


def _boundaries(rows: DataFrame, order: str, slices: int) -> list:
    """At most ``slices`` ascending cut points of the order column, about evenly spaced."""
    shares = [i / slices for i in range(1, slices)]
    if not shares:
        return []
    if isinstance(rows.schema[order].dataType, _COUNTED):
        found = rows.agg(F.percentile_approx(order, shares).alias("cuts")).first()["cuts"]
        return sorted(set(found or []))
    # The keys of the least hashes: an even sample of bounded size, the same every time.
    drawn = rows.where(F.col(order).isNotNull()).orderBy(F.xxhash64(order)).limit(DRAWN * slices)
    found = drawn.agg(F.array_sort(F.collect_set(order)).alias("keys")).first()["keys"]
    return found[len(found) // slices :: max(1, len(found) // slices)][: slices - 1]


def row_positions(
    rows: DataFrame, order: str, name: str = "position", slices: int | None = None
) -> DataFrame:
    """Number rows 1..n in the order of a unique column.

    The column's approximate quantiles, for texts and bytes those of a sample of bounded size, cut the rows into slices; each slice is numbered on its
    own and shifted by the size of the slices before it. The numbers are exact wherever the cuts
    fall, so recomputed tasks agree. Two passes read the order column alone and one shuffle
    moves the rows; the driver sees one count per slice.
    """
    kind = rows.schema[order].dataType
    if not isinstance(kind, (*_COUNTED, T.StringType, T.BinaryType)):
        raise TypeError(f"row order needs a number, time, text or bytes, {order} is {kind.simpleString()}")
    spark = rows.sparkSession
    # Several slices per shuffle partition even out what hashing slice numbers leaves uneven.
    slices = slices or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _boundaries(rows.select(order), order, slices)
    bucketed = rows.withColumn(_BUCKET, _slice_of(F.col(order), cuts, kind))
    sizes = dict(bucketed.groupBy(_BUCKET).count().collect())  # one row per slice
    before, running = {}, 0
    for bucket in sorted(sizes):
        before[bucket] = running
        running += sizes[bucket]
    local = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(order))
    if not before:
        return rows.withColumn(name, F.lit(None).cast("bigint"))
    starts = [before.get(b, 0) for b in range(max(before) + 1)]
    offset = F.get(F.lit(starts).cast("array<bigint>"), F.col(_BUCKET))
    return bucketed.withColumn(name, (local + offset).cast("bigint")).drop(_BUCKET)


def _slice_of(x: Column, cuts: list, kind: T.DataType) -> Column:
    """Number of cut points below the value, found in two steps of about sqrt(n) comparisons."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    points = [F.array(*[F.lit(c).cast(kind) for c in group]) for group in groups]
    lasts = F.array(*[F.lit(group[-1]).cast(kind) for group in groups])
    coarse = F.size(F.filter(lasts, lambda c: c < x))
    fine = F.size(F.filter(F.get(F.array(*points), coarse), lambda c: c < x))
    return F.when(coarse < len(groups), coarse * width + fine).otherwise(len(cuts)).cast("int")


def assign_identity(
    rows: DataFrame, column: str, order: str, first: int = 1, slices: int | None = None
) -> DataFrame:
    """Fill NULL identities with ``first, first+1, …`` in row order; given ones stay."""
    given = rows.where(F.col(column).isNotNull())
    open_rows = rows.where(F.col(column).isNull())
    numbered = row_positions(open_rows, order, "_position", slices)
    kind = rows.schema[column].dataType
    filled = numbered.withColumn(column, (F.col("_position") + F.lit(first - 1)).cast(kind))
    return given.unionByName(filled.drop("_position"))
