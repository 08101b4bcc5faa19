"""Limits and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.identity import row_positions
from quayside.operators.keys import top_per_key

# A page that ends within this many rows is kept whole in one task's heap.
SHALLOW = 100_000


def limit(rows: DataFrame, n: int) -> DataFrame:
    """``LIMIT n``; a negative n means no limit."""
    return rows if n < 0 else rows.limit(n)


def offset_page(
    rows: DataFrame, key: str, offset: int, size: int, shallow: int = SHALLOW
) -> DataFrame:
    """Rows ``offset+1 … offset+size`` in key order (a unique column).

    A shallow page is a top-k. A deep one takes row positions instead of passing everything
    before it through one task; only the page itself is sorted. Both give the same rows in order.
    """
    if 0 <= size and offset + size <= shallow:
        return rows.orderBy(key).offset(offset).limit(size)
    placed = row_positions(rows, key, "_position")
    page = placed.where(F.col("_position") > offset)
    if size >= 0:
        page = page.where(F.col("_position") <= offset + size)
    return page.orderBy("_position").drop("_position")


def keyset_page(rows: DataFrame, key: str, after: object, size: int) -> DataFrame:
    """The next ``size`` rows after a key; the bound reaches the scan as a filter."""
    later = rows if after is None else rows.where(F.col(key) > F.lit(after))
    return later.orderBy(key).limit(size)


def key_bounds(rows: DataFrame, key: str) -> DataFrame:
    """One row with the first and the last key."""
    return rows.agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def top_n_per_key(
    rows: DataFrame, key: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows per key with their position ``rn`` (a feed query)."""
    return top_per_key(rows, key, order, n)


def with_total(rows: DataFrame, name: str = "n") -> DataFrame:
    """``count(*) over ()``: the row count on every row, as a scalar and not as a window."""
    return rows.withColumn(name, rows.agg(F.count("*")).scalar())
