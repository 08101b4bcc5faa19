"""Helpers for operators that work by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Up to this rank Spark cuts groups before the shuffle (its group-limit threshold).
EARLY_CUT = 1000
SALTS = 64


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def complete(key: Sequence[str]) -> Column:
    """No key column is NULL. Only such rows can conflict under a unique key."""
    return all_of([F.col(k).isNotNull() for k in key])


def same_key(left: str, right: str, key: Sequence[str], null_safe: bool = False) -> Column:
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in key]
    return all_of([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def guard(rows: DataFrame, key: Sequence[str], what: str, nulls: bool = True) -> DataFrame:
    """Fail the query when the key repeats (or, with ``nulls``, is NULL) in ``rows``.

    The test is a scalar subquery over the key columns alone, so whole rows are not shuffled
    for it.
    """
    names = ", ".join(key)
    repeated = rows.groupBy(*key).count()
    if nulls:
        bad = (F.col("count") > 1) | ~complete(key)
    else:
        bad = (F.col("count") > 1) & complete(key)
    hits = repeated.where(bad).agg(F.count("*")).scalar()
    message = F.lit(f"{what}: key ({names}) is not unique" + (" or is NULL" if nulls else ""))
    return rows.where(F.when(hits > 0, F.raise_error(message)).otherwise(F.lit(True)))


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark keeps one row per key and map task before the shuffle, so a hot key costs nothing.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def top_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key with their position ``rn``.

    Beyond the size that Spark cuts before the shuffle, each key is first cut within salted
    slices: the first n of a key are among the first n of its slices.
    """
    if n > EARLY_CUT:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
        within = Window.partitionBy(*key, "_salt").orderBy(*order)
        cut = salted.withColumn("_rank", F.row_number().over(within)).where(F.col("_rank") <= n)
        rows = cut.drop("_rank", "_salt")
    window = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(window)).where(F.col("rn") <= n)
