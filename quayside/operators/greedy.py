"""Which rows stay when rows are taken in order and each must conflict with none taken before it.

Rows conflict when they share a claim (the value of a unique key). Whether a row stays is a function of
earlier rows, which says "one after the other"; three observations make it parallel. Call a claim of
a row *open* as long as a row before it that holds the same claim is undecided.

1. A row without an open claim is first everywhere, hence stays, and all others with a claim of it go.
2. A row with a single open claim settles that claim: afterwards it is taken, by the row or by
   one before it. All rows that come later under that claim go.
3. When the only row before it under its open claim is the claim's first, a row stays exactly if that
   one goes. Such rows form trees. Along a path to the root verdicts alternate, and paths are
   contracted: within slices of the order by one pass each, across them by pointer doubling.

A round applies all three to the undecided rows and drops what they decide, so a chain of a million
conflicts takes one round, whose number of jobs grows with the logarithm of the number of slices. What
goes on into further rounds are rows with two and more open claims, whose verdict joins several paths.

Only numbers move in a round: each row's place in the order and, per key, the place of the first row
with its value. A hot value is met by counting first, never by gathering its rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.keys import complete, same_key
from quayside.session import stored

_N = "_n"


def numbered(rows: DataFrame, sequence: str) -> DataFrame:
    """Rows with their place in the order as whole numbers ``_n`` with gaps, stored once."""
    if isinstance(rows.schema[sequence].dataType, T.IntegralType):
        return stored(rows.withColumn(_N, F.col(sequence).cast("bigint")), "numbered")
    placed = rows.repartitionByRange(sequence).sortWithinPartitions(sequence)
    return stored(placed.withColumn(_N, F.monotonically_increasing_id()), "numbered")


def claims(rows: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """``_n`` and per key the first ``_n`` with the same value; a key with a NULL is a claim of its own."""
    out = rows.select(_N, *dict.fromkeys(c for k in keys for c in k))
    for i, key in enumerate(keys):
        first = out.where(complete(key)).groupBy(*key).agg(F.min(_N).alias(f"_c{i}"), F.count("*").alias("_size"))
        shared = first.where("_size > 1").drop("_size").alias("f")
        joined = out.alias("o").join(shared, same_key("o", "f", key), "left")
        out = joined.select("o.*", F.coalesce(f"f._c{i}", f"o.{_N}").alias(f"_c{i}"))
    return out.select(_N, *[f"_c{i}" for i in range(len(keys))])


def _per_claim(rows: DataFrame, m: int, aggregates) -> DataFrame:
    """Rows with aggregates over those that share each claim, named ``<name><key>``."""
    for i in range(m):
        made = [a.alias(f"{name}{i}") for name, a in aggregates(i).items()]
        each = rows.groupBy(f"_c{i}").agg(*made).withColumnRenamed(f"_c{i}", "_key")
        rows = rows.join(each, F.col(f"_c{i}") == F.col("_key")).drop("_key")
    return rows


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def accepted(rows: DataFrame, keys: Sequence[Sequence[str]], sequence: str) -> DataFrame:
    """The rows that stay, in the order of a unique column."""
    placed = numbered(rows, sequence)
    live, m = stored(claims(placed, keys), "claims"), len(keys)
    names = live.columns
    # A claim is named after its first row, which in the first round is live.
    firsts = live.select("*", *[F.col(f"_c{i}").alias(f"_f{i}") for i in range(m)])
    stay = None
    while True:
        later = [F.col(_N) != F.col(f"_f{i}") for i in range(m)]
        judged = firsts.withColumn("_open", sum((x.cast("int") for x in later), F.lit(0)))
        single = F.col("_open") == 1
        judged = _per_claim(
            judged,
            m,
            lambda i: {
                "_second": F.min(F.when(later[i], F.col(_N))),
                "_settler": F.min(F.when(later[i] & single, F.col(_N))),
                "_taken": F.max(F.col("_open") == 0),
            },
        )
        gone = _any([later[i] & (F.col(f"_taken{i}") | F.coalesce(F.col(_N) > F.col(f"_settler{i}"), F.lit(False))) for i in range(m)])
        # The one open claim of a row that follows the claim's first directly.
        follows = [later[i] & single & (F.col(_N) == F.col(f"_second{i}")) for i in range(m)]
        before = F.coalesce(*[F.when(f, F.col(f"_f{i}")) for i, f in enumerate(follows)])
        state = F.when(F.col("_open") == 0, "stays").when(gone, "goes").when(before.isNotNull(), "follows").otherwise("open")
        told = stored(judged.select(*names, state.alias("_state"), before.alias("_before")), "told")
        counts = dict(told.groupBy("_state").count().collect())
        won = told.where("_state = 'stays'").select(_N)
        stay = won if stay is None else stay.unionAll(won)
        left = told.where("_state in ('open', 'follows')")
        if counts.get("follows"):
            paths = contracted(told.where("_state = 'follows'").select(_N, "_before"))
            roots = told.where("_state in ('stays', 'goes')").select(F.col(_N).alias("_root"), (F.col("_state") == "stays").alias("_known"))
            ends = paths.join(roots, "_root", "left").select(F.col(_N).alias("_m"), "_odd", "_known")
            left = left.join(ends, F.col(_N) == F.col("_m"), "left").drop("_m")
            verdict = F.when(F.col("_known") != F.col("_odd"), "stays").when(F.col("_known") == F.col("_odd"), "goes")
            left = left.withColumn("_state", F.coalesce(verdict, "_state")).drop("_odd", "_known", "_before")
            if counts.get("open"):  # what newly stays makes others go; what stayed before has done so already
                left = _per_claim(left, m, lambda i: {"_won": F.max(F.col("_state") == "stays")})
                undone = F.col("_state").isin("open", "follows") & _any([F.col(f"_won{i}") for i in range(m)])
                left = left.withColumn("_state", F.when(undone, "goes").otherwise(F.col("_state"))).select(*names, "_state")
            left = stored(left, "left")
            stay = stay.unionAll(left.where("_state = 'stays'").select(_N))
        live = left.where("_state in ('open', 'follows')").select(*names)
        if live.isEmpty():
            break
        firsts = _per_claim(live, m, lambda i: {"_f": F.min(_N)})
    kept = stay.withColumnRenamed(_N, "_kept")
    return placed.join(kept, F.col(_N) == F.col("_kept"), "left_semi").drop(_N)


def contracted(steps: DataFrame) -> DataFrame:
    """The end of the path from every ``_n`` by ``_before``: ``_n, _root, _odd`` (steps taken, odd or even).

    ``_before`` is smaller than ``_n``. Each slice of the order is followed to its edge in one pass; as
    a path enters no slice twice, doubling then takes as many rounds as the slices have binary digits.
    """

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[int, bool]] = {}
        for batch in batches:
            here, roots, odd = batch.column(0).to_pylist(), [], []
            for n, before in zip(here, batch.column(1).to_pylist(), strict=True):
                root, flipped = known.get(before, (before, False))
                known[n] = end = (root, not flipped)
                roots.append(end[0])
                odd.append(end[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(roots, pa.int64()), pa.array(odd)], ["_n", "_root", "_odd"]
            )

    sliced = steps.select(_N, "_before").repartitionByRange(_N).sortWithinPartitions(_N)
    paths = stored(sliced.mapInArrow(follow, "_n bigint, _root bigint, _odd boolean"), "paths")
    while True:
        ahead = paths.select(F.col(_N).alias("_at"), F.col("_root").alias("_next"), F.col("_odd").alias("_more"))
        moved = paths.join(ahead, F.col("_root") == F.col("_at"), "left")
        odd = F.col("_odd") != F.coalesce("_more", F.lit(False))
        moved = moved.select(_N, F.coalesce("_next", "_root").alias("_root"), odd.alias("_odd"), F.col("_at").isNotNull().alias("_moved"))
        moved = stored(moved, "paths")
        paths = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return paths
