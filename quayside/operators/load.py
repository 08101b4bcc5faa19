"""Keyed loads. Each takes the current target and the incoming rows and gives the new target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators import greedy
from quayside.operators.keys import complete, first_per_key, guard, same_key


class NoKey(ValueError):
    """The operation needs a primary or unique key and the table has none."""


class Referenced(ValueError):
    """The table cannot be emptied because another table references it."""


class Conflict(ValueError):
    """A plain insert met rows that are already there."""


def _default(defaults: Mapping[str, Column] | None, target: DataFrame, name: str) -> Column:
    kind = target.schema[name].dataType
    value = (defaults or {}).get(name)
    return (F.lit(None) if value is None else value).cast(kind)


def _completed(rows: DataFrame, target: DataFrame, defaults: Mapping[str, Column] | None) -> DataFrame:
    """Incoming rows with the target's columns, unlisted ones at their default."""
    return rows.select(
        *[
            F.col(c).cast(target.schema[c].dataType) if c in rows.columns
            else _default(defaults, target, c).alias(c)
            for c in target.columns
        ]
    )


def load_if_empty(source: DataFrame, target: DataFrame) -> DataFrame:
    """The source when the target has no rows, else the target as it is."""
    return _completed(source, target, None) if target.isEmpty() else target


def truncate_guard(table: str, children: Sequence[str]) -> None:
    """Refuse to empty a table that others reference; a cascade would empty them as well."""
    others = [c for c in children if c != table]
    if others:
        raise Referenced(
            f"cannot truncate {table}: referenced in a foreign key of {', '.join(others)}"
        )


def truncate_reload(
    source: DataFrame, target: DataFrame, table: str = "", children: Sequence[str] = ()
) -> DataFrame:
    """The source in place of the target's rows; never cascades."""
    truncate_guard(table, children)
    return _completed(source, target, None)


def upsert_mirror(
    source: DataFrame,
    target: DataFrame,
    pk: Sequence[str],
    identity: Sequence[str] = (),
    defaults: Mapping[str, Column] | None = None,
    table: str = "table",
    check_keys: bool = True,
    unique: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """Make the target mirror the source by primary key.

    New keys are inserted, common columns of known keys updated, keys the source lost removed.
    Columns only the target has, and identity columns outside the key, keep their value; on new
    rows they take their default (identity columns: the source's value). Because the source
    drives, a target that has nothing of its own to keep is not read at all. ``unique`` lists
    further keys; a result that repeats one fails.
    """
    if not pk:
        raise NoKey(f"{table}: no primary key, cannot upsert")
    common = [c for c in target.columns if c in source.columns]
    updated = [c for c in common if c not in pk and c not in identity]
    kept = [c for c in target.columns if c not in pk and c not in updated]
    rows = guard(source, pk, f"upsert into {table}") if check_keys else source
    if not kept:
        return _unique(_completed(rows, target, defaults), unique, table)
    old = target.select(*pk, *kept, F.lit(True).alias("_old")).alias("t")
    joined = rows.select(*common).alias("s").join(old, same_key("s", "t", pk), "left")
    columns = []
    for name in target.columns:
        if name in kept:
            fresh = F.col(f"s.{name}") if name in common else _default(defaults, target, name)
            value = F.when(F.col("t._old"), F.col(f"t.{name}")).otherwise(fresh)
        else:
            value = F.col(f"s.{name}")
        columns.append(value.cast(target.schema[name].dataType).alias(name))
    return _unique(joined.select(*columns), unique, table)


def upsert_changes(source: DataFrame, target: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One row of counts: ``inserted, updated, removed``. Only key columns are shuffled."""
    sides = source.select(*pk, F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(
        target.select(*pk, F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    per_key = sides.groupBy(*pk).agg(F.max("s").alias("s"), F.max("t").alias("t"))
    return per_key.agg(
        F.count_if(F.expr("s = 1 and t = 0")).alias("inserted"),
        F.count_if(F.expr("s = 1 and t = 1")).alias("updated"),
        F.count_if(F.expr("s = 0 and t = 1")).alias("removed"),
    )


def stale_rows(source: DataFrame, target: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Target rows whose key the source no longer has."""
    return target.alias("t").join(
        source.select(*pk).alias("s"), same_key("t", "s", pk), "left_anti"
    )


def insert_ignore(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[Sequence[str]],
    sequence: str,
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add source rows that conflict with nothing, in sequence order; skip the others.

    A row conflicts when it equals an existing or earlier accepted row on any key. A key with a
    NULL never conflicts. ``sequence`` is a unique column of the source giving the row order.
    """
    rows = accepted_rows(source, target, keys, sequence)
    return target.unionByName(_completed(rows, target, defaults))


def accepted_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[Sequence[str]], sequence: str
) -> DataFrame:
    """The source rows that :func:`insert_ignore` adds."""
    if not keys:
        return source
    if len(keys) == 1:
        (key,) = keys
        first = first_per_key(source.where(complete(key)), key, [F.col(sequence)])
        fresh = _without(first, target, key)
        free = source.where(~complete(key))
        return fresh.unionByName(free)
    live = source
    for key in keys:
        live = _without(live, target, key)
    return greedy.accepted(live, keys, sequence)


def _without(rows: DataFrame, taken: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``taken``."""
    held = taken.where(complete(key)).select(*key).alias("h")
    return rows.alias("r").join(held, same_key("r", "h", key), "left_anti")


def insert_replace(
    source: DataFrame,
    target: DataFrame,
    sequence: str,
    pk: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    listed: Sequence[str] | None = None,
    defaults: Mapping[str, Column] | None = None,
    table: str = "table",
    applied: str | None = None,
) -> DataFrame:
    """Insert rows, replacing the listed columns where the key exists; the last row wins.

    The key is the primary key, else the first unique key. Columns that are not listed keep the
    old row's value (new rows: the default). A NULL in a unique key never conflicts. A result that
    repeats one of the other unique keys fails, as the replaced row is found by one key only.

    ``applied`` names a target column that holds the sequence a row was last replaced at: older
    rows then replace nothing, and the column is kept up to date.
    """
    key = list(pk) or list(next(iter(unique), ()))
    if not key:
        raise NoKey(f"cannot replace into {table}: no primary key or unique index found")
    names = [c for c in (listed or target.columns) if c in source.columns]
    updates = [c for c in names if c not in key]
    wanted = source.select(*dict.fromkeys([*names, *key, sequence]))
    if pk:
        wanted = wanted.where(
            F.when(complete(key), F.lit(True)).otherwise(
                F.raise_error(F.lit(f"NOT NULL constraint failed: {table}.{key[0]}"))
            )
        )
        keyed, old = wanted, target
    else:
        keyed, old = wanted.where(complete(key)), target.where(complete(key))
    last = first_per_key(keyed, key, [F.col(sequence).desc()])
    left = old.withColumn("_old", F.lit(True)).alias("t")
    right = last.withColumn("_new", F.lit(True)).alias("s")
    both = left.join(right, same_key("t", "s", key), "full")
    wins = F.col("s._new")
    if applied is not None:
        wins = wins & F.coalesce(F.col(f"t.{applied}") <= F.col(f"s.{sequence}"), F.lit(True))
    columns = []
    for name in target.columns:
        kind = target.schema[name].dataType
        if name == applied:
            value = F.greatest(F.col(f"t.{name}"), F.col(f"s.{sequence}").cast(kind))
        elif name in key:
            value = F.coalesce(F.col(f"t.{name}"), F.col(f"s.{name}").cast(kind))
        elif name in updates:
            value = F.when(wins, F.col(f"s.{name}").cast(kind)).otherwise(F.col(f"t.{name}"))
        else:
            value = F.when(F.col("t._old"), F.col(f"t.{name}")).otherwise(
                _default(defaults, target, name)
            )
        columns.append(value.alias(name))
    result = both.select(*columns)
    if not pk:
        loose = wanted.where(~complete(key)).select(*names)
        result = result.unionByName(target.where(~complete(key))).unionByName(
            _completed(loose, target, defaults)
        )
    return _unique(result, [u for u in unique if list(u) != key], table)


def _unique(rows: DataFrame, keys: Sequence[Sequence[str]], table: str) -> DataFrame:
    """Fail the query when one of the keys repeats."""
    for key in keys:
        names = ", ".join(f"{table}.{c}" for c in key)
        rows = guard(rows, key, f"UNIQUE constraint failed: {names}", nulls=False)
    return rows


def conflicts(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys on which a plain insert would fail, with the number of rows claiming each."""
    claims = source.where(complete(key)).select(*key, F.lit(1).alias("_s")).unionAll(
        target.where(complete(key)).select(*key, F.lit(0).alias("_s"))
    )
    per_key = claims.groupBy(*key).agg(F.count("*").alias("n"), F.max("_s").alias("_s"))
    return per_key.where("n > 1 and _s = 1").drop("_s")


def insert_abort(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[Sequence[str]],
    defaults: Mapping[str, Column] | None = None,
    table: str = "table",
) -> DataFrame:
    """A plain insert (also OR ABORT, OR FAIL, OR ROLLBACK): any conflict is an error."""
    for key in keys:
        if not conflicts(source, target, key).isEmpty():
            names = ", ".join(f"{table}.{c}" for c in key)
            raise Conflict(f"UNIQUE constraint failed: {names}")
    return target.unionByName(_completed(source, target, defaults))


def update_where(rows: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """``UPDATE … SET … WHERE``; a NULL condition leaves the row alone."""
    hit = F.coalesce(condition, F.lit(False))
    return rows.select(
        *[
            F.when(hit, values[c].cast(rows.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in rows.columns
        ]
    )


def delete_where(rows: DataFrame, condition: Column) -> DataFrame:
    """``DELETE … WHERE``; a NULL condition keeps the row."""
    return rows.where(~F.coalesce(condition, F.lit(False)))
