"""Aggregates that build one text per group: joined text, JSON arrays and JSON objects.

Every function takes an explicit row order. A pass over the group columns and value sizes, with
map-side combining, finds groups larger than ``part_bytes``. Usual groups are joined in one shuffle.
A large group is a rope: its values are laid end to end, and the rope is cut at every ``part_bytes``.
Where a value starts follows from a distributed prefix sum: sizes are added up per slice of the
order, slices are shifted by those before them, and each slice is summed on its own. So a part
holds the values that start within its stretch, never more than ``part_bytes`` and one value,
whatever the sizes are, and parts are joined in separate tasks. A value counts for what it takes in
memory, ``VALUE_BYTES`` at least, so many tiny values are a large group too.

A text beyond what one cell can hold is refused before any work; the ``*_parts`` forms give the
whole of it as numbered parts instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.jsons import json_member, json_value
from quayside.operators.keys import same_key
from quayside.session import ready_checkpoints

PART_BYTES = 64 * 1024 * 1024
CELL_BYTES = 2**31 - 1024
VALUE_BYTES = 32  # what a value takes beside its text
# Least bytes of a slice of the order: parts may be many and small, slices are tasks.
SLICE_BYTES = 16 * 1024 * 1024
# Up to this many large groups of up to so many bytes of keys are known on the driver.
FEW_KEYS, KEY_BYTES = 1000, 4 << 20
_PIECE, _ORDER, _PART, _TEXT, _BYTES, _COST, _SLICE, _SHIFT = (
    "_piece", "_order", "_part", "_text", "_bytes", "_cost", "_slice", "_shift",
)


class TextTooLarge(ValueError):
    """A group's text does not fit into one cell."""


def _joined(separator: str, text: str, order: str) -> Column:
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"listagg({text}, '{quoted}') WITHIN GROUP (ORDER BY {order})")


def _pieces(rows: DataFrame, keys: Sequence[str], piece: Column, order: Sequence[str]) -> DataFrame:
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return rows.select(*keys, place.alias(_ORDER), piece.alias(_PIECE))


def _cost(separator: str) -> Column:
    """What a value counts for; one that is NULL is skipped and counts for nothing."""
    return F.coalesce(F.greatest(F.octet_length(_PIECE) + F.lit(len(separator.encode())), F.lit(VALUE_BYTES)), F.lit(0))


def _sizes(pieces: DataFrame, keys: Sequence[str], separator: str) -> DataFrame:
    each = F.octet_length(_PIECE) + F.lit(len(separator.encode()))
    return pieces.groupBy(*keys).agg(F.sum(each).alias(_BYTES), F.sum(_cost(separator)).alias(_COST))


def _parts(pieces: DataFrame, keys: Sequence[str], separator: str, part_bytes: int, total: int) -> DataFrame:
    """Consecutive stretches of each group, joined; ``_part`` counts stretches of ``part_bytes``."""
    ready_checkpoints(pieces.sparkSession)
    slices = max(1, -(-total // max(part_bytes, SLICE_BYTES)))
    spread = pieces.withColumn(_COST, _cost(separator).cast("bigint"))
    spread = spread.repartitionByRange(slices, *keys, _ORDER).withColumn(_SLICE, F.spark_partition_id())
    # Stored once: the cuts between slices come from a sample, and both passes need the same ones.
    spread = spread.checkpoint()
    ahead = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sums = spread.groupBy(*keys, _SLICE).agg(F.sum(_COST).alias(_COST))  # a row per group and slice
    shifts = sums.select(*keys, _SLICE, F.coalesce(F.sum(_COST).over(ahead), F.lit(0)).alias(_SHIFT))
    match = same_key("p", "s", [*keys, _SLICE], null_safe=True)
    placed = spread.alias("p").join(shifts.alias("s"), match).select("p.*", _SHIFT)
    before = Window.partitionBy(*keys, _SLICE).orderBy(_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col(_SHIFT) + F.coalesce(F.sum(_COST).over(before), F.lit(0))
    cut = placed.withColumn(_PART, F.floor(start / F.lit(part_bytes)).cast("bigint"))
    return cut.groupBy(*keys, _PART).agg(_joined(separator, _PIECE, _ORDER).alias(_TEXT))


def _whole(pieces: DataFrame, keys: Sequence[str], separator: str) -> DataFrame:
    return pieces.groupBy(*keys).agg(_joined(separator, _PIECE, _ORDER).alias(_TEXT))


def _join_groups(
    pieces: DataFrame, keys: Sequence[str], separator: str, part_bytes: int
) -> DataFrame:
    large = _sizes(pieces, keys, separator).where(F.col(_COST) > part_bytes)
    seen = large.limit(FEW_KEYS + 1).collect()  # at most so many keys reach the driver
    if not seen:
        return _whole(pieces, keys, separator)
    few = len(seen) <= FEW_KEYS and sum(len(str(r)) for r in seen) <= KEY_BYTES
    if few:
        largest, total = max(r[_BYTES] for r in seen), sum(r[_COST] for r in seen)
    else:
        largest, total = large.agg(F.max(_BYTES), F.sum(_COST)).first()
    if largest > CELL_BYTES:
        raise TextTooLarge(
            f"a group's text needs {largest} bytes, more than one cell holds; use the parts form"
        )
    hot, usual = pieces, None
    if keys:
        held = large.select(*keys)
        if few:  # the number and size of the rows is known, so sending them to every task is safe
            rows = [tuple(r[k] for k in keys) for r in seen]
            held = F.broadcast(pieces.sparkSession.createDataFrame(rows, held.schema))
        match = same_key("p", "h", keys, null_safe=True)
        hot = pieces.alias("p").join(held.alias("h"), match, "left_semi")
        usual = pieces.alias("p").join(held.alias("h"), match, "left_anti")
    parts = _parts(hot, keys, separator, part_bytes, total)
    joined = parts.groupBy(*keys).agg(_joined(separator, _TEXT, _PART).alias(_TEXT))
    return joined if usual is None else joined.unionAll(_whole(usual, keys, separator))


def _all_parts(pieces: DataFrame, keys: Sequence[str], separator: str, part_bytes: int) -> DataFrame:
    pieces = pieces.where(F.col(_PIECE).isNotNull())
    total = pieces.agg(F.sum(_cost(separator))).first()[0] or 0
    return _parts(pieces, keys, separator, part_bytes, total).withColumnRenamed(_PART, "part")


def group_concat(
    rows: DataFrame,
    keys: Sequence[str],
    value: Column,
    order: Sequence[str],
    separator: str = ",",
    name: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Join the values of each group as text, in order; NULLs are skipped, none left is NULL."""
    pieces = _pieces(rows, keys, value.cast("string"), order)
    return _join_groups(pieces, keys, separator, part_bytes).withColumnRenamed(_TEXT, name)


def group_concat_parts(
    rows: DataFrame,
    keys: Sequence[str],
    value: Column,
    order: Sequence[str],
    separator: str = ",",
    name: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The text of each group as parts: joined in ``part`` order they are the whole text."""
    pieces = _pieces(rows, keys, value.cast("string"), order)
    return _all_parts(pieces, keys, separator, part_bytes).withColumnRenamed(_TEXT, name)


def group_concat_distinct(
    rows: DataFrame,
    keys: Sequence[str],
    value: Column,
    separator: str = ",",
    name: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Join the distinct values of each group in ascending order."""
    once = rows.select(*keys, value.cast("string").alias(_TEXT)).distinct()
    return group_concat(once, keys, F.col(_TEXT), [_TEXT], separator, name, part_bytes)


def json_group_array(
    rows: DataFrame,
    keys: Sequence[str],
    value: Column,
    order: Sequence[str],
    name: str = "json",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """A JSON array of the values of each group, NULLs included."""
    pieces = _pieces(rows, keys, json_value(value), order)
    joined = _join_groups(pieces, keys, ",", part_bytes)
    return joined.withColumn(_TEXT, F.concat(F.lit("["), _TEXT, F.lit("]"))).withColumnRenamed(_TEXT, name)


def json_group_object(
    rows: DataFrame,
    keys: Sequence[str],
    member: Column,
    value: Column,
    order: Sequence[str],
    name: str = "json",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """A JSON object of key-value pairs per group; repeated keys are kept, NULL keys an error."""
    pieces = _pieces(rows, keys, json_member(member, value), order)
    joined = _join_groups(pieces, keys, ",", part_bytes)
    return joined.withColumn(_TEXT, F.concat(F.lit("{"), _TEXT, F.lit("}"))).withColumnRenamed(_TEXT, name)


def json_group_array_parts(
    rows: DataFrame,
    keys: Sequence[str],
    value: Column,
    order: Sequence[str],
    name: str = "json",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The values of each group as JSON arrays: one after the other in ``part`` order they are the whole."""
    parts = _all_parts(_pieces(rows, keys, json_value(value), order), keys, ",", part_bytes)
    return parts.withColumn(_TEXT, F.concat(F.lit("["), _TEXT, F.lit("]"))).withColumnRenamed(_TEXT, name)


def json_group_object_parts(
    rows: DataFrame,
    keys: Sequence[str],
    member: Column,
    value: Column,
    order: Sequence[str],
    name: str = "json",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The pairs of each group as JSON objects, as many as the size calls for, in ``part`` order."""
    parts = _all_parts(_pieces(rows, keys, json_member(member, value), order), keys, ",", part_bytes)
    return parts.withColumn(_TEXT, F.concat(F.lit("{"), _TEXT, F.lit("}"))).withColumnRenamed(_TEXT, name)
