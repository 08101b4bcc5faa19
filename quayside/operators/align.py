"""Bringing source rows to a target's columns and types."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.coerce import coerce, reads_stripped, strip
from quayside.tables import Field, Table, spark_type

ROW_KEY = "rowid"
REJECTS = "_rejects"
_RAW, _BARE = "_raw_", "_bare_"


def missing_columns(source: DataFrame, table: Table, row_key: str | None = None) -> list[str]:
    """Target columns the source does not bring; these are left to their defaults."""
    given = set(source.columns) | ({ROW_KEY} if row_key else set())
    return [f.name for f in table.fields if f.name not in given and f.generated is None]


def align(
    source: DataFrame,
    table: Table,
    now: Any = None,
    row_key: str | None = None,
    with_rejects: bool = False,
    passing: tuple[str, ...] = (),
) -> DataFrame:
    """Select exactly the target's columns, typed.

    Columns on both sides are coerced; missing ones take their default (a NULL that is present
    stays NULL); generated ones are computed from the typed row and never read from the source.
    A target column named ``rowid`` takes the source's ``row_key`` column. Columns named in
    ``passing`` (a sequence, say) are kept as they are.

    The work is a chain of projections (stripped text, values, reasons), so that nothing costly
    is computed twice; there is no shuffle.
    """
    stored = [f for f in table.fields if f.generated is None]
    read = {
        f.name: f.name if f.name in source.columns else row_key
        for f in stored
        if f.name in source.columns or (f.name == ROW_KEY and row_key)
    }
    inputs, stripped = {}, {}
    for name, column in read.items():
        kind = source.schema[column].dataType
        inputs[name] = F.col(column).alias(_RAW + name)
        if reads_stripped(kind, table.target(name)):
            stripped[name] = strip(F.col(column).cast("string")).alias(_BARE + name)
    others = [F.col(p) for p in passing if p not in table.columns]
    ready = source.select(*inputs.values(), *stripped.values(), *others)

    coerced = {
        name: coerce(
            F.col(_RAW + name), source.schema[column].dataType, table.target(name),
            F.col(_BARE + name) if name in stripped else None,
        )
        for name, column in read.items()
    }
    values = [
        (coerced[f.name].value.cast(table.type_of(f.name)) if f.name in read
         else f.default_column(table.type_of(f.name), now)).alias(f.name)
        for f in stored
    ]
    kept = [c for c in ready.columns if with_rejects or not c.startswith((_RAW, _BARE))]
    typed = ready.select(*values, *kept)
    if with_rejects:
        reasons = [
            F.when(
                coerced[name].refusal(F.col(name)),
                F.struct(
                    F.lit(name).alias("column"),
                    F.lit(table.target(name)).alias("type"),
                    F.col(_RAW + name).cast("string").alias("value"),
                ),
            )
            for name in read
        ]
        empty = F.lit(None).cast("struct<column:string,type:string,value:string>")
        names = [f.name for f in stored]
        typed = typed.select(
            *names, *others, F.array_compact(F.array(*reasons or [empty])).alias(REJECTS)
        )
    return add_generated(typed, table)


def add_generated(rows: DataFrame, table: Table) -> DataFrame:
    """Compute stored generated columns, in the target's column order."""
    generated = {f.name: f.generated() for f in table.fields if f.generated is not None}
    if not generated:
        return rows
    extra = [c for c in rows.columns if c not in table.columns]
    return rows.withColumns(generated).select(*table.columns, *extra)


def split_rejects(aligned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without refused values, and one row per refused value with its reason.

    Rows are told apart by generators: a filter would be moved below the projections and repeat
    the whole coercion.
    """
    rest = [c for c in aligned.columns if c != REJECTS]
    clean = F.when(F.size(REJECTS) == 0, F.array(F.lit(True)))
    good = aligned.select(*rest, F.explode(clean).alias("_clean")).drop("_clean")
    bad = aligned.select(*rest, F.inline(F.array_compact(REJECTS)))
    return good, bad


def add_column(rows: DataFrame, field: Field, now: Any = None, json: str = "text") -> DataFrame:
    """``ADD COLUMN … DEFAULT``: existing rows are filled with the default."""
    if field.generated is not None:
        return rows.withColumn(field.name, field.generated())
    kind = spark_type(field.target(json))
    return rows.withColumn(field.name, field.default_column(kind, now))


def unnest(rows: DataFrame, *arrays: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parallel arrays to rows, one column each; short arrays are filled with NULL."""
    return rows.select(*keep, F.inline(F.arrays_zip(*arrays)))
