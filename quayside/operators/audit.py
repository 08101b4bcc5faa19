"""Constraint audits: what a typed server would refuse, as set-based reports.

Each report has ``message, table, columns`` and the count ``n``; keyed ones also the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.keys import complete, same_key
from quayside.tables import Table, folded


def _key_text(key: Sequence[str]) -> Column:
    return F.to_json(F.array(*[F.col(k).cast("string") for k in key])).alias("key")


def _labels(message: str, table: str, columns: Sequence[str]) -> list[Column]:
    return [
        F.lit(message).alias("message"),
        F.lit(table).alias("table"),
        F.lit(", ".join(columns)).alias("columns"),
    ]


def unique_violations(
    rows: DataFrame, table: str, key: Sequence[str], nocase: Sequence[str] = ()
) -> DataFrame:
    """Keys that occur more than once; keys with a NULL are exempt.

    Columns in ``nocase``, and those whose type says so, are compared in lower case.
    """
    nocase = {*nocase, *(f.name for f in rows.schema if f.name in key and folded(f.dataType))}
    named = ", ".join(f"{table}.{c}" for c in key)
    parts = [F.lower(F.col(c).cast("string")).alias(c) if c in nocase else F.col(c) for c in key]
    counted = rows.where(complete(key)).groupBy(*parts).agg(F.count("*").alias("n"))
    return counted.where("n > 1").select(
        *_labels(f"UNIQUE constraint failed: {named}", table, key), _key_text(key), "n"
    )


def not_null_violations(rows: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Columns that hold NULLs, all counted in one pass."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("columns"), F.col(c).alias("n")) for c in columns])
    return (
        counts.select(F.inline(pairs))
        .where("n > 0")
        .select(
            F.concat(F.lit(f"NOT NULL constraint failed: {table}."), "columns").alias("message"),
            F.lit(table).alias("table"),
            "columns",
            "n",
        )
    )


def fk_violations(
    child: DataFrame,
    table: str,
    columns: Sequence[str],
    parent: DataFrame,
    parent_columns: Sequence[str],
) -> DataFrame:
    """Foreign keys without a parent, with the number of rows; a NULL column exempts the row.

    Child rows are counted per key before the join, so a hot key is one row by then.
    """
    used = child.where(complete(columns)).groupBy(*columns).agg(F.count("*").alias("n"))
    known = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns)])
    orphans = used.alias("c").join(known.alias("p"), same_key("c", "p", columns), "left_anti")
    return orphans.select(
        *_labels("FOREIGN KEY constraint failed", table, columns), _key_text(columns), "n"
    )


def check_violations(rows: DataFrame, table: str, checks: Mapping[str, Column]) -> DataFrame:
    """Named conditions that are false for some rows, counted in one pass; NULL passes."""
    counts = rows.agg(
        *[F.count_if(~F.coalesce(test, F.lit(True))).alias(name) for name, test in checks.items()]
    )
    pairs = F.array(
        *[F.struct(F.lit(name).alias("columns"), F.col(f"`{name}`").alias("n")) for name in checks]
    )
    return (
        counts.select(F.inline(pairs))
        .where("n > 0")
        .select(
            F.concat(F.lit("CHECK constraint failed: "), "columns").alias("message"),
            F.lit(table).alias("table"),
            "columns",
            "n",
        )
    )


def check_failures(rows: DataFrame, test: Column) -> DataFrame:
    """The rows for which a condition is false."""
    return rows.where(~F.coalesce(test, F.lit(True)))


def audit(rows: DataFrame, table: Table, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Every violation of a declared table in one report (``key`` is NULL where none applies)."""
    reports = []
    required = [f.name for f in table.fields if f.not_null or f.name in table.pk]
    if required:
        reports.append(not_null_violations(rows, table.name, required))
    for key in ([table.pk] if table.pk else []) + list(table.unique):
        reports.append(unique_violations(rows, table.name, key))
    for fk in table.foreign_keys:
        parent = parents[fk.parent]
        reports.append(fk_violations(rows, table.name, fk.columns, parent, fk.parent_columns))
    checks = table.sound_checks()
    if checks:
        reports.append(check_violations(rows, table.name, checks))
    if not reports:
        schema = "message string, table string, columns string, n bigint, key string"
        return rows.sparkSession.createDataFrame([], schema)
    whole = reports[0]
    for report in reports[1:]:
        whole = whole.unionByName(report, allowMissingColumns=True)
    return whole


def verify_counts(
    source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]
) -> DataFrame:
    """Row counts per source table on both sides: ``table, source, target, ok``.

    A table the target lacks has a NULL count and is not ok.
    """
    nothing = F.lit(None).cast("bigint")
    sides = None
    for table, rows in source.items():
        sums = [rows.agg(F.lit(table).alias("table"), F.count("*").alias("source"),
                         nothing.alias("target"))]
        if table in target:
            sums.append(target[table].agg(F.lit(table).alias("table"), nothing.alias("source"),
                                          F.count("*").alias("target")))
        for one in sums:
            sides = one if sides is None else sides.unionAll(one)
    per_table = sides.groupBy("table").agg(
        F.max("source").alias("source"), F.max("target").alias("target")
    )
    return per_table.withColumn("ok", F.coalesce(F.col("source") == F.col("target"), F.lit(False)))


def all_ok(report: DataFrame) -> bool:
    """Whether every table of a verification matches."""
    return report.where("not ok").isEmpty()
