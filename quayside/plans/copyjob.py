"""Copying several tables into the catalog, with a report per table."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import asdict, dataclass
from graphlib import CycleError, TopologicalSorter
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import load
from quayside.operators.align import REJECTS, align, missing_columns, split_rejects
from quayside.operators.audit import fk_violations, unique_violations, verify_counts
from quayside.operators.identity import next_identity
from quayside.operators.keys import complete, same_key
from quayside.sources.publish import latest, publish
from quayside.tables import Table

MODES = ("load", "truncate", "upsert")
REPORT_SCHEMA = (
    "`table` string, mode string, `rows` bigint, seconds double, skipped string, rejected bigint, "
    "inserted bigint, updated bigint, removed bigint, defaulted array<string>, next_identity bigint"
)


@dataclass
class TableReport:
    """What a copy did to one table.

    ``rows`` are in the table afterwards; ``rejected`` values kept their rows out. Of the rows, ``inserted`` and
    ``updated`` ones came from the source; ``removed`` ones are gone. ``defaulted`` columns were not in the
    source. ``next_identity`` is the value an identity column goes on with.
    """

    table: str
    mode: str
    rows: int = 0
    seconds: float = 0.0
    skipped: str | None = None
    rejected: int = 0
    inserted: int = 0
    updated: int = 0
    removed: int = 0
    defaulted: tuple[str, ...] = ()
    next_identity: int | None = None


def chosen(names: Sequence[str], include: Sequence[str] = (), exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Names kept by include and exclude lists (any case), and included names that do not exist."""
    wanted = {n.lower() for n in include}
    unwanted = {n.lower() for n in exclude}
    kept = [n for n in names if (not wanted or n.lower() in wanted) and n.lower() not in unwanted]
    known = {n.lower() for n in names}
    return kept, [n for n in include if n.lower() not in known]


def load_order(tables: Sequence[Table]) -> list[str]:
    """Parents before children, else by name; references within a cycle do not count."""
    names = {t.name for t in tables}
    parents = {
        t.name: {k.parent for k in t.foreign_keys if k.parent in names and k.parent != t.name}
        for t in tables
    }
    while True:
        sorter = TopologicalSorter(parents)
        try:
            sorter.prepare()
            break
        except CycleError as err:
            cycle = set(err.args[1])
            for name in cycle:
                parents[name] -= cycle
    order: list[str] = []
    while sorter.is_active():
        ready = sorted(sorter.get_ready())
        order += ready
        sorter.done(*ready)
    return order


class RejectedValues(ValueError):
    """A source has values that the target's types or constraints do not allow."""


class ConstraintFailed(RejectedValues):
    """Rows that are each allowed break a key or a reference together."""


def copy_tables(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    tables: Sequence[Table],
    base: str,
    mode: str = "load",
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    dry_run: bool = False,
    now: Any = None,
    parallel: int = 4,
    rejects: str = "error",
    row_keys: Mapping[str, str] | None = None,
) -> list[TableReport]:
    """Copy source tables into catalog tables of the same names.

    ``load`` skips tables that have rows, ``truncate`` replaces them (never a table others
    reference), ``upsert`` mirrors the source by primary key. A source without a declared target
    is skipped; the first failure is raised. A target column ``rowid`` takes the source column named
    for its table in ``row_keys``.

    Declared constraints hold in every table that is switched to. The new state is written, checked
    and only then committed, so a failure leaves the table as it was:

    * values the target's types cannot hold, NULLs in required columns and failed checks are told row by
      row. They end the table, or with ``rejects="keep"`` their rows are left out, written with reasons
      to ``<base>/<table>-rejects`` and counted;
    * so are references without a parent, looked up in the parents' new states: a table waits for
      those it references;
    * repeated keys end a table in every mode, as which of the rows is right cannot be told.

    Up to ``parallel`` tables are in flight at once, so small tables do not hold up a large one.
    """
    if rejects not in ("error", "keep"):
        raise ValueError(f"unknown handling of rejects {rejects!r}")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    declared = {t.name: t for t in tables}
    names, unknown = chosen(list(sources), include, exclude)
    order = load_order([declared[n] for n in names if n in declared])
    reports = [TableReport(n, "skipped", skipped="not in the source") for n in unknown]
    if dry_run:
        return reports + [TableReport(n, "dry-run") for n in order]
    reports += [TableReport(n, "skipped", skipped="no target table") for n in names if n not in declared]
    children: dict[str, list[str]] = {n: [] for n in declared}
    for t in tables:
        for key in t.foreign_keys:
            children.setdefault(key.parent, []).append(t.name)
    under_way: dict[str, Future] = {}

    def timed(name: str) -> TableReport:
        table = declared[name]
        for parent in {k.parent for k in table.foreign_keys} - {name}:
            # Within a cycle of references the earlier table does not wait for the later one.
            if parent in order and order.index(parent) < order.index(name):
                under_way[parent].result()
        started = time.monotonic()
        job = _Copy(spark, sources[name], table, f"{base.rstrip('/')}/{name}", mode, now, rejects, (row_keys or {}).get(name))
        report = job.run(children[name])
        report.seconds = round(time.monotonic() - started, 3)
        return report

    with ThreadPoolExecutor(parallel) as pool:
        for name in order:  # parents first, so a waiting table never holds the place its parent needs
            under_way[name] = pool.submit(timed, name)
        return reports + [under_way[n].result() for n in order]


@dataclass
class _Copy:
    """The copy of one table."""

    spark: SparkSession
    source: DataFrame
    table: Table
    folder: str
    mode: str
    now: Any
    rejects: str
    row_key: str | None
    kept: bool = False  # whether this copy has written rejects

    def run(self, children: Sequence[str]) -> TableReport:
        spark, table, name, mode = self.spark, self.table, self.table.name, self.mode
        old = self._typed(latest(spark, name)) if spark.catalog.tableExists(name) else None
        if mode == "load" and old is not None and not old.isEmpty():
            return TableReport(name, "skipped", old.count(), skipped="already has rows")
        if mode == "upsert" and not table.pk:
            raise load.NoKey(f"{name}: no primary key, cannot upsert")
        if mode == "truncate":
            load.truncate_guard(name, children)
        seen = Observation()
        aligned = self._judged(align(self.source, table, self.now, self.row_key, with_rejects=True))
        aligned = aligned.observe(seen, F.sum(F.size(REJECTS)).alias("refused"))
        rows, bad = split_rejects(aligned)
        if mode == "upsert" and old is not None:
            rows = self._upserted(rows, old)
        report = TableReport(name, mode, defaulted=tuple(missing_columns(self.source, table, self.row_key)))

        def settle(written: DataFrame) -> None:
            if seen.get["refused"]:
                report.rejected = self._refuse(bad)
            for key in ([table.pk] if table.pk else []) + list(table.unique):
                self._end_on(unique_violations(written, name, key))
            for key in table.foreign_keys:
                parent = self._parent(key, written)
                if parent is not None:
                    self._end_on(fk_violations(written, name, key.columns, parent, key.parent_columns))
            if old is not None and table.pk:
                changes = load.upsert_changes(written, old, table.pk).first()
                report.inserted, report.updated, report.removed = changes
            if table.identity:
                report.next_identity = next_identity(written, table.identity).first()[0]

        if self.rejects == "keep":
            rows, orphans = self._without_orphans(rows)
        report.rows = publish(rows, name, self.folder, before_commit=settle)
        if old is None or not table.pk:
            report.inserted = report.rows
            report.removed = 0 if old is None else old.count()
        if self.rejects == "keep" and orphans is not None:
            report.rejected += self._keep(orphans)
        return report

    def _typed(self, target: DataFrame) -> DataFrame:
        """The target's rows with texts compared as declared, also if the table was made otherwise."""
        texts = {f.name: F.col(f"`{f.name}`").cast(self.table.type_of(f.name)) for f in self.table.fields
                 if f.name in target.columns and isinstance(target.schema[f.name].dataType, T.StringType)
                 and isinstance(self.table.type_of(f.name), T.StringType)}
        return target.withColumns(texts) if texts else target

    def _judged(self, aligned: DataFrame) -> DataFrame:
        """Aligned rows with what row-wise constraints say beside what the types said."""
        table = self.table
        reason = lambda column, kind, value: F.struct(
            F.lit(column).alias("column"), F.lit(kind).alias("type"), value.cast("string").alias("value")
        )
        required = [f.name for f in table.fields if f.not_null or f.name in table.pk]
        refused = F.transform(REJECTS, lambda r: r["column"])
        told = [
            F.when(F.col(f"`{c}`").isNull() & ~F.array_contains(refused, c), reason(c, "not null", F.lit(None)))
            for c in required
        ]
        told += [F.when(~F.coalesce(test, F.lit(True)), reason(n, "check", F.lit(None))) for n, test in table.sound_checks().items()]
        if not told:
            return aligned
        return aligned.withColumn(REJECTS, F.concat(REJECTS, F.array_compact(F.array(*told))))

    def _refuse(self, bad: DataFrame) -> int:
        if self.rejects == "keep":
            return self._keep(bad)
        name, first = self.table.name, bad.first()
        if first["type"] == "not null":
            raise RejectedValues(f"NOT NULL constraint failed: {name}.{first['column']}")
        if first["type"] == "check":
            raise RejectedValues(f"CHECK constraint failed: {first['column']}")
        raise RejectedValues(f"{name}: {bad.count()} values do not fit, such as {first['value']!r} in {first['column']}")

    def _keep(self, bad: DataFrame) -> int:
        """Write refused rows beside the table; gives how many reasons there were."""
        seen = Observation()
        mode, self.kept = "append" if self.kept else "overwrite", True
        bad.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(f"{self.folder}-rejects")
        return seen.get["n"]

    def _end_on(self, violations: DataFrame) -> None:
        first = violations.first()
        if first is not None:
            raise ConstraintFailed(f"{first['message']} ({first['n']} rows of {first['key']})")

    def _parent(self, key, written: DataFrame) -> DataFrame | None:
        if key.parent == self.table.name:
            return written
        return latest(self.spark, key.parent) if self.spark.catalog.tableExists(key.parent) else None

    def _without_orphans(self, rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Rows whose references all lead somewhere, and those left out with the reason.

        A self-reference is looked up among the rows left so far; one that loses its parent only after
        that ends the table when the written rows are checked.
        """
        left, out = rows, None
        for key in self.table.foreign_keys:
            parent = self._parent(key, left)
            if parent is None:
                continue
            names = [f"_p{i}" for i in range(len(key.columns))]
            known = parent.select(*[F.col(p).alias(n) for p, n in zip(key.parent_columns, names, strict=True)]).distinct()
            same = [left[c] == known[n] for c, n in zip(key.columns, names, strict=True)]
            used = complete(key.columns)
            reason = [F.lit(", ".join(key.columns)).alias("column"), F.lit("foreign key").alias("type"),
                      F.to_json(F.array(*[F.col(c).cast("string") for c in key.columns])).alias("value")]
            lost = left.where(used).join(known, same, "left_anti").select("*", *reason)
            left = left.where(used).join(known, same, "left_semi").unionByName(left.where(~used))
            out = lost if out is None else out.unionByName(lost)
        return left, out

    def _upserted(self, rows: DataFrame, target: DataFrame) -> DataFrame:
        """Mirror into an existing target; columns the source lacks keep the target's values."""
        table, source = self.table, self.source
        given = [f.name for f in table.fields if f.name in source.columns or f.generated is not None
                 or (f.name == "rowid" and self.row_key)]
        absent = [c for c in table.columns if c not in given]
        fresh = rows.select(*given, *[F.col(c).alias(f"_new_{c}") for c in absent])
        if not absent:
            return load.upsert_mirror(fresh, target, table.pk, table=table.name, check_keys=False)
        own = [c for c in target.columns if c not in table.columns]  # known to the target only
        old = target.select(*table.pk, *absent, *own, F.lit(True).alias("_old")).alias("o")
        joined = fresh.alias("f").join(old, same_key("f", "o", table.pk), "left")
        return joined.select(
            *[
                F.when(F.col("_old"), F.col(f"o.{c}")).otherwise(F.col(f"_new_{c}")).alias(c)
                if c in absent
                else F.col(f"f.{c}").alias(c)
                for c in table.columns
            ],
            *[F.col(f"o.{c}") for c in own],
        )


def report_frame(spark: SparkSession, reports: Sequence[TableReport]) -> DataFrame:
    """Reports as a DataFrame."""
    return spark.createDataFrame([tuple(asdict(r).values()) for r in reports], REPORT_SCHEMA)


def verify_tables(
    spark: SparkSession, sources: Mapping[str, DataFrame], include: Sequence[str] = (),
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Row counts of sources against the catalog tables of the same names."""
    names, _ = chosen(list(sources), include, exclude)
    there = {n: spark.table(n) for n in names if spark.catalog.tableExists(n)}
    return verify_counts({n: sources[n] for n in names}, there)
