"""Publishing a new table state.

Files that a query reads cannot be replaced under it. Every state is written to a new folder
below the table's base folder and becomes the table's by one commit (see ``snapshots``). Readers see
the old or the new state, and a failed write leaves only an unused folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.sources.snapshots import (
    APPLIED,
    NO_BATCH,
    PART,
    ConcurrentPublish,
    Layout,
    Snapshot,
    align_catalog,
    base_of,
    commit,
    location,
    new_folder,
    newest,
    read_state,
    state_of,
    subfolders,
)

__all__ = ["APPLIED", "NO_BATCH", "PART", "ConcurrentPublish", "current_version", "latest", "publish"]


def current_version(spark: SparkSession, table: str) -> tuple[int, int]:
    """Version number and last stream batch of a published table; ``(0, -1)`` before the first."""
    state = state_of(spark, table)[1]
    return state.version, state.batch


def publish(
    rows: DataFrame,
    table: str,
    base: str,
    batch: int | None = None,
    cluster_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    before_commit: Callable[[DataFrame], None] | None = None,
    options: Mapping[str, str] | None = None,
) -> int:
    """Write ``rows`` as the next state of ``table`` and switch to it; returns the row count.

    The table shows exactly these rows afterwards, whatever layout it has: buckets, partitions, and the
    parts of a table that follows a stream are kept until another layout is given. Rows of a followed
    table keep the sequence they were last replaced at, by key, so late rows still replace nothing.

    ``batch`` is remembered in the same commit. ``cluster_by`` sorts the files by key ranges, so later
    key lookups skip files. ``bucket_by`` with a number of ``buckets`` stores rows by key, one file per
    bucket: loads that join two such tables by that key then shuffle neither side. ``partition_by``
    makes a folder per value. ``before_commit`` is called with the written rows; when it raises, the
    table stays as it was. ``options`` are the file format's own, for this state.

    Of two writers that started from the same state one fails with ``ConcurrentPublish``. Columns added
    or retyped, and another layout, make a new catalog entry. Leaving a column out is refused.
    """
    spark = rows.sparkSession
    base = base.rstrip("/")
    exists = spark.catalog.tableExists(table)
    state = state_of(spark, table)[1]
    if not exists or base_of(spark, table) != _qualified(spark, base):
        # Versions count on where the folder already holds some.
        below = newest(spark, base)
        state = Snapshot(version=below.version if below else 0, batch=state.batch, layout=state.layout,
                         folders=state.folders, schema=state.schema, home=state.home)
    layout = state.layout
    if buckets or partition_by:
        layout = Layout(tuple(partition_by), tuple(bucket_by), buckets)
    if exists:
        hidden = {PART, APPLIED} if state.layout.parts else set()
        lost = [c for c in spark.table(table).columns if c not in hidden and c.lower() not in {x.lower() for x in rows.columns}]
        if lost:
            raise ValueError(f"{table} would lose columns {lost}")
    folder = new_folder(base, state.version + 1)
    if layout.parts:
        rows = in_parts(_with_applied(rows, state), layout)
    elif layout.partition_by:
        rows = rows.hint("rebalance", *layout.partition_by)
    elif layout.buckets:
        rows = rows.repartition(layout.buckets, *layout.bucket_by)
    elif cluster_by:
        rows = rows.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    # Counted in the writing tasks: before a shuffle, sampling and retries would count twice.
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format(file_format).options(**(options or {}))
    if layout.buckets:
        keyed = writer.bucketBy(layout.buckets, *layout.bucket_by).sortBy(*layout.bucket_by)
        if layout.partition_by:
            keyed = keyed.partitionBy(*layout.partition_by)
        staged = f"{table}_{folder.rpartition('-')[2]}"
        keyed.option("path", folder).saveAsTable(staged)  # bucketed files are only written through the catalog
        spark.sql(f"DROP TABLE {staged}")  # external: its files stay
    elif layout.partitions:
        writer.partitionBy(*layout.partitions).save(folder)
    else:
        writer.save(folder)
    if before_commit is not None:
        written = spark.read.format(file_format).schema(rows.schema).load(folder)
        before_commit(written.drop(PART, APPLIED) if layout.parts else written)
    commit_folder(spark, table, base, state, folder, rows, layout, batch, file_format)
    return seen.get["n"]


def commit_folder(
    spark: SparkSession, table: str, base: str, state: Snapshot, folder: str, rows: DataFrame,
    layout: Layout, batch: int | None = None, file_format: str = "parquet", kept: dict[str, str] | None = None,
) -> Snapshot:
    """Commit a written folder as the state after ``state``; parts in ``kept`` stay where they are."""
    parts = {name.partition("=")[2]: folder for name in subfolders(spark, folder)} if layout.parts else {}
    order = [f for f in rows.schema if f.name not in layout.partitions]
    order += [f for c in layout.partitions for f in rows.schema if f.name == c]
    made = state.next(batch, layout=layout, folders=(kept or {}) | parts, home=folder, file_format=file_format,
                      schema=type(rows.schema)(order))
    commit(spark, base, made)
    return align_catalog(spark, table, base)


def part_of(rows: DataFrame, layout: Layout) -> Column:
    """The part of a followed table that a row belongs to."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in layout.key]), F.lit(layout.parts)).cast("int")


def in_parts(rows: DataFrame, layout: Layout) -> DataFrame:
    """Rows with their part, each part's rows together, a large part's in several tasks."""
    return rows.withColumn(PART, part_of(rows, layout)).hint("rebalance", PART)


def _with_applied(rows: DataFrame, state: Snapshot) -> DataFrame:
    """Rows with the sequence that the table's row of the same key was last replaced at."""
    key = list(state.layout.key)
    held = read_state(rows.sparkSession, state).where(F.col(APPLIED).isNotNull())
    held = held.select(*[F.col(k).alias(f"_held_{i}") for i, k in enumerate(key)], APPLIED)
    same = [rows[k] == held[f"_held_{i}"] for i, k in enumerate(key)]
    return rows.drop(PART, APPLIED).join(held, same, "left").drop(*[f"_held_{i}" for i in range(len(key))])


def _qualified(spark: SparkSession, path: str) -> str:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def latest(spark: SparkSession, table: str) -> DataFrame:
    """The current state of a published table, also when another session switched it.

    A followed table is read straight from its newest state, whole batches only; columns that
    only serve to follow a stream are left out.
    """
    base, state = state_of(spark, table)
    if base and location(spark, table).rstrip("/").rpartition("/")[2] != state.home.rpartition("/")[2]:
        state = align_catalog(spark, table, base)
    if state.layout.parts:
        return read_state(spark, state).drop(APPLIED)
    spark.catalog.refreshTable(table)
    return spark.table(table)
