"""Snapshots of published tables: one small file per state, and the commit that only one writer wins.

The file ``<base>/_commits/<version>.json`` names everything a state consists of: its layout, its
schema, the folder of each part and the last stream batch in it. A writer prepares new folders, then
creates the file of the next version, which fails when it exists. That creation *is* the commit, for
every writer whatever it writes; the catalog entry is brought in line afterwards, and brought in
line again by whoever next looks at a table whose writer died in between.

A commit is as atomic as exclusive creation is on the file system of ``base``: HDFS and local disks give
it; an object store must offer conditional writes.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMITS = "_commits"
NO_BATCH = -1
# Columns that following a stream keeps in its table: the part a row is in, and the sequence it was last replaced at.
PART, APPLIED = "_part", "_applied"
_FILE = re.compile(r"(\d{10})\.json$")
_STATE = re.compile(r"/v-\d+-[0-9a-f]+/?$")


class ConcurrentPublish(RuntimeError):
    """Another writer committed a state while this one was being written."""


@dataclass(frozen=True)
class Layout:
    """How the files of a table are laid out.

    ``partition_by`` and ``bucket_by`` are the catalog's own forms. ``key`` with ``parts`` divides the rows
    by a hash of the key into the hidden column ``_part``, which is how a followed table is kept.
    """

    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    key: tuple[str, ...] = ()
    parts: int = 0

    @property
    def partitions(self) -> tuple[str, ...]:
        return (PART,) if self.parts else self.partition_by


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: ``home`` is the folder its writer made; ``folders`` has those of parts by number."""

    version: int = 0
    batch: int = NO_BATCH
    home: str = ""
    layout: Layout = field(default_factory=Layout)
    folders: dict[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None
    file_format: str = "parquet"

    def to_json(self) -> str:
        made = {k: getattr(self, k) for k in ("version", "batch", "home", "folders", "file_format")}
        return json.dumps(made | {"layout": vars(self.layout), "schema": self.schema.json()})

    @classmethod
    def from_json(cls, text: str) -> Snapshot:
        held: dict[str, Any] = json.loads(text)
        layout = {k: tuple(v) if isinstance(v, list) else v for k, v in held.pop("layout").items()}
        schema = T.StructType.fromJson(json.loads(held.pop("schema")))
        return cls(**held, layout=Layout(**layout), schema=schema)

    def next(self, batch: int | None = None, **changes: Any) -> Snapshot:
        return replace(self, version=self.version + 1, batch=self.batch if batch is None else batch, **changes)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    place, files = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def new_folder(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/v-{version}-{uuid.uuid4().hex}"


def newest(spark: SparkSession, base: str) -> Snapshot | None:
    """The last committed state below a base folder."""
    place, files = _files(spark, f"{base.rstrip('/')}/{COMMITS}")
    if not files.exists(place):
        return None
    found = max((s.getPath().getName() for s in files.listStatus(place) if _FILE.search(s.getPath().getName())), default=None)
    if found is None:
        return None
    stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(place, found))
    try:
        return Snapshot.from_json(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, base: str, state: Snapshot) -> None:
    """Make ``state`` the newest one, or raise when its version is taken.

    The text is written beside and moved to the version's name, which fails when the name exists, so
    a reader never sees half a file and a dead writer leaves no half commit.
    """
    name = f"{base.rstrip('/')}/{COMMITS}/{state.version:010d}.json"
    place, files = _files(spark, name)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{COMMITS}/.{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(state.to_json().encode()))
    finally:
        out.close()
    try:
        _move_if_absent(spark, draft, place)
    except Exception as error:
        if files.exists(place):
            raise ConcurrentPublish(f"version {state.version} below {base} was committed by another writer") from error
        raise
    finally:
        files.delete(draft, False)


def _move_if_absent(spark: SparkSession, draft, place) -> None:
    """Give a file its name, atomically, or fail when the name is taken."""
    jvm = spark._jvm
    if (place.toUri().getScheme() or jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).getScheme()) == "file":
        local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (place, draft)]
        jvm.java.nio.file.Files.createLink(*local)  # a local rename would replace what is there
        return
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(context.makeQualified(draft), context.makeQualified(place), options)


# --- the catalog


def location(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return None if details is None else details["data_type"]


def base_of(spark: SparkSession, table: str) -> str | None:
    """The base folder of a table that was published; ``None`` for any other table."""
    held = location(spark, table)
    found = _STATE.search(held or "")
    return held[: found.start()] if found else None


def catalog_layout(spark: SparkSession, table: str) -> Layout:
    """Partitioning and buckets as the catalog has them."""
    shown = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").select("col_name", "data_type").collect()
    found = dict(map(tuple, shown))
    number = int(found.get("Num Buckets") or 0)
    columns = [c.replace("``", "`") for c in re.findall(r"`((?:[^`]|``)+)`", found.get("Bucket Columns") or "")]
    parts = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    return Layout(parts, tuple(columns) if number else (), number)


def state_of(spark: SparkSession, table: str) -> tuple[str | None, Snapshot]:
    """Base folder and newest state of a table; version 0 for one that was not published here."""
    base = base_of(spark, table)
    state = base and newest(spark, base)
    if state:
        return base, state
    layout = catalog_layout(spark, table) if spark.catalog.tableExists(table) else Layout()
    return base, Snapshot(layout=layout)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _ddl(spark: SparkSession, schema: T.StructType) -> str:
    kind = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
    return kind.toDDL()


def align_catalog(spark: SparkSession, table: str, base: str) -> Snapshot:
    """Bring the catalog entry in line with the newest state below ``base``, which is returned.

    Repeated until no newer state has come meanwhile: a slow writer must not bring back an old one.
    """
    while True:
        state = newest(spark, base)
        if (location(spark, table) or "").rstrip("/").endswith(state.home.rpartition("/")[2]):
            return state
        _install(spark, table, state)


def _install(spark: SparkSession, table: str, state: Snapshot) -> None:
    """Make the catalog entry show a committed state.

    The same shape takes a change of locations, another shape a new entry that takes the old one's
    name; between those two steps the name is missing for a moment.
    """
    exists = spark.catalog.tableExists(table)
    if exists and _shape(spark.table(table).schema, catalog_layout(spark, table)) == _shape(state.schema, state.layout):
        if state.layout.parts:
            _point_parts(spark, table, state, _version_of(location(spark, table)))
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{state.home}'")
        if state.layout.partition_by:
            _rediscover(spark, table)
    else:
        name = f"{table}_{uuid.uuid4().hex}" if exists else table
        layout = state.layout
        parted = f"PARTITIONED BY ({', '.join(map(_quoted, layout.partitions))})" if layout.partitions else ""
        by = ", ".join(map(_quoted, layout.bucket_by))
        bucketed = f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {layout.buckets} BUCKETS" if layout.buckets else ""
        spark.sql(
            f"CREATE TABLE {name} ({_ddl(spark, state.schema)}) USING {state.file_format} {parted} {bucketed} LOCATION '{state.home}'"
        )
        if layout.parts:
            _point_parts(spark, name, state, 0)
        elif layout.partition_by:
            _rediscover(spark, name)
        if exists:
            spark.sql(f"DROP TABLE {table}")  # external: its files stay
            spark.sql(f"ALTER TABLE {name} RENAME TO {table}")
    spark.catalog.refreshTable(table)


def _shape(schema: T.StructType, layout: Layout) -> tuple:
    """What a catalog entry cannot change in place; partition columns come last there."""
    by = [c.lower() for c in layout.partitions]
    fields = [(f.name.lower(), f.dataType.simpleString()) for f in schema]
    last = [f for f in fields if f[0] in by]
    return [f for f in fields if f[0] not in by] + sorted(last), by, layout.bucket_by, layout.buckets


def _rediscover(spark: SparkSession, table: str) -> None:
    """Take the partitions of the table's folder in place of those the entry had."""
    for spec in spark.sql(f"SHOW PARTITIONS {table}").collect():
        pairs = (p.partition("=") for p in spec[0].split("/"))
        values = ", ".join(f"{_quoted(_unescaped(k))} = '{_literal(_unescaped(v))}'" for k, _, v in pairs)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({values})")
    spark.sql(f"MSCK REPAIR TABLE {table} ADD PARTITIONS")


def _unescaped(text: str) -> str:
    return re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text)


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _point_parts(spark: SparkSession, table: str, state: Snapshot, since: int) -> None:
    """Partition locations as the state has them; those of versions up to ``since`` are there already."""
    shown = {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for part in shown - state.folders.keys():
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PART} = {part})")
    for part, folder in sorted(state.folders.items()):
        spec, place = f"PARTITION ({PART} = {part})", f"'{folder}/{PART}={part}'"
        if part not in shown:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION {place}")
        elif _version_of(folder) > since:
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {place}")


def _version_of(folder: str | None) -> int:
    found = re.search(r"/v-(\d+)-[0-9a-f]+/?$", folder or "")
    return int(found[1]) if found else 0


def read_state(spark: SparkSession, state: Snapshot, parts: list[int] | None = None) -> DataFrame:
    """The rows of one state, all of it or some parts, straight from its folders.

    Nothing a later writer does changes what is read.
    """
    if not state.layout.parts:
        return spark.read.format(state.file_format).schema(state.schema).load(state.home)
    chosen = {p: f for p, f in state.folders.items() if parts is None or int(p) in parts}
    bare = T.StructType([f for f in state.schema if f.name != PART])
    if not chosen:
        return spark.createDataFrame([], bare)
    places = [f"{folder}/{PART}={part}" for part, folder in sorted(chosen.items())]
    return spark.read.format(state.file_format).schema(bare).load(places)
