"""Session settings the toolkit relies on.

A cluster brings its own session; :func:`tune` sets on it what results depend on.
:func:`local_session` is for tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Result-relevant: timestamps are UTC; a failed cast is an error unless `try_` is used.
_SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Plan-relevant: run-time re-planning, splitting of skewed join partitions, and no fused stages
# larger than the JVM compiles (a wide typed load would otherwise run interpreted).
_PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# For rows from bytes to megabytes in order. Parquet would look at the size of a row group after hundreds or thousands of
# them; it holds the group until then, and so does a reader, as columns.
UNEVEN_ROWS = {
    "parquet.block.size": str(4 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "8",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to an existing session and return it."""
    for key, value in {**_SEMANTICS, **_PLANNING}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", name: str = "quayside") -> SparkSession:
    """A local session for tests and the benchmark."""
    width = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUAYSIDE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(width))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="quayside-warehouse-"))
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    That is ``spark.checkpoint.dir``, else the folder given to ``setCheckpointDir``. A temporary
    folder is made only for a local master; elsewhere a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quayside-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def delete_at_exit(spark: SparkSession, path: str) -> str:
    """Have a folder removed when the session's JVM ends; returns the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def ready_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding the cluster's own folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def stored(rows: DataFrame, name: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Write rows once into the cluster's shared folder and read them from there.

    Lost executors cost no recomputation of what went before, and later steps read the columns they
    need. ``checkpoint`` computes its rows twice; it is left for those that Parquet does not hold. The
    folder goes when the session's JVM ends. ``options`` are those of Parquet.
    """
    spark = rows.sparkSession
    kinds = rows.schema.simpleString()
    if "void" in kinds or "interval" in kinds or len({c.lower() for c in rows.columns}) < len(rows.columns):
        ready_checkpoints(spark)
        return rows.checkpoint()
    path = delete_at_exit(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    rows.write.options(**(options or {})).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
