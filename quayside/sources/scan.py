"""Scans of source tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = 2000


class Slices(NamedTuple):
    """An integer key range ``first..last`` cut into ``count`` slices of ``width`` keys."""

    first: int
    last: int
    count: int
    width: int


def key_slices(first: int, last: int, workers: int, batch: int = BATCH) -> Slices:
    """Cut a key range for ``workers`` readers, with at least one batch of keys per slice."""
    span = last - first + 1
    count = max(1, min(workers, -(-span // batch)))
    return Slices(first, last, count, -(-span // count))


def sliced(key: str, slices: Slices) -> Column:
    """The slice number of a row."""
    return F.call_function("div", F.col(key) - F.lit(slices.first), F.lit(slices.width)).cast("bigint")


def read_loose(
    spark: SparkSession, path: str, source_format: str, columns: list[str] | None = None, **options: str
) -> DataFrame:
    """Read files without guessing types.

    Text formats come with every column as a string, to be typed by ``operators.align``; the
    names must be given for formats without their own schema. Columnar files keep their types.
    """
    reader = spark.read.format(source_format).options(**options)
    if source_format in ("csv", "json"):
        if not columns:
            raise ValueError(f"{source_format} needs the column names")
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.load(path)


def jdbc_options(
    url: str,
    table: str,
    slices: Slices | None = None,
    key: str | None = None,
    batch: int = BATCH,
    **options: str,
) -> dict[str, str]:
    """Options of a JDBC scan.

    With an integer key the range is read slice by slice in parallel; the bounds only cut the
    range, rows outside them are read as well. Without one it is a single plain scan.
    """
    chosen = {"url": url, "dbtable": table, "fetchsize": str(batch), **options}
    if slices is not None and key is not None and slices.count > 1:
        chosen |= {
            "partitionColumn": key,
            "lowerBound": str(slices.first),
            "upperBound": str(slices.first + slices.width * slices.count),
            "numPartitions": str(slices.count),
        }
    return chosen


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    workers: int = 1,
    batch: int = BATCH,
    **options: str,
) -> DataFrame:
    """Scan a database table, in key slices when it has an integer row key.

    The first and the last key are two one-row lookups, never one aggregate over the table.
    """
    slices = None
    if key is not None and workers > 1:
        ends = []
        for direction in ("", " desc"):
            query = f"(select {key} as k from {table} order by {key}{direction} limit 1) ends"
            row = spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load().first()
            ends.append(None if row is None else int(row["k"]))
        if ends[0] is not None:
            slices = key_slices(ends[0], ends[1], workers, batch)
    return spark.read.format("jdbc").options(**jdbc_options(url, table, slices, key, batch, **options)).load()


def remainder_predicates(expression: str, count: int) -> list[str]:
    """Conditions that cut a table without a row key into disjoint, complete parts.

    ``expression`` is an integer in the database's SQL, such as a hash of a column.
    """
    parts = [f"mod(abs({expression}), {count}) = {i}" for i in range(count)]
    parts[0] = f"({parts[0]} or {expression} is null)"
    return parts


def read_jdbc_parts(
    spark: SparkSession, url: str, table: str, predicates: list[str], **options: str
) -> DataFrame:
    """Scan a database table in parallel by given conditions."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def write_jdbc(rows: DataFrame, url: str, table: str, batch: int = BATCH, **options: str) -> None:
    """Append typed rows to a database table in batches, one connection per partition."""
    chosen = {"url": url, "dbtable": table, "batchsize": str(batch), **options}
    rows.write.format("jdbc").options(**chosen).mode("append").save()
