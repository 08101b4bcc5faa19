"""What the operators share: stored intermediate tables, Arrow batches, components, checks."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.session import ready_checkpoints, shared_dir

OUT_ROWS = 2000
# Rows of an Arrow batch: whole texts of ten thousand rows at once would be held by the JVM and by Python, twice each.
BATCH_ROWS = 1000
# Rows may be large themselves, as a block of an index is: a batch also ends with the row that passes so many bytes.
BATCH_BYTES = 8 << 20
# For rows of megabytes: Parquet would look at the size of a row group after a hundred rows, and readers take one whole.
ROW_BY_ROW = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false"}


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str, large: bool = False) -> DataFrame:
    """Write rows once into the cluster's shared folder and read them from there.

    Lost executors cost no recomputation of what went before. The folder goes when the session's
    JVM ends. ``large`` rows are written and read one at a time, however many a task has.
    """
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    rows.write.options(**(ROW_BY_ROW if large else {})).parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(rows.schema).parquet(path)


def small_batches(rows: DataFrame) -> None:
    """Have the session hand texts to Python in batches of bounded size; results do not depend on it."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_KEPT: dict = {}


def kept(name: str, make: Callable):
    """What an operator keeps in a worker process for its next task; see ``keeps`` of :func:`map_rows`."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def release(but: str | None = None) -> None:
    """Forget what other operators kept: workers live on, and stages of a pipeline would add up in them.

    What is free goes back to the system, as the C library and Arrow otherwise hold it for a next time.
    """
    gone = [x for x in _KEPT if x != but]
    for name in gone:
        del _KEPT[name]
    if gone:
        gc.collect()  # stores may refer to themselves
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_rows(
    rows: DataFrame,
    work: Callable[[Iterator[tuple]], Iterable[tuple]],
    schema: str | T.StructType,
    taken: int = 512,
    given: int = OUT_ROWS,
    keeps: str | None = None,
) -> DataFrame:
    """Run ``work`` over the rows of each partition, as a stream of tuples, through Arrow batches.

    Whole numbers beside NULLs stay exact, as no data frame library stands between. ``taken`` rows
    are Python objects at once and ``given`` are held back for a batch: few where a row is large.
    Of what is ``kept`` in a worker only ``keeps`` outlasts the start of a task.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = to_arrow_schema(struct)
    small_batches(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keeps)

        def tuples() -> Iterator[tuple]:
            for batch in batches:
                # Slices bound what a batch of long texts costs as Python objects.
                for start in range(0, batch.num_rows, taken):
                    piece = batch.slice(start, taken)
                    yield from zip(*(c.to_pylist() for c in piece.columns), strict=True)

        held: list[tuple] = []
        for row in work(tuples()):
            held.append(row)
            if len(held) == given:
                yield _batch(held, out)
                held = []
        if held:
            yield _batch(held, out)

    return rows.mapInArrow(run, struct)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def rewrite_text(rows: DataFrame, work: Callable[[Iterator[list]], Iterator[list]], text: str = "text") -> DataFrame:
    """Replace or drop rows by their text; every other column passes unread, whatever its name.

    ``work`` turns lists of texts into lists of the same length whose items are the new text, or
    ``DROP`` for rows that go.
    """
    place = rows.columns.index(text)
    small_batches(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                piece = batch.slice(start, 512)
                (made,) = work(iter([piece.column(place).to_pylist()]))
                keep = pa.array([x is not DROP for x in made])
                field = piece.schema.field(place)
                column = pa.array([None if x is DROP else x for x in made], type=field.type)
                yield piece.set_column(place, field, column).filter(keep)

    return rows.mapInArrow(run, rows.schema)


class _Drop:
    """Marks a row that goes; one object per process."""

    def __reduce__(self):
        return "DROP"


DROP = _Drop()


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys in which NULL equals NULL; the right side's keys are left out."""
    other = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    on = [left[k].eqNullSafe(other[f"__r_{k}"]) for k in keys]
    joined = left.join(other, on, how)
    return joined.drop(*[f"__r_{k}" for k in keys])


def marks(spots: DataFrame) -> DataFrame:
    """A bitmap of the longs ``spot``, well mixed, as rows ``__word, __bits``: 2**20 at most, for any number of spots."""
    bit = F.expr("shiftleft(1L, cast(spot & 63 as int))")
    return spots.groupBy(F.shiftrightunsigned("spot", 44).alias("__word")).agg(F.bit_or(bit).alias("__bits"))


def by_marks(rows: DataFrame, spot: Column, held: DataFrame, there: bool = True) -> DataFrame:
    """The rows whose ``spot`` is in the bitmap, which may be a few too many; or all others, which are not among its spots.

    The bitmap is broadcast, so that rows with whole texts are not moved to find those that matter.
    """
    seen = rows.withColumn("__spot", spot)
    seen = seen.join(F.broadcast(held), F.shiftrightunsigned("__spot", 44) == F.col("__word"), "inner" if there else "left")
    bit = F.expr("shiftrightunsigned(__bits, cast(__spot & 63 as int)) & 1L")
    return seen.where(F.coalesce(bit, F.lit(0)) == int(there)).drop("__spot", "__word", "__bits")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges ``a, b`` (longs): one row ``node, label``.

    The label is the smallest node of the component. Large stars and small stars alternate, which
    takes a logarithmic number of rounds; each star is a minimum per node with map-side combining
    and a join that run-time skew handling may split, so a node with very many links is not
    gathered. Lineage is cut by ``checkpoint`` each round. Self loops and repeats do no harm.
    """
    ready_checkpoints(edges.sparkSession)
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = links.distinct().checkpoint()
    before = _state(links)
    while before[0]:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        lower = small.withColumnRenamed("a", "n")
        moved = large.join(lower, large.a == lower.n).select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = moved.union(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct().checkpoint()
        after = _state(links)
        if after == before:
            break
        before = after
    leaves = links.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "node")
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return leaves.union(roots)


def _state(links: DataFrame) -> tuple:
    mix = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), mix).first())
