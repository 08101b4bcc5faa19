"""Following a growing source: micro-batches replaced into a published table by key.

Deletes cannot be seen in an append-only stream; a batch upsert mirrors those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.operators.load import insert_replace
from quayside.sources.publish import commit_folder, in_parts, latest, part_of
from quayside.sources.snapshots import APPLIED, PART, ConcurrentPublish, Layout, new_folder, read_state, state_of

PARTS = 64
TRIES = 5  # merges of one batch when other writers keep committing first


def catch_up(
    changes: DataFrame,
    table: str,
    base: str,
    key: Sequence[str],
    sequence: str,
    checkpoint: str,
    listed: Sequence[str] | None = None,
    defaults: Mapping[str, Column] | None = None,
    available_now: bool = True,
    parts: int = PARTS,
) -> StreamingQuery:
    """Replace streamed rows into ``table``, the last row per key by ``sequence`` winning.

    The sequence a row was last replaced at stays in the table, so a late row replaces nothing,
    whichever batch brings it. Rows of the first state are older than any streamed one.

    The first batch divides the table into ``parts`` by a hash of the key. From then on a batch reads
    and rewrites only the parts its keys are in; a part of any size is written by as many tasks as
    its rows call for. A batch is one commit of the table (``sources.snapshots``), so it is there
    as a whole or not at all for those who read by ``sources.latest``; the catalog's own entry is
    switched part by part after the commit. A batch that is delivered again changes nothing. When
    another writer commits first, the batch is merged again, into that writer's state.
    Replaced files are left to whoever knows the readers.
    """

    def apply(rows: DataFrame, batch: int) -> None:
        for left in reversed(range(TRIES)):
            try:
                return merge(rows, batch)
            except ConcurrentPublish:
                if not left:
                    raise

    def merge(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        latest(spark, table)  # a commit whose writer died before the catalog knew is shown first
        state = state_of(spark, table)[1]
        if batch <= state.batch or rows.isEmpty():
            return
        divided = bool(state.layout.parts)
        layout = state.layout if divided else Layout(key=tuple(key), parts=parts)
        if layout.key != tuple(key):
            raise ValueError(f"{table} is divided by {list(layout.key)}, not by {list(key)}")
        kept = None
        if divided:
            kinds = {f.name: f.dataType for f in state.schema}
            keys = rows.select(*[F.col(f"`{k}`").cast(kinds[k]).alias(k) for k in key])
            touched = [r[0] for r in keys.select(part_of(keys, layout).alias("p")).distinct().collect()]  # part numbers
            old = read_state(spark, state, touched)
            kept = {p: f for p, f in state.folders.items() if int(p) not in touched}
        else:
            old = latest(spark, table).withColumn(APPLIED, F.lit(None).cast(rows.schema[sequence].dataType))
        own = [c for c in old.columns if c != APPLIED]
        merged = insert_replace(
            rows, old, sequence, pk=key, listed=listed or own, defaults=defaults, table=table, applied=APPLIED
        )
        placed = in_parts(merged, layout)
        folder = new_folder(base, state.version + 1)
        placed.write.format(state.file_format).partitionBy(PART).save(folder)
        commit_folder(spark, table, base.rstrip("/"), state, folder, placed, layout, batch, state.file_format, kept)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
