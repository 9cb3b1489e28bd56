"""Streams over landed JSON Lines: dated landing, first-seen filter, repeated upsert.

All run with `trigger(availableNow=True)`: they take what has arrived and stop, and continue from
their checkpoint on the next run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from jobmeld.operators.upsert import JOB_KEYS, VERSIONS, fold, fold_versions, upsert, upsert_versions
from jobmeld.sources.jsonl import dated
from jobmeld.sources.store import SnapshotStore

# the batch number as a column of the changes put aside
SEQ = "_batch"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(path)


def land(items: DataFrame, root: str, checkpoint: str, spider: str, at: Column) -> StreamingQuery:
    """Append items below dated folders as JSON Lines, each exactly once (ST1)."""
    return (
        dated(items, spider, at)
        .writeStream.format("json")
        .partitionBy("year", "month", "day", "spider")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(root)
    )


def first_seen(items: DataFrame, keys: Sequence[str], event_time: str, within: str) -> DataFrame:
    """Items whose key was not seen within the watermark; state is dropped after it (ST2, DD5).

    Repeats close together are dropped where they are read: the stateful step sends every row it
    gets to the task of its key, and so gets at most one row per key and Arrow batch.
    """
    keys = list(keys)
    if isinstance(items.schema[event_time].dataType, T.TimestampNTZType):
        items = items.withColumn(event_time, F.col(event_time).cast("timestamp"))

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.select(keys).to_pandas().drop_duplicates().index
            yield batch.take(pa.array(first, pa.int64()))

    thinned = items.mapInArrow(thin, items.schema)
    return thinned.withWatermark(event_time, within).dropDuplicatesWithinWatermark(keys)


def upsert_stream(
    items: DataFrame,
    store: SnapshotStore,
    table: str,
    checkpoint: str,
    keys: Sequence[str] = JOB_KEYS,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Upsert what has arrived into a stored table and return the table (ST3).

    Later values win, nulls never do. What is later is said by the records' column `order`; then the table keeps,
    in `_versions`, the order of every value beside it, and the result is the same for any division into micro-batches and
    runs: a record that arrives late changes nothing that a later one said. Without such a column the batch number
    counts, and among the values of one batch the largest is taken as the last.

    Each micro-batch is only written aside, to a folder of its number, so a batch that runs again
    after a failure replaces itself. At the end all batches are folded and merged in one rewrite of the
    table's buckets that they have keys of, whatever their number.
    """
    pending = f"{checkpoint.rstrip('/')}-changes"

    def put_aside(batch: DataFrame, batch_id: int) -> None:
        src = prepare(batch) if prepare else batch
        src.write.mode("overwrite").parquet(f"{pending}/{SEQ}={batch_id}")

    (
        items.writeStream.foreachBatch(put_aside)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return merge_pending(store, table, pending, keys, order)


def merge_pending(
    store: SnapshotStore, table: str, pending: str, keys: Sequence[str] = JOB_KEYS, order: str | None = None
) -> DataFrame:
    """Merge the batches put aside into the table, then drop them.

    Should it stop before they are dropped, the next run merges them again, which changes nothing:
    the upsert is by key.
    """
    batches = store.folders(pending)
    if not batches:
        return store.read(table).drop(VERSIONS)
    changes = store.spark.read.option("basePath", pending).parquet(*batches)
    # the order column stays a column of the table
    changes = changes.withColumn(SEQ, F.col(order) if order else F.col(SEQ).cast("bigint"))
    if order:
        merged = store.merge(table, fold_versions(changes, SEQ, keys), keys, lambda dest, src: upsert_versions(dest, src, keys))
    else:
        merged = store.merge(table, fold(changes, SEQ, keys), keys, lambda dest, src: upsert(dest, src, keys))
    store.drop_folders(batches)
    return merged.drop(VERSIONS)
