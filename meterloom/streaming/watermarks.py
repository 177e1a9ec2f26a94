"""Deduplication under a watermark, with a side table of late readings instead of loss.

Spark's watermark lets a state store forget keys, at the price that late rows vanish. Here
a first query judges every reading: one that is no more than ``delay`` seconds behind the newest
reading up to its own micro-batch is on time, the others and those without a readable time are
late. Both go to one table, each side in folders of its own. A second query deduplicates
the on-time side with a RocksDB state store that holds the keys of the last ``delay`` seconds.

A reading that is on time here is on time there, however its files are cut into micro-batches:
that query's watermark is made from the same or fewer readings. And a key that comes again
on time has the time it had before, so its state is still there: on-time keys stay once.
:func:`settled` adds the keys that only late readings hold.

The state is bounded by the delay, not by the table; where no bound on lateness is known, the
key index of ``stages.start_deduplication`` needs none.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterloom.operators import cleaning
from meterloom.presets import Dataset
from meterloom.sources import tables
from meterloom.streaming.batches import BATCH, start_batches

#: Folder column of judged readings, and its values.
SIDE, ON_TIME, LATE = "_side", "on_time", "late"
#: A reading's second as a number: free of time zones and of their gaps.
SECOND, EVENT = "_second", "_event"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _with_second(rows: DataFrame) -> DataFrame:
    second = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', timestamp)"
    return rows.withColumn(SECOND, F.expr(second))


def _mark(batch: DataFrame, dataset: Dataset, path: str, name: str) -> int | None:
    """The newest second up to this batch, kept for the next one; None before the first.

    A batch reads the mark of the one before it, so a replayed batch finds the same.
    """
    spark, (stream, number) = batch.sparkSession, name.rsplit("-", 1)
    before = f"{stream}-{int(number) - 1:08d}"
    times = _with_second(cleaning.normalise(batch.select("timestamp"), dataset)).select(SECOND)
    earlier = tables.scan_values(spark, path, BATCH, [before], f"{SECOND} bigint, {BATCH} string")
    newest = times.unionByName(earlier.select(SECOND)).agg(F.max(SECOND)).first()[0]
    kept = spark.createDataFrame([(newest, name)], f"{SECOND} bigint, {BATCH} string")
    tables.append_runs(kept.coalesce(1), path, (BATCH,))
    return newest


def start_judging(
    readings: DataFrame, dataset: Dataset, root: str, checkpoint: str, delay: int
) -> StreamingQuery:
    """Clean each micro-batch and lay it out in ``root``/judged, on time or late."""

    def write(batch: DataFrame, name: str) -> None:
        newest = _mark(batch, dataset, f"{root}/marks", name)
        rows = _with_second(cleaning.clean(batch, dataset))
        # A watermark takes what is exactly as old as the delay for late.
        fresh = F.col(SECOND) > F.lit(newest).cast("bigint") - F.lit(delay)
        side = F.when(fresh, F.lit(ON_TIME)).otherwise(F.lit(LATE))
        named = rows.withColumns({SIDE: side, BATCH: F.lit(name)})
        tables.append_runs(named, f"{root}/judged", (SIDE, BATCH), rebalance=True)

    return start_batches(readings, checkpoint, write)


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session stays as it was."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def _judged_schema(readings: DataFrame, dataset: Dataset) -> T.StructType:
    fields = cleaning.normalise(readings, dataset).schema.fields
    own = [T.StructField(SECOND, T.LongType()), *(T.StructField(c, T.StringType()) for c in (SIDE, BATCH))]
    return T.StructType([*(T.StructField(f.name, f.dataType) for f in fields), *own])


def start_within_watermark(
    readings: DataFrame, dataset: Dataset, root: str, checkpoint: str, delay: int
) -> StreamingQuery:
    """Write the on-time side of ``root``/judged to ``root``/table, one row per key.

    ``readings`` gives the columns only. Of a key that several micro-batches hold, the row that this
    query meets first stays; within a micro-batch, the first in the batch order of ``clean``.
    """
    spark, place = readings.sparkSession, f"{root}/judged"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    judged = spark.readStream.schema(_judged_schema(readings, dataset)).parquet(place)
    timed = judged.where(F.col(SIDE) == ON_TIME).withColumn(EVENT, F.timestamp_seconds(SECOND))
    first = timed.withWatermark(EVENT, f"{delay} seconds").dropDuplicatesWithinWatermark(list(dataset.dedup_keys))
    writer = first.drop(EVENT, SECOND, SIDE, BATCH).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", f"{root}/table").option("checkpointLocation", checkpoint)
    with rocksdb(spark):
        return writer.trigger(availableNow=True).start()


def _read(spark: SparkSession, path: str, kinds: T.StructType) -> DataFrame:
    """A table of known columns; one that nothing was written to yet is empty."""
    if not tables.exists(spark, path):
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(path)


def late_readings(readings: DataFrame, dataset: Dataset, root: str) -> DataFrame:
    """The side table; ``readings`` gives the columns."""
    judged = _read(readings.sparkSession, f"{root}/judged", _judged_schema(readings, dataset))
    return judged.where(F.col(SIDE) == LATE).drop(SECOND, SIDE, BATCH)


def settled(readings: DataFrame, dataset: Dataset, root: str) -> DataFrame:
    """Every key once: the on-time table, and the late readings of keys it does not hold."""
    late = late_readings(readings, dataset, root)
    kinds = T.StructType([T.StructField(f.name, f.dataType) for f in late.schema.fields])
    table = _read(readings.sparkSession, f"{root}/table", kinds)
    first = cleaning.deduplicate(late, dataset.dedup_keys)
    return table.unionByName(cleaning.without_known(first, table, dataset.dedup_keys))
