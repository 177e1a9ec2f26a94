"""Stages and daily reports over unbounded readings.

Stages without state run on the stream itself. Whatever looks at more than one row
works in micro-batches against tables of the stream's own: deduplication against an index of
the keys seen, by day; daily reports against mergeable partials, by period. A batch reads
what it brings and the days it touches, not the table so far. No event is too late, no row
without a readable time is left out, nothing is held in a state store, and files may come in
any order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterloom import presets as P
from meterloom.operators import cleaning, faults, kpis, quality
from meterloom.operators.partials import Mergeable
from meterloom.presets import Dataset
from meterloom.sources import tables
from meterloom.streaming.batches import BATCH, start_batches

#: A batch is one folder.
LAYOUT = (BATCH,)
#: Folder column of reports: the first characters of ``dt``.
PERIOD = "_period"
DAY, MONTH = 10, 7
#: Folder columns of partials, under ``PERIOD``: whose they are, and up to which batch.
STREAM, NUMBER = "_stream", "_number"
#: Folder column of the key index, and the folder of readings without a time.
KEY_DAY, NO_DAY = "_key_day", "none"
#: Number column of the key index; name of joined folders.
KEY_SECOND, JOINED = "_key_second", "joined"
#: Folders of a day in the key index that are joined into one.
KEY_FOLDERS = 16


def graded(readings: DataFrame, dataset: Dataset) -> DataFrame:
    """Stateless stages on a stream: the batch transforms, unchanged."""
    rows = quality.grade(cleaning.normalise(readings, dataset), dataset.rules)
    if dataset.name == P.HVAC.name:
        return kpis.hvac_kpis(faults.detect_faults(rows))
    return kpis.utility_kpis(rows)


def start_append(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's rows to a Parquet table, each exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append")
    return (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _add(batch: DataFrame, name: str, path: str) -> DataFrame | None:
    """Write a micro-batch to folders of its own and read it back."""
    tables.append_runs(batch.withColumn(BATCH, F.lit(name)), path, LAYOUT)
    return tables.scan_folders(batch.sparkSession, path, BATCH, [name])


def start_grading(
    readings: DataFrame, dataset: Dataset, root: str, checkpoint: str
) -> StreamingQuery:
    """Grade a stream into ``validated`` and copy critical rows to ``quarantine``.

    Both writes of a micro-batch go to folders of its name, so a replay replaces
    them; the readings keep their run ids. The quarantine reads the written
    table, not the stream again.
    """

    def write(batch: DataFrame, name: str) -> None:
        written = _add(batch, name, f"{root}/validated")
        if written is not None:
            tables.append_runs(quality.quarantined(written), f"{root}/quarantine", LAYOUT)

    return start_batches(graded(readings, dataset), checkpoint, write)


def _day() -> Column:
    """The day of a reading's own time; those without one share a folder."""
    return F.coalesce(F.substring(F.col("timestamp").cast("string"), 1, DAY), F.lit(NO_DAY)).alias(KEY_DAY)


def _second() -> Column:
    """The reading's second as a number, which file statistics can skip by."""
    return F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', timestamp)").alias(KEY_SECOND)


def key_table(rows: DataFrame, keys: Sequence[str]) -> str:
    """Schema of the key index of a table with the columns of ``rows``."""
    if "timestamp" not in keys:
        raise ValueError(f"keys {tuple(keys)} without the timestamp have no day to be looked up in")
    kinds = [f"`{key}` {rows.schema[key].dataType.simpleString()}" for key in keys]
    return ", ".join([*kinds, f"{KEY_SECOND} bigint", f"{KEY_DAY} string", f"{BATCH} string"])


def seen_keys(batch: DataFrame, keys: Sequence[str], index: str, name: str) -> DataFrame:
    """Keys that earlier batches hold in the time span of ``batch`` (normalised).

    The index has a folder per day, so a batch reads the days it has readings of; within
    them it is sorted by time, and statistics skip what lies outside the batch's span.
    One row per day reaches the driver.
    """
    spark, kinds = batch.sparkSession, key_table(batch, keys)
    second = F.col(KEY_SECOND)
    spans = batch.select(_day(), _second()).groupBy(KEY_DAY).agg(F.min(second).alias("low"), F.max(second).alias("high"))
    spans = spans.collect()
    days = [span[KEY_DAY] for span in spans]
    _tidy(spark, index, days, kinds, name)
    known = tables.scan_values(spark, index, KEY_DAY, days, kinds).where(F.col(BATCH) != name)
    lows = [span["low"] for span in spans if span["low"] is not None]
    if not lows:
        return known
    highs = [span["high"] for span in spans if span["high"] is not None]
    return known.where(second.isNull() | second.between(min(lows), max(highs)))


def _add_keys(rows: DataFrame, index: str) -> None:
    """Write (keys, second, day, batch) rows, each folder in files sorted by time."""
    laid = rows.hint("rebalance", KEY_DAY, BATCH).sortWithinPartitions(KEY_DAY, BATCH, KEY_SECOND)
    tables.append_runs(laid, index, (KEY_DAY, BATCH))


def _tidy(spark: SparkSession, index: str, days: Sequence[str], kinds: str, name: str) -> None:
    """Join the folders of days that many batches have added to.

    A joined folder holds what the old ones hold, and a key may be in an index twice, so it
    is written before they go, and a reader in between is not misled. The batch that is
    running takes no part: its folder is written again when it is replayed.
    """
    joined = f"{JOINED}-{name}"
    for day in days:
        place = f"{index}/{tables.folder(spark, KEY_DAY, day)}"
        held = [value for value in tables.folder_values(spark, place, BATCH) if value not in (name, joined)]
        if len(held) < KEY_FOLDERS:
            continue
        rows = tables.scan_values(spark, index, KEY_DAY, [day], kinds).where(F.col(BATCH).isin(held))
        _add_keys(rows.drop(BATCH).distinct().withColumn(BATCH, F.lit(joined)), index)
        for value in held:
            tables.drop(spark, f"{place}/{tables.folder(spark, BATCH, value)}")


def start_deduplication(
    readings: DataFrame, dataset: Dataset, root: str, checkpoint: str
) -> StreamingQuery:
    """Clean a stream into ``root``: one row per key over all batches.

    A key's first row may be any time ago: it is looked up in an index of the keys
    seen, of which a batch reads its own days only. Rows of a batch that is being replayed do
    not count as known. The index lies beside the table, in ``root``-keys.
    """
    keys = dataset.dedup_keys
    index = f"{root.rstrip('/')}-keys"

    def write(batch: DataFrame, name: str) -> None:
        rows = cleaning.normalise(batch, dataset)
        known = seen_keys(rows, keys, index, name)
        written = _add(cleaning.clean(batch, dataset, known=known), name, root)
        if written is not None:
            _add_keys(written.select(*keys, _second(), _day(), F.lit(name).alias(BATCH)), index)

    return start_batches(readings, checkpoint, write)


def add_partials(
    rows: DataFrame, report: Mergeable, path: str, name: str, period: int = DAY
) -> DataFrame:
    """Add a batch's rows to the partials at ``path``; returns those of the periods it touches.

    A period's folder holds, for each stream that adds to it, the merged partials up to a
    batch. A batch reads the last state before it of the periods it touches, adds its own,
    and writes the sum under its own number; a batch that is replayed finds the same state and
    writes the same sum. States before the one it was made from are of no more use and go.
    """
    spark = rows.sparkSession
    stream, number = name.rsplit("-", 1)
    own = report.partial(rows).withColumn(PERIOD, F.substring("dt", 1, period))
    layout = (PERIOD, STREAM, NUMBER)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields if f.name != PERIOD)
    kinds += "".join(f", {column} string" for column in layout)
    named = rows.dropna(subset=list(report.keys)).select(F.substring("dt", 1, period).alias(PERIOD))
    periods = [row[PERIOD] for row in named.distinct().collect()]
    before = tables.scan_values(spark, path, PERIOD, periods, kinds)
    before = before.where((F.col(STREAM) != stream) | (F.col(NUMBER) < number))
    states = before.select(*layout).distinct()
    last = states.groupBy(PERIOD, STREAM).agg(F.max(NUMBER).alias(NUMBER)).collect()
    old = [row for row in states.where(F.col(STREAM) == stream).collect() if tuple(row) not in {tuple(r) for r in last}]
    chosen = spark.createDataFrame([tuple(row) for row in last], ", ".join(f"{column} string" for column in layout))
    same = [F.col(f"state.{column}").eqNullSafe(F.col(f"chosen.{column}")) for column in layout]
    state = before.alias("state").join(chosen.alias("chosen"), reduce(Column.__and__, same), "left_semi")
    mine = state.where(F.col(STREAM) == stream).drop(STREAM, NUMBER).unionByName(own)
    summed = mine.groupBy(PERIOD, *report.by).agg(*report.sums())
    numbered = summed.withColumns({STREAM: F.lit(stream), NUMBER: F.lit(number)})
    tables.append_runs(numbered, path, layout, rebalance=True)
    for row in old:
        parts = "/".join(tables.folder(spark, column, row[column]) for column in layout)
        tables.drop(spark, f"{path}/{parts}")
    others = state.where(F.col(STREAM) != stream)
    written = tables.scan_values(spark, path, PERIOD, periods, kinds)
    return written.where((F.col(STREAM) == stream) & (F.col(NUMBER) == number)).unionByName(others)


def start_reports(
    readings: DataFrame,
    dataset: Dataset,
    root: str,
    checkpoint: str,
    reports: Mapping[str, Mergeable],
    period: int = DAY,
) -> StreamingQuery:
    """Grade a stream into ``silver`` and keep daily reports of it up to date.

    Every micro-batch is added to ``silver`` and reduced to partials; these are merged with
    the partials of the periods it touches, and the reports of those periods are finished from
    them and replaced. So a batch costs what it holds and what its periods' partials hold, however
    long the table is, and the reports are those of a batch run over all rows seen, whatever
    order they came in. A period is a folder of a report: a day, or a month where days hold few
    rows.
    """

    def write(batch: DataFrame, name: str) -> None:
        new = _add(batch, name, f"{root}/silver")
        if new is None:
            return
        for report, kind in reports.items():
            partials = add_partials(new, kind, f"{root}/partials/{report}", name, period)
            made = kind.report(partials).withColumn(PERIOD, F.substring("dt", 1, period))
            tables.overwrite(made, f"{root}/{report}", [PERIOD], touched_only=True)

    return start_batches(graded(readings, dataset), checkpoint, write)
