"""Partitioned Parquet tables: scans, replay-safe appends, overwrites, compaction."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.operators.cleaning import RUN_ID
from meterloom.session import text_partition_values

PARTITIONS = (RUN_ID, "building_id", "dt")
MAX_RECORDS_PER_FILE = 5_000_000
MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def check_run_id(run_id: str) -> str:
    """Run ids are folder names, so they are kept to plain characters."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
        raise ValueError(f"run id {run_id!r} has characters other than letters, digits, _ . -")
    return run_id


def scan(
    spark: SparkSession,
    path: str,
    empty: T.StructType | str | None = None,
    merge_schema: bool = False,
) -> DataFrame | None:
    """The table at ``path``. A table not written yet is an empty DataFrame of
    the given schema, or None without one."""
    try:
        with text_partition_values(spark):
            return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in MISSING:
            raise
        return None if empty is None else spark.createDataFrame([], empty)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file system has this path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table or a folder of one, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def scan_folders(
    spark: SparkSession, path: str, column: str, values: Sequence[str]
) -> DataFrame | None:
    """Only the folders of the given values of the first partition column: the
    rest of the table is not even listed, and extra columns are merged over these
    footers alone. A value without rows has no folder; None if none has."""
    folders = [f"{path}/{column}={check_run_id(value)}" for value in values]
    folders = [folder for folder in folders if exists(spark, folder)]
    if not folders:
        return None
    with text_partition_values(spark):
        reader = spark.read.option("basePath", path).option("mergeSchema", "true")
        return reader.parquet(*folders)


def folder(spark: SparkSession, column: str, value: str | None) -> str:
    """The folder that Spark's writer gives a partition value, escaped as it does."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return names.getPartitionPathString(column, value)


def folder_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column`` that have a folder right below ``path``: one listing of it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    unescaped = context._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return [unescaped(name[len(column) + 1 :]) for name in names if name.startswith(f"{column}=")]


def scan_values(
    spark: SparkSession, path: str, column: str, values: Sequence[str], empty: T.StructType | str
) -> DataFrame:
    """Like :func:`scan_folders`, for values of any characters; ``empty`` is the schema
    of a table without these folders, and what is read otherwise."""
    folders = [f"{path}/{folder(spark, column, value)}" for value in values]
    folders = [found for found in folders if exists(spark, found)]
    if not folders:
        return spark.createDataFrame([], empty)
    with text_partition_values(spark):
        return spark.read.option("basePath", path).schema(empty).parquet(*folders)


def scan_runs(spark: SparkSession, path: str, run_ids: Sequence[str]) -> DataFrame | None:
    return scan_folders(spark, path, RUN_ID, run_ids)


def _laid_out(df: DataFrame, partition_by: Sequence[str], rebalance: bool) -> DataFrame:
    # Rebalancing gathers the rows of a folder into few files, and splits a folder
    # that holds too many rows over several tasks.
    return df.hint("rebalance", *partition_by) if rebalance and partition_by else df


def append_runs(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = PARTITIONS,
    rebalance: bool = False,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    observed: Observation | None = None,
) -> None:
    """Add runs to a table. Each run has folders of its own, and writing it again
    replaces them: a run that died after its data was written can be replayed.

    ``observed`` gets ``rows``, counted by the tasks that write; a task done twice counts once.
    """
    laid = _laid_out(df, partition_by, rebalance)
    if observed is not None:
        laid = laid.observe(observed, F.count(F.lit(1)).alias("rows"))
    writer = laid.write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.partitionBy(*partition_by).parquet(path)


def overwrite(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    touched_only: bool = False,
) -> None:
    """Replace a table, or with ``touched_only`` just the partitions in ``df``.

    ``df`` must not read from ``path``: its files go before the job ends.
    """
    writer = _laid_out(df, partition_by, rebalance).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic" if touched_only else "static")
    writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    partition_by: Sequence[str] = ("building_id", "dt"),
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Rewrite a table of many small files into few larger ones at a new path.

    A folder of any size is split over as many tasks as it needs.
    """
    if target.rstrip("/") == path.rstrip("/"):
        raise ValueError("compaction writes to a new path, never over its own input")
    table = scan(spark, path, merge_schema=True)
    if table is None:
        raise ValueError(f"no table at {path}")
    overwrite(table, target, partition_by, True, max_records_per_file)
