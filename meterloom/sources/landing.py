"""Reading landing files whose schemas drift.

Writers disagree about physical types: a batch without a fault has a
``fault_code`` column of no type, a batch of whole readings has integers. One
Parquet read over such files fails, whatever schema it is given. So the footers
are read first, in Spark tasks; files with the same footer signature are read
together by Spark's own reader, cast to the contract, and united.

About ``max_files`` paths are handled at a time, so what passes through the
driver is bounded; the files beyond it are handled in further rounds.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from typing import TYPE_CHECKING

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.functions import parse_double
from meterloom.operators.cleaning import INGESTED_AT, RUN_ID, SOURCE_FILE

if TYPE_CHECKING:
    from meterloom.presets import Dataset

LISTING = "path string, modificationTime timestamp, length bigint, content binary"
FOOTERS = "path string, signature string, columns array<string>, error string"
MAX_FILES = 10_000


def list_landing(spark: SparkSession, root: str) -> DataFrame:
    """The Parquet files below ``root``; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = reader.option("pathGlobFilter", "*.parquet").load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], LISTING)
    return files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "length")


def path_pattern(keys: Sequence[str]) -> str:
    return "/".join(f"{key}=([^/]+)" for key in keys) + "/"


def unescaped(text: Column) -> Column:
    """``%3A`` and the like as the characters they stand for; ``+`` stays ``+``."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def plain_path(file_path: Column) -> Column:
    """Spark's ``_metadata.file_path``, which is a URL, as listings have the path."""
    return F.regexp_replace(unescaped(file_path), "^file:/+", "file:/")


def path_key_columns(path: Column, keys: Sequence[str]) -> dict[str, Column]:
    """Partition values of a plain path; writers escape some characters in them."""
    pattern = path_pattern(keys)
    return {key: unescaped(F.regexp_extract(path, pattern, n + 1)) for n, key in enumerate(keys)}


def split_by_path(files: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Files that name their partition in the path, and those that do not."""
    named = F.col("path").rlike(path_pattern(keys))
    return files.where(named), files.where(~named)


def footers(files: DataFrame) -> DataFrame:
    """Per file: its schema signature and column names, or why it is unreadable.

    The function sent to the tasks holds all it needs, so executors do not have
    to have this package installed. Object stores are reached with the end point
    and keys of the session's ``fs.s3a`` settings.
    """
    hadoop = files.sparkSession.sparkContext._jsc.hadoopConfiguration()
    s3 = {
        "endpoint_override": hadoop.get("fs.s3a.endpoint"),
        "access_key": hadoop.get("fs.s3a.access.key"),
        "secret_key": hadoop.get("fs.s3a.secret.key"),
        "region": hadoop.get("fs.s3a.endpoint.region"),
    }
    s3 = {key: value for key, value in s3.items() if value}
    if hadoop.get("fs.s3a.connection.ssl.enabled") == "false":
        s3["scheme"] = "http"

    def read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        def locate(path):
            for scheme in ("s3a://", "s3n://", "s3://"):
                if path.startswith(scheme):
                    return fs.S3FileSystem(**s3), path[len(scheme):]
            if path.startswith("file:"):
                return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
            if "://" not in path:
                return fs.LocalFileSystem(), path
            return fs.FileSystem.from_uri(path)

        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    filesystem, inner = locate(path)
                    with filesystem.open_input_file(inner) as handle:
                        schema = pq.ParquetFile(handle).schema
                    columns = [schema.column(n) for n in range(len(schema))]
                    fields = sorted((c.path, c.physical_type, str(c.logical_type)) for c in columns)
                    names = sorted({name.split(".")[0] for name, _, _ in fields})
                    rows.append((path, json.dumps(fields), names, None))
                except Exception as error:  # noqa: BLE001 - every bad file is reported
                    rows.append((path, None, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=["path", "signature", "columns", "error"])

    # A listing is a few kilobytes in one task; opening its files is the work.
    tasks = files.sparkSession.sparkContext.defaultParallelism
    return files.select("path").repartition(tasks, "path").mapInPandas(read_footers, FOOTERS)


def drift_report(footer_rows: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Files whose columns differ from the contract: what is missing, what is extra."""
    contract = F.array(*map(F.lit, expected))
    report = footer_rows.where("error is null").select(
        "path",
        F.array_except(contract, "columns").alias("missing"),
        F.array_except("columns", contract).alias("extra"),
    )
    return report.where((F.size("missing") > 0) | (F.size("extra") > 0))


def conform(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Contract columns at their canonical type (null when missing), then the extra
    ones as text, so that batches which disagree about an extra column still make
    one table."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def canonical(name: str, kind: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast(kind)
        return parse_double(name, kinds[name]) if kind == "double" else F.col(name).cast(kind)

    def text(name: str) -> Column:
        nested = isinstance(kinds[name], (T.StructType, T.ArrayType, T.MapType))
        return F.to_json(name) if nested else F.col(name).cast("string")

    return df.select(
        *(canonical(name, kind).alias(name) for name, kind in contract.items()),
        *(text(name).alias(name) for name in df.columns if name not in contract),
    )


def unite(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column absent from one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stamp(df: DataFrame, source: Column, ingested_at: str, run_id: str) -> DataFrame:
    return df.withColumns(
        {SOURCE_FILE: source, INGESTED_AT: F.lit(ingested_at), RUN_ID: F.lit(run_id)}
    )


def _read_alike(
    spark: SparkSession, paths: Sequence[str], dataset: Dataset, ingested_at: str, run_id: str
) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "false")
    raw = reader.parquet(*paths)
    carried = raw.select("*", F.col("_metadata.file_path").alias("_file"))
    contract = {name: kind for name, kind in dataset.columns.items() if name not in dataset.path_keys}
    frame = conform(carried.drop(*dataset.path_keys), {**contract, "_file": "string"})
    frame = with_path_values(frame, raw.inputFiles(), dataset.path_keys)
    return stamp(frame, F.col("_path"), ingested_at, run_id).drop("_path")


def with_path_values(rows: DataFrame, urls: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Replaces ``_file``, the URL of a row's file, by ``_path``, the plain path, and its ``keys``.

    Paths are taken apart once per file of ``urls`` and looked up by the rows, since the patterns
    would cost a row more than its reading. The files of a round are bounded, so the
    lookup is broadcast. The path of a URL that is not listed is taken apart by its row.
    """

    def told(url: Column) -> dict[str, Column]:
        path = plain_path(url)
        return {"_path": path, **path_key_columns(path, keys)}

    url = F.col("_url")
    # Listings and rows may write the start of a local file's URL differently.
    plain = {re.sub("^file:/+", "file:/", each) for each in urls}
    known = sorted(plain | {re.sub("^file:/", "file:///", each) for each in plain})
    listed = rows.sparkSession.createDataFrame([(each,) for each in known], "_url string")
    listed = listed.select(url, F.struct(*(value.alias(name) for name, value in told(url).items())).alias("_told"))
    joined = rows.join(F.broadcast(listed), F.col("_file") == url, "left")
    values = {name: F.coalesce(F.col("_told")[name], value) for name, value in told(F.col("_file")).items()}
    return joined.withColumns(values).drop("_file", "_url", "_told")


def read_landing(
    spark: SparkSession, files: DataFrame, dataset: Dataset, ingested_at: str, run_id: str
) -> tuple[DataFrame | None, DataFrame]:
    """One bounded round of landing files as a single contract-typed DataFrame,
    and the report of the files that drift.

    Values in the path replace columns of the same name in the file. A file that
    cannot be read fails the round, and the error names all such files.
    """
    groups = footers(files).groupBy("signature").agg(
        F.collect_list("path").alias("paths"),
        F.collect_list("error").alias("errors"),
        F.first("columns").alias("columns"),
    ).collect()
    errors = [error for group in groups for error in group["errors"]]
    if errors:
        bad = [p for group in groups if group["signature"] is None for p in group["paths"]]
        listing = "\n".join(f"  {path}: {error}" for path, error in zip(bad, errors))
        raise RuntimeError(f"{len(bad)} landing file(s) cannot be read:\n{listing}")
    alike = [(path, group["columns"], None) for group in groups for path in group["paths"]]
    seen = spark.createDataFrame(alike, "path string, columns array<string>, error string")
    in_file = [name for name in dataset.columns if name not in dataset.path_keys]
    drift = drift_report(seen, in_file)
    if not groups:
        return None, drift
    rows = [_read_alike(spark, g["paths"], dataset, ingested_at, run_id) for g in groups]
    return unite(rows), drift
