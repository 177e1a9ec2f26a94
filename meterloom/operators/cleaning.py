"""Types, missing values, text form and duplicates of raw readings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.functions import parse_double, parse_timestamp, strip, title_case

if TYPE_CHECKING:
    from meterloom.presets import Dataset

SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"
RUN_ID = "_pipeline_run_id"


def normalise(df: DataFrame, dataset: Dataset) -> DataFrame:
    """Cast, fill and format every contract column; no shuffle.

    Title case looks at its input several times, so it comes after the rest, in a
    projection of its own.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    present = [name for name in dataset.columns if name in kinds]
    parsed: dict[str, Column] = {}
    for name in present:
        if name == "timestamp":
            parsed[name] = parse_timestamp(name, kinds[name])
        elif name in dataset.measures:
            parsed[name] = parse_double(name, kinds[name])
        else:
            value = F.col(name).cast("string")
            if name in dataset.null_fill:
                value = F.coalesce(value, F.lit(dataset.null_fill[name]))
            parsed[name] = strip(value)
    if "dt" in kinds:
        parsed["dt"] = F.col("dt").cast("string")
    titled = {name: title_case(F.col(name)) for name in dataset.titled if name in present}
    return df.withColumns(parsed).withColumns(titled)


def survivor_order(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """First ingested first, then source file, then every other column.

    Rows that tie on all of it are equal, so any of them may stay: the result is
    the same on every run.
    """
    audit = [name for name in (INGESTED_AT, SOURCE_FILE) if name in df.columns]
    return audit + [name for name in df.columns if name not in audit and name not in keys]


def deduplicate(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    null_keys: str = "match",
) -> DataFrame:
    """One row per key: the first by ``order_by``.

    ``null_keys="match"`` treats missing keys as equal to each other;
    ``"keep"`` leaves rows with a missing key alone.

    ``row_number() = 1`` lets Spark keep one row per key in each map task before
    the shuffle (a partial group limit), so a key that holds a third of all rows
    sends one row per map task.
    """
    if null_keys not in ("match", "keep"):
        raise ValueError(f"null_keys must be 'match' or 'keep', not {null_keys!r}")
    order = [F.col(name) for name in (order_by or survivor_order(df, keys))]
    window = Window.partitionBy(*keys).orderBy(*order)

    def first(rows: DataFrame) -> DataFrame:
        ranked = rows.withColumn("_rank", F.row_number().over(window))
        return ranked.where(F.col("_rank") == 1).drop("_rank")

    if null_keys == "match":
        return first(df)
    anonymous = reduce(Column.__or__, [F.col(key).isNull() for key in keys])
    return first(df.where(~anonymous)).unionByName(df.where(anonymous))


def without_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``known`` yet (missing keys are equal).

    Both sides hold a key once when ``df`` is deduplicated and ``known`` is the
    table it goes to, so no key is hot. Only the keys of ``known`` are read.
    """
    left, right = df.alias("new"), known.select(*keys).alias("known")
    same = reduce(
        Column.__and__, [F.col(f"new.{key}").eqNullSafe(F.col(f"known.{key}")) for key in keys]
    )
    return left.join(right, same, "left_anti")


def clean(
    df: DataFrame,
    dataset: Dataset,
    null_keys: str = "match",
    known: DataFrame | None = None,
) -> DataFrame:
    """Raw readings to clean ones, one per key within ``df``.

    With ``known``, the table the rows go to, a key delivered before is dropped
    as well, which makes incremental loads equal to a rebuild.
    """
    rows = deduplicate(normalise(df, dataset), dataset.dedup_keys, null_keys=null_keys)
    return rows if known is None else without_known(rows, known, dataset.dedup_keys)


def dedup_counts(normalised: DataFrame, keys: Sequence[str], run_column: str = RUN_ID) -> DataFrame:
    """One row: rows in, rows out, duplicates removed, runs seen.

    Counted per key first, so the shuffle carries one row per key and map task.
    The runs, a handful of values, are counted on their own.
    """
    per_key = normalised.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    totals = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in"),
        F.count(F.lit(1)).alias("rows_out"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
    )
    runs = normalised.agg(F.count_distinct(run_column).alias("new_runs"))
    parts = totals.unionByName(runs, allowMissingColumns=True)
    return parts.agg(*(F.sum(name).alias(name) for name in parts.columns))
