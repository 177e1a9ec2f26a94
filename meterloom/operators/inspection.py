"""Looking into graded tables: listings, breakdowns, samples, figure profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.functions.conditions import FLAG
from meterloom.operators.quality import ISSUES

#: Tasks that a flag is sorted in when its first rows are looked for.
SAMPLE_BUCKETS = 200


def with_severity(graded: DataFrame, severity: str = "any") -> DataFrame:
    if severity == "any":
        return graded.where(F.col(FLAG) != "clean")
    if severity not in ("warning", "critical"):
        raise ValueError(f"severity must be warning, critical or any, not {severity!r}")
    return graded.where(F.col(FLAG) == severity)


def flagged_rows(
    graded: DataFrame,
    id_column: str,
    severity: str = "any",
    limit: int = 25,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The first flagged rows; sorted and cut in the tasks, merged at the end."""
    shown = ["timestamp", "building_id", id_column, FLAG, ISSUES]
    order = list(order_by) or shown
    return with_severity(graded, severity).orderBy(*order).limit(limit).select(*shown)


def issue_histogram(graded: DataFrame, severity: str = "any") -> DataFrame:
    issues = with_severity(graded, severity).select(
        F.explode(F.split(ISSUES, ";")).alias("issue")
    )
    counted = issues.groupBy("issue").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.orderBy(F.desc("row_count"), "issue")


def top_partitions(
    graded: DataFrame,
    severity: str = "any",
    keys: Sequence[str] = ("building_id", "dt"),
    limit: int = 10,
) -> DataFrame:
    flagged = with_severity(graded, severity).dropna(subset=list(keys))
    counted = flagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.orderBy(F.desc("row_count"), *keys).limit(limit)


def kpi_null_profile(enriched: DataFrame, kpi_columns: Sequence[str]) -> DataFrame:
    """Per flag: rows, nulls per figure, and whether the flag's promise holds
    (critical: every figure null; otherwise: some figure present)."""
    nulls = {name: F.count_if(F.col(name).isNull()) for name in kpi_columns}
    grouped = enriched.groupBy(FLAG).agg(
        F.count(F.lit(1)).alias("row_count"),
        *(count.alias(f"{name}_nulls") for name, count in nulls.items()),
    )
    counts = [F.col(f"{name}_nulls") for name in kpi_columns]
    all_null = reduce(Column.__and__, [c == F.col("row_count") for c in counts])
    some_present = reduce(Column.__or__, [c < F.col("row_count") for c in counts])
    return grouped.withColumns(
        {
            "all_null": all_null,
            "any_populated": some_present,
            "as_expected": F.when(F.col(FLAG) == "critical", all_null).otherwise(some_present),
        }
    )


def flag_samples(
    enriched: DataFrame,
    id_column: str,
    kpi_columns: Sequence[str],
    limit: int = 5,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The first rows of each flag.

    Cut twice, with one scan: first to ``limit`` rows per flag and bucket of rows,
    then per flag, so no task sorts a whole flag, whatever the limit.
    """
    shown = [id_column, FLAG, *kpi_columns]
    order = list(order_by) or ["timestamp", *shown]
    bucket = F.pmod(F.xxhash64(*order), F.lit(SAMPLE_BUCKETS))

    def first(rows: DataFrame, *keys: str) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order)
        ranked = rows.withColumn("_rank", F.row_number().over(window))
        return ranked.where(F.col("_rank") <= limit).drop("_rank")

    part = first(enriched.withColumn("_bucket", bucket), FLAG, "_bucket")
    return first(part, FLAG).select(*shown)
