"""Records of whole runs and totals over datasets."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom import presets as P
from meterloom.functions import holds
from meterloom.functions.conditions import FLAG


def with_overall_status(runs: DataFrame, stages: Sequence[str] = P.STAGES) -> DataFrame:
    """A run succeeded when every stage did; skipped or cancelled is a failure."""
    done = reduce(Column.__and__, [holds(F.col(f"{s}_status") == "success") for s in stages])
    head = ["run_id", "triggered_by", "logged_at", "duration_seconds"]
    return runs.select(
        *head,
        F.when(done, "success").otherwise("failure").alias("overall_status"),
        *(f"{stage}_status" for stage in stages),
    )


def run_record(
    spark: SparkSession,
    run_id: str,
    triggered_by: str,
    duration_seconds: int,
    logged_at: str,
    statuses: Mapping[str, str],
    stages: Sequence[str] = P.STAGES,
) -> DataFrame:
    """The one row a finished run adds to the execution history."""
    missing = [stage for stage in stages if stage not in statuses]
    if missing:
        raise ValueError(f"no status for stage(s) {missing}")
    schema = "run_id string, triggered_by string, logged_at string, duration_seconds bigint, " + (
        ", ".join(f"{stage}_status string" for stage in stages)
    )
    row = (run_id, triggered_by, logged_at, duration_seconds, *(statuses[s] for s in stages))
    return with_overall_status(spark.createDataFrame([row], schema), stages)


def append_history(record: DataFrame, path: str) -> bool:
    """Append to an audit table that is never rewritten. The run itself is over,
    so a failed append is a warning, not an error."""
    try:
        record.coalesce(1).write.mode("append").parquet(path)
        return True
    except (PySparkException, Py4JJavaError) as error:
        warnings.warn(f"could not append to {path}: {error}", RuntimeWarning, stacklevel=2)
        return False


def stage_totals(graded: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and flag mix per dataset, and over all of them."""
    levels = ("clean", "warning", "critical")
    parts = [
        rows.agg(
            F.count(F.lit(1)).alias("total_rows"),
            *(F.count_if(F.col(FLAG) == level).alias(level) for level in levels),
        ).select(F.lit(name).alias("dataset"), "total_rows", *levels)
        for name, rows in graded.items()
    ]
    each = reduce(DataFrame.unionByName, parts)
    return each.rollup("dataset").agg(
        *(F.sum(name).alias(name) for name in ("total_rows", *levels))
    ).withColumn("dataset", F.coalesce("dataset", F.lit("all")))
