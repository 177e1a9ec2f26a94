"""What was processed already: append-only tables of ids.

A stage writes its data first and its ledger entry after. Should it die in
between, the same ids are processed again, and because a run's folders are
replaced (see ``append_runs``), nothing is doubled.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.sources.tables import scan


_APPEND = threading.Lock()


class Ledger:
    """The ids processed by one stage."""

    def __init__(self, spark: SparkSession, path: str, id_column: str):
        self.spark, self.path, self.id_column = spark, path, id_column

    @property
    def _renames(self) -> str:
        """Where renames are appended; files below a name with ``_`` are no part of the ledger."""
        return f"{self.path}/_renames_{self.id_column}"

    def _held(self) -> DataFrame:
        table = scan(self.spark, self.path, f"{self.id_column} string, committed_at timestamp")
        return table.where(F.col(self.id_column).isNotNull()).select(self.id_column)

    @property
    def _seen(self) -> str:
        """Where acknowledged ids are appended."""
        return f"{self.path}/_seen_{self.id_column}"

    def known(self) -> DataFrame:
        """Every id that was ever committed, acknowledged, or that ids were joined under."""
        held, renamed, seen = self._held(), scan(self.spark, self._renames), scan(self.spark, self._seen)
        if renamed is not None:
            held = held.union(renamed.select(F.col("new").alias(self.id_column)))
        if seen is not None:
            held = held.union(seen.select(self.id_column))
        return held.distinct()

    def ids(self) -> DataFrame:
        """The ids in force: renamed ones by their present name."""
        renamed = scan(self.spark, self._renames)
        if renamed is None:
            return self._held().distinct()
        new = renamed.select(F.col("new").alias(self.id_column))
        old = renamed.select(F.col("old").alias(self.id_column))
        return self._held().union(new).distinct().join(old, self.id_column, "left_anti")

    def _entries(self, ids: DataFrame) -> DataFrame:
        return ids.withColumn("committed_at", F.current_timestamp())

    def commit(self, ids: DataFrame) -> None:
        """Add ids, with whatever columns are to be kept beside them.

        Appends of one driver take turns: jobs that append to a folder at the same time share
        their temporary files.
        """
        with _APPEND:
            self._entries(ids).write.mode("append").parquet(self.path)

    def commit_values(self, values: Sequence[str]) -> None:
        rows = self.spark.createDataFrame([(v,) for v in values], f"{self.id_column} string")
        self.commit(rows.coalesce(1))

    def acknowledge(self, value: str) -> None:
        """Note an id as known that names nothing of this stage's own: the upstream joined
        what was processed here already under it."""
        entry = self.spark.createDataFrame([(value,)], f"{self.id_column} string").coalesce(1)
        self._entries(entry).write.mode("append").parquet(self._seen)

    def replace(self, ids: DataFrame) -> None:
        """Set the ledger to these ids; they must come from another table."""
        self._entries(ids).write.mode("overwrite").parquet(self.path)

    def rename(self, old: Sequence[str], new: str, number: int) -> None:
        """Put one id in the place of several.

        Nothing is rewritten: the mapping is appended in one file, which is there as a whole or
        not at all. ``number`` is the round of renames it belongs to.
        """
        rows = [(name, new, number) for name in old]
        entry = self.spark.createDataFrame(rows, "old string, new string, round int").coalesce(1)
        self._entries(entry).write.mode("append").parquet(self._renames)

    def last_round(self) -> tuple[int, list[str]]:
        """Number and replaced ids of the last round of renames; (0, []) before the first."""
        renamed = scan(self.spark, self._renames)
        if renamed is None:
            return 0, []
        number = renamed.agg(F.max("round")).first()[0] or 0
        return number, id_list(renamed.where(F.col("round") == number).select("old"), "old")


def only_new(df: DataFrame, processed: DataFrame, id_column: str) -> DataFrame:
    """Rows whose id is set and not processed yet.

    Spark broadcasts the ledger while it is under the broadcast threshold, which
    it checks, and otherwise shuffles, splitting ids that hold very many rows.
    """
    return df.where(F.col(id_column).isNotNull()).join(processed, id_column, "left_anti")


def new_ids(upstream: DataFrame, processed: DataFrame, id_column: str) -> DataFrame:
    return only_new(upstream.select(id_column).distinct(), processed, id_column)


def id_list(ids: DataFrame, id_column: str) -> list[str]:
    """The ids on the driver: one short string per run, never per row or file."""
    return sorted(row[id_column] for row in ids.select(id_column).distinct().collect())
