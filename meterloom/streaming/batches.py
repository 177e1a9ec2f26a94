"""Micro-batches with a name that outlives restarts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

#: Folder column of tables that streams write.
BATCH = "_stream_batch"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a query keeps over restarts, from its checkpoint."""
    line = spark.read.text(f"{checkpoint}/metadata").first()
    return json.loads(line["value"])["id"]


def start_batches(
    stream: DataFrame,
    checkpoint: str,
    work: Callable[[DataFrame, str], None],
    available_now: bool = True,
) -> StreamingQuery:
    """Call ``work`` with every micro-batch and its name.

    The name holds the query's id and the batch's number: a batch replayed after
    a failure has its old name, and a new checkpoint shares none with an old one.
    """

    def named(batch: DataFrame, number: int) -> None:
        work(batch, f"{query_id(batch.sparkSession, checkpoint)}-{number:08d}")

    writer = stream.writeStream.foreachBatch(named).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
