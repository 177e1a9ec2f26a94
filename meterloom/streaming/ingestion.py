"""Landing files as a stream: the checkpoint remembers which were ingested."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from meterloom.plans.lake import Lake, land_files
from meterloom.presets import Dataset
from meterloom.sources.landing import LISTING, MAX_FILES
from meterloom.streaming.batches import start_batches


def start_ingestion(
    lake: Lake,
    landing_root: str,
    dataset: Dataset,
    checkpoint: str,
    max_files: int = MAX_FILES,
    available_now: bool = True,
) -> StreamingQuery:
    """Ingest new landing files, at most ``max_files`` per micro-batch.

    A micro-batch is one run, named by the query's id and its number. When it is
    replayed after a failure it replaces its own folders, and a new checkpoint
    cannot meet the runs of an old one.
    """
    files = (
        lake.spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .load(landing_root)
        .select("path")
    )

    def land(batch: DataFrame, name: str) -> None:
        land_files(Lake(batch.sparkSession, lake.root), batch, dataset, name)

    return start_batches(files, checkpoint, land, available_now)
