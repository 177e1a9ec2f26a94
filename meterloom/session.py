"""Session settings the library is written for, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"
CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    # Naive timestamps are UTC by convention.
    "spark.sql.session.timeZone": "UTC",
    # `dt=2026-01-01` and `building_id=007` must stay strings.
    INFERENCE: "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Recording the call site of every Column doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Listing many landing folders is itself a Spark job beyond this many paths.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
}


def build_session(app_name: str = "meterloom", master: str | None = None, **extra) -> SparkSession:
    """Get or create a session; ``extra`` overrides, with ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Set the session's shuffle partitions for work on these tables, by their bytes.

    AQE merges partitions that turn out small and never adds any, so the initial
    number has to fit the input.
    """
    context = spark.sparkContext
    total = 0
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(context._jsc.hadoopConfiguration())
        total += files.getContentSummary(place).getLength()
    wanted = shuffle_partitions_for(total, context.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", wanted)
    return wanted


def shuffle_partitions_for(input_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Initial shuffle partitions: about ``target_bytes`` each, a whole number of
    waves over ``cores``. AQE merges the small ones afterwards."""
    wanted = max(1, -(-input_bytes // target_bytes))
    waves = -(-wanted // cores)
    return waves * cores


_INFERENCE = threading.RLock()


@contextlib.contextmanager
def text_partition_values(spark: SparkSession):
    """Resolve a read with partition values kept as text, whatever the session says."""
    with _INFERENCE:
        before = spark.conf.get(INFERENCE)
        spark.conf.set(INFERENCE, "false")
        try:
            yield
        finally:
            spark.conf.set(INFERENCE, before)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables and stream checkpoints, deleted when
    the driver ends.

    A cluster names the shared folder in ``spark.checkpoint.dir``. Only where it
    is unset and the master is local, as in tests, a folder of this machine is used:
    on a cluster executors and driver would not see each other's files.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        folder = f"{shared.rstrip('/')}/meterloom-{purpose}-{uuid.uuid4().hex}"
    elif spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix=f"meterloom-{purpose}-")
    else:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that driver and executors share")
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)
    return folder
