"""Tables, scratch tables and names shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import meterloom

CHECKPOINT_DIR = "spark.checkpoint.dir"
ARROW_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000

#: A word is a longest run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local one only for a local master."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that driver and executors share")
    return local_root()


@functools.cache
def local_root() -> str:
    return tempfile.mkdtemp(prefix="meterloom-")


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as a table of the shared folder and read it back.

    Cuts the lineage and computes ``df`` once (``checkpoint()`` would do so twice).
    The table is deleted when it is released, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    table = spark.read.schema(df.schema).parquet(path)
    table.kept_at = path
    return table


def released(*tables: DataFrame) -> None:
    """Delete tables that :func:`kept` wrote; all that is computed from them must be written.

    The shuffle files behind them go as well, once the driver's JVM collects its garbage,
    which a driver with little to do puts off for half an hour.
    """
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.kept_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        context._jvm.System.gc()


@functools.cache
def _shipped(application: str) -> str:
    package = Path(meterloom.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="meterloom-code-")) / "meterloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    return str(archive)


def ship(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package, wherever they run."""
    context = spark.sparkContext
    archive = _shipped(context.applicationId)
    if Path(archive).name not in {Path(f).name for f in context._python_includes}:
        context.addPyFile(archive)


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers BATCH_ROWS at a time from here on.

    The JVM and the worker each hold a whole batch, several times over while it is
    converted; Spark's 10,000 rows of text are tens of megabytes for each.
    """
    if int(spark.conf.get(ARROW_ROWS)) > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, BATCH_ROWS)


def mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
