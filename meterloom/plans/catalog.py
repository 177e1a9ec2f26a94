"""The registered queries: each takes a session and a table folder.

All of them start from whole tables, through the raw feeds of ``views``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom import presets as P
from meterloom.operators import (
    cleaning,
    dimensions,
    faults,
    inspection,
    kpis,
    monitoring,
    partials,
    quality,
    rollups,
    sketches,
)
from meterloom.operators.cleaning import RUN_ID
from meterloom.plans import views
from meterloom.plans.lake import (
    Lake,
    advance_all,
    build_gold,
    compact_all,
    ingest,
    rebuild,
    refresh_gold,
)
from meterloom.session import scratch_folder
from meterloom.sources import landing, ledger, tables
from meterloom.streaming import stages, watermarks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Files a micro-batch takes; files may come in any order.
FILES_PER_BATCH = 64
#: Seconds that a reading may be behind the newest one: fifteen days.
WATERMARK_DELAY = 15 * 86_400


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- layers ---------------------------------------------------------------
def hvac_normalised(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.normalise(views.hvac_raw(spark, d), P.HVAC)


def utility_normalised(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.normalise(views.utility_raw(spark, d), P.UTILITY)


@query
def hvac_clean(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean(views.hvac_raw(spark, d), P.HVAC)


@query
def utility_clean(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean(views.utility_raw(spark, d), P.UTILITY)


@query
def hvac_dedup_counts(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.dedup_counts(hvac_normalised(spark, d), P.HVAC.dedup_keys)


@query
def utility_dedup_counts(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.dedup_counts(utility_normalised(spark, d), P.UTILITY.dedup_keys)


@query
def hvac_new_rows(spark: SparkSession, d: str) -> DataFrame:
    """Table-wide deduplication: clean rows whose key the first run did not bring."""
    first_run = hvac_normalised(spark, d).where(F.col(RUN_ID) == "run-1")
    known = first_run.select(*P.HVAC.dedup_keys).distinct()
    return cleaning.clean(views.hvac_raw(spark, d), P.HVAC, known=known)


# --- quality ----------------------------------------------------------------
@query
def hvac_dq_flags(spark: SparkSession, d: str) -> DataFrame:
    return quality.grade(hvac_clean(spark, d), P.HVAC.rules)


@query
def utility_dq_flags(spark: SparkSession, d: str) -> DataFrame:
    return quality.grade(utility_clean(spark, d), P.UTILITY.rules)


@query
def hvac_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return quality.quarantined(hvac_dq_flags(spark, d))


@query
def utility_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return quality.quarantined(utility_dq_flags(spark, d))


@query
def hvac_flag_mix(spark: SparkSession, d: str) -> DataFrame:
    return quality.flag_mix(hvac_dq_flags(spark, d))


@query
def utility_dq_run_log(spark: SparkSession, d: str) -> DataFrame:
    graded = quality.grade(utility_normalised(spark, d), P.UTILITY.rules)
    return quality.run_log(
        graded, P.UTILITY.dedup_keys, "run-check", "2026-01-01T00:00:00+00:00"
    )


@query
def hvac_duplicate_audit(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_audit(hvac_normalised(spark, d), P.HVAC.dedup_keys)


@query
def lineitem_duplicate_audit(spark: SparkSession, d: str) -> DataFrame:
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    return quality.duplicate_audit(lines, ["l_orderkey", "l_linenumber"])


# --- inspection -------------------------------------------------------------
@query
def hvac_flagged_rows(spark: SparkSession, d: str) -> DataFrame:
    return inspection.flagged_rows(hvac_dq_flags(spark, d), P.HVAC.id_column)


@query
def hvac_issue_histogram(spark: SparkSession, d: str) -> DataFrame:
    return inspection.issue_histogram(hvac_dq_flags(spark, d))


@query
def utility_issue_histogram(spark: SparkSession, d: str) -> DataFrame:
    return inspection.issue_histogram(utility_dq_flags(spark, d))


@query
def utility_top_partitions(spark: SparkSession, d: str) -> DataFrame:
    return inspection.top_partitions(utility_dq_flags(spark, d))


@query
def hvac_kpi_null_profile(spark: SparkSession, d: str) -> DataFrame:
    return inspection.kpi_null_profile(hvac_kpis(spark, d), P.HVAC.kpi_columns)


@query
def utility_kpi_null_profile(spark: SparkSession, d: str) -> DataFrame:
    return inspection.kpi_null_profile(utility_kpis(spark, d), P.UTILITY.kpi_columns)


@query
def hvac_flag_samples(spark: SparkSession, d: str) -> DataFrame:
    return inspection.flag_samples(hvac_kpis(spark, d), P.HVAC.id_column, P.HVAC.kpi_columns)


# --- signals and figures ----------------------------------------------------
@query
def hvac_faults(spark: SparkSession, d: str) -> DataFrame:
    return faults.detect_faults(hvac_dq_flags(spark, d))


@query
def hvac_fault_counts(spark: SparkSession, d: str) -> DataFrame:
    return faults.fault_counts(hvac_faults(spark, d))


@query
def hvac_kpis(spark: SparkSession, d: str) -> DataFrame:
    return kpis.hvac_kpis(hvac_faults(spark, d))


@query
def utility_kpis(spark: SparkSession, d: str) -> DataFrame:
    return kpis.utility_kpis(utility_dq_flags(spark, d))


@query
def utility_enriched_count(spark: SparkSession, d: str) -> DataFrame:
    return kpis.enriched_count(utility_kpis(spark, d))


# --- reports ------------------------------------------------------------------
@query
def hvac_daily_summary(spark: SparkSession, d: str) -> DataFrame:
    return rollups.hvac_daily_summary(hvac_kpis(spark, d))


@query
def hvac_daily_summary_by_join(spark: SparkSession, d: str) -> DataFrame:
    return rollups.hvac_daily_summary_by_join(hvac_kpis(spark, d))


@query
def utility_daily_summary(spark: SparkSession, d: str) -> DataFrame:
    return rollups.utility_daily_summary(utility_kpis(spark, d))


@query
def utility_daily_summary_by_join(spark: SparkSession, d: str) -> DataFrame:
    return rollups.utility_daily_summary_by_join(utility_kpis(spark, d))


@query
def equipment_daily(spark: SparkSession, d: str) -> DataFrame:
    return rollups.equipment_daily(hvac_faults(spark, d))


@query
def equipment_daily_by_join(spark: SparkSession, d: str) -> DataFrame:
    return rollups.equipment_daily_by_join(hvac_faults(spark, d))


@query
def alarm_log(spark: SparkSession, d: str) -> DataFrame:
    return rollups.alarm_log(hvac_kpis(spark, d))


# --- dimensions -----------------------------------------------------------------
@query
def dim_building(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.dim_building(hvac_normalised(spark, d), utility_normalised(spark, d))


@query
def dim_equipment(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.dim_equipment(hvac_normalised(spark, d))


@query
def dim_meter(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.dim_meter(utility_normalised(spark, d))


@query
def dim_date(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.dim_date_of(views.utility_raw(spark, d))


@query
def alarm_star(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.alarm_star(alarm_log(spark, d), dimensions.dim_alarm_type(spark))


# --- ingestion ------------------------------------------------------------------
@query
def incremental_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the runs after the first, which a ledger says is done."""
    raw = views.utility_raw(spark, d)
    done = raw.agg(F.min(RUN_ID).alias(RUN_ID))
    return ledger.only_new(raw, done, RUN_ID)


@query
def schema_contract_union(spark: SparkSession, d: str) -> DataFrame:
    """Two feeds that agree on little, under one contract; the extra column stays."""
    first = views.hvac_raw(spark, d).drop("dt", "_source_file", "_ingested_at", RUN_ID)
    second = spark.read.parquet(f"{d}/orders.parquet").select(
        F.col("o_orderdate").cast("string").alias("timestamp"),
        F.concat(F.lit("AHU-O"), "o_custkey").alias("equipment_id"),
        F.lit("B0").alias("building_id"),
        F.col("o_custkey").alias("return_air_temp"),
        F.col("o_orderkey").alias("firmware"),
    )
    return landing.unite([landing.conform(part, P.HVAC.columns) for part in (first, second)])


def _lake(spark: SparkSession, d: str) -> Lake:
    """Write the raw HVAC feed as landing files of drifting schemas; ingest them."""
    root = scratch_folder(spark, "lake")
    raw = views.hvac_raw(spark, d).drop("_source_file", "_ingested_at")
    early = F.col(RUN_ID) <= "run-2"
    drifted = (
        raw.where(early).withColumn("firmware", F.lit(7)),
        raw.where(~early).drop("outdoor_air_temp").withColumn("fault_code", F.lit(None).cast("int")),
    )
    for rows in drifted:
        writer = rows.drop(RUN_ID).hint("rebalance", "building_id", "dt").write.mode("append")
        writer.partitionBy("building_id", "dt").parquet(f"{root}/landing")
    lake = Lake(spark, root)
    ingest(lake, f"{root}/landing", P.HVAC)
    return lake


@query
def lake_hvac_bronze(spark: SparkSession, d: str) -> DataFrame:
    """What arrives in bronze from landing files whose schemas drift."""
    bronze = _lake(spark, d).table("bronze", P.HVAC)
    return bronze.groupBy("building_id", "dt").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count("outdoor_air_temp").alias("outdoor_readings"),
        F.count("fault_code").alias("fault_codes"),
        F.count_distinct("equipment_id").alias("raw_units"),
    )


@query
def lake_drift(spark: SparkSession, d: str) -> DataFrame:
    """What ingestion says about files that do not hold the contract's columns."""
    lake = _lake(spark, d)
    drift = tables.scan(spark, lake.path("drift", P.HVAC.name))
    files = drift.withColumns(landing.path_key_columns(F.col("path"), P.HVAC.path_keys))
    return files.groupBy("building_id", "dt").agg(
        F.max(F.array_join("missing", ",")).alias("missing"),
        F.max(F.array_join("extra", ",")).alias("extra"),
    )


def _deliver(spark: SparkSession, d: str, root: str, part: str = "true", prefix: str = "") -> None:
    """Write part of the raw HVAC feed to the landing folder."""
    raw = views.hvac_raw(spark, d).drop("_source_file", "_ingested_at", RUN_ID).where(part)
    raw = raw.withColumn("building_id", F.concat(F.lit(prefix), "building_id"))
    writer = raw.hint("rebalance", "building_id", "dt").write.mode("append")
    writer.partitionBy("building_id", "dt").parquet(f"{root}/landing")


#: The two deliveries of the lake queries.
EARLY = "substr(dt, 9, 2) <= '15'"
#: All other rows, those without a day too.
LATE = f"NOT coalesce({EARLY}, false)"


def _gold(lake: Lake) -> DataFrame:
    return tables.scan(lake.spark, lake.path("gold", "hvac_daily_summary"))


def _take_in(lake: Lake, d: str, part: str) -> None:
    """Deliver, ingest and carry through to gold."""
    _deliver(lake.spark, d, lake.root, part)
    ingest(lake, f"{lake.root}/landing", P.HVAC)
    advance_all(lake, [P.HVAC], dedup_scope="table")
    refresh_gold(lake)


@query
def lake_hvac_gold(spark: SparkSession, d: str) -> DataFrame:
    """The daily summary after a trip through every layer on disk."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    _deliver(spark, d, lake.root)
    ingest(lake, f"{lake.root}/landing", P.HVAC)
    advance_all(lake, [P.HVAC])
    build_gold(lake)
    return _gold(lake)


@query
def lake_odd_paths(spark: SparkSession, d: str) -> DataFrame:
    """Buildings whose names writers and listings escape, and the source files."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    _deliver(spark, d, lake.root, prefix="Main Hall 50%+:")
    ingest(lake, f"{lake.root}/landing", P.HVAC)
    landed = lake.finished("bronze", P.HVAC).join(
        lake.files(P.HVAC).ids().withColumnRenamed("path", "_source_file"), "_source_file"
    )
    return landed.groupBy("building_id", "dt").agg(F.count(F.lit(1)).alias("readings"))


@query
def lake_replay(spark: SparkSession, d: str) -> DataFrame:
    """Gold when the first ingestion died before its ledger was written, was
    called again, and a second delivery followed."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    _deliver(spark, d, lake.root, EARLY)
    ingest(lake, f"{lake.root}/landing", P.HVAC)
    tables.drop(spark, lake.files(P.HVAC).path)
    ingest(lake, f"{lake.root}/landing", P.HVAC)
    advance_all(lake, [P.HVAC], dedup_scope="table")
    refresh_gold(lake)
    _take_in(lake, d, LATE)
    return _gold(lake)


@query
def lake_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """Gold of a lake that got half of its files twice and was rebuilt from landing."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    for part in (LATE, "true"):
        _deliver(spark, d, lake.root, part)
        ingest(lake, f"{lake.root}/landing", P.HVAC)
        advance_all(lake, [P.HVAC])
        refresh_gold(lake)
    rebuild(lake, "bronze", P.HVAC, f"{lake.root}/landing")
    return _gold(lake)


#: Five deliveries: by the day of the month, and the rest.
FIFTHS = [f"substr(dt, 9, 2) BETWEEN '{low:02d}' AND '{low + 5:02d}'" for low in (1, 7, 13, 19)]
FIFTHS.append(f"NOT coalesce({' OR '.join(FIFTHS)}, false)")


@query
def lake_compacted(spark: SparkSession, d: str) -> DataFrame:
    """Gold when all layers are compacted after each of five deliveries."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    for part in FIFTHS:
        _take_in(lake, d, part)
        compact_all(lake, P.HVAC)
    build_gold(lake)
    return _gold(lake)


@query
def lake_stage_counts(spark: SparkSession, d: str) -> DataFrame:
    """What staging took in, kept and dropped of the whole feed in one delivery; nothing
    before anything was delivered, and nothing more when it is called again."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    advance_all(lake, [P.HVAC])
    _deliver(spark, d, lake.root)
    ingest(lake, f"{lake.root}/landing", P.HVAC)
    for _ in range(2):
        advance_all(lake, [P.HVAC])
    counts = tables.scan(spark, lake.path("stage_counts", P.HVAC.name))
    return counts.select("rows_in", "rows_out", "duplicates_removed")


@query
def lake_increment_counts(spark: SparkSession, d: str) -> DataFrame:
    """What staging took in, kept and dropped, per increment, over the whole feed."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    for part in (EARLY, LATE):
        _deliver(spark, d, lake.root, part)
        ingest(lake, f"{lake.root}/landing", P.HVAC)
        advance_all(lake, [P.HVAC])
    counts = tables.scan(spark, lake.path("stage_counts", P.HVAC.name))
    return counts.select("rows_in", "rows_out", "duplicates_removed")


# --- distinct counts by sketches ------------------------------------------------------
def _sketched(rows: DataFrame, dataset: str, unit: str) -> DataFrame:
    """Units of each building, exactly and from merged daily sketches."""
    daily = sketches.distinct_sketches(rows, ["building_id", "dt"], unit)
    merged = sketches.merged_sketches(daily, ["building_id"])
    exact = rows.dropna(subset=["building_id", "dt"]).groupBy("building_id").agg(F.count_distinct(unit).alias("units"))
    off = F.abs(sketches.estimate(F.col("sketch")) - F.col("units"))
    within = off <= F.ceil(F.col("units") * sketches.BOUND)
    return exact.join(merged, "building_id").select(
        F.lit(dataset).alias("dataset"), "building_id", "units", within.alias("within_bound")
    )


@query
def unit_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Exact distinct counts beside those of sketches kept by day and merged over days."""
    hvac = _sketched(hvac_normalised(spark, d), P.HVAC.name, "equipment_id")
    return hvac.unionByName(_sketched(utility_normalised(spark, d), P.UTILITY.name, "meter_id"))


@query
def hvac_daily_summary_sketched(spark: SparkSession, d: str) -> DataFrame:
    """The daily summary from partials of three pieces of the table, with sketched unit counts;
    a building's few units are counted exactly by a sketch too."""
    rows, report = hvac_kpis(spark, d), partials.HVAC_DAILY_SKETCHED
    piece = F.pmod(F.xxhash64("timestamp", "equipment_id"), F.lit(3))
    made = [report.partial(rows.where(piece == n)) for n in range(3)]
    return report.report(made[0].unionByName(made[1]).unionByName(made[2]))


# --- monitoring -------------------------------------------------------------------
@query
def execution_history(spark: SparkSession, d: str) -> DataFrame:
    return monitoring.with_overall_status(views.runs_raw(spark, d))


@query
def stage_totals(spark: SparkSession, d: str) -> DataFrame:
    return monitoring.stage_totals(
        {P.HVAC.name: hvac_dq_flags(spark, d), P.UTILITY.name: utility_dq_flags(spark, d)}
    )


# --- streaming --------------------------------------------------------------------
def _stream(spark: SparkSession, d: str, view: str, table: str) -> DataFrame:
    """A raw feed as a stream over its table, be that one file or a folder of them.

    The pattern matches the table's own name only; a stream takes a file's path
    no other way.
    """
    kind = spark.read.parquet(f"{d}/{table}.parquet").schema
    files = spark.readStream.schema(kind).option("maxFilesPerTrigger", FILES_PER_BATCH)
    text = view.format(text="STRING").replace(f"FROM {table}", f"FROM {{{table}}}")
    return spark.sql(text, **{table: files.parquet(f"{d}/{table}.parque[t]")})


def _hvac_stream(spark: SparkSession, d: str) -> DataFrame:
    return _stream(spark, d, views.HVAC_RAW, "events")


def _run(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there now into a table, and read the table."""
    root = scratch_folder(stream.sparkSession, name)
    stages.start_append(stream, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema.fields])
    return stream.sparkSession.read.schema(kind).parquet(f"{root}/table")


def _reported(stream: DataFrame, dataset: P.Dataset, report: partials.Mergeable) -> DataFrame:
    """A daily report kept by a stream over what is there now."""
    spark = stream.sparkSession
    root = scratch_folder(spark, "stream-report")
    stages.start_reports(
        stream, dataset, root, f"{root}/checkpoint", {"report": report}, stages.MONTH
    ).awaitTermination()
    return tables.scan(spark, f"{root}/report").drop(stages.PERIOD)


@query
def stream_hvac_daily_summary(spark: SparkSession, d: str) -> DataFrame:
    return _reported(_hvac_stream(spark, d), P.HVAC, partials.HVAC_DAILY)


@query
def stream_hvac_graded(spark: SparkSession, d: str) -> DataFrame:
    rows = _run(stages.graded(_hvac_stream(spark, d), P.HVAC), "stream-graded")
    return rows.groupBy("data_quality_flag").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("overheating_flag").alias("judged"),
        F.count("temp_differential").alias("with_kpis"),
    )


@query
def stream_hvac_deduplicated(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_folder(spark, "stream-dedup")
    stages.start_deduplication(
        _hvac_stream(spark, d), P.HVAC, f"{root}/table", f"{root}/checkpoint"
    ).awaitTermination()
    return tables.scan(spark, f"{root}/table").select("timestamp", "equipment_id")


@query
def stream_hvac_watermarked(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the whole feed after deduplication under a watermark: those on time, which the
    state store kept once, and those that only late readings hold."""
    stream, root = _hvac_stream(spark, d), scratch_folder(spark, "stream-watermarked")
    for name, start in (("judge", watermarks.start_judging), ("unique", watermarks.start_within_watermark)):
        start(stream, P.HVAC, root, f"{root}/{name}-checkpoint", WATERMARK_DELAY).awaitTermination()
    return watermarks.settled(stream, P.HVAC, root).select("timestamp", "equipment_id")


@query
def stream_utility_daily_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = _stream(spark, d, views.UTILITY_RAW, "lineitem")
    return _reported(rows, P.UTILITY, partials.UTILITY_DAILY)


@query
def stream_equipment_daily(spark: SparkSession, d: str) -> DataFrame:
    return _reported(_hvac_stream(spark, d), P.HVAC, partials.EQUIPMENT_DAILY)
