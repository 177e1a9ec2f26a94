"""The layered lake: each stage reads what is new upstream, transforms it, and
adds it to its own table.

landing -> bronze -> staging -> dq_validated (+ quarantine, dq_logs)
        -> fault_detection (hvac) -> silver -> gold
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterloom import presets as P
from meterloom.operators import cleaning, dimensions, faults, kpis, quality, rollups
from meterloom.operators.cleaning import RUN_ID
from meterloom.presets import Dataset
from meterloom.sources import landing, tables
from meterloom.sources.ledger import Ledger, id_list, new_ids

#: Rounds of landing files that are landed at the same time.
ROUNDS = 8
#: Runs of a level that compaction joins.
FANOUT = 2

# Which layer a dataset's layer is built from.
UPSTREAM = {
    P.HVAC.name: {
        "staging": "bronze",
        "dq_validated": "staging",
        "fault_detection": "dq_validated",
        "silver": "fault_detection",
    },
    P.UTILITY.name: {"staging": "bronze", "dq_validated": "staging", "silver": "dq_validated"},
}


def _side_by_side(spark: SparkSession, function: Callable, items: Sequence, most: int = ROUNDS) -> list:
    """``function`` of each item, ``most`` at a time, for work that shares no table it writes.

    One that fails does not stop the others; the first error is raised when all have ended.
    """
    call = inheritable_thread_target(spark)(function)
    with ThreadPoolExecutor(max(1, min(most, len(items)))) as pool:
        calls = [pool.submit(call, item) for item in items]
    return [each.result() for each in calls]


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


def new_run_id() -> str:
    return f"run-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def runs(self, layer: str, dataset: Dataset) -> Ledger:
        """The runs a layer has finished."""
        return Ledger(self.spark, f"{self.root}/_ledgers/{layer}/{dataset.name}", RUN_ID)

    def files(self, dataset: Dataset) -> Ledger:
        """The landing files ingested. Bronze's run ledger is the same table: a
        file and its run are committed in one write."""
        return Ledger(self.spark, f"{self.root}/_ledgers/bronze/{dataset.name}", "path")

    def plan(self, dataset: Dataset) -> Ledger:
        """The landing files taken up, with the run that lands each."""
        return Ledger(self.spark, f"{self.root}/_ledgers/plan/{dataset.name}", "path")

    def table(
        self, layer: str, dataset: Dataset, merge_schema: bool = False
    ) -> DataFrame | None:
        return tables.scan(self.spark, self.path(layer, dataset.name), merge_schema=merge_schema)

    def finished(self, layer: str, dataset: Dataset) -> DataFrame | None:
        """The layer's table with its extra columns, without what a run that died
        half way left behind."""
        return self.of_runs(layer, dataset, id_list(self.runs(layer, dataset).ids(), RUN_ID))

    def of_runs(self, layer: str, dataset: Dataset, run_ids: Sequence[str]) -> DataFrame | None:
        """The rows of these runs, from their folders alone."""
        return tables.scan_runs(self.spark, self.path(layer, dataset.name), run_ids)


# ---------------------------------------------------------------------------
# Landing to bronze
# ---------------------------------------------------------------------------
def land_files(
    lake: Lake, files: DataFrame, dataset: Dataset, run_id: str, ingested_at: str | None = None
) -> None:
    """Bring one bounded round of landing files into bronze, as one run."""
    spark = lake.spark
    tables.check_run_id(run_id)
    named, unnamed = landing.split_by_path(files, dataset.path_keys)
    rows, drift = landing.read_landing(spark, named, dataset, ingested_at or now(), run_id)
    if rows is not None:
        tables.append_runs(rows, lake.path("bronze", dataset.name), rebalance=True)
        drift = drift.withColumn(RUN_ID, F.lit(run_id))
        tables.append_runs(drift, lake.path("drift", dataset.name), partition_by=(RUN_ID,))
    reason = F.lit("no partition in path").alias("reason")
    rejects = unnamed.select("path", reason, F.lit(run_id).alias(RUN_ID))
    tables.append_runs(rejects, lake.path("rejects", dataset.name), partition_by=(RUN_ID,))
    landed = F.lit(None if rows is None else run_id).cast("string").alias(RUN_ID)
    lake.files(dataset).commit(files.select("path", landed))


def _planned(lake: Lake, dataset: Dataset) -> DataFrame:
    """path and run of every file that was ever taken up, landed or not."""
    schema = f"path string, {RUN_ID} string, committed_at timestamp"
    return tables.scan(lake.spark, lake.plan(dataset).path, schema).select("path", RUN_ID)


def _land_planned(lake: Lake, dataset: Dataset) -> list[str]:
    """Land the planned runs that are not in bronze's ledger, oldest plan first.

    A run that died half way has its old name and its old files, so it replaces
    what it left.
    """
    open_files = _planned(lake, dataset).join(lake.files(dataset).ids(), "path", "left_anti").persist()
    run_ids = sorted(row[RUN_ID] for row in open_files.select(RUN_ID).distinct().collect())

    def land(run_id: str) -> None:
        # The plan is read once; a run's files are a filter on what is open of it.
        land_files(lake, open_files.where(F.col(RUN_ID) == run_id).select("path"), dataset, run_id)

    # Runs write folders of their own, so their jobs fill the cluster together.
    try:
        _side_by_side(lake.spark, land, run_ids)
    finally:
        open_files.unpersist()
    return run_ids


def _plan(lake: Lake, files: DataFrame, dataset: Dataset, max_files: int) -> DataFrame | None:
    """Names a run for each of ``files`` (path), about ``max_files`` to a run."""
    total = files.count()
    if total == 0:
        return None
    name, rounds = new_run_id(), -(-total // max_files)
    number = F.pmod(F.xxhash64("path"), F.lit(rounds))
    run = F.concat(F.lit(f"{name}-"), F.lpad(number.cast("string"), 6, "0"))
    return files.select("path", run.alias(RUN_ID))


def ingest(
    lake: Lake, landing_root: str, dataset: Dataset, max_files: int = landing.MAX_FILES
) -> list[str]:
    """Ingest the landing files not seen yet; returns the run ids.

    The files are first written to a plan, with the run that is to land them, and
    then landed. A call that died is finished by the next one, under the same
    run ids, before new files are taken up; no reading lands twice.
    ``max_files`` is how many paths pass through the driver at a time, on average.
    """
    finished = _land_planned(lake, dataset)
    files = landing.list_landing(lake.spark, landing_root).select("path")
    known = _planned(lake, dataset).select("path").union(lake.files(dataset).ids())
    new = files.join(known, "path", "left_anti")
    plan = _plan(lake, new, dataset, max_files)
    if plan is None:
        return finished
    lake.plan(dataset).commit(plan)
    return finished + _land_planned(lake, dataset)


# ---------------------------------------------------------------------------
# Layer to layer
# ---------------------------------------------------------------------------
def transform_for(
    layer: str, dataset: Dataset, known: DataFrame | None = None
) -> Callable[[DataFrame], DataFrame]:
    """The transform that makes ``layer``; ``known`` widens staging's
    deduplication from the new runs to the whole table."""
    if layer == "staging":
        return lambda df: cleaning.clean(df, dataset, known=known)
    if layer == "dq_validated":
        return lambda df: quality.grade(df, dataset.rules)
    if layer == "fault_detection":
        return faults.detect_faults
    if layer == "silver":
        return kpis.hvac_kpis if dataset.name == P.HVAC.name else kpis.utility_kpis
    raise ValueError(f"no layer {layer!r}")


def advance(
    lake: Lake, layer: str, dataset: Dataset, dedup_scope: str = "batch"
) -> list[str]:
    """Process the upstream runs ``layer`` has not seen; returns their ids.

    A missing upstream table has no new runs. Staging counts what it took in,
    kept and dropped in ``stage_counts``: the job that writes the rows counts them.
    """
    if dedup_scope not in ("batch", "table"):
        raise ValueError(f"dedup_scope must be 'batch' or 'table', not {dedup_scope!r}")
    upstream = UPSTREAM[dataset.name][layer]
    seen = lake.runs(layer, dataset)
    named = id_list(new_ids(lake.runs(upstream, dataset).ids(), seen.known(), RUN_ID), RUN_ID)
    if not named:
        return []
    rows = lake.of_runs(upstream, dataset, named)
    if rows is not None:
        known = None
        if layer == "staging" and dedup_scope == "table":
            known = _known_keys(lake, dataset, rows, named)
        # Deduplication spreads a folder's rows over all tasks; gather them again.
        # The other layers keep the layout of what they read.
        result = transform_for(layer, dataset, known)(rows)
        target = lake.path(layer, dataset.name)
        observed = Observation() if layer == "staging" else None
        tables.append_runs(result, target, rebalance=layer == "staging", observed=observed)
        if observed is not None:
            _count(lake, dataset, rows, observed.get.get("rows", 0), named)
        if layer == "dq_validated":
            _after_grading(lake, dataset, named)
    seen.commit_values(named)
    return named


def increment_id(run_ids: Sequence[str]) -> str:
    """A name for the work on these runs, the same when it is done again."""
    return "inc-" + hashlib.sha256("\n".join(sorted(run_ids)).encode()).hexdigest()[:32]


def _count(lake: Lake, dataset: Dataset, rows: DataFrame, kept: int, named: list[str]) -> None:
    """Rows in, rows kept, duplicates and runs of one increment of staging.

    Rows in come from file footers, which hold their number: no column is read. (Counted
    on their way into the shuffle, they would count twice when an executor is lost.)
    """
    taken = rows.count()
    counted = lake.spark.createDataFrame(
        [(taken, kept, taken - kept, len(named), now(), increment_id(named))],
        f"rows_in long, rows_out long, duplicates_removed long, new_runs long, logged_at string, {RUN_ID} string",
    )
    tables.append_runs(counted.coalesce(1), lake.path("stage_counts", dataset.name), partition_by=(RUN_ID,))


def _known_keys(
    lake: Lake, dataset: Dataset, rows: DataFrame, named: list[str]
) -> DataFrame | None:
    """Keys already in staging that the new rows could repeat.

    Equal keys have equal timestamps, so the table is cut to the time span of the
    new rows, which Parquet statistics turn into skipped row groups. Runs being
    replayed do not count as known.
    """
    table = lake.finished("staging", dataset)
    if table is None:
        return None
    stamps = cleaning.normalise(rows.select("timestamp"), dataset)
    span = stamps.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")).first()
    stamp = F.col("timestamp")
    within = stamp.isNull()
    if span["low"] is not None:
        within = within | stamp.between(F.lit(span["low"]), F.lit(span["high"]))
    return table.where(within & ~F.col(RUN_ID).isin(named))


def _after_grading(lake: Lake, dataset: Dataset, named: list[str]) -> None:
    """Quarantine and run log, both read back from the table just written; done
    again for the same runs, both replace what they wrote."""
    rows = lake.of_runs("dq_validated", dataset, named)
    if rows is None:
        return
    tables.append_runs(quality.quarantined(rows), lake.path("quarantine", dataset.name))
    log = quality.run_log(rows, dataset.dedup_keys, increment_id(named), now())
    tables.append_runs(log, lake.path("dq_logs", dataset.name), partition_by=("run_id",))


def rebuild(
    lake: Lake,
    layer: str,
    dataset: Dataset,
    landing_root: str | None = None,
    max_files: int = landing.MAX_FILES,
) -> None:
    """Make a layer anew from its whole upstream, every layer after it, and the
    reports built on them. Bronze is made from all landing files.

    From staging on, run ids stay what they were, so the layers agree on them
    afterwards. A rebuild that died is started again.
    """
    order = list(UPSTREAM[dataset.name])
    if layer == "bronze":
        if landing_root is None:
            raise ValueError("bronze is rebuilt from a landing_root")
        files = landing.list_landing(lake.spark, landing_root).select("path")
        plan = _plan(lake, files, dataset, max_files)
        for old in ("bronze", "rejects", "drift"):
            tables.drop(lake.spark, lake.path(old, dataset.name))
        tables.drop(lake.spark, lake.files(dataset).path)
        if plan is None:
            tables.drop(lake.spark, lake.plan(dataset).path)
        else:
            lake.plan(dataset).replace(plan)
            _land_planned(lake, dataset)
    else:
        order = order[order.index(layer):]
    for current in order:
        upstream = UPSTREAM[dataset.name][current]
        rows = lake.finished(upstream, dataset)
        if rows is None:
            for gone in order[order.index(current):]:
                tables.drop(lake.spark, lake.path(gone, dataset.name))
                tables.drop(lake.spark, lake.runs(gone, dataset).path)
            break
        result = transform_for(current, dataset)(rows)
        tables.overwrite(result, lake.path(current, dataset.name), tables.PARTITIONS, current == "staging")
        lake.runs(current, dataset).replace(lake.runs(upstream, dataset).ids())
        if current == "dq_validated":
            tables.drop(lake.spark, lake.path("quarantine", dataset.name))
            named = id_list(lake.runs(current, dataset).ids(), RUN_ID)
            _after_grading(lake, dataset, named)
    built_on = [r for r in REPORTS if r.dataset.name == dataset.name and r.layer in order]
    for report in built_on:
        tables.drop(lake.spark, report_ledger(lake, report).path)
        tables.drop(lake.spark, lake.path("gold", report.name))
    _build(lake, built_on)


def _level(run_id: str) -> int:
    """How many joins a run has behind it."""
    found = re.match(r"join(\d+)-", run_id)
    return int(found[1]) if found else 0


def compact(lake: Lake, layer: str, dataset: Dataset, fanout: int = FANOUT) -> str | None:
    """Join runs of a layer into fewer, of larger files.

    Runs have levels: what ingestion makes is of level 0, and ``fanout`` or more runs of a
    level are joined into one of the next. So a row is rewritten once per level, a
    logarithmic number of times however often a schedule calls this, and few runs are left.

    Only runs that every later layer and report has taken are joined, so nothing
    is processed again. Readers go by the ledger: they see the old runs until it
    names the new one, then the new one. The old folders stay until the next call, for readers
    that started before. A call may die anywhere: until the one append that renames the runs,
    nothing has changed; after it, only the folders to delete are left, and the next call does
    that. Returns the last new run, or None if no level has enough.
    """
    if fanout < 2:
        raise ValueError(f"fanout is at least 2, not {fanout}")
    readers = [lake.runs(name, dataset) for name, up in UPSTREAM[dataset.name].items() if up == layer]
    readers += [
        report_ledger(lake, report)
        for report in REPORTS
        if (report.layer, report.dataset.name) == (layer, dataset.name)
    ]
    own, path = lake.runs(layer, dataset), lake.path(layer, dataset.name)
    last, replaced = own.last_round()
    for run_id in replaced:
        tables.drop(lake.spark, f"{path}/{RUN_ID}={run_id}")
    taken = set(id_list(own.ids(), RUN_ID)).intersection(
        *(id_list(reader.known(), RUN_ID) for reader in readers)
    )
    levels: dict[int, list[str]] = defaultdict(list)
    for run_id in sorted(taken):
        levels[_level(run_id)].append(run_id)
    joined, level = None, 0
    while level <= max(levels, default=-1):
        runs = levels[level]
        rows = lake.of_runs(layer, dataset, runs) if len(runs) >= fanout else None
        if rows is not None:
            joined = f"join{level + 1}-{increment_id(runs)}"
            tables.append_runs(rows.withColumn(RUN_ID, F.lit(joined)), path, rebalance=True)
            for reader in readers:
                reader.acknowledge(joined)
            own.rename(runs, joined, last + 1)
            levels[level + 1].append(joined)
        level += 1
    return joined


def compact_all(lake: Lake, dataset: Dataset, fanout: int = FANOUT) -> dict[str, str | None]:
    """:func:`compact` for bronze and every layer after it, side by side: each writes its own
    rows and renames, and notes of its own in the ledgers of its readers."""
    layers = ["bronze", *UPSTREAM[dataset.name]]
    joined = _side_by_side(lake.spark, lambda layer: compact(lake, layer, dataset, fanout), layers)
    return dict(zip(layers, joined, strict=True))


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Report:
    name: str
    layer: str
    dataset: Dataset
    build: Callable[[DataFrame], DataFrame]


REPORT_PARTITIONS = ("dt",)
REPORTS = (
    Report("hvac_daily_summary", "silver", P.HVAC, rollups.hvac_daily_summary),
    Report("alarm_log", "silver", P.HVAC, rollups.alarm_log),
    Report("utility_daily_summary", "silver", P.UTILITY, rollups.utility_daily_summary),
    Report("fact_equipment_daily", "fault_detection", P.HVAC, rollups.equipment_daily),
)


def report_ledger(lake: Lake, report: Report) -> Ledger:
    """The runs that a report covers."""
    return Ledger(lake.spark, f"{lake.root}/_ledgers/gold/{report.name}", RUN_ID)


def build_gold(lake: Lake) -> list[str]:
    """Write every report whose upstream exists anew; returns their names.

    Reports are laid out by day: a building's day is one row of a summary, far
    too little for a folder of its own.
    """
    return _build(lake, REPORTS)


def _build(lake: Lake, reports: Sequence[Report]) -> list[str]:
    def build(report: Report) -> str | None:
        # The list of runs is fixed first: one that ends meanwhile is not marked.
        named = id_list(lake.runs(report.layer, report.dataset).ids(), RUN_ID)
        rows = lake.of_runs(report.layer, report.dataset, named)
        if rows is None:
            return None
        target = lake.path("gold", report.name)
        tables.overwrite(report.build(rows), target, REPORT_PARTITIONS)
        done = report_ledger(lake, report)
        tables.drop(lake.spark, done.path)
        done.commit_values(named)
        return report.name

    return [name for name in _side_by_side(lake.spark, build, reports) if name is not None]


def refresh_gold(lake: Lake) -> list[str]:
    """Recompute only the days that runs not reported yet have touched.

    Those days are read whole, from all finished runs, and replace their
    partitions, so the tables equal a full build and a replay changes nothing.
    Runs only ever add rows to a day, so none loses its report.
    """
    by_day = list(REPORT_PARTITIONS)

    def refresh(report: Report) -> str | None:
        done = report_ledger(lake, report)
        upstream = id_list(lake.runs(report.layer, report.dataset).ids(), RUN_ID)
        seen = set(id_list(done.known(), RUN_ID))
        named = [run_id for run_id in upstream if run_id not in seen]
        rows = lake.of_runs(report.layer, report.dataset, upstream)
        new = lake.of_runs(report.layer, report.dataset, named)
        if not named or rows is None:
            return None
        if new is not None:
            touched = new.select(*by_day).distinct()
            days = rows.join(touched, by_day, "left_semi")
            tables.overwrite(
                report.build(days), lake.path("gold", report.name), by_day, touched_only=True
            )
        done.commit_values(named)
        return None if new is None else report.name

    return [name for name in _side_by_side(lake.spark, refresh, REPORTS) if name is not None]


def build_dimensions(lake: Lake, year: int) -> list[str]:
    spark = lake.spark
    made = {
        "dim_alarm_type": dimensions.dim_alarm_type(spark),
        "dim_date": dimensions.dim_date(spark, year),
    }
    hvac, utility = lake.finished("staging", P.HVAC), lake.finished("staging", P.UTILITY)
    if hvac is not None:
        made["dim_equipment"] = dimensions.dim_equipment(hvac)
    if utility is not None:
        made["dim_meter"] = dimensions.dim_meter(utility)
    if hvac is not None and utility is not None:
        made["dim_building"] = dimensions.dim_building(hvac, utility)
    for name, rows in made.items():
        tables.overwrite(rows, lake.path("dimensions", name), rebalance=False)
    return list(made)


def advance_all(
    lake: Lake, datasets: Sequence[Dataset] = (P.HVAC, P.UTILITY), dedup_scope: str = "batch"
) -> dict[tuple[str, str], list[str]]:
    """Every layer between bronze and gold, for the given datasets."""
    return {
        (layer, dataset.name): advance(
            lake, layer, dataset, dedup_scope if layer == "staging" else "batch"
        )
        for dataset in datasets
        for layer in UPSTREAM[dataset.name]
    }
