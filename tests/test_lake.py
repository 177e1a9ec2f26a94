"""Landing files to gold: drift, increments, replays, rebuilds."""

from __future__ import annotations

import compare
import pandas as pd
import pytest
from pyspark.sql import functions as F
from readings import HVAC

from meterloom import presets as P
from meterloom.operators import rollups
from meterloom.operators.cleaning import RUN_ID
from meterloom.plans import lake as L
from meterloom.sources import landing, ledger, tables
from meterloom.streaming import ingestion

BASE = {k: v for k, v in HVAC.items() if k != "dt"}


def put(root, folder: str, name: str, *changes: dict, drop=(), **columns):
    """A landing file as a pandas writer makes it."""
    rows = [{**BASE, **change} for change in changes or ({},)]
    table = pd.DataFrame(rows).drop(columns=list(drop)).assign(**columns)
    target = root / "landing" / folder
    target.mkdir(parents=True, exist_ok=True)
    table.to_parquet(target / f"{name}.parquet", index=False)


def day(building: str = "B1", dt: str = "2026-01-05") -> str:
    return f"building_id={building}/dt={dt}"


def at(minute: int, **more) -> dict:
    return {"timestamp": f"2026-01-05 10:{minute:02d}:00", **more}


@pytest.fixture
def lake(spark, tmp_path):
    return L.Lake(spark, str(tmp_path / "lake"))


def landing_root(tmp_path) -> str:
    return str(tmp_path / "landing")


def rows_of(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def equal(a, b) -> bool:
    return sorted(a.columns) == sorted(b.columns) and (
        compare.bag(a.columns, a.collect()) == compare.bag(b.columns, b.collect())
    )


def test_drifting_files_make_one_table(spark, lake, tmp_path):
    put(tmp_path, day(), "plain", at(0))  # fault_code has no type here
    put(tmp_path, day(), "coded", at(1, fault_code="HC-412"))
    put(tmp_path, day("B2"), "short", at(2), drop=["outdoor_air_temp"])
    put(tmp_path, day("B2"), "wide", at(3), firmware=7)
    put(tmp_path, day("B3"), "worded", at(4), firmware="v8")
    put(tmp_path, day("B3"), "whole", at(5), fan_speed_pct=50)
    put(tmp_path, day("B3"), "text", at(6), fan_speed_pct="n/a")
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    bronze = lake.finished("bronze", P.HVAC)
    kinds = dict(bronze.dtypes)
    assert {kinds[name] for name in P.HVAC.measures} == {"double"}
    assert (kinds["fault_code"], kinds["timestamp"], kinds["dt"]) == ("string",) * 3
    found = {r["timestamp"][14:16]: r for r in bronze.collect()}
    assert len(found) == 7
    assert found["00"]["fault_code"] is None and found["01"]["fault_code"] == "HC-412"
    assert found["02"]["outdoor_air_temp"] is None
    assert (found["03"]["firmware"], found["04"]["firmware"]) == ("7", "v8")
    assert found["05"]["fan_speed_pct"] == 50.0 and found["06"]["fan_speed_pct"] is None
    assert found["00"]["_source_file"].endswith("plain.parquet")


def test_drift_report(spark, tmp_path):
    put(tmp_path, day(), "plain", at(0))
    put(tmp_path, day(), "odd", at(1), drop=["duct_pressure"], firmware=7)
    files = landing.list_landing(spark, landing_root(tmp_path))
    report = landing.drift_report(landing.footers(files), list(P.HVAC.columns)).collect()
    assert [(r["missing"], r["extra"]) for r in report] == [(["duct_pressure"], ["firmware"])]


def test_the_path_wins_over_the_file(lake, tmp_path):
    put(tmp_path, day("007", "2026-01-09"), "a", at(0, building_id="B9"))
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    assert rows_of(lake.table("bronze", P.HVAC), "building_id", "dt") == [("007", "2026-01-09")]


def test_files_without_a_partition_are_rejected_once(spark, lake, tmp_path):
    put(tmp_path, day(), "a", at(0))
    put(tmp_path, "loose", "b", at(1))
    (tmp_path / "landing" / "notes.txt").write_text("not Parquet")
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    rejects = tables.scan(spark, lake.path("rejects", P.HVAC.name))
    assert [r["path"].endswith("loose/b.parquet") for r in rejects.collect()] == [True]
    assert lake.table("bronze", P.HVAC).count() == 1
    assert L.ingest(lake, landing_root(tmp_path), P.HVAC) == []


def test_every_unreadable_file_is_named(lake, tmp_path):
    put(tmp_path, day(), "good", at(0))
    for name in ("bad1", "bad2"):
        (tmp_path / "landing" / day() / f"{name}.parquet").write_bytes(b"PAR1 no")
    with pytest.raises(RuntimeError, match="2 landing file"):
        L.ingest(lake, landing_root(tmp_path), P.HVAC)
    assert lake.table("bronze", P.HVAC) is None


def test_rounds_take_all_files(lake, tmp_path):
    for n in range(9):
        put(tmp_path, day(), f"f{n}", at(n))
    runs = L.ingest(lake, landing_root(tmp_path), P.HVAC, max_files=2)
    assert 2 <= len(runs) <= 5
    assert lake.table("bronze", P.HVAC).count() == 9
    put(tmp_path, day(), "late", at(30))
    assert len(L.ingest(lake, landing_root(tmp_path), P.HVAC)) == 1
    assert lake.table("bronze", P.HVAC).count() == 10


def test_nothing_there_is_no_work(lake, tmp_path):
    assert L.ingest(lake, landing_root(tmp_path), P.HVAC) == []
    assert L.advance(lake, "staging", P.HVAC) == []
    assert L.build_gold(lake) == [] and L.refresh_gold(lake) == []


def test_layers_take_only_new_runs(spark, lake, tmp_path):
    put(tmp_path, day(), "a", at(0), at(0), at(1, supply_air_temp=400.0))
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    first = L.advance_all(lake, [P.HVAC])
    assert all(len(runs) == 1 for runs in first.values())
    put(tmp_path, day(), "b", at(2), at(3, status_flag="FAULT"))
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    second = L.advance_all(lake, [P.HVAC])
    assert all(len(runs) == 1 and runs != first[key] for key, runs in second.items())
    assert all(runs == [] for runs in L.advance_all(lake, [P.HVAC]).values())
    assert lake.table("bronze", P.HVAC).count() == 5
    assert lake.table("silver", P.HVAC).count() == 4
    assert lake.table("quarantine", P.HVAC).count() == 1
    logs = tables.scan(spark, lake.path("dq_logs", P.HVAC.name))
    assert rows_of(logs, "total_rows", "clean", "critical", "duplicates_found") == [(2, 1, 1, 0), (2, 2, 0, 0)]


def test_a_replayed_stage_changes_nothing(spark, lake, tmp_path):
    put(tmp_path, day(), "a", at(0), at(1, supply_air_temp=400.0))
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    L.advance_all(lake, [P.HVAC])
    before = {layer: lake.table(layer, P.HVAC).collect() for layer in ("staging", "dq_validated", "silver")}
    for layer in before:  # as if the stage had died before its ledger was written
        lake.runs(layer, P.HVAC).replace(spark.createDataFrame([], f"{RUN_ID} string"))
    L.advance_all(lake, [P.HVAC])
    for layer, rows in before.items():
        assert sorted(map(str, lake.table(layer, P.HVAC).collect())) == sorted(map(str, rows))


def test_redelivered_readings(spark, tmp_path):
    """Table-wide deduplication makes increments equal to a rebuild."""
    made = {}
    for scope in ("batch", "table"):
        lake = L.Lake(spark, str(tmp_path / scope))
        base = tmp_path / f"src-{scope}"
        for n, readings in enumerate([(at(0), at(1)), (at(1, supply_air_temp=65.0), at(2), at(2, equipment_id=None))]):
            put(base, day(), f"f{n}", *readings)
            L.ingest(lake, str(base / "landing"), P.HVAC)
            L.advance_all(lake, [P.HVAC], dedup_scope=scope)
        increments = rows_of(lake.table("staging", P.HVAC), "timestamp", "supply_air_temp")
        L.rebuild(lake, "staging", P.HVAC)
        rebuilt = rows_of(lake.table("staging", P.HVAC), "timestamp", "supply_air_temp")
        made[scope] = (increments, rebuilt)
        assert lake.table("silver", P.HVAC).count() == len(rebuilt)
        assert all(runs == [] for runs in L.advance_all(lake, [P.HVAC]).values())
    assert made["table"][0] == made["table"][1] == made["batch"][1]
    assert len(made["batch"][0]) == len(made["batch"][1]) + 1


def test_many_new_runs_at_once(spark, lake, tmp_path):
    for n in range(12):
        put(tmp_path, day(), f"f{n}", at(n), at(n + 20, supply_air_temp=400.0))
    L.ingest(lake, landing_root(tmp_path), P.HVAC, max_files=1)
    runs = L.advance(lake, "staging", P.HVAC, "table")
    assert len(runs) > 3 and L.advance(lake, "dq_validated", P.HVAC) == runs
    assert lake.table("dq_validated", P.HVAC).count() == 24
    assert lake.table("quarantine", P.HVAC).count() == 12
    assert L.advance(lake, "staging", P.HVAC) == []


def test_an_ingestion_that_died_is_finished_by_the_next(spark, lake, tmp_path, monkeypatch):
    put(tmp_path, day(), "a", at(0), at(1))
    landed = L.land_files

    def die(lake, files, dataset, run_id):
        landed(lake, files, dataset, run_id)
        tables.drop(lake.spark, lake.files(dataset).path)
        raise KeyboardInterrupt

    monkeypatch.setattr(L, "land_files", die)
    with pytest.raises(KeyboardInterrupt):
        L.ingest(lake, landing_root(tmp_path), P.HVAC)
    monkeypatch.setattr(L, "land_files", landed)
    put(tmp_path, day("B2"), "b", at(2))
    assert len(L.ingest(lake, landing_root(tmp_path), P.HVAC)) == 2
    assert lake.table("bronze", P.HVAC).count() == 3
    assert L.ingest(lake, landing_root(tmp_path), P.HVAC) == []


def test_escaped_values_and_source_files(lake, tmp_path):
    put(tmp_path, "building_id=Main Hall%3A 5%25+/dt=2026-01-05", "a b%", at(0))
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    bronze = lake.finished("bronze", P.HVAC)
    assert rows_of(bronze, "building_id") == [("Main Hall: 5%+",)]
    assert rows_of(bronze, "_source_file") == rows_of(lake.files(P.HVAC).ids(), "path")


def test_paths_are_taken_apart_once_per_file(spark, tmp_path):
    """Every row finds its file in the lookup; one that does not is told the same."""
    put(tmp_path, "building_id=Main Hall%3A 5%25+/dt=2026-01-05", "a b%", at(0), at(1), at(1))
    put(tmp_path, day("B2", "2026-01-06"), "c", at(2, building_id="B9"))
    read = spark.read.option("recursiveFileLookup", "true").parquet(landing_root(tmp_path))
    files = read.select("timestamp", F.col("_metadata.file_path").alias("_file"))
    urls = {url.split(":", 1)[1].lstrip("/") for url in read.inputFiles()}
    assert {r["_file"].split(":", 1)[1].lstrip("/") for r in files.collect()} == urls
    keys = P.HVAC.path_keys
    told = landing.with_path_values(files, read.inputFiles(), keys)
    marked = landing.with_path_values(files, [f"{url}?" for url in read.inputFiles()], keys)
    names = ["timestamp", "_path", *keys]
    assert sorted(told.columns) == sorted(names) and rows_of(told, *names) == rows_of(marked, *names)
    assert [r[2:] for r in rows_of(told, *names)] == [("Main Hall: 5%+", "2026-01-05")] * 3 + [("B2", "2026-01-06")]
    assert "BroadcastHashJoin" in told._jdf.queryExecution().executedPlan().toString()
    # All rows have a partner: the patterns are left to rows without.
    listed = [url.replace("file:///", "file:/") for url in read.inputFiles()]
    assert {r["_file"] for r in files.collect()} <= set(listed) | set(read.inputFiles())


def test_rebuild_after_double_delivery_equals_a_fresh_build(spark, tmp_path):
    """Gold follows a rebuild, and a day that is gone from landing is gone from gold."""
    names = ["hvac_daily_summary", "alarm_log", "fact_equipment_daily"]
    old, new = (L.Lake(spark, str(tmp_path / name)) for name in ("old", "new"))
    put(tmp_path, day(), "a", at(0), at(1, heating_coil_temp=140.0))
    put(tmp_path, day("B2", "2026-01-09"), "gone", at(3))
    for name in ("b", "c"):
        L.ingest(old, landing_root(tmp_path), P.HVAC)
        L.advance_all(old, [P.HVAC])
        L.refresh_gold(old)
        put(tmp_path, day(), name, at(0), at(1, heating_coil_temp=140.0))
    (tmp_path / "landing" / day("B2", "2026-01-09") / "gone.parquet").unlink()
    L.rebuild(old, "bronze", P.HVAC, landing_root(tmp_path))
    L.ingest(new, landing_root(tmp_path), P.HVAC)
    L.advance_all(new, [P.HVAC])
    L.build_gold(new)
    for name in names:
        assert equal(*(tables.scan(spark, lake.path("gold", name)) for lake in (old, new)))
    assert old.table("silver", P.HVAC).count() == 2
    assert all(runs == [] for runs in L.advance_all(old, [P.HVAC]).values()) and L.refresh_gold(old) == []


def test_compacted_layers_read_the_same(spark, lake, tmp_path):
    for n in range(3):
        put(tmp_path, day(), f"f{n}", at(n), at(n + 20, supply_air_temp=400.0))
        L.ingest(lake, landing_root(tmp_path), P.HVAC)
    assert L.compact(lake, "bronze", P.HVAC) is None  # staging has not read it
    L.advance_all(lake, [P.HVAC])
    L.refresh_gold(lake)
    before = {layer: lake.finished(layer, P.HVAC).drop(RUN_ID).collect() for layer in ("bronze", "silver")}
    gold = tables.scan(spark, lake.path("gold", "hvac_daily_summary")).collect()
    for layer in ("bronze", *L.UPSTREAM[P.HVAC.name]):
        assert L.compact(lake, layer, P.HVAC) and L.compact(lake, layer, P.HVAC) is None
    for layer, rows in before.items():
        assert sorted(map(str, lake.finished(layer, P.HVAC).drop(RUN_ID).collect())) == sorted(map(str, rows))
        assert len(lake.table(layer, P.HVAC).inputFiles()) == 1
    assert L.ingest(lake, landing_root(tmp_path), P.HVAC) == []
    assert all(runs == [] for runs in L.advance_all(lake, [P.HVAC]).values()) and L.refresh_gold(lake) == []
    L.build_gold(lake)
    assert tables.scan(spark, lake.path("gold", "hvac_daily_summary")).collect() == gold


def joinable(lake, tmp_path, runs=2):
    for n in range(runs):
        put(tmp_path, day(), f"f{n}", at(n), at(n + 20, supply_air_temp=400.0))
        L.ingest(lake, landing_root(tmp_path), P.HVAC)
    L.advance_all(lake, [P.HVAC])
    L.refresh_gold(lake)


def test_rounds_land_together_and_the_plan_is_read_once(spark, lake, tmp_path, monkeypatch):
    for n in range(10):
        put(tmp_path, day(), f"f{n}", at(n))
    together, most, read = [], [], []
    land, planned = L.land_files, L._planned

    def watched(*args):
        together.append(1)
        most.append(len(together))
        try:
            land(*args)
        finally:
            together.pop()

    monkeypatch.setattr(L, "land_files", watched)
    monkeypatch.setattr(L, "_planned", lambda *args: read.append(1) or planned(*args))
    runs = L.ingest(lake, landing_root(tmp_path), P.HVAC, max_files=2)
    assert len(runs) >= 3 and max(most) > 1
    assert len(read) == 3  # what is open before, what is new, what is planned now
    assert rows_of(lake.finished("bronze", P.HVAC), "timestamp") == [(at(n)["timestamp"],) for n in range(10)]
    assert lake.files(P.HVAC).ids().count() == 10
    (tmp_path / "landing" / day() / "bad.parquet").write_bytes(b"no parquet")
    put(tmp_path, day(), "good", at(30))
    with pytest.raises(RuntimeError, match="bad.parquet"):
        L.ingest(lake, landing_root(tmp_path), P.HVAC, max_files=1)
    assert lake.files(P.HVAC).ids().count() in (10, 11)


class Died(Exception):
    pass


@pytest.mark.parametrize("step", [0, 1, 3, 4])
def test_compaction_may_die_at_any_step(lake, tmp_path, monkeypatch, step):
    """Its writes are: the rows, a note to each of two readers, the renames, and
    after them nothing but old folders to delete."""
    joinable(lake, tmp_path)
    before = rows_of(lake.finished("fault_detection", P.HVAC), "timestamp", "supply_air_temp")
    left = [step]

    def dying(function):
        def call(*args, **more):
            if not left[0]:
                raise Died
            left[0] -= 1
            return function(*args, **more)
        return call

    with monkeypatch.context() as patch:
        patch.setattr(tables, "append_runs", dying(tables.append_runs))
        patch.setattr(ledger.Ledger, "acknowledge", dying(ledger.Ledger.acknowledge))
        patch.setattr(ledger.Ledger, "rename", dying(ledger.Ledger.rename))
        if step < 4:
            with pytest.raises(Died):
                L.compact(lake, "fault_detection", P.HVAC)
        else:
            assert L.compact(lake, "fault_detection", P.HVAC)
    read = lambda: rows_of(lake.finished("fault_detection", P.HVAC), "timestamp", "supply_air_temp")
    assert read() == before
    assert all(runs == [] for runs in L.advance_all(lake, [P.HVAC]).values()) and L.refresh_gold(lake) == []
    L.compact(lake, "fault_detection", P.HVAC)
    L.compact(lake, "fault_detection", P.HVAC)
    assert read() == before and len(lake.runs("fault_detection", P.HVAC).ids().collect()) == 1
    assert all(runs == [] for runs in L.advance_all(lake, [P.HVAC]).values()) and L.refresh_gold(lake) == []


def test_compaction_of_one_layer_makes_no_work_for_it(lake, tmp_path):
    joinable(lake, tmp_path)
    assert L.compact(lake, "staging", P.HVAC)
    assert all(runs == [] for runs in L.advance_all(lake, [P.HVAC]).values())


def test_layers_are_compacted_side_by_side(lake, tmp_path, monkeypatch):
    joinable(lake, tmp_path, runs=3)
    layers = ["bronze", *L.UPSTREAM[P.HVAC.name]]
    before = {layer: rows_of(lake.finished(layer, P.HVAC), "timestamp") for layer in layers}
    together, most, join = [], [], L.compact

    def watched(*args):
        together.append(1)
        most.append(len(together))
        try:
            return join(*args)
        finally:
            together.pop()

    with monkeypatch.context() as patch:
        patch.setattr(L, "compact", watched)
        made = L.compact_all(lake, P.HVAC)
    assert list(made) == layers and all(made.values()) and max(most) > 1
    assert {layer: rows_of(lake.finished(layer, P.HVAC), "timestamp") for layer in layers} == before
    assert all(len(lake.runs(layer, P.HVAC).ids().collect()) == 1 for layer in layers)
    assert all(runs == [] for runs in L.advance_all(lake, [P.HVAC]).values()) and L.refresh_gold(lake) == []
    assert not any(L.compact_all(lake, P.HVAC).values())


def test_a_report_that_fails_leaves_the_others(lake, tmp_path, monkeypatch):
    """Reports are refreshed side by side; the failed one is done by the next call."""
    joinable(lake, tmp_path, runs=1)
    put(tmp_path, day(), "more", at(40))
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    L.advance_all(lake, [P.HVAC])
    write = tables.overwrite

    def failing(df, path, *args, **more):
        if path.endswith("hvac_daily_summary"):
            raise Died
        write(df, path, *args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "overwrite", failing)
        with pytest.raises(Died):
            L.refresh_gold(lake)
    assert L.refresh_gold(lake) == ["hvac_daily_summary"] and L.refresh_gold(lake) == []


def test_compaction_leaves_readers_alone(lake, tmp_path):
    joinable(lake, tmp_path)
    opened = lake.finished("silver", P.HVAC)
    before = rows_of(opened, "timestamp")
    assert L.compact(lake, "silver", P.HVAC)
    assert rows_of(opened, "timestamp") == before == rows_of(lake.finished("silver", P.HVAC), "timestamp")
    assert L.compact(lake, "silver", P.HVAC) is None  # deletes the folders of the round before
    assert len(lake.table("silver", P.HVAC).inputFiles()) == 1


def test_compaction_rewrites_a_row_a_logarithmic_number_of_times(spark, lake, monkeypatch):
    """Twelve runs, compacted after each, in a layer nobody reads but gold."""
    written, path = [], lake.path("silver", P.HVAC.name)
    append = tables.append_runs
    ready = [L.report_ledger(lake, report) for report in L.REPORTS if report.layer == "silver" and report.dataset is P.HVAC]

    def counting(rows, *args, **more):
        written.append(rows.count())
        append(rows, *args, **more)

    for n in range(12):
        rows = spark.range(10).selectExpr("id", "'B1' AS building_id", "'2026-01-05' AS dt", f"'run-{n:02d}' AS {RUN_ID}")
        append(rows.coalesce(1), path)
        for each in (lake.runs("silver", P.HVAC), *ready):
            each.commit_values([f"run-{n:02d}"])
        with monkeypatch.context() as patch:
            patch.setattr(tables, "append_runs", counting)
            L.compact(lake, "silver", P.HVAC)
    assert lake.finished("silver", P.HVAC).count() == 120
    assert len(ledger.id_list(lake.runs("silver", P.HVAC).ids(), RUN_ID)) <= 4
    assert sum(written) <= 120 * 4  # fewer than 2^4 runs


def test_staging_counts_while_it_writes(lake, tmp_path):
    put(tmp_path, day(), "a", at(0), at(0), at(1))
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    L.advance_all(lake, [P.HVAC])
    counts = tables.scan(lake.spark, lake.path("stage_counts", P.HVAC.name))
    assert rows_of(counts, "rows_in", "rows_out", "duplicates_removed", "new_runs") == [(3, 2, 1, 1)]


def test_refreshed_gold_equals_full_gold(spark, lake, tmp_path):
    put(tmp_path, day(), "a", at(0), at(1, heating_coil_temp=140.0))
    put(tmp_path, day("B2", "2026-01-06"), "b", at(0, equipment_id="AHU-B2-01"))
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    L.advance_all(lake, [P.HVAC])
    names = ["hvac_daily_summary", "alarm_log", "fact_equipment_daily"]
    assert L.refresh_gold(lake) == names and L.refresh_gold(lake) == []
    put(tmp_path, day(), "c", at(2, heating_coil_temp=140.0), at(3, equipment_id="AHU-B1-02"))
    L.ingest(lake, landing_root(tmp_path), P.HVAC)
    L.advance_all(lake, [P.HVAC])
    assert L.refresh_gold(lake) == names
    refreshed = {name: tables.scan(spark, lake.path("gold", name)).collect() for name in names}
    assert L.build_gold(lake) == names
    for name, rows in refreshed.items():
        again = tables.scan(spark, lake.path("gold", name)).collect()
        assert sorted(map(str, again)) == sorted(map(str, rows))
    assert equal(tables.scan(spark, lake.path("gold", "hvac_daily_summary")),
                 rollups.hvac_daily_summary(lake.table("silver", P.HVAC)))
    assert set(L.build_dimensions(lake, 2026)) == {"dim_alarm_type", "dim_date", "dim_equipment"}


def test_compaction_keeps_rows_and_splits_large_folders(spark, tmp_path):
    rows = spark.range(1_000).selectExpr(
        "id", "IF(id % 3 = 0, 'B1', 'B' || id % 5) AS building_id", "'2026-01-05' AS dt", f"'r' AS {RUN_ID}")
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    tables.append_runs(rows.repartition(8), source)
    tables.compact(spark, source, target, max_records_per_file=100)
    before, after = tables.scan(spark, source), tables.scan(spark, target)
    assert len(after.inputFiles()) < len(before.inputFiles())
    assert after.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 100
    assert equal(before, after)
    with pytest.raises(ValueError):
        tables.compact(spark, source, source)


def test_only_new_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], f"{RUN_ID} string, n int")
    done = spark.createDataFrame([("a",)], f"{RUN_ID} string")
    assert [r["n"] for r in ledger.only_new(rows, done, RUN_ID).collect()] == [2]
    with pytest.raises(ValueError):
        tables.check_run_id("a/b")


# --- streams ------------------------------------------------------------------
def stream(lake, tmp_path, **more):
    query = ingestion.start_ingestion(lake, landing_root(tmp_path), P.HVAC, str(tmp_path / "cp"), **more)
    query.awaitTermination()
    return query


def test_streamed_ingestion_takes_each_file_once(lake, tmp_path):
    for n in range(5):
        put(tmp_path, day(), f"f{n}", at(n))
    stream(lake, tmp_path, max_files=2)
    assert lake.table("bronze", P.HVAC).count() == 5
    assert lake.runs("bronze", P.HVAC).ids().count() == 3
    put(tmp_path, day("B2"), "late", at(9, fault_code="HC-412"))
    stream(lake, tmp_path)
    stream(lake, tmp_path)
    assert lake.table("bronze", P.HVAC).count() == 6
    L.advance_all(lake, [P.HVAC])
    assert lake.table("silver", P.HVAC).count() == 6


def test_a_replayed_micro_batch_changes_nothing(lake, tmp_path):
    put(tmp_path, day(), "a", at(0), at(1))
    stream(lake, tmp_path)
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    for stale in (tmp_path / "cp" / "commits").glob(f".{commits[-1].name}.crc"):
        stale.unlink()
    stream(lake, tmp_path)
    assert lake.finished("bronze", P.HVAC).count() == 2
    assert lake.files(P.HVAC).ids().count() == 1
