from __future__ import annotations

import compare
from pyspark.sql import functions as F
from readings import HVAC, frame

from meterloom import presets as P
from meterloom.operators import cleaning, faults, kpis, partials, quality, rollups
from meterloom.sources import tables
from meterloom.streaming import stages


def changes():
    for d in (5, 6, 7):
        for n in range(40):
            yield {
                "timestamp": f"2026-01-{d:02d} {n % 24:02d}:{n:02d}:00",
                "dt": f"2026-01-{d:02d}",
                "equipment_id": ["a", "b", "c", None][n % 4],
                "building_id": f"B{n % 3}",
                "supply_air_temp": [60.0, 77.0, 400.0, 61.5][n % 4 if d != 6 else 2],
                "status_flag": [" fault", "OPERATIONAL"][n % 2],
            }


def raw_stream(spark, tmp_path, pieces=4):
    rows = list(changes()) + [{"timestamp": "bad", "equipment_id": "a", "dt": "2026-01-06"}]
    batch = frame(spark, HVAC, *rows, clean=False)
    for n in range(pieces):  # every file holds rows of all days, latest first
        part = frame(spark, HVAC, *rows[::-1][n::pieces], clean=False)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    reader = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1)
    return batch, reader.parquet(str(tmp_path / "in"))


def batch_form(batch):
    rows = quality.grade(cleaning.normalise(batch, P.HVAC), P.HVAC.rules)
    return kpis.hvac_kpis(faults.detect_faults(rows))


def run(stream, tmp_path, name):
    path = str(tmp_path / name)
    stages.start_append(stream, path, str(tmp_path / f"{name}-cp")).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def same(a, b):
    return compare.bag(a.columns, a.select(sorted(a.columns)).collect()) == compare.bag(
        b.columns, b.select(sorted(b.columns)).collect())


def test_stateless_stages_and_alarms_equal_their_batch_form(spark, tmp_path):
    batch, stream = raw_stream(spark, tmp_path)
    expected = batch_form(batch)
    assert same(run(stages.graded(stream, P.HVAC), tmp_path, "graded"), expected)
    alarms = rollups.alarm_log(stages.graded(stream, P.HVAC))
    assert same(run(alarms, tmp_path, "alarms"), rollups.alarm_log(expected))


REPORTS = {"daily": partials.HVAC_DAILY, "units": partials.EQUIPMENT_DAILY, "sketched": partials.HVAC_DAILY_SKETCHED}
BATCH_REPORTS = {
    "daily": rollups.hvac_daily_summary, "units": rollups.equipment_daily, "sketched": rollups.hvac_daily_summary}


def test_reports_equal_the_batch_reports(spark, tmp_path):
    batch, stream = raw_stream(spark, tmp_path)
    for period in (stages.DAY, stages.MONTH):
        root = str(tmp_path / f"out-{period}")
        stages.start_reports(stream, P.HVAC, root, f"{root}/cp", REPORTS, period).awaitTermination()
        for name, report in BATCH_REPORTS.items():
            expected = report(batch_form(batch))
            assert expected.where("dt = '2026-01-07'").count() > 0
            assert same(tables.scan(spark, f"{root}/{name}").drop(stages.PERIOD), expected)


def test_deduplication_over_all_batches(spark, tmp_path):
    batch, stream = raw_stream(spark, tmp_path)
    root = str(tmp_path / "clean")
    stages.start_deduplication(stream.union(stream), P.HVAC, root, f"{root}-cp").awaitTermination()
    keys = list(P.HVAC.dedup_keys)
    kept = tables.scan(spark, root).select(keys)
    assert kept.where("timestamp is null").count() == 1
    assert same(kept, cleaning.normalise(batch, P.HVAC).select(keys).distinct())


def test_a_new_checkpoint_keeps_what_an_old_one_wrote(spark, tmp_path):
    batch, stream = raw_stream(spark, tmp_path)
    stream = stream.withColumn(cleaning.RUN_ID, F.lit("run-7"))
    root = str(tmp_path / "out")
    for checkpoint in ("one", "two"):
        stages.start_grading(stream, P.HVAC, root, str(tmp_path / checkpoint)).awaitTermination()
    written = tables.scan(spark, f"{root}/validated")
    assert written.count() == 2 * batch.count()
    assert [r[0] for r in written.select(cleaning.RUN_ID).distinct().collect()] == ["run-7"]


def test_queries_read_tables_stored_as_folders(spark, small, tmp_path):
    from meterloom.plans.catalog import QUERIES

    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_hvac_daily_summary", "stream_hvac_graded"):
        assert same(QUERIES[name](spark, str(tmp_path)), QUERIES[name](spark, small))


def test_graded_stream_with_quarantine(spark, tmp_path):
    batch, stream = raw_stream(spark, tmp_path)
    root = str(tmp_path / "out")
    stages.start_grading(stream, P.HVAC, root, str(tmp_path / "cp")).awaitTermination()
    expected = batch_form(batch)
    critical = expected.where("data_quality_flag = 'critical'").count()
    assert tables.scan(spark, f"{root}/validated").count() == expected.count()
    assert tables.scan(spark, f"{root}/quarantine").count() == critical > 0


def feed(spark, tmp_path, *days, fresh=0):
    """Add one file of readings to a stream's folder, and read it as a stream."""
    rows = [
        {"timestamp": f"{day} {n:02d}:{fresh:02d}:00", "dt": day, "equipment_id": f"u{n % 3}", "building_id": "B0"}
        for day in days
        for n in range(6)
    ]
    part = frame(spark, HVAC, *rows, clean=False)
    part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def all_rows(spark, tmp_path):
    return batch_form(spark.read.parquet(str(tmp_path / "in")))


def test_reports_need_only_their_own_batch_and_partials(spark, tmp_path):
    root = str(tmp_path / "out")
    daily = {"daily": partials.HVAC_DAILY}
    for n in range(4):
        stream = feed(spark, tmp_path, "2026-01-05", f"2026-02-{n + 1:02d}", fresh=n)
        stages.start_reports(stream, P.HVAC, root, f"{root}/cp", daily).awaitTermination()
        tables.drop(spark, f"{root}/silver")  # what came before is not read again
        expected = rollups.hvac_daily_summary(all_rows(spark, tmp_path))
        assert same(tables.scan(spark, f"{root}/daily").drop(stages.PERIOD), expected)
    day = f"{root}/partials/daily/{stages.PERIOD}=2026-01-05"
    (stream,) = tables.folder_values(spark, day, stages.STREAM)
    # The last state and the one it was made from: a day does not collect folders.
    assert sorted(tables.folder_values(spark, f"{day}/{stages.STREAM}={stream}", stages.NUMBER)) == ["00000002", "00000003"]


def test_partials_read_the_periods_of_their_batch_only(spark, tmp_path):
    path = str(tmp_path / "partials")
    rows = batch_form(frame(spark, HVAC, *changes(), clean=False))
    stages.add_partials(rows, partials.HVAC_DAILY, path, "s-00000000")
    late = rows.where("dt = '2026-01-06'")
    found = stages.add_partials(late, partials.HVAC_DAILY, path, "s-00000001")
    assert all(f"{stages.PERIOD}=2026-01-06" in file for file in found.inputFiles())
    twice = rollups.hvac_daily_summary(late.unionAll(late))
    assert same(partials.HVAC_DAILY.report(found), twice)
    # Again after a failure, and from another stream.
    again = stages.add_partials(late, partials.HVAC_DAILY, path, "s-00000001")
    assert same(partials.HVAC_DAILY.report(again), twice)
    other = stages.add_partials(late, partials.HVAC_DAILY, path, "t-00000000")
    assert same(partials.HVAC_DAILY.report(other), rollups.hvac_daily_summary(late.unionAll(late).unionAll(late)))


def test_partials_of_pieces_merge_to_the_whole(spark):
    rows = batch_form(frame(spark, HVAC, *changes(), {"dt": None}, {"building_id": None}, clean=False))
    pieces = [rows.where(F.pmod(F.xxhash64("timestamp", "status_flag"), F.lit(3)) == n) for n in range(3)]
    for name, kind in REPORTS.items():
        merged = kind.partial(pieces[0])
        for piece in pieces[1:]:
            merged = kind.merged(merged.unionByName(kind.partial(piece)))
        assert same(kind.report(merged), BATCH_REPORTS[name](rows)), name


def test_deduplication_reads_the_days_of_its_batch_only(spark, tmp_path, monkeypatch):
    root, read = str(tmp_path / "clean"), []
    looked_up = stages.seen_keys

    def watch(*args):
        known = looked_up(*args)
        read.append(known.inputFiles())
        return known

    monkeypatch.setattr(stages, "seen_keys", watch)
    monkeypatch.setattr(stages, "KEY_FOLDERS", 3)
    for n, day in enumerate(["2026-01-05", "2026-01-06", "2026-01-05", "2026-01-05", "2026-01-05", "2026-01-05"]):
        stream = feed(spark, tmp_path, day, fresh=n % 4)
        stages.start_deduplication(stream, P.HVAC, root, f"{root}-cp").awaitTermination()
        assert all(f"{stages.KEY_DAY}={day}" in file for file in read[-1])
        seen = cleaning.normalise(spark.read.parquet(str(tmp_path / "in")), P.HVAC).select(*P.HVAC.dedup_keys)
        assert same(tables.scan(spark, root).select(*P.HVAC.dedup_keys), seen.distinct())
    held = tables.folder_values(spark, f"{root}-keys/{stages.KEY_DAY}=2026-01-05", stages.BATCH)
    assert any(value.startswith(stages.JOINED) for value in held) and len(held) <= 3
    rows = cleaning.normalise(spark.read.parquet(str(tmp_path / "in")), P.HVAC).where("dt = '2026-01-05'")
    plan = looked_up(rows, P.HVAC.dedup_keys, f"{root}-keys", "now")._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and f"GreaterThanOrEqual({stages.KEY_SECOND}" in plan
