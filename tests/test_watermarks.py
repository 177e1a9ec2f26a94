"""Deduplication under a watermark: on-time keys once, late readings beside."""

from __future__ import annotations

import compare
import pytest
from readings import HVAC, frame

from meterloom import presets as P
from meterloom.operators import cleaning
from meterloom.streaming import watermarks as W

HOUR, KEYS = 3600, list(P.HVAC.dedup_keys)


def feed(spark, tmp_path, *pieces):
    """A stream with a micro-batch for each list of (time, unit)."""
    for piece in pieces:
        rows = [{"timestamp": time, "equipment_id": unit, "dt": "2026-01-05"} for time, unit in piece]
        frame(spark, HVAC, *rows, clean=False).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def run(stream, tmp_path, delay=HOUR):
    root = str(tmp_path / "out")
    for name, start in (("judge", W.start_judging), ("unique", W.start_within_watermark)):
        query = start(stream, P.HVAC, root, f"{root}/{name}-cp", delay)
        query.awaitTermination()
    return root, query


def keys_of(df):
    return compare.bag(KEYS, df.select(KEYS).collect())


def t(clock: str) -> str:
    return f"2026-01-05 {clock}:00"


FIRST = [(t("10:00"), "a"), (t("10:00"), "a"), (t("10:30"), None), (t("10:30"), None)]
SECOND = [(t("10:00"), "a"), (t("10:45"), "b"), (t("11:30"), "a"), ("bad", "a")]
THIRD = [(t("10:30"), "late"), (t("10:00"), "a"), (t("10:31"), "b"), (t("11:30"), "a"), (t("12:30"), "c")]


def test_late_readings_go_beside_and_every_key_stays_once(spark, tmp_path):
    stream = feed(spark, tmp_path, FIRST, SECOND, THIRD)
    before = spark.conf.get(W.STATE_STORE)
    root, query = run(stream, tmp_path)
    assert spark.conf.get(W.STATE_STORE) == before
    table = spark.read.parquet(f"{root}/table")
    everything = cleaning.normalise(spark.read.parquet(str(tmp_path / "in")), P.HVAC).select(KEYS).distinct()
    # Behind the newest reading by the delay or more: 10:00 of the second; all but 12:30 of the third.
    late = W.late_readings(stream, P.HVAC, root)
    assert late.count() == 2 + 4
    assert table.count() == 5 == table.select(KEYS).distinct().count()
    assert keys_of(W.settled(stream, P.HVAC, root)) == keys_of(everything)
    dropped = [op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators]
    assert dropped and sum(dropped) == 0
    # What comes later goes on from the state and the mark.
    stream = feed(spark, tmp_path, [(t("12:30"), "c"), (t("12:00"), "d"), (t("11:00"), "e")])
    root, query = run(stream, tmp_path)
    assert spark.read.parquet(f"{root}/table").count() == 6
    assert W.late_readings(stream, P.HVAC, root).count() == 2 + 4 + 1
    everything = cleaning.normalise(spark.read.parquet(str(tmp_path / "in")), P.HVAC).select(KEYS).distinct()
    assert keys_of(W.settled(stream, P.HVAC, root)) == keys_of(everything)


def test_old_state_goes(spark, tmp_path):
    pieces = [[(t(f"{hour:02d}:{m:02d}"), "a") for m in range(20)] for hour in range(2, 12, 2)]
    _, query = run(feed(spark, tmp_path, *pieces[:1]), tmp_path)
    for n in range(1, 5):
        _, query = run(feed(spark, tmp_path, pieces[n]), tmp_path)
    held = query.lastProgress.stateOperators[0]
    # Two hours apart and a delay of one: the last batches' keys are left of a hundred.
    assert held.numRowsTotal <= 40
    assert any(name.startswith("rocksdb") for name in held.customMetrics)


@pytest.mark.parametrize("times", [[], ["bad", None]])
def test_without_readings_or_times(spark, tmp_path, times):
    stream = feed(spark, tmp_path, [(time, "a") for time in times] or [("bad", "a")])
    if not times:
        stream = stream.where("false")
    root, _ = run(stream, tmp_path)
    assert W.late_readings(stream, P.HVAC, root).count() == min(len(times), 1)
    assert W.settled(stream, P.HVAC, root).count() == min(len(times), 1)
