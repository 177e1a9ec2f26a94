from __future__ import annotations

import math
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from readings import HVAC, UTILITY, column, frame

from meterloom import presets as P
from meterloom.functions import round_half_even, strip, title_case
from meterloom.operators import cleaning


def test_timestamps_that_cannot_be_read_become_null(spark):
    texts = ["2026-01-05 10:00:00", "bad", "2026-01-05T10:00:00", "2026-13-05 10:00:00", None, "2026-01-05"]
    raw = frame(spark, HVAC, *({"timestamp": t} for t in texts), clean=False)
    assert column(cleaning.normalise(raw, P.HVAC), "timestamp") == [
        datetime(2026, 1, 5, 10), None, None, None, None, None
    ]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    raw = frame(spark, HVAC, {"timestamp": "2026-03-29 02:30:00"}, clean=False)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        rows = cleaning.normalise(raw, P.HVAC).select(F.col("timestamp").cast("string").alias("t"))
        assert column(rows, "t") == ["2026-03-29 02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_numbers_that_cannot_be_read_become_null(spark):
    texts = {"1.5": 1.5, " 2 ": 2.0, "1e2": 100.0, "x": None, "1d": None, "1f": None, "0x10": None,
             "1,000": None, "": None, "nan": None, "-.5": -0.5, "7.": 7.0, None: None,
             "inf": math.inf}
    raw = frame(spark, HVAC, *({"supply_air_temp": t} for t in texts), clean=False)
    assert column(cleaning.normalise(raw, P.HVAC), "supply_air_temp") == list(texts.values())


def test_nan_and_whole_numbers(spark):
    raw = frame(spark, HVAC, {"fan_speed_pct": math.nan}, {"fan_speed_pct": 3.0}, clean=False)
    assert column(cleaning.normalise(raw, P.HVAC), "fan_speed_pct") == [None, 3.0]
    whole = raw.withColumn("fan_speed_pct", F.lit(7))
    assert column(cleaning.normalise(whole, P.HVAC), "fan_speed_pct") == [7.0, 7.0]


def test_only_the_fault_code_is_filled(spark):
    raw = frame(spark, HVAC, {"fault_code": None, "equipment_id": None, "duct_pressure": None}, clean=False)
    row = cleaning.normalise(raw, P.HVAC).first()
    assert (row["fault_code"], row["equipment_id"], row["duct_pressure"]) == ("NONE", None, None)


def test_text_is_stripped_and_titled(spark):
    raw = frame(spark, HVAC, {"status_flag": " fault ", "equipment_id": "\t AHU-B1-01 \n"},
                {"status_flag": "OFFLINE"}, clean=False)
    rows = cleaning.normalise(raw, P.HVAC)
    assert column(rows, "status_flag") == ["Fault", "Offline"]
    assert column(rows, "equipment_id")[0] == "AHU-B1-01"
    meters = frame(spark, UTILITY, {"utility_type": " chilled WATER"}, clean=False)
    assert column(cleaning.normalise(meters, P.UTILITY), "utility_type") == ["Chilled Water"]


TEXT = st.text(alphabet="abXY -_'.59\té ", max_size=8)


@settings(max_examples=20, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_text_functions_equal_python(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    found = rows.select(strip(F.col("v")), title_case(F.col("v"))).collect()
    assert [tuple(row) for row in found] == [(v.strip(), v.title()) for v in values]


def test_rounding_is_half_even(spark):
    row = spark.range(1).select(
        round_half_even(F.lit(0.25), 1), round_half_even(F.lit(0.35), 1), round_half_even(F.lit(12.345), 2)
    ).first()
    assert tuple(row) == (0.2, 0.4, 12.34)


def test_first_delivery_survives(spark):
    raw = frame(
        spark, HVAC,
        {"_ingested_at": "2026-01-02", "_source_file": "a", "supply_air_temp": 61.0},
        {"_ingested_at": "2026-01-01", "_source_file": "b", "supply_air_temp": 62.0},
        {"_ingested_at": "2026-01-01", "_source_file": "a", "supply_air_temp": 63.0},
    )
    assert column(cleaning.deduplicate(raw, P.HVAC.dedup_keys), "supply_air_temp") == [63.0]


def test_missing_ids_are_one_key_or_none(spark):
    raw = frame(spark, HVAC, {"equipment_id": None, "building_id": "B1"},
                {"equipment_id": None, "building_id": "B2"}, {}, {})
    keys = P.HVAC.dedup_keys
    assert cleaning.deduplicate(raw, keys).count() == 2
    assert cleaning.deduplicate(raw, keys, null_keys="keep").count() == 3
    with pytest.raises(ValueError):
        cleaning.deduplicate(raw, keys, null_keys="drop")


def test_known_keys_are_left_out(spark):
    known = frame(spark, HVAC, {}, {"equipment_id": None})
    raw = frame(spark, HVAC, {"supply_air_temp": 1.0}, {"equipment_id": None}, {"equipment_id": "new"})
    left = cleaning.without_known(raw, known, P.HVAC.dedup_keys)
    assert left.columns == raw.columns
    assert column(left, "equipment_id") == ["new"]


def test_dedup_counts(spark):
    rows = frame(spark, HVAC, {"_pipeline_run_id": "a"}, {"_pipeline_run_id": "b"},
                 {"equipment_id": "x", "_pipeline_run_id": "b"})
    found = cleaning.dedup_counts(rows, P.HVAC.dedup_keys).first().asDict()
    assert found == {"rows_in": 3, "rows_out": 2, "duplicates_removed": 1, "new_runs": 2}
    none = cleaning.dedup_counts(rows.where("false"), P.HVAC.dedup_keys).first().asDict()
    assert set(none.values()) == {0}


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    """A third of all rows share one key; the map side keeps one row per task."""
    rows = spark.range(30_000).selectExpr(
        "timestamp_ntz'2026-01-05 00:00:00' + make_dt_interval(0, 0, IF(id % 3 = 0, 0, id)) AS timestamp",
        "'AHU-B1-01' AS equipment_id", "id",
    )
    kept = cleaning.deduplicate(rows, P.HVAC.dedup_keys, order_by=["id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("1, Partial"), plan.index("Exchange")
    assert plan.index("1, Final") < exchange < partial  # printed top down
    assert kept.count() == 20_001
    assert kept.where("timestamp = timestamp_ntz'2026-01-05 00:00:00'").first()["id"] == 0
