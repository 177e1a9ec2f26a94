from __future__ import annotations

import random

import compare
import pytest
from readings import HVAC, UTILITY, frame

from meterloom import presets as P
from meterloom.operators import faults, kpis, quality, rollups
from meterloom.plans.catalog import QUERIES


def hvac(spark, *changes):
    return kpis.hvac_kpis(faults.detect_faults(quality.grade(frame(spark, HVAC, *changes), P.HVAC.rules)))


def utility(spark, *changes):
    return kpis.utility_kpis(quality.grade(frame(spark, UTILITY, *changes), P.UTILITY.rules))


def same(a, b) -> bool:
    return compare.bag(a.columns, a.collect()) == compare.bag(b.columns, b.collect())


def random_hvac(spark, seed, rows=400):
    pick = random.Random(seed)
    return hvac(spark, *(
        {
            "timestamp": f"2026-01-05 {pick.randrange(24):02d}:{pick.randrange(60):02d}:00",
            "equipment_id": pick.choice(["a", "b", "c", None]),
            "building_id": pick.choice(["B1", "B1", "B1", "B2", "B3", None]),
            "dt": pick.choice(["2026-01-05", "2026-01-06", "2026-01-07", None]),
            "supply_air_temp": pick.choice([60.5, 77.3, 79.9, 400.0, None]),
            "filter_pressure_drop": pick.choice([0.1, 0.35, 0.95, 2.5]),
            "cooling_coil_temp": pick.choice([45.0, 57.0]),
            "status_flag": pick.choice(["Operational", "Fault", "Offline", None]),
        }
        for _ in range(rows)
    ))


def random_utility(spark, seed, rows=400):
    pick = random.Random(seed)
    return utility(spark, *(
        {
            "building_id": pick.choice(["B1", "B2", None]),
            "dt": pick.choice(["2026-01-05", "2026-01-06", "2026-01-07"]),
            "utility_type": pick.choice(["Gas", "Electricity", None]),
            "meter_id": pick.choice(["m1", "m2", None]),
            "actual_consumption_kwh": pick.choice([10.1, 33.3, 90.7, -1.0, None]),
            "expected_consumption_kwh": pick.choice([30.0, 0.0, 47.3, None]),
            "peak_demand_kw": pick.choice([100.0, 20.0, 0.0]),
            "cost_rate": pick.choice([0.123, 0.3, 0.0]),
        }
        for _ in range(rows)
    ))


@pytest.mark.parametrize("seed", [1, 2])
def test_one_aggregate_equals_two_and_a_join(spark, seed):
    h, u = random_hvac(spark, seed), random_utility(spark, seed)
    assert same(rollups.hvac_daily_summary(h), rollups.hvac_daily_summary_by_join(h))
    assert same(rollups.equipment_daily(h), rollups.equipment_daily_by_join(h))
    assert same(rollups.utility_daily_summary(u), rollups.utility_daily_summary_by_join(u))


def test_results_do_not_depend_on_row_order(spark):
    h = random_hvac(spark, 3)
    assert same(rollups.hvac_daily_summary(h), rollups.hvac_daily_summary(h.repartition(7).orderBy("timestamp")))


def test_alarms_add_up_to_the_flags(spark):
    h = random_hvac(spark, 4)
    fired = faults.fault_counts(h).first()
    total = fired["overheating"] + fired["coolant_leak"] + fired["operational_fault"]
    assert rollups.alarm_log(h).count() == total > 0


def test_critical_rows_have_no_figures_and_are_all_quarantined(spark):
    h = random_hvac(spark, 5)
    critical = h.where("data_quality_flag = 'critical'")
    assert critical.count() > 0
    assert critical.dropna(how="all", subset=list(P.HVAC.kpi_columns)).count() == 0
    assert quality.quarantined(h).exceptAll(critical).count() == 0


def test_hand_counted_day(spark):
    rows = hvac(
        spark, {},
        {"equipment_id": "AHU-B1-02", "status_flag": "Fault", "heating_coil_temp": 140.0},
        {"equipment_id": None},
        {"supply_air_temp": 400.0, "equipment_id": "AHU-B1-03"},
        {"filter_pressure_drop": 0.9, "supply_air_temp": 75.5},
    )
    assert rollups.hvac_daily_summary(rows).first().asDict() == {
        "building_id": "B1", "dt": "2026-01-05", "equipment_count": 3, "total_readings": 4,
        "clean_readings": 2, "warning_readings": 1, "critical_readings": 2, "overheating_events": 1,
        "coolant_leak_events": 0, "operational_fault_events": 1, "avg_temp_differential": 8.8,
        "filter_replace_now_count": 1, "uptime_pct": 50.0,
    }


def test_a_group_without_reliable_rows(spark):
    row = rollups.hvac_daily_summary(hvac(spark, {"supply_air_temp": 400.0})).first()
    assert row["total_readings"] == row["critical_readings"] == 1
    assert (row["avg_temp_differential"], row["filter_replace_now_count"], row["uptime_pct"]) == (None,) * 3
    row = rollups.utility_daily_summary(utility(spark, {"cost_rate": 0.0})).first()
    assert (row["total_actual_consumption_kwh"], row["total_estimated_cost"],
            row["avg_variance_pct"], row["over_consuming_count"]) == (None,) * 4


def test_sums_of_nothing_are_zero(spark):
    row = rollups.utility_daily_summary(utility(spark, {"actual_consumption_kwh": None})).first()
    assert (row["total_actual_consumption_kwh"], row["total_estimated_cost"]) == (0.0, 0.0)
    assert (row["avg_variance_pct"], row["over_consuming_count"]) == (None, 0)


def test_two_alarms_at_once_and_none(spark):
    rows = hvac(spark, {"heating_coil_temp": 140.0, "cooling_coil_temp": 60.0})
    log = rollups.alarm_log(rows)
    assert {row["alarm_type"] for row in log.collect()} == {"overheating", "coolant_leak"}
    none = rollups.alarm_log(hvac(spark, {}))
    assert none.count() == 0 and none.columns == log.columns


# --- plans ------------------------------------------------------------------
def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_stages_need_no_shuffle(spark):
    plan = plan_of(hvac(spark, {}))
    assert "Exchange" not in plan and "Python" not in plan


def test_each_report_reads_its_table_once(spark, tmp_path):
    h, u = random_hvac(spark, 6, 50), random_utility(spark, 6, 50)
    h.write.parquet(str(tmp_path / "h"))
    u.write.parquet(str(tmp_path / "u"))
    h, u = spark.read.parquet(str(tmp_path / "h")), spark.read.parquet(str(tmp_path / "u"))
    for report, exchanges in (
        (rollups.equipment_daily(h), 1),
        (rollups.utility_daily_summary(u), 1),
        (rollups.hvac_daily_summary(h), 2),  # the second carries one row per unit and day
        (rollups.alarm_log(h), 0),
    ):
        plan = plan_of(report)
        assert plan.count("Exchange") == exchanges, plan
        assert plan.count("FileScan") == 1 and "Join" not in plan and "Python" not in plan


def test_unused_columns_are_not_read(spark, tmp_path):
    random_hvac(spark, 7, 50).write.parquet(str(tmp_path / "h"))
    table = spark.read.parquet(str(tmp_path / "h"))
    plan = plan_of(rollups.equipment_daily(table))
    assert "outdoor_air_temp" not in plan and "duct_pressure" not in plan
    assert "PushedFilters: [IsNotNull(" in plan_of(
        quality.quarantined(table).select("timestamp")
    ) or "EqualNullSafe" in plan_of(quality.quarantined(table).select("timestamp"))


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("lake", "stream"))))
def test_no_query_runs_python_or_crosses_rows(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    for node in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
