"""Fault signals and figures, at, below and above each threshold."""

from __future__ import annotations

import pytest
from readings import HVAC, UTILITY, column, frame

from meterloom import presets as P
from meterloom.functions import bucketize
from meterloom.operators import faults, kpis, quality


def hvac(spark, *changes):
    return kpis.hvac_kpis(faults.detect_faults(quality.grade(frame(spark, HVAC, *changes), P.HVAC.rules)))


def utility(spark, *changes):
    return kpis.utility_kpis(quality.grade(frame(spark, UTILITY, *changes), P.UTILITY.rules))


def test_overheating(spark):
    hot = {"return_air_temp": 95.0}
    rows = hvac(spark, {"supply_air_temp": 78.0, **hot}, {"supply_air_temp": 78.1, **hot},
                {"heating_coil_temp": 130.0}, {"heating_coil_temp": 130.1})
    assert column(rows, "overheating_flag") == [False, True, False, True]


def test_coolant_leak(spark):
    warm = {"cooling_coil_temp": 56.0}
    rows = hvac(spark, {"fan_speed_pct": 30.0, **warm}, {"fan_speed_pct": 30.1, **warm},
                {"cooling_coil_temp": 55.0}, {"cooling_coil_temp": 55.1})
    assert column(rows, "coolant_leak_flag") == [False, True, False, True]


def test_critical_rows_keep_only_the_reported_fault(spark):
    rows = hvac(spark, {"duct_pressure": -5.0, "supply_air_temp": 90.0, "status_flag": "Fault"})
    row = rows.first()
    assert row["overheating_flag"] is None and row["coolant_leak_flag"] is None
    assert row["operational_fault_flag"] is True
    assert [row[name] for name in P.HVAC.kpi_columns] == [None, None, None]


def test_reported_status(spark):
    rows = hvac(spark, *({"status_flag": s} for s in ("Fault", "fault", "Offline", "Warning", None)))
    assert column(rows, "operational_fault_flag") == [True, True, False, False, False]


def test_fault_counts(spark):
    rows = hvac(spark, {}, {"heating_coil_temp": 140.0, "status_flag": "Fault"}, {"duct_pressure": None})
    assert faults.fault_counts(rows).first().asDict() == {
        "row_count": 3, "overheating": 1, "coolant_leak": 0, "operational_fault": 1}
    assert faults.fault_counts(rows.where("false")).first()["overheating"] == 0


def test_differential_and_mode(spark):
    rows = hvac(spark, {}, {"supply_air_temp": 76.0, "return_air_temp": 74.0},
                {"supply_air_temp": 70.0, "return_air_temp": 70.0})
    assert column(rows, "temp_differential") == [14.0, -2.0, 0.0]
    assert column(rows, "operating_mode") == ["Cooling", "Heating", "Heating"]


def test_filter_buckets(spark):
    drops = [0.29, 0.3, 0.49, 0.5, 0.79, 0.8, 3.0, None]
    rows = hvac(spark, *({"filter_pressure_drop": d} for d in drops))
    assert column(rows, "filter_health_status") == [
        "Good", "Monitor", "Monitor", "Replace Soon", "Replace Soon", "Replace Now", "Replace Now", None]


def test_bucketize_checks_its_table():
    with pytest.raises(ValueError):
        bucketize(None, (1, 2), ("a", "b"))
    with pytest.raises(ValueError):
        bucketize(None, (2, 1), ("a", "b", "c"))


def test_meter_figures(spark):
    row = utility(spark, {}).first()
    assert (row["consumption_variance_pct"], row["is_over_consuming"], row["estimated_cost"],
            row["load_factor"], row["time_of_use_period"]) == (25.0, True, 20.0, 0.8, "Shoulder")


def test_divisions_by_zero_are_null(spark):
    rows = utility(spark, {"expected_consumption_kwh": 0.0, "actual_consumption_kwh": 5.0},
                   {"actual_consumption_kwh": 0.0, "peak_demand_kw": 0.0})
    assert column(rows, "consumption_variance_pct") == [None, -100.0]
    assert column(rows, "load_factor")[1] is None


def test_missing_consumption(spark):
    row = utility(spark, {"actual_consumption_kwh": None}).first()
    assert row["data_quality_flag"] == "clean"
    assert row["is_over_consuming"] is False
    assert (row["estimated_cost"], row["load_factor"], row["consumption_variance_pct"]) == (None,) * 3


def test_an_infinite_ratio_is_null(spark):
    row = utility(spark, {"actual_consumption_kwh": 1e308, "expected_consumption_kwh": 1e-10}).first()
    assert row["consumption_variance_pct"] is None


def test_critical_meter_rows_have_no_figures(spark):
    row = utility(spark, {"cost_rate": 0.0}).first()
    assert [row[name] for name in P.UTILITY.kpi_columns] == [None] * 5
    assert kpis.enriched_count(utility(spark, {}, {"cost_rate": 0.0})).first().asDict() == {
        "row_count": 2, "enriched": 1}


def test_time_of_use(spark):
    hours = [0, 9, 10, 13, 14, 19, 20, 21, 22, 23]
    rows = utility(spark, *({"timestamp": f"2026-01-05 {h:02d}:00:00"} for h in hours))
    short = {"Off-Peak": "o", "Shoulder": "s", "Peak": "p"}
    assert "".join(short[p] for p in column(rows, "time_of_use_period")) == "oosspps" + "soo"
