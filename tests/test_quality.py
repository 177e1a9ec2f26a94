from __future__ import annotations

import pytest
from readings import HVAC, UTILITY, column, frame

from meterloom import presets as P
from meterloom.operators import inspection, quality


def graded(df, dataset):
    return [tuple(r) for r in quality.grade(df, dataset.rules).select(
        "data_quality_flag", "data_quality_issues").collect()]


@pytest.mark.parametrize("name, span", P.HVAC_RANGES.items())
def test_ranges_include_their_bounds(spark, name, span):
    low, high = map(float, span)
    values = [low, high, low - 0.01, high + 0.01, None]
    base = {**HVAC, "supply_air_temp": 30.0, "return_air_temp": 100.0}
    found = graded(frame(spark, base, *({name: v} for v in values)), P.HVAC)
    outside = f"{name}_out_of_range"
    assert [outside in issues for _, issues in found] == [False, False, True, True, True]
    assert [flag == "critical" for flag, _ in found] == [False, False, True, True, True]


def test_identifiers_are_required(spark):
    rows = frame(spark, HVAC, {"timestamp": None}, {"equipment_id": None}, {"building_id": None}, {})
    assert graded(rows, P.HVAC) == [("critical", "missing_identifier")] * 3 + [("clean", "")]


def test_all_failed_rules_are_listed_in_order(spark):
    rows = frame(
        spark, HVAC,
        {"supply_air_temp": 400.0, "return_air_temp": 72.0},
        {"supply_air_temp": 76.0, "return_air_temp": 74.0},
        {"supply_air_temp": 70.0, "return_air_temp": 70.0},
        {"equipment_id": None, "duct_pressure": -5.0, "fan_speed_pct": None},
    )
    assert graded(rows, P.HVAC) == [
        ("critical", "supply_air_temp_out_of_range;supply_warmer_than_return"),
        ("warning", "supply_warmer_than_return"),
        ("clean", ""),
        ("critical", "missing_identifier;fan_speed_pct_out_of_range;duct_pressure_out_of_range"),
    ]


def test_meter_rules(spark):
    cases = {
        ("actual_consumption_kwh", -0.1): ("critical", "negative_actual_consumption"),
        ("actual_consumption_kwh", 0.0): ("clean", ""),
        ("actual_consumption_kwh", None): ("clean", ""),
        ("peak_demand_kw", -1.0): ("critical", "negative_peak_demand;peak_below_actual"),
        ("peak_demand_kw", 99.9): ("warning", "peak_below_actual"),
        ("peak_demand_kw", 100.0): ("clean", ""),
        ("cost_rate", 0.0): ("critical", "non_positive_cost_rate"),
        ("cost_rate", 0.01): ("clean", ""),
        ("expected_consumption_kwh", 0.0): ("warning", "non_positive_expected_consumption"),
        ("expected_consumption_kwh", None): ("clean", ""),
    }
    rows = frame(spark, UTILITY, *({name: value} for name, value in cases))
    assert graded(rows, P.UTILITY) == list(cases.values())


def test_strict_rules_fail_on_missing_values(spark):
    rows = frame(spark, UTILITY, {"cost_rate": None})
    assert graded(rows, P.UTILITY.strict()) == [("critical", "non_positive_cost_rate")]


def test_rules_are_checked():
    with pytest.raises(ValueError):
        quality.Rule("x", "fatal", "true")
    with pytest.raises(ValueError):
        quality.Rule("x'y", "critical", "true")


def test_no_rules(spark):
    assert [tuple(r)[-2:] for r in quality.grade(frame(spark, HVAC), []).collect()] == [("clean", "")]


def test_duplicates_and_run_log(spark):
    rows = quality.grade(
        frame(spark, HVAC, {}, {}, {"equipment_id": "x", "supply_air_temp": 0.0},
              {"equipment_id": None}, {"equipment_id": None}), P.HVAC.rules)
    assert quality.duplicate_audit(rows, P.HVAC.dedup_keys).first()[0] == 4
    assert quality.duplicate_audit(rows.where("false"), P.HVAC.dedup_keys).first()[0] == 0
    assert quality.run_log(rows, P.HVAC.dedup_keys, "r", "now").first().asDict() == {
        "run_id": "r", "logged_at": "now", "total_rows": 5, "clean": 2, "warning": 0, "critical": 3,
        "duplicates_found": 4,
    }
    assert quality.quarantined(rows).count() == 3
    assert {tuple(r) for r in quality.flag_mix(rows).collect()} == {("clean", 2), ("critical", 3)}


@pytest.fixture(scope="module")
def mixed(spark):
    rows = frame(
        spark, HVAC,
        *({"timestamp": f"2026-01-05 10:{n:02d}:00", "supply_air_temp": t, "building_id": b}
          for n, (t, b) in enumerate([(60.0, "B1"), (76.0, "B1"), (400.0, "B2"), (400.0, "B1"), (77.0, "B2")])),
    )
    return quality.grade(rows, P.HVAC.rules)


def test_flagged_rows(mixed):
    assert len(column(inspection.flagged_rows(mixed, "equipment_id"), "timestamp")) == 4
    assert inspection.flagged_rows(mixed, "equipment_id", limit=2).count() == 2
    assert inspection.flagged_rows(mixed, "equipment_id", "warning").count() == 2
    assert inspection.flagged_rows(mixed, "equipment_id", "critical").count() == 2
    with pytest.raises(ValueError):
        inspection.flagged_rows(mixed, "equipment_id", "clean")


def test_breakdowns(mixed):
    assert [tuple(r) for r in inspection.issue_histogram(mixed).collect()] == [
        ("supply_warmer_than_return", 4), ("supply_air_temp_out_of_range", 2)]
    assert [tuple(r) for r in inspection.top_partitions(mixed).collect()] == [
        ("B1", "2026-01-05", 2), ("B2", "2026-01-05", 2)]
    assert inspection.top_partitions(mixed, limit=1).count() == 1


def test_samples_below_and_beyond_the_group_limit(spark, mixed):
    few = inspection.flag_samples(mixed, "equipment_id", ["supply_air_temp"], limit=1)
    assert few.count() == 3
    many = inspection.flag_samples(mixed, "equipment_id", ["supply_air_temp"], limit=5_000)
    assert many.count() == 5
    assert many.columns == few.columns
