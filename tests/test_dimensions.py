from __future__ import annotations

import warnings

import pytest
from readings import HVAC, UTILITY, frame

from meterloom import presets as P
from meterloom.operators import dimensions, inspection, kpis, monitoring, quality


def test_equipment_and_meters(spark):
    units = frame(spark, HVAC, {}, {}, {"equipment_id": "AHU-B2-12", "building_id": "B2"},
                  {"equipment_id": "odd", "building_id": "B2"}, {"equipment_id": None})
    assert {tuple(r) for r in dimensions.dim_equipment(units).collect()} == {
        ("AHU-B1-01", "B1", "AHU", 1), ("AHU-B2-12", "B2", "AHU", 12), ("odd", "B2", "AHU", None)}
    meters = frame(spark, UTILITY, {}, {}, {"meter_id": None})
    assert [tuple(r) for r in dimensions.dim_meter(meters).collect()] == [("MTR-B1-ELEC", "B1", "Electricity")]


def test_buildings_on_either_feed(spark):
    units = frame(spark, HVAC, {}, {"equipment_id": "x"}, {"building_id": None})
    meters = frame(spark, UTILITY, {}, {"building_id": "B77"})
    assert {tuple(r) for r in dimensions.dim_building(units, meters).collect()} == {
        ("B1", "Building 1", "Office", 2, 1), ("B77", "Building 77", None, 0, 1)}


def test_dates(spark):
    year = {r["date_key"]: r for r in dimensions.dim_date(spark, 2026).collect()}
    assert len(year) == 365
    assert year["2026-01-01"].asDict() == {
        "date_key": "2026-01-01", "year": 2026, "month": 1, "month_name": "January", "day": 1,
        "day_of_week": 3, "day_name": "Thursday", "is_weekend": False, "week_of_year": 1, "quarter": 1}
    assert year["2026-12-27"]["is_weekend"] is True and year["2026-12-27"]["day_of_week"] == 6
    assert dimensions.dim_date(spark, 2024).count() == 366
    later = dimensions.dim_date(spark, 2027).where("date_key = '2027-01-01'").first()
    assert later["week_of_year"] == 53


def test_dates_of_facts_fill_whole_years(spark):
    facts = frame(spark, HVAC, {"dt": "2023-05-01"}, {"dt": "2024-02-01"}, {"dt": "bad"})
    assert dimensions.dim_date_of(facts).count() == 365 + 366
    assert dimensions.dim_date_of(facts.where("false")).count() == 0


def test_star_keeps_facts_without_a_dimension_row(spark):
    types = dimensions.dim_alarm_type(spark)
    assert types.count() == 3
    fact = spark.createDataFrame([("overheating", 1), ("other", 2)], "alarm_type string, n int")
    rows = {r["alarm_type"]: r["category"] for r in dimensions.star(fact, (types, ["alarm_type"])).collect()}
    assert rows == {"overheating": "Thermal", "other": None}


def test_profile_of_figures(spark):
    rows = kpis.utility_kpis(quality.grade(frame(spark, UTILITY, {}, {"cost_rate": 0.0}), P.UTILITY.rules))
    found = {r["data_quality_flag"]: r for r in inspection.kpi_null_profile(rows, P.UTILITY.kpi_columns).collect()}
    assert found["critical"]["all_null"] and found["critical"]["as_expected"]
    assert found["clean"]["any_populated"] and found["clean"]["load_factor_nulls"] == 0


STATUSES = dict.fromkeys(P.STAGES, "success")


@pytest.mark.parametrize("change, overall", [
    ({}, "success"), ({"gold": "skipped"}, "failure"), ({"dq": "cancelled"}, "failure"), ({"silver": None}, "failure")])
def test_overall_status(spark, change, overall):
    record = monitoring.run_record(spark, "r", "manual", 245, "now", {**STATUSES, **change})
    assert record.first()["overall_status"] == overall
    assert record.columns[:5] == ["run_id", "triggered_by", "logged_at", "duration_seconds", "overall_status"]


def test_history_grows_and_a_failed_append_only_warns(spark, tmp_path):
    record = monitoring.run_record(spark, "r", "manual", 245, "now", STATUSES)
    path = str(tmp_path / "history")
    assert monitoring.append_history(record, path) and monitoring.append_history(record, path)
    assert spark.read.parquet(path).count() == 2
    (tmp_path / "file").write_text("in the way")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        assert not monitoring.append_history(record, str(tmp_path / "file" / "history"))
    assert any("could not append" in str(w.message) for w in caught)
    with pytest.raises(ValueError):
        monitoring.run_record(spark, "r", "manual", 1, "now", {"gold": "success"})


def test_dimensions_do_not_deduplicate_first(spark, small):
    """One shuffle for a distinct, no window; the star join scans the alarms' table once."""
    from meterloom.plans.catalog import QUERIES

    def plan(name):
        return QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()

    for name in ("dim_meter", "dim_equipment", "dim_building"):
        assert "Window" not in plan(name)
    assert plan("alarm_star").count("] parquet") == 1
