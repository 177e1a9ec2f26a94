"""DuckDB SQL that states, in its own way, what each registered query returns."""

from __future__ import annotations

from meterloom import presets as P
from meterloom.plans.views import HVAC_RAW, RUNS_RAW, UTILITY_RAW, for_duckdb


def _trim(name: str) -> str:
    return f"trim({name}, ' ' || chr(9))"


def _stamp() -> str:
    shape = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
    return (
        f"CASE WHEN regexp_full_match(\"timestamp\", '{shape}') "
        'THEN TRY_CAST("timestamp" AS TIMESTAMP) END AS "timestamp"'
    )


def _word(name: str) -> str:
    return f"upper({name}[1]) || lower({name}[2:])"


_AUDIT = "dt, _source_file, _ingested_at, _pipeline_run_id"

_HVAC_NORM = f"""
SELECT {_stamp()}, {_trim('equipment_id')} AS equipment_id, {_trim('building_id')} AS building_id,
  TRY_CAST(supply_air_temp AS DOUBLE) AS supply_air_temp, return_air_temp,
  CASE WHEN isnan(fan_speed_pct) THEN NULL ELSE fan_speed_pct END AS fan_speed_pct,
  duct_pressure, filter_pressure_drop, cooling_coil_temp, heating_coil_temp, outdoor_air_temp,
  coalesce({_trim('fault_code')}, 'NONE') AS fault_code,
  {_word(_trim('status_flag'))} AS status_flag, {_AUDIT}
FROM hvac_raw
"""

_UTILITY_NORM = f"""
SELECT {_stamp()}, {_trim('meter_id')} AS meter_id, {_trim('building_id')} AS building_id,
  array_to_string(list_transform(string_split({_trim('utility_type')}, ' '),
    lambda w: {_word('w')}), ' ') AS utility_type,
  actual_consumption_kwh, expected_consumption_kwh, peak_demand_kw, cost_rate, {_AUDIT}
FROM utility_raw
"""


def _first(source: str, keys: str, rest: list[str]) -> str:
    order = ", ".join(f"{name} NULLS FIRST" for name in ["_ingested_at", "_source_file", *rest])
    return f"""
SELECT * FROM {source}
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1
"""


_HVAC_CLEAN = _first(
    "hvac_norm", '"timestamp", equipment_id',
    ["building_id", *P.HVAC_RANGES, "fault_code", "status_flag", "dt", "_pipeline_run_id"],
)
_UTILITY_CLEAN = _first(
    "utility_norm", '"timestamp", meter_id',
    ["building_id", "utility_type", "actual_consumption_kwh", "expected_consumption_kwh",
     "peak_demand_kw", "cost_rate", "dt", "_pipeline_run_id"],
)


def _graded(source: str, rules: list[tuple[str, str, str]]) -> str:
    """``rules``: name, severity, and a condition that is null-free."""
    def worst(severity: str) -> str:
        return " OR ".join(f"({test})" for _, level, test in rules if level == severity)

    issues = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, _, test in rules)
    return f"""
SELECT *, CASE WHEN {worst('critical')} THEN 'critical' WHEN {worst('warning')} THEN 'warning'
  ELSE 'clean' END AS data_quality_flag, concat_ws(';', {issues}) AS data_quality_issues
FROM {source}
"""


def _out(column: str, low: float, high: float) -> str:
    return f"{column} IS NULL OR {column} < {low} OR {column} > {high}"


_HVAC_RULES = [
    ("missing_identifier", "critical",
     '"timestamp" IS NULL OR equipment_id IS NULL OR building_id IS NULL'),
    *((f"{c}_out_of_range", "critical", _out(c, *span)) for c, span in P.HVAC_RANGES.items()),
    ("supply_warmer_than_return", "warning", "coalesce(supply_air_temp > return_air_temp, false)"),
]
_UTILITY_RULES = [
    ("missing_identifier", "critical",
     '"timestamp" IS NULL OR meter_id IS NULL OR building_id IS NULL'),
    ("negative_actual_consumption", "critical", "coalesce(actual_consumption_kwh < 0, false)"),
    ("negative_peak_demand", "critical", "coalesce(peak_demand_kw < 0, false)"),
    ("non_positive_cost_rate", "critical", "coalesce(cost_rate <= 0, false)"),
    ("non_positive_expected_consumption", "warning",
     "coalesce(expected_consumption_kwh <= 0, false)"),
    ("peak_below_actual", "warning", "coalesce(peak_demand_kw < actual_consumption_kwh, false)"),
]

_HVAC_FAULTS = """
SELECT *,
  CASE WHEN data_quality_flag <> 'critical'
    THEN supply_air_temp > 78 OR heating_coil_temp > 130 END AS overheating_flag,
  CASE WHEN data_quality_flag <> 'critical'
    THEN fan_speed_pct > 30 AND cooling_coil_temp > 55 END AS coolant_leak_flag,
  coalesce(lower(status_flag) = 'fault', false) AS operational_fault_flag
FROM {source}
"""
_HVAC_SILVER = """
SELECT *,
  CASE WHEN data_quality_flag <> 'critical' THEN return_air_temp - supply_air_temp END
    AS temp_differential,
  CASE WHEN data_quality_flag = 'critical' THEN NULL
    WHEN supply_air_temp < return_air_temp THEN 'Cooling'
    WHEN supply_air_temp >= return_air_temp THEN 'Heating' END AS operating_mode,
  CASE WHEN data_quality_flag = 'critical' OR filter_pressure_drop IS NULL THEN NULL
    WHEN filter_pressure_drop < 0.3 THEN 'Good' WHEN filter_pressure_drop < 0.5 THEN 'Monitor'
    WHEN filter_pressure_drop < 0.8 THEN 'Replace Soon' ELSE 'Replace Now' END
    AS filter_health_status
FROM {source}
"""
_UTILITY_SILVER = """
SELECT *,
  CASE WHEN data_quality_flag <> 'critical' AND expected_consumption_kwh <> 0 THEN round_even(
    (actual_consumption_kwh - expected_consumption_kwh) / expected_consumption_kwh * 100, 1) END
    AS consumption_variance_pct,
  CASE WHEN data_quality_flag <> 'critical'
    THEN coalesce(actual_consumption_kwh > expected_consumption_kwh, false) END
    AS is_over_consuming,
  CASE WHEN data_quality_flag <> 'critical'
    THEN round_even(actual_consumption_kwh * cost_rate, 2) END AS estimated_cost,
  CASE WHEN data_quality_flag <> 'critical' AND peak_demand_kw <> 0
    THEN round_even(actual_consumption_kwh / peak_demand_kw, 3) END AS load_factor,
  CASE WHEN data_quality_flag = 'critical' THEN NULL
    WHEN hour("timestamp") BETWEEN 14 AND 19 THEN 'Peak'
    WHEN hour("timestamp") IN (10, 11, 12, 13, 20, 21) THEN 'Shoulder' ELSE 'Off-Peak' END
    AS time_of_use_period
FROM {source}
"""


_CTES = {
    "hvac_raw": for_duckdb(HVAC_RAW),
    "hvac_norm": _HVAC_NORM,
    "hvac_clean": _HVAC_CLEAN,
    "hvac_dq": _graded("hvac_clean", _HVAC_RULES),
    "hvac_fault": _HVAC_FAULTS.format(source="hvac_dq"),
    "hvac_silver": _HVAC_SILVER.format(source="hvac_fault"),
    "hvac_norm_dq": _graded("hvac_norm", _HVAC_RULES),
    "hvac_norm_fault": _HVAC_FAULTS.format(source="hvac_norm_dq"),
    "hvac_norm_silver": _HVAC_SILVER.format(source="hvac_norm_fault"),
    "utility_raw": for_duckdb(UTILITY_RAW),
    "utility_norm": _UTILITY_NORM,
    "utility_clean": _UTILITY_CLEAN,
    "utility_dq": _graded("utility_clean", _UTILITY_RULES),
    "utility_silver": _UTILITY_SILVER.format(source="utility_dq"),
    "utility_norm_dq": _graded("utility_norm", _UTILITY_RULES),
    "utility_norm_silver": _UTILITY_SILVER.format(source="utility_norm_dq"),
    "runs_raw": for_duckdb(RUNS_RAW),
}


def sql(body: str, **more: str) -> str:
    """``body`` over the named intermediate results it needs."""
    available = {**_CTES, **more}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, definition in available.items():
            if name not in needed and any(
                f"{word} {name}{end}" in f"{text} "
                for word in ("FROM", "JOIN") for end in (" ", "\n", ")", ",")
            ):
                needed.add(name)
                visit(definition)

    visit(body)
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in available.items() if name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


_FLAG_COUNTS = """
  count(*) FILTER (WHERE data_quality_flag = 'clean') AS clean_readings,
  count(*) FILTER (WHERE data_quality_flag = 'warning') AS warning_readings,
  count(*) FILTER (WHERE data_quality_flag = 'critical') AS critical_readings"""


def _mean(name: str) -> str:
    return f"CAST(sum(CAST({name} AS DECIMAL(18, 6))) AS DOUBLE) / count({name})"


def _total(name: str, digits: int) -> str:
    exact = f"CAST(sum(CAST({name} AS DECIMAL(18, 6))) AS DOUBLE)"
    return f"round_even(coalesce({exact}, 0), {digits})"


def _hvac_daily(source: str) -> str:
    """Two aggregates and a left join, unlike the query it checks."""
    return f"""
SELECT c.*, m.avg_temp_differential, m.filter_replace_now_count,
  round_even(m.operational::DOUBLE / c.total_readings * 100, 1) AS uptime_pct
FROM (SELECT building_id, dt, count(DISTINCT equipment_id) AS equipment_count,
    count(equipment_id) AS total_readings, {_FLAG_COUNTS},
    count(*) FILTER (WHERE overheating_flag) AS overheating_events,
    count(*) FILTER (WHERE coolant_leak_flag) AS coolant_leak_events,
    count(*) FILTER (WHERE operational_fault_flag) AS operational_fault_events
  FROM {source} WHERE building_id IS NOT NULL AND dt IS NOT NULL GROUP BY building_id, dt) c
LEFT JOIN (SELECT building_id, dt, round_even({_mean('temp_differential')}, 1) AS avg_temp_differential,
    count(*) FILTER (WHERE filter_health_status = 'Replace Now') AS filter_replace_now_count,
    count(*) FILTER (WHERE lower(status_flag) = 'operational') AS operational
  FROM {source} WHERE data_quality_flag <> 'critical' GROUP BY building_id, dt) m
ON c.building_id = m.building_id AND c.dt = m.dt
"""


def _utility_daily(source: str) -> str:
    return f"""
SELECT c.*, m.total_actual_consumption_kwh, m.total_estimated_cost, m.avg_variance_pct,
  m.over_consuming_count
FROM (SELECT building_id, dt, utility_type, count(meter_id) AS total_readings, {_FLAG_COUNTS}
  FROM {source} GROUP BY ALL) c
LEFT JOIN (SELECT building_id, dt, utility_type,
    {_total('actual_consumption_kwh', 1)} AS total_actual_consumption_kwh,
    {_total('estimated_cost', 2)} AS total_estimated_cost,
    round_even({_mean('consumption_variance_pct')}, 1) AS avg_variance_pct,
    count(*) FILTER (WHERE is_over_consuming) AS over_consuming_count
  FROM {source} WHERE data_quality_flag <> 'critical' GROUP BY ALL) m
USING (building_id, dt, utility_type)
"""

def _equipment_daily(source: str) -> str:
    return f"""
SELECT c.*, m.avg_filter_pressure_drop,
  round_even(m.operational::DOUBLE / c.total_readings * 100, 1) AS uptime_pct
FROM (SELECT building_id, equipment_id, dt, count(*) AS total_readings, {_FLAG_COUNTS},
    count(*) FILTER (WHERE overheating_flag) AS overheating_count,
    count(*) FILTER (WHERE coolant_leak_flag) AS coolant_leak_count,
    count(*) FILTER (WHERE operational_fault_flag) AS operational_fault_count
  FROM {source} WHERE equipment_id IS NOT NULL GROUP BY building_id, equipment_id, dt) c
LEFT JOIN (SELECT building_id, equipment_id, dt,
    round_even({_mean('filter_pressure_drop')}, 2) AS avg_filter_pressure_drop,
    count(*) FILTER (WHERE lower(status_flag) = 'operational') AS operational
  FROM {source} WHERE data_quality_flag <> 'critical' GROUP BY building_id, equipment_id, dt) m
ON c.building_id = m.building_id AND c.equipment_id = m.equipment_id AND c.dt = m.dt
"""

_ALARMS = " UNION ALL ".join(
    f"""SELECT "timestamp", building_id, equipment_id, dt, status_flag, fault_code,
  '{alarm}' AS alarm_type FROM hvac_silver WHERE {flag}"""
    for alarm, flag in P.ALARM_FLAGS.items()
)

_BUILDING_TYPE = "CASE building_id " + " ".join(
    f"WHEN '{name}' THEN '{kind}'" for name, kind in P.BUILDING_TYPES.items()
) + " END"
_DIM_BUILDING = f"""
SELECT building_id, 'Building ' || building_id[2:] AS building_name, {_BUILDING_TYPE} AS building_type,
  coalesce(equipment_count, 0) AS equipment_count, coalesce(meter_count, 0) AS meter_count
FROM (SELECT building_id, count(DISTINCT equipment_id) AS equipment_count FROM hvac_clean
  GROUP BY building_id)
FULL JOIN (SELECT building_id, count(DISTINCT meter_id) AS meter_count FROM utility_clean
  GROUP BY building_id) USING (building_id)
WHERE building_id IS NOT NULL
"""
_ALARM_TYPES = "VALUES " + ", ".join(
    "(" + ", ".join(f"'{cell}'" for cell in row) + ")" for row in P.ALARM_TYPES
)


def _calendar(table: str, column: str) -> str:
    return f"""
SELECT CAST(d AS VARCHAR) AS date_key, year(d)::INTEGER AS year, month(d)::INTEGER AS month,
  monthname(d) AS month_name, day(d)::INTEGER AS day, (isodow(d) - 1)::INTEGER AS day_of_week,
  dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend, weekofyear(d)::INTEGER AS week_of_year,
  quarter(d)::INTEGER AS quarter
FROM (SELECT CAST(unnest(generate_series(date_trunc('year', min({column})),
  date_trunc('year', max({column})) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
  FROM {table})
"""


def _mix(source: str) -> str:
    return f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE data_quality_flag = 'clean') AS clean,
  count(*) FILTER (WHERE data_quality_flag = 'warning') AS warning,
  count(*) FILTER (WHERE data_quality_flag = 'critical') AS critical FROM {source}
"""


def _duplicates(source: str, keys: str) -> str:
    return f"""
SELECT coalesce(sum(n), 0)::BIGINT AS duplicates_found
FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys} HAVING count(*) > 1)
"""


def _profile(source: str, columns: tuple[str, ...]) -> str:
    nulls = {c: f"count(*) - count({c})" for c in columns}
    every = " AND ".join(f"count({c}) = 0" for c in columns)
    some = " OR ".join(f"count({c}) > 0" for c in columns)
    return f"""
SELECT data_quality_flag, count(*) AS row_count,
  {', '.join(f'{n} AS {c}_nulls' for c, n in nulls.items())},
  {every} AS all_null, {some} AS any_populated,
  CASE WHEN data_quality_flag = 'critical' THEN {every} ELSE {some} END AS as_expected
FROM {source} GROUP BY data_quality_flag
"""


def _samples(source: str, columns: tuple[str, ...], limit: int) -> str:
    shown = ", ".join(columns)
    order = ", ".join(f"{c} NULLS FIRST" for c in ('"timestamp"', *columns))
    return f"""
SELECT {shown} FROM {source}
QUALIFY row_number() OVER (PARTITION BY data_quality_flag ORDER BY {order}) <= {limit}
"""


def _histogram(source: str) -> str:
    return f"""
SELECT issue, count(*) AS row_count
FROM (SELECT unnest(string_split(data_quality_issues, ';')) AS issue
  FROM {source} WHERE data_quality_flag <> 'clean')
GROUP BY issue
"""


def _dedup_counts(source: str, keys: str) -> str:
    return f"""
SELECT sum(n)::BIGINT AS rows_in, count(*) AS rows_out, sum(n - 1)::BIGINT AS duplicates_removed,
  (SELECT count(DISTINCT _pipeline_run_id) FROM {source}) AS new_runs
FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys})
"""


_STATUS_COLUMNS = [f"{stage}_status" for stage in P.STAGES]

_DELIVERY = "CASE WHEN substr(dt, 9, 2) <= '15' THEN '1' ELSE '2' END"
_FIFTH = (
    "CASE WHEN substr(dt, 9, 2) BETWEEN '01' AND '06' THEN '1' WHEN substr(dt, 9, 2) BETWEEN '07' AND '12' THEN '2' "
    "WHEN substr(dt, 9, 2) BETWEEN '13' AND '18' THEN '3' WHEN substr(dt, 9, 2) BETWEEN '19' AND '24' THEN '4' ELSE '5' END"
)


def _landed_gold(ingested_at: str) -> str:
    """On disk a folder's path stands where the feed's own file names stood."""
    return sql(
        _hvac_daily("landed_silver"),
        landed_norm=f"SELECT * REPLACE ({ingested_at} AS _ingested_at, "
        "building_id || dt AS _source_file, '' AS _pipeline_run_id) FROM hvac_norm",
        landed_clean=_HVAC_CLEAN.replace("FROM hvac_norm", "FROM landed_norm"),
        landed_dq=_graded("landed_clean", _HVAC_RULES),
        landed_fault=_HVAC_FAULTS.format(source="landed_dq"),
        landed_silver=_HVAC_SILVER.format(source="landed_fault"),
    )


ORACLES: dict[str, str] = {
    "hvac_clean": sql("SELECT * FROM hvac_clean"),
    "utility_clean": sql("SELECT * FROM utility_clean"),
    "hvac_dedup_counts": sql(_dedup_counts("hvac_norm", '"timestamp", equipment_id')),
    "utility_dedup_counts": sql(_dedup_counts("utility_norm", '"timestamp", meter_id')),
    "hvac_new_rows": sql(
        """SELECT n.* FROM hvac_clean n WHERE NOT EXISTS (SELECT 1 FROM hvac_norm k
        WHERE k._pipeline_run_id = 'run-1' AND k."timestamp" IS NOT DISTINCT FROM n."timestamp"
        AND k.equipment_id IS NOT DISTINCT FROM n.equipment_id)"""
    ),
    "hvac_dq_flags": sql("SELECT * FROM hvac_dq"),
    "utility_dq_flags": sql("SELECT * FROM utility_dq"),
    "hvac_quarantine": sql("SELECT * FROM hvac_dq WHERE data_quality_flag = 'critical'"),
    "utility_quarantine": sql("SELECT * FROM utility_dq WHERE data_quality_flag = 'critical'"),
    "hvac_flag_mix": sql(
        "SELECT data_quality_flag, count(*) AS row_count FROM hvac_dq GROUP BY data_quality_flag"
    ),
    "utility_dq_run_log": sql(
        f"""SELECT 'run-check' AS run_id, '2026-01-01T00:00:00+00:00' AS logged_at, m.*, d.*
        FROM ({_mix('utility_norm_dq')}) m,
        ({_duplicates('utility_norm_dq', '"timestamp", meter_id')}) d"""
    ),
    "hvac_duplicate_audit": sql(_duplicates("hvac_norm", '"timestamp", equipment_id')),
    "lineitem_duplicate_audit": _duplicates("lineitem", "l_orderkey, l_linenumber"),
    "hvac_flagged_rows": sql(
        """SELECT "timestamp", building_id, equipment_id, data_quality_flag, data_quality_issues
        FROM hvac_dq WHERE data_quality_flag <> 'clean' ORDER BY "timestamp" NULLS FIRST,
        building_id, equipment_id NULLS FIRST, data_quality_flag, data_quality_issues LIMIT 25"""
    ),
    "hvac_issue_histogram": sql(_histogram("hvac_dq")),
    "utility_issue_histogram": sql(_histogram("utility_dq")),
    "utility_top_partitions": sql(
        """SELECT building_id, dt, count(*) AS row_count FROM utility_dq
        WHERE data_quality_flag <> 'clean' GROUP BY building_id, dt
        ORDER BY row_count DESC, building_id, dt LIMIT 10"""
    ),
    "hvac_kpi_null_profile": sql(_profile("hvac_silver", P.HVAC.kpi_columns)),
    "utility_kpi_null_profile": sql(_profile("utility_silver", P.UTILITY.kpi_columns)),
    "hvac_flag_samples": sql(
        _samples("hvac_silver", ("equipment_id", "data_quality_flag", *P.HVAC.kpi_columns), 5)
    ),
    "hvac_faults": sql("SELECT * FROM hvac_fault"),
    "hvac_fault_counts": sql(
        """SELECT count(*) AS row_count, count(*) FILTER (WHERE overheating_flag) AS overheating,
        count(*) FILTER (WHERE coolant_leak_flag) AS coolant_leak,
        count(*) FILTER (WHERE operational_fault_flag) AS operational_fault FROM hvac_fault"""
    ),
    "hvac_kpis": sql("SELECT * FROM hvac_silver"),
    "utility_kpis": sql("SELECT * FROM utility_silver"),
    "utility_enriched_count": sql(
        """SELECT count(*) AS row_count,
        count(*) FILTER (WHERE data_quality_flag <> 'critical') AS enriched FROM utility_silver"""
    ),
    "hvac_daily_summary": sql(_hvac_daily("hvac_silver")),
    "hvac_daily_summary_by_join": sql(_hvac_daily("hvac_silver")),
    "utility_daily_summary": sql(_utility_daily("utility_silver")),
    "utility_daily_summary_by_join": sql(_utility_daily("utility_silver")),
    "equipment_daily": sql(_equipment_daily("hvac_fault")),
    "equipment_daily_by_join": sql(_equipment_daily("hvac_fault")),
    "alarm_log": sql(_ALARMS),
    "dim_building": sql(_DIM_BUILDING),
    "dim_equipment": sql(
        """SELECT DISTINCT equipment_id, building_id, 'AHU' AS equipment_type,
        TRY_CAST(string_split(equipment_id, '-')[-1] AS INTEGER) AS equipment_number
        FROM hvac_clean WHERE equipment_id IS NOT NULL AND building_id IS NOT NULL"""
    ),
    "dim_meter": sql(
        """SELECT DISTINCT meter_id, building_id, utility_type FROM utility_clean
        WHERE meter_id IS NOT NULL AND building_id IS NOT NULL"""
    ),
    "dim_date": _calendar("lineitem", "l_shipdate"),
    "alarm_star": sql(
        f"""SELECT building_id, building_name, building_type, alarm_type, category, description,
        count(*) AS alarm_count, min("timestamp") AS first_alarm, max("timestamp") AS last_alarm
        FROM alarms LEFT JOIN ({_ALARM_TYPES}) k(alarm_type, description, category) USING (alarm_type)
        LEFT JOIN ({_DIM_BUILDING}) b USING (building_id) GROUP BY ALL""",
        alarms=_ALARMS,
    ),
    "incremental_rows": sql(
        """SELECT * FROM utility_raw WHERE _pipeline_run_id NOT IN
        (SELECT min(_pipeline_run_id) FROM utility_raw)"""
    ),
    "schema_contract_union": sql(
        """SELECT "timestamp", equipment_id, building_id, TRY_CAST(supply_air_temp AS DOUBLE)
        AS supply_air_temp, return_air_temp, CASE WHEN isnan(fan_speed_pct) THEN NULL ELSE
        fan_speed_pct END AS fan_speed_pct, duct_pressure, filter_pressure_drop,
        cooling_coil_temp, heating_coil_temp, outdoor_air_temp, fault_code, status_flag,
        CAST(NULL AS VARCHAR) AS firmware FROM hvac_raw
        UNION ALL
        SELECT CAST(o_orderdate AS VARCHAR), 'AHU-O' || o_custkey, 'B0', CAST(NULL AS DOUBLE),
        CAST(o_custkey AS DOUBLE), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
        CAST(o_orderkey AS VARCHAR) FROM orders"""
    ),
    "execution_history": sql(
        f"""SELECT run_id, triggered_by, logged_at, duration_seconds,
        CASE WHEN {' AND '.join(f"coalesce({c}, '') = 'success'" for c in _STATUS_COLUMNS)}
        THEN 'success' ELSE 'failure' END AS overall_status, {', '.join(_STATUS_COLUMNS)}
        FROM runs_raw"""
    ),
    "stage_totals": sql(
        f"""SELECT 'hvac_telemetry' AS dataset, h.* FROM ({_mix('hvac_dq')}) h
        UNION ALL SELECT 'utility_meter', u.* FROM ({_mix('utility_dq')}) u
        UNION ALL SELECT 'all', h.total_rows + u.total_rows, h.clean + u.clean,
        h.warning + u.warning, h.critical + u.critical
        FROM ({_mix('hvac_dq')}) h, ({_mix('utility_dq')}) u"""
    ),
    "stream_hvac_daily_summary": sql(_hvac_daily("hvac_norm_silver")),
    "stream_utility_daily_summary": sql(_utility_daily("utility_norm_silver")),
    "stream_equipment_daily": sql(_equipment_daily("hvac_norm_silver")),
    "stream_hvac_graded": sql(
        "SELECT data_quality_flag, count(*) AS row_count, count(overheating_flag) AS judged, "
        "count(temp_differential) AS with_kpis FROM hvac_norm_silver GROUP BY data_quality_flag"
    ),
    "stream_hvac_deduplicated": sql(
        """SELECT DISTINCT "timestamp", equipment_id FROM hvac_norm"""
    ),
    "stream_hvac_watermarked": sql(
        """SELECT DISTINCT "timestamp", equipment_id FROM hvac_norm"""
    ),
    "lake_hvac_bronze": sql(
        """SELECT building_id, dt, count(*) AS readings, count(outdoor_air_temp) AS outdoor_readings,
        count(fault_code) AS fault_codes, count(DISTINCT equipment_id) AS raw_units
        FROM (SELECT * REPLACE (CASE WHEN _pipeline_run_id > 'run-2' THEN NULL
          ELSE outdoor_air_temp END AS outdoor_air_temp, CASE WHEN _pipeline_run_id > 'run-2'
          THEN NULL ELSE fault_code END AS fault_code) FROM hvac_raw)
        GROUP BY building_id, dt"""
    ),
    "lake_drift": sql(
        """SELECT building_id, dt,
        CASE WHEN max(_pipeline_run_id) > 'run-2' THEN 'outdoor_air_temp' ELSE '' END AS missing,
        CASE WHEN min(_pipeline_run_id) <= 'run-2' THEN 'firmware' ELSE '' END AS extra
        FROM hvac_raw GROUP BY building_id, dt"""
    ),
    "lake_odd_paths": sql(
        """SELECT 'Main Hall 50%+:' || building_id AS building_id, dt, count(*) AS readings
        FROM hvac_raw GROUP BY building_id, dt"""
    ),
    "lake_stage_counts": sql(
        """SELECT count(*) AS rows_in, count(DISTINCT ("timestamp", equipment_id)) AS rows_out,
        count(*) - count(DISTINCT ("timestamp", equipment_id)) AS duplicates_removed
        FROM hvac_norm"""
    ),
    "lake_increment_counts": sql(
        f"""SELECT count(*) AS rows_in, count(DISTINCT ("timestamp", equipment_id)) AS rows_out,
        count(*) - count(DISTINCT ("timestamp", equipment_id)) AS duplicates_removed
        FROM hvac_norm GROUP BY {_DELIVERY}"""
    ),
    "lake_hvac_gold": _landed_gold("''"),
    "lake_rebuild": _landed_gold("''"),
    # Of two deliveries the first one's readings survive.
    "lake_replay": _landed_gold(_DELIVERY),
    "lake_compacted": _landed_gold(_FIFTH),
    "unit_sketches": sql(
        """SELECT 'hvac_telemetry' AS dataset, building_id, count(DISTINCT equipment_id) AS units, true AS within_bound
        FROM hvac_norm WHERE building_id IS NOT NULL AND dt IS NOT NULL GROUP BY building_id
        UNION ALL SELECT 'utility_meter', building_id, count(DISTINCT meter_id), true
        FROM utility_norm WHERE building_id IS NOT NULL AND dt IS NOT NULL GROUP BY building_id"""
    ),
    "hvac_daily_summary_sketched": sql(_hvac_daily("hvac_silver")),
}
