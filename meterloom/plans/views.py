"""Raw sensor and meter feeds derived from the star-schema tables.

Every row of ``events`` becomes an HVAC reading and every row of ``lineitem`` a
meter reading, with the flaws real feeds have: unreadable times and numbers, NaN,
missing ids, stray white space, mixed case, re-delivered rows. The text is valid
in Spark and in DuckDB, so both sides of a check start from the same readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


HVAC_RAW = """
SELECT
  CASE WHEN event_id % 97 = 0 THEN 'not a time'
       ELSE substr(CAST(ts AS {text}), 1, 16) || ':00' END AS timestamp,
  CASE WHEN event_id % 37 = 0 THEN NULL
       WHEN event_id % 5 = 0
         THEN chr(9) || ' AHU-B' || (user_id % 5 + 1) || '-0' || (user_id % 3 + 1) || ' '
       ELSE 'AHU-B' || (user_id % 5 + 1) || '-0' || (user_id % 3 + 1) END AS equipment_id,
  'B' || (user_id % 5 + 1) AS building_id,
  CASE WHEN event_id % 89 = 0 THEN 'n/a'
       WHEN event_id % 83 = 0 THEN '60.5d'
       WHEN event_id % 41 = 0 THEN '400'
       ELSE CAST(54.0::DOUBLE + (event_id * 7 % 300) / 10.0::DOUBLE AS {text})
  END AS supply_air_temp,
  70.0::DOUBLE + (event_id * 11 % 90) / 10.0::DOUBLE AS return_air_temp,
  CASE WHEN event_id % 101 = 0 THEN 'nan'::DOUBLE
       ELSE (event_id * 13 % 1000) / 10.0::DOUBLE END AS fan_speed_pct,
  (event_id * 17 % 70) / 10.0::DOUBLE AS duct_pressure,
  (event_id * 19 % 101) / 100.0::DOUBLE AS filter_pressure_drop,
  42.0::DOUBLE + (event_id * 23 % 260) / 10.0::DOUBLE AS cooling_coil_temp,
  100.0::DOUBLE + (event_id * 29 % 350) / 10.0::DOUBLE AS heating_coil_temp,
  68.0::DOUBLE + (event_id * 31 % 200) / 10.0::DOUBLE AS outdoor_air_temp,
  CASE WHEN event_type = 'error' THEN ' HC-412 ' END AS fault_code,
  CASE event_type
    WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'FAULT' ELSE ' fault' END
    WHEN 'signup' THEN 'warning ' WHEN 'purchase' THEN 'OFFLINE'
    ELSE CASE WHEN event_id % 3 = 0 THEN 'operational' ELSE 'Operational ' END
  END AS status_flag,
  CAST(CAST(ts AS DATE) AS {text}) AS dt,
  'landing/hvac-' || (event_id % 16) || '.parquet' AS _source_file,
  '2026-01-0' || (event_id % 4 + 1) || 'T00:00:00+00:00' AS _ingested_at,
  'run-' || (event_id % 4 + 1) AS _pipeline_run_id
FROM events
"""

UTILITY_RAW = """
SELECT
  substr(CAST(l_shipdate AS {text}), 1, 10) || ' '
    || lpad(CAST(l_orderkey % 24 AS {text}), 2, '0') || ':00:00' AS timestamp,
  CASE WHEN l_orderkey % 53 = 0 THEN NULL
       ELSE 'MTR-B' || (l_suppkey % 5 + 1) || '-' ||
         CASE l_linenumber % 3 WHEN 0 THEN 'ELEC' WHEN 1 THEN 'CHW' ELSE 'GAS' END
  END AS meter_id,
  'B' || (l_suppkey % 5 + 1) AS building_id,
  CASE l_linenumber % 3 WHEN 0 THEN ' electricity' WHEN 1 THEN 'CHILLED water' ELSE 'Gas' END
    AS utility_type,
  CASE WHEN l_orderkey % 31 = 0 THEN NULL
       WHEN l_orderkey % 29 = 0 THEN -l_quantity
       ELSE l_quantity * 4.0::DOUBLE END AS actual_consumption_kwh,
  (l_partkey * 7 % 2000) / 10.0::DOUBLE AS expected_consumption_kwh,
  CASE WHEN l_orderkey % 43 = 0 THEN -1.0::DOUBLE WHEN l_orderkey % 47 = 0 THEN 0.0::DOUBLE
       ELSE l_quantity * 4.0::DOUBLE + (l_orderkey % 11 - 2) END AS peak_demand_kw,
  l_discount AS cost_rate,
  substr(CAST(l_shipdate AS {text}), 1, 10) AS dt,
  'landing/utility-' || (l_partkey % 16) || '.parquet' AS _source_file,
  '2026-01-0' || (l_orderkey % 4 + 1) || 'T00:00:00+00:00' AS _ingested_at,
  'run-' || (l_orderkey % 4 + 1) AS _pipeline_run_id
FROM lineitem
"""

# Orders as runs of the six stages; a few stages were skipped, failed or cancelled.
RUNS_RAW = """
SELECT
  'run-' || o_orderkey AS run_id,
  CASE WHEN o_custkey % 2 = 0 THEN 'schedule' ELSE 'manual' END AS triggered_by,
  CAST(o_orderdate AS {text}) AS logged_at,
  CAST(o_orderkey % 600 AS BIGINT) AS duration_seconds,
  CASE WHEN o_orderkey % 11 = 0 THEN 'failure' ELSE 'success' END AS bronze_status,
  CASE WHEN o_orderkey % 11 = 0 THEN 'skipped' ELSE 'success' END AS staging_status,
  CASE WHEN o_orderkey % 13 = 0 THEN 'cancelled' ELSE 'success' END AS dq_status,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'success' END AS fault_detection_status,
  'success' AS silver_status,
  CASE WHEN o_orderkey % 13 = 0 THEN 'skipped' ELSE 'success' END AS gold_status
FROM orders
"""


def for_duckdb(view: str) -> str:
    return view.format(text="VARCHAR")


def derive(spark: SparkSession, sf_dir: str, view: str, table: str) -> DataFrame:
    """The view over one Parquet table, as a DataFrame."""
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    text = view.format(text="STRING").replace(f"FROM {table}", f"FROM {{{table}}}")
    return spark.sql(text, **{table: source})


def hvac_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, HVAC_RAW, "events")


def utility_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, UTILITY_RAW, "lineitem")


def runs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, RUNS_RAW, "orders")
