"""Dataset contracts, quality rules and thresholds shipped with the library.

Every operator takes these as parameters; another plant passes its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from meterloom.operators.quality import Rule, at_most, below, exceeds, outside, required

# ---------------------------------------------------------------------------
# Fixed values. Results depend on them, so they are spelled out here as text.
# ---------------------------------------------------------------------------
HVAC_COLUMNS = {
    "timestamp": "string",
    "equipment_id": "string",
    "building_id": "string",
    "supply_air_temp": "double",
    "return_air_temp": "double",
    "fan_speed_pct": "double",
    "duct_pressure": "double",
    "filter_pressure_drop": "double",
    "cooling_coil_temp": "double",
    "heating_coil_temp": "double",
    "outdoor_air_temp": "double",
    "fault_code": "string",
    "status_flag": "string",
}
UTILITY_COLUMNS = {
    "timestamp": "string",
    "meter_id": "string",
    "building_id": "string",
    "utility_type": "string",
    "actual_consumption_kwh": "double",
    "expected_consumption_kwh": "double",
    "peak_demand_kw": "double",
    "cost_rate": "double",
}
HVAC_RANGES = {
    "supply_air_temp": (30, 100),
    "return_air_temp": (50, 100),
    "fan_speed_pct": (0, 100),
    "duct_pressure": (0, 8),
    "filter_pressure_drop": (0, 3),
    "cooling_coil_temp": (30, 75),
    "heating_coil_temp": (70, 150),
    "outdoor_air_temp": (-30, 135),
}
SUPPLY_TOO_HOT = 78.0
HEATING_COIL_TOO_HOT = 130.0
FAN_RUNNING = 30.0
COOLING_COIL_TOO_WARM = 55.0
FILTER_BOUNDS = (0.3, 0.5, 0.8)
FILTER_LABELS = ("Good", "Monitor", "Replace Soon", "Replace Now")
PEAK_HOURS = (14, 15, 16, 17, 18, 19)
SHOULDER_HOURS = (10, 11, 12, 13, 20, 21)
ALARM_FLAGS = {
    "overheating": "overheating_flag",
    "coolant_leak": "coolant_leak_flag",
    "operational_fault": "operational_fault_flag",
}
ALARM_TYPES = (
    ("overheating",
     "Supply air or heating coil temperature operationally too hot, even though physically plausible",
     "Thermal"),
    ("coolant_leak",
     "Fan actively running but cooling coil temperature too high for that to be working properly",
     "Refrigerant"),
    ("operational_fault",
     "Equipment reported its own fault code / non-operational status",
     "Equipment-Reported"),
)
BUILDING_TYPES = {"B1": "Office", "B2": "Retail", "B3": "Warehouse", "B4": "Office", "B5": "Mixed-Use"}
STAGES = ("bronze", "staging", "dq", "fault_detection", "silver", "gold")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Dataset:
    """What one feed looks like and how its readings are judged."""

    name: str
    columns: dict[str, str]
    id_column: str
    dedup_keys: tuple[str, ...]
    rules: tuple[Rule, ...]
    kpi_columns: tuple[str, ...]
    titled: tuple[str, ...]
    null_fill: dict[str, str] = field(default_factory=dict)
    path_keys: tuple[str, ...] = ("building_id", "dt")

    @property
    def measures(self) -> tuple[str, ...]:
        return tuple(name for name, kind in self.columns.items() if kind == "double")

    @property
    def texts(self) -> tuple[str, ...]:
        return tuple(
            name for name, kind in self.columns.items() if kind == "string" and name != "timestamp"
        )

    def strict(self) -> "Dataset":
        """The same dataset with every rule failing on a missing value."""
        return replace(self, rules=tuple(replace(rule, on_null=True) for rule in self.rules))


HVAC = Dataset(
    name="hvac_telemetry",
    columns=HVAC_COLUMNS,
    id_column="equipment_id",
    dedup_keys=("timestamp", "equipment_id"),
    rules=(
        required("missing_identifier", "critical", "timestamp", "equipment_id", "building_id"),
        *(
            outside(f"{column}_out_of_range", "critical", column, low, high)
            for column, (low, high) in HVAC_RANGES.items()
        ),
        exceeds("supply_warmer_than_return", "warning", "supply_air_temp", "return_air_temp"),
    ),
    kpi_columns=("temp_differential", "operating_mode", "filter_health_status"),
    titled=("status_flag",),
    null_fill={"fault_code": "NONE"},
)

UTILITY = Dataset(
    name="utility_meter",
    columns=UTILITY_COLUMNS,
    id_column="meter_id",
    dedup_keys=("timestamp", "meter_id"),
    rules=(
        required("missing_identifier", "critical", "timestamp", "meter_id", "building_id"),
        below("negative_actual_consumption", "critical", "actual_consumption_kwh", 0),
        below("negative_peak_demand", "critical", "peak_demand_kw", 0),
        at_most("non_positive_cost_rate", "critical", "cost_rate", 0),
        at_most("non_positive_expected_consumption", "warning", "expected_consumption_kwh", 0),
        exceeds("peak_below_actual", "warning", "actual_consumption_kwh", "peak_demand_kw"),
    ),
    kpi_columns=(
        "consumption_variance_pct",
        "is_over_consuming",
        "estimated_cost",
        "load_factor",
        "time_of_use_period",
    ),
    titled=("utility_type",),
)

DATASETS = {dataset.name: dataset for dataset in (HVAC, UTILITY)}
