"""Daily reports from mergeable partial aggregates.

A report over a table that grows is kept as partials: additive counts and scaled sums, one
row per group and unit. Rows are reduced to partials once; partials of any pieces of
the table merge into those of the whole, in any order and to the last digit (scaled
sums are whole numbers); and a report is finished from merged partials without looking at a
reading again. The ``rollups`` state the same reports over rows.

Units are counted exactly by keeping one partial per unit, or by a sketch that merges
(:data:`HVAC_DAILY_SKETCHED`), which has one row per building and day.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom import presets as P
from meterloom.functions import holds, is_critical, ratio, round_half_even
from meterloom.functions.conditions import FLAG
from meterloom.operators import sketches
from meterloom.operators.faults import status_is
from meterloom.operators.rollups import BUILDING_DAY, BUILDING_DAY_TYPE, BUILDING_UNIT_DAY

Parts = Callable[[], dict[str, Column]]


@dataclass(frozen=True)
class Mergeable:
    """A report by ``keys`` from partials by ``keys`` and ``units``.

    ``parts`` are aggregates over rows that merge by a sum, ``unions`` (rows to
    sketch) by a sketch union. ``finish`` makes the report from sums by ``keys``; with
    ``units``, ``unit_count`` names their number.
    """

    keys: tuple[str, ...]
    parts: Parts
    finish: Callable[[], dict[str, Column]]
    units: tuple[str, ...] = ()
    unit_count: str | None = None
    unions: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()

    @property
    def by(self) -> tuple[str, ...]:
        return (*self.keys, *self.units)

    def partial(self, rows: DataFrame) -> DataFrame:
        """Partials of rows; a row without a key belongs to no group."""
        named = rows.dropna(subset=list(self.keys))
        made = {f"{name}_sketch": sketches.sketch(F.col(name)) for name in self.unions}
        made |= self.parts()
        return named.groupBy(*self.by).agg(*(value.alias(name) for name, value in made.items()))

    def merged(self, partials: DataFrame) -> DataFrame:
        """One partial for each group and unit."""
        return partials.groupBy(*self.by).agg(*self.sums())

    def report(self, partials: DataFrame) -> DataFrame:
        """The report of these partials, merged or not."""
        groups = self.merged(partials)
        if self.units:
            count = [F.count(self.units[0]).alias(self.unit_count)] if self.unit_count else []
            groups = groups.groupBy(*self.keys).agg(*count, *self.sums())
        made = self.finish()
        return groups.select(*self.keys, *(made.get(name, F.col(name)).alias(name) for name in self.columns))

    def sums(self) -> list[Column]:
        unions = [sketches.union(F.col(f"{name}_sketch")).alias(f"{name}_sketch") for name in self.unions]
        return unions + [F.sum(name).alias(name) for name in self.parts()]


def _reliable(value: Column) -> Column:
    return F.when(~is_critical(), value)


def _scaled(name: str, digits: int = 6) -> dict[str, Column]:
    """Sum and number of a measure's reliable values, as whole numbers of the last digit."""
    value = _reliable(F.col(name))
    return {f"{name}_sum": F.sum(F.rint(value * F.lit(float(10**digits)))), f"{name}_n": F.count(value)}


def _total(name: str, digits: int = 6) -> Column:
    return F.col(f"{name}_sum") / F.lit(float(10**digits))


def _mean(name: str, digits: int = 6) -> Column:
    return F.try_divide(_total(name, digits), F.col(f"{name}_n"))


def _known(value: Column) -> Column:
    return F.when(F.col("reliable_rows") > 0, value)


def _levels() -> dict[str, Column]:
    return {f"{level}_readings": F.count_if(F.col(FLAG) == level) for level in ("clean", "warning", "critical")}


def _operation() -> dict[str, Column]:
    return {
        "operational": F.count_if(~is_critical() & status_is("operational")),
        "reliable_rows": F.count_if(~is_critical()),
    }


def _uptime() -> Column:
    return _known(round_half_even(ratio(F.col("operational"), F.col("total_readings")) * 100, 1))


LEVELS = ("total_readings", "clean_readings", "warning_readings", "critical_readings")


def _hvac_parts() -> dict[str, Column]:
    return {
        "total_readings": F.count("equipment_id"),
        **_levels(),
        "overheating_events": F.count_if(F.col("overheating_flag")),
        "coolant_leak_events": F.count_if(F.col("coolant_leak_flag")),
        "operational_fault_events": F.count_if(F.col("operational_fault_flag")),
        **_scaled("temp_differential"),
        "replace_now": F.count_if(~is_critical() & holds(F.col("filter_health_status") == P.FILTER_LABELS[-1])),
        **_operation(),
    }


def _hvac_finish() -> dict[str, Column]:
    return {
        "avg_temp_differential": round_half_even(_mean("temp_differential"), 1),
        "filter_replace_now_count": _known(F.col("replace_now")),
        "uptime_pct": _uptime(),
    }


_HVAC_COLUMNS = (
    "equipment_count",
    *LEVELS,
    "overheating_events",
    "coolant_leak_events",
    "operational_fault_events",
    "avg_temp_differential",
    "filter_replace_now_count",
    "uptime_pct",
)
HVAC_DAILY = Mergeable(
    BUILDING_DAY, _hvac_parts, _hvac_finish, units=("equipment_id",), unit_count="equipment_count", columns=_HVAC_COLUMNS
)
HVAC_DAILY_SKETCHED = Mergeable(
    BUILDING_DAY,
    _hvac_parts,
    lambda: {**_hvac_finish(), "equipment_count": sketches.estimate(F.col("equipment_id_sketch"))},
    unions=("equipment_id",),
    columns=_HVAC_COLUMNS,
)
UTILITY_DAILY = Mergeable(
    BUILDING_DAY_TYPE,
    lambda: {
        "total_readings": F.count("meter_id"),
        **_levels(),
        **_scaled("actual_consumption_kwh"),
        **_scaled("estimated_cost", 2),
        **_scaled("consumption_variance_pct", 1),
        "over": F.count_if(~is_critical() & F.col("is_over_consuming")),
        "reliable_rows": F.count_if(~is_critical()),
    },
    lambda: {
        "total_actual_consumption_kwh": _known(
            round_half_even(F.coalesce(_total("actual_consumption_kwh"), F.lit(0.0)), 1)
        ),
        "total_estimated_cost": _known(round_half_even(F.coalesce(_total("estimated_cost", 2), F.lit(0.0)), 2)),
        "avg_variance_pct": round_half_even(_mean("consumption_variance_pct", 1), 1),
        "over_consuming_count": _known(F.col("over")),
    },
    columns=(*LEVELS, "total_actual_consumption_kwh", "total_estimated_cost", "avg_variance_pct", "over_consuming_count"),
)
EQUIPMENT_DAILY = Mergeable(
    BUILDING_UNIT_DAY,
    lambda: {
        "total_readings": F.count("equipment_id"),
        **_levels(),
        "overheating_count": F.count_if(F.col("overheating_flag")),
        "coolant_leak_count": F.count_if(F.col("coolant_leak_flag")),
        "operational_fault_count": F.count_if(F.col("operational_fault_flag")),
        **_scaled("filter_pressure_drop"),
        **_operation(),
    },
    lambda: {
        "avg_filter_pressure_drop": round_half_even(_mean("filter_pressure_drop"), 2),
        "uptime_pct": _uptime(),
    },
    columns=(
        *LEVELS,
        "overheating_count",
        "coolant_leak_count",
        "operational_fault_count",
        "avg_filter_pressure_drop",
        "uptime_pct",
    ),
)
