"""Dimensions derived from cleaned facts, and star joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom import presets as P


def _lookup(key: Column, table: Mapping[str, str]) -> Column:
    """A small fixed table as an expression: no join, null when absent."""
    chain = F.lit(None).cast("string")
    for name, value in reversed(list(table.items())):
        chain = F.when(key == name, value).otherwise(chain)
    return chain


def dim_equipment(hvac: DataFrame, equipment_type: str = "AHU") -> DataFrame:
    """One row per unit and building; the number is what follows the last dash."""
    units = hvac.select("equipment_id", "building_id").dropna().distinct()
    number = F.substring_index("equipment_id", "-", -1).try_cast("int")
    return units.select(
        "equipment_id",
        "building_id",
        F.lit(equipment_type).alias("equipment_type"),
        number.alias("equipment_number"),
    )


def dim_meter(utility: DataFrame) -> DataFrame:
    return utility.select("meter_id", "building_id", "utility_type").dropna(
        subset=["meter_id", "building_id"]
    ).distinct()


def building_texts(building: Column, building_types: Mapping[str, str]) -> list[Column]:
    """Name and type of a building follow from its id."""
    name = F.concat(F.lit("Building "), F.substring(building, 2, 1 << 30))
    return [name.alias("building_name"), _lookup(building, building_types).alias("building_type")]


def dim_building(
    hvac: DataFrame,
    utility: DataFrame,
    building_types: Mapping[str, str] = P.BUILDING_TYPES,
) -> DataFrame:
    """One row per building seen on either feed, with its units and meters."""
    units = hvac.dropna(subset=["building_id"]).groupBy("building_id").agg(
        F.count_distinct("equipment_id").alias("equipment_count")
    )
    meters = utility.dropna(subset=["building_id"]).groupBy("building_id").agg(
        F.count_distinct("meter_id").alias("meter_count")
    )
    building = F.col("building_id")
    return units.join(meters, "building_id", "full").select(
        "building_id",
        *building_texts(building, building_types),
        F.coalesce("equipment_count", F.lit(0)).alias("equipment_count"),
        F.coalesce("meter_count", F.lit(0)).alias("meter_count"),
    )


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("day_date")
    return days.select(
        day.cast("string").alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        F.weekofyear(day).alias("week_of_year"),
        F.quarter(day).alias("quarter"),
    )


def dim_date(spark: SparkSession, year: int) -> DataFrame:
    """Every day of one year."""
    first, last = F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year), F.lit(12), F.lit(31))
    return _calendar(spark.range(1).select(F.explode(F.sequence(first, last)).alias("day_date")))


def dim_date_of(facts: DataFrame, day_column: str = "dt") -> DataFrame:
    """Every day of the years the facts cover, first to last.

    The years come from one min/max aggregate; the facts are not shuffled.
    """
    day = F.col(day_column).try_cast("date")
    span = facts.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    first = F.trunc("first", "year")
    last = F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1)
    return _calendar(span.select(F.explode(F.sequence(first, last)).alias("day_date")))


def dim_alarm_type(spark: SparkSession, alarm_types=P.ALARM_TYPES) -> DataFrame:
    """The few fixed types as inline values, whose size the planner knows."""
    text = lambda value: "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(f"({', '.join(map(text, row))})" for row in alarm_types)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(alarm_type, description, category)")


def star(fact: DataFrame, *joins: tuple[DataFrame, list[str]]) -> DataFrame:
    """Left joins of a fact to its dimensions.

    Spark decides per dimension whether it is small enough to broadcast: it
    checks the size against ``spark.sql.autoBroadcastJoinThreshold``, again at
    run time under AQE, and shuffles (splitting skewed keys) beyond it.
    """
    for dimension, keys in joins:
        fact = fact.join(dimension, keys, "left")
    return fact


def alarm_star(
    alarms: DataFrame,
    alarm_types: DataFrame,
    building_types: Mapping[str, str] = P.BUILDING_TYPES,
) -> DataFrame:
    """Alarms per building and type with the text of both dimensions.

    Counted before the join, so only group rows meet the types; what the building
    dimension would add follows from the building's id.
    """
    counted = alarms.groupBy("building_id", "alarm_type").agg(
        F.count(F.lit(1)).alias("alarm_count"),
        F.min("timestamp").alias("first_alarm"),
        F.max("timestamp").alias("last_alarm"),
    )
    return star(counted, (alarm_types, ["alarm_type"])).select(
        "building_id",
        *building_texts(F.col("building_id"), building_types),
        "alarm_type",
        "category",
        "description",
        "alarm_count",
        "first_alarm",
        "last_alarm",
    )
