"""Data-quality rules: grading rows, quarantine, duplicate audit, run log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.functions.conditions import FLAG, is_critical

ISSUES = "data_quality_issues"
SEVERITIES = ("critical", "warning")


@dataclass(frozen=True)
class Rule:
    """A named test, as plain data: ``fails`` is the SQL condition under which a
    row fails; ``on_null`` says whether an unknown outcome counts as failing."""

    name: str
    severity: str
    fails: str
    on_null: bool = False

    def __post_init__(self):
        if self.severity not in SEVERITIES:
            raise ValueError(f"unknown severity {self.severity!r}")
        if not self.name.replace("_", "").isalnum():
            raise ValueError(f"rule name {self.name!r} is not made of letters, digits and _")

    @property
    def mask(self) -> str:
        """The condition, never null."""
        return f"coalesce({self.fails}, {str(self.on_null).lower()})"


def required(name: str, severity: str, *columns: str) -> Rule:
    """Fails when any of the columns is missing."""
    return Rule(name, severity, " OR ".join(f"`{column}` IS NULL" for column in columns))


def outside(name: str, severity: str, column: str, low: float, high: float) -> Rule:
    """Fails outside the inclusive range; a missing value is outside."""
    test = f"`{column}` NOT BETWEEN {_number(low)} AND {_number(high)}"
    return Rule(name, severity, test, on_null=True)


def below(name: str, severity: str, column: str, limit: float) -> Rule:
    return Rule(name, severity, f"`{column}` < {_number(limit)}")


def at_most(name: str, severity: str, column: str, limit: float) -> Rule:
    return Rule(name, severity, f"`{column}` <= {_number(limit)}")


def exceeds(name: str, severity: str, column: str, other: str) -> Rule:
    """Fails when one column is greater than another."""
    return Rule(name, severity, f"`{column}` > `{other}`")


def _number(value: float) -> str:
    return f"{float(value)!r}D"


def grade(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the worst severity and the names of all failed rules, in rule order."""
    worst = [
        f"WHEN {' OR '.join(rule.mask for rule in tests)} THEN '{severity}'"
        for severity in SEVERITIES
        if (tests := [rule for rule in rules if rule.severity == severity])
    ]
    flag = f"CASE {' '.join(worst)} ELSE 'clean' END" if worst else "'clean'"
    names = [f"CASE WHEN {rule.mask} THEN '{rule.name}' END" for rule in rules]
    return df.withColumns(
        {FLAG: F.expr(flag), ISSUES: F.expr(f"concat_ws({', '.join([repr(';'), *names])})")}
    )


def quarantined(graded: DataFrame) -> DataFrame:
    """A copy of the critical rows; the graded table keeps them too."""
    return graded.where(is_critical())


def duplicate_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows share their key with another row."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return copies.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicates_found"))


def flag_mix(graded: DataFrame) -> DataFrame:
    return graded.groupBy(FLAG).agg(F.count(F.lit(1)).alias("row_count"))


def run_log(graded: DataFrame, keys: Sequence[str], run_id: str, logged_at: str) -> DataFrame:
    """The run's audit row: totals, flag mix and duplicates from one scan.

    Flags are counted per key before the shuffle, then summed.
    """
    counted = {level: F.count_if(F.col(FLAG) == level) for level in ("clean", "warning", "critical")}
    per_key = graded.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"), *(c.alias(level) for level, c in counted.items())
    )

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return per_key.agg(
        total(F.col("copies")).alias("total_rows"),
        *(total(F.col(level)).alias(level) for level in counted),
        total(F.when(F.col("copies") > 1, F.col("copies"))).alias("duplicates_found"),
    ).select(F.lit(run_id).alias("run_id"), F.lit(logged_at).alias("logged_at"), "*")
