"""Data quality checks. Each returns the violating rows; none means a pass."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quotepanel.schemas import KEYS

# Fixed value: the latest date may be this many days old.
STALE_DAYS = 4


class QualityError(RuntimeError):
    """A gate found violations; ``failures`` maps rule to violating rows."""

    def __init__(self, failures: dict[str, int]):
        super().__init__(f"quality checks failed: {failures}")
        self.failures = failures


def not_null(df: DataFrame, columns: list[str], keys: list[str] = KEYS) -> DataFrame:
    """One row per NULL in ``columns``, all rules in one pass over the data."""
    broken = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(f"not_null_{c}")) for c in columns]),
        lambda rule: rule.isNotNull(),
    )
    return df.select(F.explode(broken).alias("rule"), *keys)


def null_count(columns: list[str]) -> Column:
    """Aggregate with the number of rows that ``not_null`` would return."""
    nulls = reduce(Column.__add__, [F.col(c).isNull().cast("long") for c in columns])
    return F.coalesce(F.sum(nulls), F.lit(0))


def unique_key(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def stale(df: DataFrame, as_of: date, days: int = STALE_DAYS) -> DataFrame:
    """One row if the table is empty or its latest date is over ``days`` old."""
    latest = F.col("latest_result_date")
    return df.agg(F.max("result_date").alias("latest_result_date")).filter(
        (latest < F.date_sub(F.lit(as_of).cast("date"), days)) | latest.isNull()
    )


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """Violations per rule, zero included."""
    counts = [
        rows.agg(F.count("*").alias("failures")).select(F.lit(rule).alias("rule"), "failures")
        for rule, rows in checks.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def gate(checks: dict[str, DataFrame]) -> None:
    """Raise ``QualityError`` if any check has violations."""
    gate_counts({row["rule"]: row["failures"] for row in report(checks).collect()})


def gate_counts(failures: dict[str, int]) -> None:
    """As ``gate``, for violations that were counted while the rows were written."""
    failures = {rule: n for rule, n in failures.items() if n}
    if failures:
        raise QualityError(failures)


def is_empty(panel: DataFrame) -> bool:
    return panel.isEmpty()


def emptiness(panel: DataFrame) -> DataFrame:
    """One row: whether the panel has no rows."""
    return panel.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty"))
