"""Checks and how they are evaluated.

All checks that are plain counts share one aggregate over the table, in which each task sends
one row. A check on distinct values or repeated keys gets a pass of its own that reads only its
columns: putting several of them into the shared aggregate would make Spark copy every row once
per distinct set. Meant for stored tables, where a narrow pass is cheap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASS, FAIL, WARNING = "PASS", "FAIL", "WARNING"


@dataclass(frozen=True)
class Counter:
    """A plain aggregate."""

    expr: Column


@dataclass(frozen=True)
class Distinct:
    """Distinct values of one column, nulls left out."""

    column: str
    where: Column | None = None


@dataclass(frozen=True)
class Repeats:
    """Repeated keys: surplus ``rows``, or ``groups`` of more than one row. Nulls equal nulls."""

    key: Sequence[str]
    measure: str = "rows"
    where: Column | None = None


@dataclass(frozen=True)
class Known:
    """A value settled without reading the table, such as its columns."""

    value: float


@dataclass(frozen=True)
class Outcome:
    """A one-row frame with the value in ``metric_value``."""

    frame: DataFrame


@dataclass(frozen=True)
class Check:
    table: str
    name: str
    metric: Counter | Distinct | Repeats | Known | Outcome
    passes: Callable[[Column], Column]
    threshold: float | None = 0.0
    on_breach: str = FAIL
    details: str = field(default="")


def at_most(limit: float) -> Callable[[Column], Column]:
    return lambda v: v <= limit


def at_least(limit: float) -> Callable[[Column], Column]:
    return lambda v: v >= limit


def none_of(cond: Column) -> Counter:
    return Counter(F.count_if(cond))


def _result(check: Check, value: Column) -> Column:
    value = value.cast("double")
    status = F.when(check.passes(value), PASS).otherwise(check.on_breach)
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.name).alias("metric_name"),
        value.alias("metric_value"),
        F.lit(check.threshold).cast("double").alias("threshold"),
        status.alias("status"),
        F.lit(check.details).alias("details"),
    )


def _rows(one_row: DataFrame, checks: Sequence[Check]) -> DataFrame:
    cells = [_result(c, F.col(f"m{i}")) for i, c in enumerate(checks)]
    return one_row.select(F.inline(F.array(*cells)))


def _narrow(df: DataFrame, metric: Distinct | Repeats) -> DataFrame:
    rows = df if metric.where is None else df.filter(metric.where)
    if isinstance(metric, Distinct):
        return rows.agg(F.count_distinct(metric.column).alias("m0"))
    groups = rows.groupBy(*metric.key).agg(F.count("*").alias("n"))
    if metric.measure == "groups":
        return groups.agg(F.count_if(F.col("n") > 1).alias("m0"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("m0"))


def run_checks(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """One row per check: table, name, value, threshold, status, details."""
    checks = list(checks)
    counters = [c for c in checks if isinstance(c.metric, Counter)]
    parts = []
    if counters:
        totals = df.agg(*[c.metric.expr.alias(f"m{i}") for i, c in enumerate(counters)])
        parts.append(_rows(totals, counters))
    for check in checks:
        metric = check.metric
        if isinstance(metric, (Distinct, Repeats)):
            parts.append(_rows(_narrow(df, metric), [check]))
        elif isinstance(metric, Outcome):
            one = metric.frame.select(F.col("metric_value").alias("m0"))
            parts.append(_rows(one, [check]))
        elif isinstance(metric, Known):
            one = df.sparkSession.range(1).select(F.lit(metric.value).alias("m0"))
            parts.append(_rows(one, [check]))
    return reduce(DataFrame.unionByName, parts)
