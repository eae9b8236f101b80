"""Data-quality checks. Each returns its failing rows; a suite counts them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, functions as F

from shelfline.session import shuffles_dropped


def _rows(df: DataFrame, where: str | None) -> DataFrame:
    return df.where(where) if where else df


def check_unique(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    """Non-null values that occur more than once, with their count."""
    return check_unique_combination(_rows(df, where).where(F.col(column).isNotNull()), [column])


def check_unique_combination(df: DataFrame, columns: list[str], where: str | None = None) -> DataFrame:
    counted = _rows(df, where).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where(F.col("n_records") > 1)


def _bad_not_null(column: str) -> Column:
    return F.col(column).isNull()


def _bad_accepted(column: str, values: list) -> Column:
    return F.coalesce(~F.col(column).isin(*values), F.lit(False))


def _bad_expression(expression: str) -> Column:
    return ~F.coalesce(F.expr(expression), F.lit(False))


def check_not_null(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    return _rows(df, where).where(_bad_not_null(column))


def check_accepted_values(df: DataFrame, column: str, values: list, where: str | None = None) -> DataFrame:
    """Values outside the list, with their count; null passes."""
    bad = _rows(df, where).where(_bad_accepted(column, values))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def check_expression(df: DataFrame, expression: str, where: str | None = None) -> DataFrame:
    """Rows for which the expression is not true."""
    return _rows(df, where).where(_bad_expression(expression))


def check_relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, where: str | None = None
) -> DataFrame:
    """Child rows whose value is missing in the parent; null passes.

    The parent is not made distinct first: an anti join does not need it, and both sides then come
    straight from a shuffle, which lets AQE split a hot child value. It is never sent to all executors by the planner's
    guess either: a parent that explodes rows, as snapshots do, is guessed at the size of its files.
    """
    rows = _rows(child, where).where(F.col(column).isNotNull())
    known = parent.select(F.col(parent_column).alias("_known")).hint("merge")
    return rows.join(known, rows[column] == known["_known"], "left_anti")


def check_payment_reconciliation(fct_payments: DataFrame, tol: Decimal = Decimal("0.009")) -> DataFrame:
    """Sales whose payments do not add up: to the total if completed, to zero if voided or returned."""
    sums = (
        fct_payments.where(~F.col("is_deleted"))
        .groupBy("transaction_id")
        .agg(
            F.max("status").alias("status"),
            F.max("transaction_total").alias("transaction_total"),
            F.sum("amount").alias("net_paid"),
        )
    )
    expected = F.when(F.col("status") == "completed", F.col("transaction_total")).otherwise(F.lit(0))
    return sums.where(F.abs(expected - F.col("net_paid")) > F.lit(tol))


# ---------------------------------------------------------------- suite
@dataclass
class Check:
    """A named check. Give `bad`, a row predicate over `df`; or `column` of `df` and the `parent` and column that have
    to hold its values; or `failing`, a frame of failing rows."""

    name: str
    df: DataFrame | None = None
    bad: Column | None = None
    failing: DataFrame | None = None
    severity: str = "error"
    where: str | None = None
    column: str | None = None
    parent: DataFrame | None = None
    parent_column: str | None = None

    def count(self) -> Column:
        """Failing rows of a row check."""
        return F.count_if((F.expr(self.where) if self.where else F.lit(True)) & self.bad)


def unique(name, df, columns, severity="error", where=None) -> Check:
    one = isinstance(columns, str)
    failing = check_unique(df, columns, where) if one else check_unique_combination(df, columns, where)
    return Check(name, failing=failing, severity=severity)


def not_null(name, df, column, severity="error", where=None) -> Check:
    return Check(name, df, _bad_not_null(column), severity=severity, where=where)


def accepted(name, df, column, values, severity="error", where=None) -> Check:
    return Check(name, df, _bad_accepted(column, values), severity=severity, where=where)


def expression(name, df, text, severity="error", where=None) -> Check:
    return Check(name, df, _bad_expression(text), severity=severity, where=where)


def relationships(name, child, column, parent, parent_column, severity="error", where=None) -> Check:
    return Check(name, child, severity=severity, where=where, column=column, parent=parent, parent_column=parent_column)


def _summary(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row checks of one frame in one pass over it."""
    counts = df.agg(*[c.count().alias(f"c{i}") for i, c in enumerate(checks)])
    return counts.select(F.explode(_told(checks, [F.col(f"c{i}") for i in range(len(checks))])).alias("r")).select("r.*")


def _told(checks: list[Check], failures: list[Column]) -> Column:
    return F.array(*[
        F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), n.alias("failures"))
        for c, n in zip(checks, failures)
    ])


def _references(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All foreign keys of one frame in one pass over it: its distinct values with their counts, of which those
    without a parent are added up. A hot value is one row of each task."""
    values = F.array(*[
        F.struct(F.lit(i).alias("of"), F.when(F.expr(c.where) if c.where else F.lit(True), F.col(c.column).cast("string")).alias("value"))
        for i, c in enumerate(checks)
    ])
    held = (df.select(F.explode(values).alias("v")).select("v.*").where("value is not null")
            .groupBy("of", "value").agg(F.count(F.lit(1)).alias("n")))
    known = reduce(DataFrame.unionByName, [
        c.parent.select(F.lit(i).alias("of"), F.col(c.parent_column).cast("string").alias("value")) for i, c in enumerate(checks)])
    lacking = held.join(known.hint("merge"), ["of", "value"], "left_anti")   # as in check_relationships
    counts = lacking.agg(*[F.coalesce(F.sum(F.when(F.col("of") == i, F.col("n"))), F.lit(0)).alias(f"c{i}") for i in range(len(checks))])
    return counts.select(F.explode(_told(checks, [F.col(f"c{i}") for i in range(len(checks))])).alias("r")).select("r.*")


def run_suite(checks: list[Check]) -> DataFrame:
    """check, severity, failures: one row per check. A frame is read once for its row checks, once for its foreign
    keys, and once for each other check."""
    rows: dict[int, list[Check]] = {}
    references: dict[int, list[Check]] = {}
    for c in checks:
        if c.failing is None:
            (rows if c.parent is None else references).setdefault(id(c.df), []).append(c)
    parts = [_summary(group[0].df, group) for group in rows.values()]
    parts += [_references(group[0].df, group) for group in references.values()]
    parts += [
        c.failing.agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "failures")
        for c in checks if c.failing is not None
    ]
    return reduce(DataFrame.unionByName, parts)


class Observed:
    """Row checks counted while a frame is written: `watch` gives the frame to write, `result` the counts, once it is.

    The counts are those of the rows that went through the write, and cost no pass of their own."""

    def __init__(self, checks: list[Check]):
        self.checks = [c for c in checks if c.bad is not None]
        self.metrics = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self.metrics, *[c.count().alias(f"c{i}") for i, c in enumerate(self.checks)]) if self.checks else df

    def result(self) -> list[tuple[str, str, int]]:
        seen = self.metrics.get if self.checks else {}
        return [(c.name, c.severity, seen.get(f"c{i}", 0)) for i, c in enumerate(self.checks)]


class QualityError(Exception):
    """A check of severity error found failing rows."""


def gate(result: DataFrame | None, observed: list[tuple[str, str, int]] = ()) -> list:
    """Runs the suite and stops the caller on an error; returns (check, severity, failures) of the warnings that fired.
    `observed` are checks that have been counted already."""
    counted = []
    if result is not None:
        with shuffles_dropped(result.sparkSession):
            counted = result.where(F.col("failures") > 0).collect()  # at most one row per check
    fired = [*counted, *(Row(check=n, severity=s, failures=k) for n, s, k in observed if k)]
    errors = [r for r in fired if r.severity == "error"]
    if errors:
        raise QualityError("; ".join(f"{r['check']}: {r.failures}" for r in errors))
    return fired


def check_freshness(
    df: DataFrame, table: str, now: dt.datetime, warn: dt.timedelta, error: dt.timedelta, column: str = "_loaded_at"
) -> DataFrame:
    """table, age_seconds, status of the newest row; an empty table is an error."""
    age = (F.unix_seconds(F.lit(str(now)).cast("timestamp")) - F.unix_seconds(F.max(column).cast("timestamp")))
    return df.agg(age.alias("age_seconds")).select(
        F.lit(table).alias("table_name"),
        "age_seconds",
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error.total_seconds()), "error")
        .when(F.col("age_seconds") > warn.total_seconds(), "warn")
        .otherwise("pass").alias("status"),
    )
