"""Data-quality checks whose results are rows.

A check is a condition on each row; ``report`` counts the violations of any number of checks,
and of one key's uniqueness, in a single pass over the table.
"""

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from landfall.functions import date_from_parts, outside_period


@dataclass(frozen=True)
class Check:
    """A named check. ``violates`` is a condition on a row, or a fixed answer for all rows."""

    name: str
    column: str
    violates: Column | bool = False
    min_rows: int = 0


def column_exists(df: DataFrame, column: str) -> Check:
    return Check("column_exists", column, column not in df.columns)


def column_type(df: DataFrame, column: str, expected: str) -> Check:
    """The column exists and has the type, written as in ``df.dtypes``."""
    return Check("column_type", column, dict(df.dtypes).get(column) != expected)


def in_period(column: str, year: int, month: int) -> Check:
    return Check("in_period", column, outside_period(column, year, month))


def date_present(column: str) -> Check:
    """No null dates, which ``in_period`` cannot judge."""
    return Check("date_present", column, F.col(column).isNull())


def well_formed(column: str, violates: Column) -> Check:
    """Every row of a text source could be read."""
    return Check("well_formed", column, violates)


def possible_date(year: str, month: str, day: str) -> Check:
    """The parts make a date. Parts that are missing do not."""
    made = date_from_parts(year, month, day, lenient=True)
    whole = F.col(year).isNotNull() & F.col(month).isNotNull() & F.col(day).isNotNull()
    return Check("possible_date", f"{year},{month},{day}", F.coalesce(~whole | made.isNull(), F.lit(True)))


def has_rows(minimum: int = 1) -> Check:
    return Check("has_rows", "", min_rows=minimum)


def report(
    df: DataFrame, table: str, checks: Sequence[Check] = (), key: Sequence[str] = ()
) -> DataFrame:
    """One row per check: check_name, table_name, column_name, passed, rows_checked, violations.

    With a key, the table is grouped by it and the counts of the other checks ride along; the
    violations of ``unique_key`` are the rows beyond the first of their key. A column that is
    missing or has another type counts every row as a violation and fails on an empty table.
    """
    marks = [f"violations_{i}" for i in range(len(checks))]
    counted = [
        F.count_if(c.violates if isinstance(c.violates, Column) else F.lit(c.violates)).alias(m)
        for c, m in zip(checks, marks)
    ]
    if key:
        groups = df.groupBy(*key).agg(F.count("*").alias("copies"), *counted)
        totals = groups.agg(
            F.sum("copies").alias("rows_checked"),
            F.sum(F.col("copies") - 1).alias("repeats"),
            *[F.sum(m).alias(m) for m in marks],
        ).na.fill(0)
    else:
        totals = df.agg(F.count("*").alias("rows_checked"), *counted)

    def result(name: str, column: str, violations: str, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            passed.alias("passed"),
            F.col("rows_checked").alias("rows_checked"),
            F.col(violations).alias("violations"),
        )

    verdicts = []
    for check, mark in zip(checks, marks):
        if isinstance(check.violates, Column):
            passed = F.col(mark) == 0
        else:
            passed = F.lit(not check.violates) & (F.col("rows_checked") >= check.min_rows)
        verdicts.append(result(check.name, check.column, mark, passed))
    if key:
        passed = F.col("repeats") == 0
        verdicts.append(result("unique_key", ",".join(key), "repeats", passed))
    return totals.select(F.inline(F.array(*verdicts)))


def verdict(check: Check, table: str, rows: int, violations: int) -> Row:
    """A row as ``report`` has it, of counts that are known already."""
    return Row(
        check_name=check.name, table_name=table, column_name=check.column,
        passed=violations == 0, rows_checked=rows, violations=violations,
    )


def raise_on_failure(
    results: DataFrame | list[Row], allowed: Collection[tuple[str, str]] = ()
) -> list[Row]:
    """Run the checks, raise ValueError naming those that failed, else return all results.

    Failures of ``allowed`` (check name, table name) pairs are returned like the others. Only
    the result rows reach the driver, one per check.
    """
    rows = results.collect() if isinstance(results, DataFrame) else results
    failed = [
        f"{r.check_name} on {r.table_name}({r.column_name}): "
        f"{r.violations} violations in {r.rows_checked} rows"
        for r in rows
        if not r.passed and (r.check_name, r.table_name) not in allowed
    ]
    if failed:
        raise ValueError("; ".join(failed))
    return rows
