"""Rows that are kept apart, and why."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

REASON = "reason"


def reason(reasons: Mapping[str, Column]) -> Column:
    """The name of the first condition that a row satisfies, null if it satisfies none."""
    return F.coalesce(*[F.when(violates, F.lit(name)) for name, violates in reasons.items()])


def quarantined(bad: DataFrame, source: str, raw: str | None = None) -> DataFrame:
    """``source, reason, line`` of rows with a reason; the line is the text ``raw``, or where that is null the fields as CSV."""
    fields = [c for c in bad.columns if c not in (REASON, raw)]
    line = F.to_csv(F.struct(*fields))
    if raw is not None:
        line = F.coalesce(raw, line)
    return bad.select(F.lit(source).alias("source"), REASON, line.alias("line"))
