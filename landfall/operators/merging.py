"""Corrections put into what is there: of each key the latest version stays."""

from pyspark.sql import DataFrame, functions as F


def latest(rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row of each key: the one of greatest ``order``, and of these the greatest in all columns.

    It aggregates within each task first, so a key with very many versions is no hot group. Rows of a null key are all kept.
    """
    ranked = [F.col(order)] if order else []
    whole = F.max(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(ranked)], F.struct(*rows.columns).alias("row")))
    keyed = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(whole.alias("last")).select("last.row.*")
    return keyed.unionAll(rows.filter(F.col(key).isNull()))


def replaced(rows: DataFrame, late: DataFrame, key: str) -> DataFrame:
    """``rows`` without those whose key ``late`` has, and the rows of ``late``."""
    keys = late.select(F.col(key).alias("__key"))
    kept = rows.join(keys, rows[key] == F.col("__key"), "left_anti")
    return kept.unionByName(late.select(*rows.columns))
