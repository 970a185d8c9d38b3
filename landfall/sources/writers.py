from pyspark.sql import DataFrame


def write_table(df: DataFrame, root: str, name: str) -> DataFrame:
    """Replace a table of the warehouse. Returns it as written, read without inference."""
    df.write.mode("overwrite").parquet(f"{root}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")


def write_by_date(
    df: DataFrame,
    root: str,
    name: str,
    key: str = "arrdate",
    gather: bool = True,
    only_dates: bool = False,
) -> DataFrame:
    """Replace a table partitioned by date. Returns it as written, read without inference.

    ``gather`` brings the rows of a date together first, else every task leaves a small file
    for every date it meets. It is a rebalance, not a plain repartition: adaptive execution
    splits a date that is too large for one task and merges those that are small. Pass False
    where the rows already lie by date, as in a table read from such files and not shuffled.

    ``only_dates`` replaces the dates present in ``df`` and leaves the others alone.
    """
    rows = df.hint("rebalance", key) if gather else df
    overwrite = "dynamic" if only_dates else "static"
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    writer.partitionBy(key).parquet(f"{root}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")
