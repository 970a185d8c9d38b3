from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from landfall.fixed import REQUIRED_COLUMNS


def keep_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null (or NaN) in the columns. ``isNotNull`` reaches the Parquet scan,
    which ``na.drop`` does not."""
    types = dict(df.dtypes)
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
        if types[name] in ("double", "float"):
            df = df.filter(~F.isnan(name))
    return df


def keep_listed(df: DataFrame, column: str, listed: DataFrame | Sequence[str]) -> DataFrame:
    """Rows whose column is among the values of a short list or of a table's first column.

    The table may have any size: Spark broadcasts it if it is small and shuffles otherwise.
    """
    if not isinstance(listed, DataFrame):
        return df.filter(F.col(column).isin(list(listed)))
    values = listed.select(F.col(listed.columns[0]).alias(column))
    return df.join(values, column, "left_semi").select(*df.columns)


def keep_arrivals(raw: DataFrame, ports: DataFrame | Sequence[str]) -> DataFrame:
    """Arrivals at known ports with departure, mode and match flag."""
    return keep_listed(keep_present(raw, REQUIRED_COLUMNS), "i94port", ports)


def stage_arrivals(raw: DataFrame, ports: DataFrame | Sequence[str]) -> DataFrame:
    """The distinct rows of ``keep_arrivals``.

    The filters stand before the distinct, so that only kept rows are shuffled. The distinct
    aggregates within each task first: copies of one row travel once per task.
    """
    return keep_arrivals(raw, ports).distinct()


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """The values, null included, that a column holds more than once."""
    counts = df.groupBy(column).agg(F.count("*").alias("copies"))
    return counts.filter(F.col("copies") > 1).select(column)


def distinct_where_repeated(df: DataFrame, column: str, repeated: DataFrame) -> DataFrame:
    """The distinct rows of ``df``, given the ``repeated_values`` of one of its columns.

    Equal rows are equal in that column, so all other rows are unique and need no shuffle.
    For a column close to a key and a broadcast list, the distinct sees few rows.
    """
    values = repeated.select(F.col(column).alias("repeated"))
    same = df[column].eqNullSafe(values["repeated"])
    copies = df.join(values, same, "left_semi").distinct()
    return df.join(values, same, "left_anti").unionAll(copies)


def stage_temperatures(
    raw: DataFrame, country: str = "US", year: int | None = None, month: int | None = None
) -> DataFrame:
    """Distinct daily temperatures of a country, with city and state in upper case.

    Case is settled before the distinct, so two spellings of a day leave one row. Without a
    year or month all of them are kept.
    """
    kept = raw.toDF(*[name.lower() for name in raw.columns])
    kept = kept.filter(F.col("country") == country)
    if year is not None:
        kept = kept.filter(F.col("year") == year)
    if month is not None:
        kept = kept.filter(F.col("month") == month)
    return kept.withColumns({"state": F.upper("state"), "city": F.upper("city")}).distinct()
