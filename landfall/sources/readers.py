from pyspark.sql import DataFrame, SparkSession, functions as F

# The text of a CSV row that does not fit its types. The name is Spark's own for it: where it is
# asked for, all columns are parsed, so a bad field counts even if nothing else reads it.
MALFORMED = "_corrupt_record"

# Types of the columns the library names; any further column of a CSV file is text.
ARRIVAL_TYPES = {
    "cicid": "double",
    "i94cit": "double",
    "i94port": "string",
    "arrdate": "double",
    "i94mode": "double",
    "depdate": "double",
    "i94visa": "double",
    "visatype": "string",
    "matflag": "string",
}
TEMPERATURE_TYPES = {
    "country": "string",
    "state": "string",
    "city": "string",
    "month": "int",
    "day": "int",
    "year": "int",
    "avgtemperature": "double",
}


def read_delimited(
    spark: SparkSession,
    path: str,
    types: dict[str, str],
    mode: str = "PERMISSIVE",
    malformed: bool = False,
) -> DataFrame:
    """A CSV file with a header. Names come from the header line and types from ``types``,
    so columns may stand in any order and no pass over the data is spent on inference.

    ``malformed`` adds a column with the text of rows that do not fit, null for the others.
    """
    header = spark.read.option("header", True).csv(path).columns
    fields = [f"`{name}` {types.get(name.lower(), 'string')}" for name in header]
    schema = ", ".join(fields + [f"`{MALFORMED}` string"] * malformed)
    reader = spark.read.schema(schema).option("header", True).option("mode", mode)
    return reader.option("enforceSchema", False).csv(path)


def read_arrivals(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    mode: str = "PERMISSIVE",
    malformed: bool = False,
) -> DataFrame:
    """Landed arrival records, dates still as day serials. ``mode`` and ``malformed`` are for CSV."""
    if file_format == "csv":
        return read_delimited(spark, path, ARRIVAL_TYPES, mode, malformed)
    return spark.read.format(file_format).load(path)


def read_temperatures(
    spark: SparkSession, path: str, mode: str = "PERMISSIVE", malformed: bool = False
) -> DataFrame:
    """The city-temperature CSV, with lower-case column names."""
    raw = read_delimited(spark, path, TEMPERATURE_TYPES, mode, malformed)
    return raw.toDF(*[name.lower() for name in raw.columns])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a text file that are not blank, in a column ``value``."""
    return spark.read.text(path).filter(F.col("value").rlike(r"\S"))
