from pyspark.sql import DataFrame, functions as F

from landfall.fixed import VISIT_COLUMNS
from landfall.functions import date_from_parts, sas_date, stay_days, whole


def _places(ports: DataFrame) -> DataFrame:
    return ports.select(F.col("code").alias("i94port"), "city", "state_name")


def _daily(temperatures: DataFrame, lenient_dates: bool) -> DataFrame:
    return temperatures.select(
        date_from_parts("year", "month", "day", lenient_dates).alias("arrdate"),
        "city",
        F.col("state").alias("state_name"),
        "avgtemperature",
    )


def build_visits(
    arrivals: DataFrame, ports: DataFrame, temperatures: DataFrame, lenient_dates: bool = False
) -> DataFrame:
    """Arrivals with the temperature of their port's city on the day of arrival.

    Both joins are inner: an arrival needs a port row and a temperature row. They carry no
    hint, so Spark broadcasts ports and temperatures only while their files are small enough
    and otherwise shuffles, splitting hot ports and days.
    """
    visits = arrivals.select(
        "cicid",
        sas_date("arrdate").alias("arrdate"),
        sas_date("depdate").alias("depdate"),
        stay_days("arrdate", "depdate").alias("stay"),
        "i94port",
        whole("i94cit").alias("i94cit"),
        whole("i94mode").alias("i94mode"),
        whole("i94visa").alias("i94visa"),
        "visatype",
    )
    placed = visits.join(_places(ports), "i94port")
    dated = placed.join(_daily(temperatures, lenient_dates), ["arrdate", "city", "state_name"])
    return dated.select(*VISIT_COLUMNS)


def port_coverage(
    arrivals: DataFrame, ports: DataFrame, temperatures: DataFrame, lenient_dates: bool = False
) -> DataFrame:
    """Per port, how many arrivals are staged, have a port row and have a temperature too.

    Arrivals are counted by port and date before any join, so the joins see few rows. Port
    codes must be unique, as they are in the dimension.
    """
    counts = (
        arrivals.select("i94port", sas_date("arrdate").alias("arrdate"))
        .groupBy("i94port", "arrdate")
        .agg(F.count("*").alias("staged"))
    )
    day = ["arrdate", "city", "state_name"]
    days = _daily(temperatures, lenient_dates).select(*day).distinct()
    placed = counts.join(_places(ports), "i94port", "left")
    dated = placed.join(days.withColumn("measured", F.lit(True)), day, "left")
    with_port = F.when(F.col("state_name").isNotNull(), F.col("staged")).otherwise(0)
    with_temperature = F.when(F.col("measured"), F.col("staged")).otherwise(0)
    return dated.groupBy("i94port").agg(
        F.sum("staged").alias("staged"),
        F.sum(with_port).alias("with_port"),
        F.sum(with_temperature).alias("with_temperature"),
    )
