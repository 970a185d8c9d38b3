"""The benchmark tables mapped to the input schemas of the operators.

=============  =======================================================================
ports          customers: the code is the key, the city the market segment, the state the
               nation; the lines of nations 3 to 8 and 11 are written in the unusual ways
               that port files have, and nation 9 is not in the state list
arrivals       orders, departing on the ship date of their last line; or events
temperatures   the highest order price (or event value) by day, segment and nation, with
               the order status (or event type) as the country
=============  =======================================================================
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall.fixed import SERIAL_EPOCH


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def serial(day: Column) -> Column:
    return F.date_diff(day.cast("date"), F.lit(SERIAL_EPOCH).cast("date")).cast("double")


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def port_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, city = F.col("c_nationkey"), F.col("c_mktsegment")
    state = F.lpad(nation.cast("string"), 2, "0")
    place = (
        F.when(nation == 3, text("No PORT Code (", city, ")"))
        .when(nation == 4, text("Collapsed into ", city, ", ", state))
        .when(nation == 5, text("Collapsed (", city, ") 06/15"))
        .when(nation == 6, text(city, ", ", state, " (BPS)"))
        .when(nation == 7, text(city, " ", state))
        .when(nation == 8, text("PORT, ", city, ", ", state))
        .when(nation == 10, text(city, ",", state))
        .when(nation == 11, text(city.substr(1, 2), "''", F.substr(city, F.lit(3)), ", ", state))
        .otherwise(text(city, ", ", state, "      "))
    )
    line = text("   '", F.col("c_custkey").cast("string"), "'\t=\t'", place, "'  ")
    return table(spark, sf_dir, "customer").select(line.alias("value"))


def state_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    code = F.when(F.col("n_nationkey") == 9, "99").otherwise(code)
    line = text("\t'", code, "'='", F.col("n_name"), "' ")
    return table(spark, sf_dir, "nation").select(line.alias("value"))


def code_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code list of customers, with the junk entries that country lists have."""
    segment, key, name = F.col("c_mktsegment"), F.col("c_custkey"), F.col("c_name")
    entry = (
        F.when(segment == "BUILDING", text("INVALID: ", name))
        .when(segment == "MACHINERY", text("No Country Code (", key.cast("string"), ")"))
        .when(segment == "HOUSEHOLD", text("Collapsed ", name, " (should not show)"))
        .when(segment == "FURNITURE", text(name, " (a, b)"))
        .otherwise(text(name, "  "))
    )
    line = text(" ", key.cast("string"), "  =  '", entry, "' ")
    return table(spark, sf_dir, "customer").select(line.alias("value"))


def order_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One arrival per order. Departures are fractional, and missing for orders without lines."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    last = lines.agg(
        F.max("l_shipdate").alias("left"), F.max("l_discount").alias("fraction")
    )
    orders = table(spark, sf_dir, "orders").join(last, "o_orderkey", "left")
    return orders.select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.month("o_orderdate").cast("double").alias("i94cit"),
        F.col("o_custkey").cast("string").alias("i94port"),
        serial(F.col("o_orderdate")).alias("arrdate"),
        F.left("o_orderpriority", F.lit(1)).cast("double").alias("i94mode"),
        (serial(F.col("left")) + F.col("fraction")).alias("depdate"),
        F.quarter("o_orderdate").cast("double").alias("i94visa"),
        F.col("o_orderpriority").alias("visatype"),
        F.nullif("o_orderstatus", F.lit("P")).alias("matflag"),
    )


def event_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One arrival per event, all in January 2024, staying as many days as its value."""
    arrival = serial(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("double").alias("cicid"),
        F.dayofmonth("ts").cast("double").alias("i94cit"),
        F.col("user_id").cast("string").alias("i94port"),
        arrival.alias("arrdate"),
        F.hour("ts").cast("double").alias("i94mode"),
        (arrival + F.col("value")).alias("depdate"),
        F.minute("ts").cast("double").alias("i94visa"),
        F.col("event_type").alias("visatype"),
        F.nullif("event_type", F.lit("error")).alias("matflag"),
    )


def _temperatures(
    spark: SparkSession, sf_dir: str, rows: DataFrame, customer: str, day: str
) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(customer),
        F.col("c_nationkey").alias("n_nationkey"),
        F.col("c_mktsegment").alias("segment"),
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    daily = (
        rows.join(customers, customer)
        .groupBy("Country", "n_nationkey", "segment", F.to_date(day).alias("day"))
        .agg(F.max("measure").alias("AvgTemperature"))
    )
    return daily.join(nations, "n_nationkey").select(
        "Country",
        F.initcap("n_name").alias("State"),
        F.initcap("segment").alias("City"),
        F.month("day").alias("Month"),
        F.dayofmonth("day").alias("Day"),
        F.year("day").alias("Year"),
        "AvgTemperature",
    )


def order_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("Country"),
        F.col("o_totalprice").alias("measure"),
        "o_custkey",
        "o_orderdate",
    )
    return _temperatures(spark, sf_dir, orders, "o_custkey", "o_orderdate")


def event_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("Country"), F.col("value").alias("measure"), "user_id", "ts"
    )
    return _temperatures(spark, sf_dir, events, "user_id", "ts")
