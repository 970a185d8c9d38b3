"""Every operator as a query over the benchmark tables, with its meaning in SQL beside it."""

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall import fixed
from landfall.functions import date_from_parts, sas_date, serial_in_period, stay_days
from landfall.operators import (
    build_visits,
    code_list,
    date_dim,
    distinct_where_repeated,
    keep_listed,
    keep_present,
    known_ports,
    port_coverage,
    port_rejects,
    ports_dim,
    repeated_values,
    stage_arrivals,
    stage_temperatures,
    visits_by,
)
from landfall.operators.quality import (
    Check,
    column_exists,
    column_type,
    date_present,
    has_rows,
    in_period,
    report,
)
from landfall.plans import mapped, warehouse
from landfall.sources import (
    Load,
    read_lines,
    read_table,
    read_temperatures,
    settle,
    shared_folder,
    write_by_date,
    write_table,
)

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None, name: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name or run.__name__] = Query(run, sql)
        return run

    return register


# --- SQL of the mapped tables -------------------------------------------------------------

ARRIVALS = """
  SELECT CAST(o_orderkey AS DOUBLE) AS cicid,
         CAST(month(o_orderdate) AS DOUBLE) AS i94cit,
         CAST(o_custkey AS VARCHAR) AS i94port,
         CAST(CAST(o_orderdate AS DATE) - DATE '1960-01-01' AS DOUBLE) AS arrdate,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS i94mode,
         CAST(CAST(last_day AS DATE) - DATE '1960-01-01' AS DOUBLE) + fraction AS depdate,
         CAST(quarter(o_orderdate) AS DOUBLE) AS i94visa,
         o_orderpriority AS visatype,
         nullif(o_orderstatus, 'P') AS matflag
  FROM orders LEFT JOIN
       (SELECT l_orderkey, max(l_shipdate) AS last_day, max(l_discount) AS fraction
        FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
"""

PORTS = """
  SELECT CAST(c_custkey AS VARCHAR) AS code, c_mktsegment AS city,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state, n_name AS state_name
  FROM customer JOIN nation ON n_nationkey = c_nationkey
  WHERE c_nationkey NOT BETWEEN 3 AND 9
"""

TEMPERATURES = """
  SELECT o_orderstatus AS country, n_name AS state, c_mktsegment AS city,
         CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(day(o_orderdate) AS INTEGER) AS day,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         max(o_totalprice) AS avgtemperature
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  GROUP BY ALL
"""

VISITS = f"""
  SELECT cicid,
         DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrdate,
         DATE '1960-01-01' + CAST(floor(depdate) AS INTEGER) AS depdate,
         CAST(trunc(depdate - arrdate) AS INTEGER) AS stay,
         i94port,
         CAST(i94cit AS INTEGER) AS i94cit,
         CAST(i94mode AS INTEGER) AS i94mode,
         CAST(i94visa AS INTEGER) AS i94visa,
         visatype, avgtemperature
  FROM ({ARRIVALS}) a
  JOIN ({PORTS}) p ON i94port = code
  JOIN ({TEMPERATURES}) t
    ON make_date(year, month, day) = DATE '1960-01-01' + CAST(arrdate AS INTEGER)
   AND t.city = p.city AND t.state = p.state_name AND country = 'F'
"""

RANKED = f"""
  SELECT {{group}}, round(avg(avgtemperature), 2) AS avg_temperature, count(*) AS count
  FROM ({VISITS}) JOIN ({PORTS}) ON i94port = code
  WHERE {{where}}
  GROUP BY {{group}} ORDER BY {{order}} DESC, {{group}} LIMIT {{n}}
"""

ORDER_SERIALS = """
  SELECT o_orderkey,
         CAST(o_orderdate AS DATE) - DATE '1998-01-01'
           + round(o_totalprice - floor(o_totalprice), 2) AS serial
  FROM orders
"""

# --- Shared parts of the queries ----------------------------------------------------------


def landed(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows handed over as a written table, so that Spark knows their size in joins."""
    root = shared_folder(spark, name)
    write_table(df, root, name)
    return read_table(spark, root, name)


def landed_lines(spark: SparkSession, lines: DataFrame, name: str, end: str = "\n") -> DataFrame:
    path = shared_folder(spark, name)
    lines.write.option("lineSep", end).text(path)
    return read_lines(spark, path)


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ports_dim(mapped.port_lines(spark, sf_dir), mapped.state_lines(spark, sf_dir))


def temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_temperatures(mapped.order_temperatures(spark, sf_dir), "F")


def visits(spark: SparkSession, sf_dir: str, places: DataFrame) -> DataFrame:
    arrivals = mapped.order_arrivals(spark, sf_dir)
    return build_visits(arrivals, places, temperatures(spark, sf_dir))


def ranked(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    places = ports(spark, sf_dir)
    return visits_by(visits(spark, sf_dir, places), places, **how)


# --- Staging ------------------------------------------------------------------------------


@query(f"""
  SELECT * FROM ({ARRIVALS})
  WHERE depdate IS NOT NULL AND i94mode IS NOT NULL AND matflag IS NOT NULL
    AND i94port IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer
                    WHERE c_nationkey NOT IN (3, 4, 5))
""")
def stage_visits_semi(spark, sf_dir):
    arrivals = mapped.order_arrivals(spark, sf_dir)
    doubled = arrivals.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return stage_arrivals(doubled, known_ports(mapped.port_lines(spark, sf_dir)))


@query("""
  SELECT o_orderkey, o_orderpriority FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM')
""")
def isin_filter(spark, sf_dir):
    orders = mapped.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return keep_listed(orders, "o_orderpriority", ["1-URGENT", "3-MEDIUM"])


@query("""
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_totalprice AS price FROM orders
  WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
""")
def na_drop(spark, sf_dir):
    low = F.col("o_orderpriority") == "5-LOW"
    orders = mapped.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(low, float("nan")).otherwise(F.col("o_totalprice")).alias("price"),
    )
    return keep_present(orders, ["status", "price"])


def micros(column: str) -> Column:
    """A time without zone as microseconds, which both engines compare alike."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")


@query("""
  SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         epoch_us(o_orderdate) AS o_orderdate, o_orderpriority
  FROM orders
""")
def distinct_rows(spark, sf_dir):
    """Orders of which those pending stand twice, without copies; their key tells which."""
    copies = F.when(F.col("o_orderstatus") == "P", 2).otherwise(1)
    doubled = mapped.table(spark, sf_dir, "orders").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), copies))
    ).drop("copy")
    repeated = landed(spark, repeated_values(doubled, "o_orderkey"), "repeated")
    distinct = distinct_where_repeated(doubled, "o_orderkey", repeated)
    return distinct.withColumn("o_orderdate", micros("o_orderdate"))


@query(f"SELECT * FROM ({TEMPERATURES}) WHERE country = 'F' AND year = 1998 AND month = 7")
def stage_measure(spark, sf_dir):
    raw = mapped.order_temperatures(spark, sf_dir)
    spellings = F.explode(F.array("City", F.lower("City")))
    return stage_temperatures(raw.withColumn("City", spellings), "F", 1998, 7)


# --- Sources and sinks --------------------------------------------------------------------


@query(f"""
  SELECT country, upper(state[1]) || lower(state[2:]) AS state,
         upper(city[1]) || lower(city[2:]) AS city, month, day, year, avgtemperature
  FROM ({TEMPERATURES})
""")
def csv_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "csv")
    mapped.order_temperatures(spark, sf_dir).write.option("header", True).csv(path)
    return read_temperatures(spark, path)


@query("SELECT * REPLACE (epoch_us(o_orderdate) AS o_orderdate) FROM orders")
def parquet_roundtrip(spark, sf_dir):
    orders = landed(spark, mapped.table(spark, sf_dir, "orders"), "orders")
    return orders.withColumn("o_orderdate", micros("o_orderdate"))


@query("""
  SELECT * REPLACE (epoch_us(ts) AS ts), CAST(ts AS DATE) AS arrdate FROM events
""")
def partitioned_roundtrip(spark, sf_dir):
    events = mapped.table(spark, sf_dir, "events").withColumn("arrdate", F.to_date("ts"))
    root = shared_folder(spark, "events")
    write_by_date(events, root, "events")
    return read_table(spark, root, "events").withColumn("ts", micros("ts"))


# --- Lookups ------------------------------------------------------------------------------


@query("""
  SELECT CAST(c_custkey AS INTEGER) AS code,
         CASE c_mktsegment WHEN 'FURNITURE' THEN c_name || ' (a, b)'
                           WHEN 'AUTOMOBILE' THEN c_name
                           ELSE 'Other countries' END AS name
  FROM customer
""")
def code_list_parse(spark, sf_dir):
    lines = landed_lines(spark, mapped.code_lines(spark, sf_dir), "codes", "\r\n")
    return code_list(lines, fixed.JUNK_COUNTRIES, fixed.OTHER_COUNTRIES)


@query("""
  SELECT CAST(c_custkey AS VARCHAR) AS code,
         CASE c_nationkey
           WHEN 6 THEN c_mktsegment || ', 06 (BPS)'
           WHEN 7 THEN c_mktsegment || ' 07'
           WHEN 8 THEN 'PORT, ' || c_mktsegment || ', 08'
           WHEN 10 THEN c_mktsegment || ',10'
           WHEN 11 THEN c_mktsegment[:2] || '''''' || c_mktsegment[3:] || ', 11'
           ELSE c_mktsegment || ', ' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '      '
         END AS place
  FROM customer WHERE c_nationkey NOT IN (3, 4, 5)
""")
def port_line_parse(spark, sf_dir):
    return known_ports(landed_lines(spark, mapped.port_lines(spark, sf_dir), "ports"))


@query(PORTS)
def port_dim(spark, sf_dir):
    lines = landed_lines(spark, mapped.port_lines(spark, sf_dir), "ports")
    return ports_dim(lines, mapped.state_lines(spark, sf_dir))


@query(f"""
  {PORTS} UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), if(c_nationkey = 8, 'PORT, ', '') || c_mktsegment,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0'), n_name
  FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_nationkey IN (6, 7, 8)
""")
def port_dim_lenient(spark, sf_dir):
    lines = mapped.port_lines(spark, sf_dir)
    return ports_dim(lines, mapped.state_lines(spark, sf_dir), "lenient")


@query("""
  SELECT CAST(c_custkey AS VARCHAR) AS code,
         CASE c_nationkey WHEN 3 THEN 'Other US ports' WHEN 4 THEN 'Other US ports'
                          WHEN 5 THEN 'Other US ports' WHEN 7 THEN c_mktsegment || ' 07'
                          WHEN 8 THEN 'PORT' ELSE c_mktsegment END AS city,
         CASE c_nationkey WHEN 6 THEN '06 (BPS)' WHEN 8 THEN c_mktsegment || ', 08'
                          WHEN 9 THEN '09' END AS state
  FROM customer WHERE c_nationkey BETWEEN 3 AND 9
""")
def port_dim_rejects(spark, sf_dir):
    lines = mapped.port_lines(spark, sf_dir)
    return port_rejects(lines, mapped.state_lines(spark, sf_dir))


# --- Scalar rules -------------------------------------------------------------------------


SERIAL_DAY = "DATE '1960-01-01' + CAST(floor(serial) AS INTEGER)"


@query(
    f"""
  SELECT o_orderkey, CASE WHEN serial <> 0 THEN {SERIAL_DAY} END AS day
  FROM ({ORDER_SERIALS})
""",
    name="sas_date",
)
def sas_date_rule(spark, sf_dir):
    """Serials of both signs, with fractions, and zeros."""
    days = F.date_diff(F.to_date("o_orderdate"), F.lit("1998-01-01").cast("date"))
    fraction = F.round(F.col("o_totalprice") - F.floor("o_totalprice"), 2)
    orders = mapped.table(spark, sf_dir, "orders")
    serials = orders.select("o_orderkey", (days + fraction).alias("serial"))
    return serials.select("o_orderkey", sas_date("serial").alias("day"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders", name="date_from_parts")
def date_from_parts_rule(spark, sf_dir):
    orders = mapped.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"),
    )
    return orders.select("o_orderkey", date_from_parts("year", "month", "day").alias("day"))


@query("""
  SELECT o_orderkey,
         CASE WHEN day(o_orderdate) <= day(last_day(make_date(year(o_orderdate), 2, 1)))
              THEN make_date(year(o_orderdate), 2, day(o_orderdate)) END AS day
  FROM orders
""")
def date_from_parts_lenient(spark, sf_dir):
    """Order days moved to February, which lacks some of them."""
    orders = mapped.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.lit(2).alias("month"),
        F.dayofmonth("o_orderdate").alias("day"),
    )
    day = date_from_parts("year", "month", "day", lenient=True)
    return orders.select("o_orderkey", day.alias("day"))


@query(
    """
  SELECT l_orderkey, l_linenumber,
         CAST(trunc((CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE)) + l_discount)
              AS INTEGER) AS stay
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""",
    name="stay_days",
)
def stay_days_rule(spark, sf_dir):
    orders = mapped.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        mapped.serial(F.col("o_orderdate")).alias("arrival"),
    )
    lines = mapped.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (mapped.serial(F.col("l_shipdate")) + F.col("l_discount")).alias("departure"),
    )
    stay = stay_days("arrival", "departure").alias("stay")
    return lines.join(orders, "l_orderkey").select("l_orderkey", "l_linenumber", stay)


# --- Fact, date dimension, coverage -------------------------------------------------------


@query(VISITS)
def fact_build(spark, sf_dir):
    return visits(spark, sf_dir, ports(spark, sf_dir))


@query(
    f"""
  SELECT DISTINCT arrdate, CAST(day(arrdate) AS INTEGER) AS day,
         strftime(arrdate, '%a') AS weekday, CAST(weekofyear(arrdate) AS INTEGER) AS week,
         CAST(month(arrdate) AS INTEGER) AS month, CAST(year(arrdate) AS INTEGER) AS year
  FROM ({VISITS})
""",
    name="date_dim",
)
def date_dim_build(spark, sf_dir):
    return date_dim(visits(spark, sf_dir, ports(spark, sf_dir)))


@query(f"""
  SELECT i94port, count(*) AS staged, count(code) AS with_port, count(t.city) AS with_temperature
  FROM ({ARRIVALS})
  LEFT JOIN ({PORTS}) p ON i94port = code
  LEFT JOIN ({TEMPERATURES}) t
    ON make_date(year, month, day) = DATE '1960-01-01' + CAST(arrdate AS INTEGER)
   AND t.city = p.city AND t.state = p.state_name AND country = 'F'
  GROUP BY i94port
""")
def visit_coverage(spark, sf_dir):
    arrivals = mapped.order_arrivals(spark, sf_dir)
    return port_coverage(arrivals, ports(spark, sf_dir), temperatures(spark, sf_dir))


# --- Rankings -----------------------------------------------------------------------------


@query(RANKED.format(group="state_name", where="true", order="count", n=10))
def q1_states_by_count(spark, sf_dir):
    return ranked(spark, sf_dir, group="state_name", order="count", n=10)


@query(RANKED.format(group="state_name", where="true", order="avg_temperature", n=5))
def q2_states_by_mean(spark, sf_dir):
    return ranked(spark, sf_dir, group="state_name", order="avg_temperature", n=5)


@query(RANKED.format(group="city", where="state = '12'", order="count", n=3))
def q3_cities_by_count(spark, sf_dir):
    return ranked(spark, sf_dir, group="city", order="count", n=3, state="12")


@query(RANKED.format(group="city", where="state = '12'", order="avg_temperature", n=3))
def q3_cities_by_mean(spark, sf_dir):
    return ranked(spark, sf_dir, group="city", order="avg_temperature", n=3, state="12")


# --- Checks -------------------------------------------------------------------------------


def checked(name: str, table: str, column: str, passed: str, violations: str, rows: str) -> str:
    return f"""
  SELECT '{name}' AS check_name, '{table}' AS table_name, '{column}' AS column_name,
         {passed} AS passed, count(*) AS rows_checked, {violations} AS violations FROM {rows}
"""


@query("""
  SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys FROM lineitem
""")
def distinct_key_count(spark, sf_dir):
    lines = mapped.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    groups = lines.agg(F.count("*").alias("copies"))
    return groups.agg(F.sum("copies").alias("n_rows"), F.count("*").alias("n_keys"))


@query(
    checked("column_exists", "orders", "o_orderkey", "true", "0::BIGINT", "orders")
    + " UNION ALL "
    + checked("column_exists", "orders", "o_missing", "false", "count(*)", "orders")
)
def dq_column_exists(spark, sf_dir):
    orders = mapped.table(spark, sf_dir, "orders")
    wanted = ["o_orderkey", "o_missing"]
    return report(orders, "orders", [column_exists(orders, c) for c in wanted])


@query(
    checked("column_type", "orders", "o_totalprice", "true", "0::BIGINT", "orders")
    + " UNION ALL "
    + checked("column_type", "orders", "o_orderkey", "false", "count(*)", "orders")
    + " UNION ALL "
    + checked("column_type", "orders", "o_missing", "false", "count(*)", "orders")
)
def dq_column_type(spark, sf_dir):
    orders = mapped.table(spark, sf_dir, "orders")
    wanted = ["o_totalprice", "o_orderkey", "o_missing"]
    return report(orders, "orders", [column_type(orders, c, "double") for c in wanted])


@query(
    checked(
        "unique_key", "orders", "o_orderkey",
        "count(*) = count(DISTINCT o_orderkey)", "count(*) - count(DISTINCT o_orderkey)", "orders",
    )
)
def dq_unique_pass(spark, sf_dir):
    return report(mapped.table(spark, sf_dir, "orders"), "orders", key=["o_orderkey"])


LINE_KEYS = "count(DISTINCT (l_orderkey, l_linenumber))"


@query(
    checked(
        "unique_key", "lineitem", "l_orderkey,l_linenumber",
        f"count(*) = {LINE_KEYS}", f"count(*) - {LINE_KEYS}", "lineitem",
    )
)
def dq_unique_fail(spark, sf_dir):
    lines = mapped.table(spark, sf_dir, "lineitem")
    return report(lines, "lineitem", key=["l_orderkey", "l_linenumber"])


OUTSIDE = (
    "count(*) FILTER (o_orderstatus <> 'P'"
    " AND (year(o_orderdate) <> 1998 OR month(o_orderdate) <> 7))"
)
UNDATED = "count(*) FILTER (o_orderstatus = 'P')"


@query(
    checked("in_period", "orders", "day", f"{OUTSIDE} = 0", OUTSIDE, "orders")
    + " UNION ALL "
    + checked("date_present", "orders", "day", f"{UNDATED} = 0", UNDATED, "orders")
)
def dq_period(spark, sf_dir):
    undated = F.col("o_orderstatus") == "P"
    orders = mapped.table(spark, sf_dir, "orders").select(
        F.when(~undated, F.to_date("o_orderdate")).alias("day")
    )
    return report(orders, "orders", [in_period("day", 1998, 7), date_present("day")])


@query(
    checked("has_rows", "lineitem", "", "count(*) >= 1", "0::BIGINT", "lineitem")
    + " UNION ALL "
    + checked("has_rows", "nothing", "", "count(*) >= 1", "0::BIGINT",
              "lineitem WHERE l_quantity < 0")
)
def dq_row_count(spark, sf_dir):
    lines = mapped.table(spark, sf_dir, "lineitem")
    nothing = lines.filter(F.col("l_quantity") < 0)
    return report(lines, "lineitem", [has_rows()]).unionAll(
        report(nothing, "nothing", [has_rows()])
    )


DAY_KEY = ["year", "month", "day", "city", "state"]
DAY_COPIES = f"count(*) - count(DISTINCT ({', '.join(DAY_KEY)}))"


@query(
    " UNION ALL ".join(
        checked("unique_key", name, ",".join(DAY_KEY), f"{DAY_COPIES} = 0", DAY_COPIES,
                f"({TEMPERATURES}) WHERE country IN {countries}")
        for name, countries in [("one_country", "('F')"), ("two_countries", "('F', 'O')")]
    )
)
def dq_unique_temperatures(spark, sf_dir):
    """City-days of one country are unique; those of two together are not."""
    raw = mapped.order_temperatures(spark, sf_dir)
    one, other = stage_temperatures(raw, "F"), stage_temperatures(raw, "O")
    return report(one, "one_country", key=DAY_KEY).unionAll(
        report(one.unionAll(other), "two_countries", key=DAY_KEY)
    )


FACT_OUTSIDE = "count(*) FILTER (year(arrdate) <> 1998 OR month(arrdate) <> 7)"


@query(
    " UNION ALL ".join([
        checked("column_exists", "visits", "cicid", "true", "0::BIGINT", f"({VISITS})"),
        checked("column_type", "visits", "cicid", "true", "0::BIGINT", f"({VISITS})"),
        checked("in_period", "visits", "arrdate", f"{FACT_OUTSIDE} = 0", FACT_OUTSIDE,
                f"({VISITS})"),
        checked("date_present", "visits", "arrdate", "true", "0::BIGINT", f"({VISITS})"),
        checked("unique_key", "visits", "cicid", "count(*) = count(DISTINCT cicid)",
                "count(*) - count(DISTINCT cicid)", f"({VISITS})"),
    ])
)
def dq_all_on_fact(spark, sf_dir):
    rows = visits(spark, sf_dir, ports(spark, sf_dir))
    checks: list[Check] = [
        column_exists(rows, "cicid"),
        column_type(rows, "cicid", "double"),
        in_period("arrdate", 1998, 7),
        date_present("arrdate"),
    ]
    return report(rows, "visits", checks, key=["cicid"])


# --- The batch job ------------------------------------------------------------------------

EVENT_STAGE = """
  SELECT CAST(event_id AS DOUBLE) AS cicid, CAST(user_id AS VARCHAR) AS i94port,
         CAST(ts AS DATE) AS arrdate, user_id
  FROM events JOIN customer ON c_custkey = user_id
  WHERE event_type <> 'error' AND c_nationkey NOT IN (3, 4, 5)
"""

EVENT_TEMPERATURES = """
  SELECT CAST(ts AS DATE) AS day, c_mktsegment AS city, n_name AS state,
         max(value) AS avgtemperature
  FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
  WHERE event_type = 'view' GROUP BY ALL
"""

EVENT_VISITS = f"""
  SELECT s.*, p.city, p.state, state_name, avgtemperature
  FROM ({EVENT_STAGE}) s JOIN ({PORTS}) p ON i94port = code
  JOIN ({EVENT_TEMPERATURES}) t ON day = arrdate AND t.city = p.city AND t.state = state_name
"""

EVENT_RANKED = f"""
  SELECT '{{item}}' AS item, {{group}} AS label, count(*) AS n,
         round(avg(avgtemperature), 2) AS mean
  FROM ({EVENT_VISITS}) WHERE {{where}}
  GROUP BY {{group}} ORDER BY {{order}} DESC, {{group}} LIMIT {{n}}
"""


def landing(
    spark: SparkSession,
    sf_dir: str,
    arrivals: DataFrame | None = None,
    temperatures: DataFrame | None = None,
    ports: DataFrame | None = None,
    **how: str,
) -> warehouse.Inputs:
    """The mapped tables as landed files, or others in their place."""
    folder = shared_folder(spark, "landing")
    arrivals = mapped.event_arrivals(spark, sf_dir) if arrivals is None else arrivals
    raw = mapped.event_temperatures(spark, sf_dir) if temperatures is None else temperatures
    ports = mapped.port_lines(spark, sf_dir) if ports is None else ports
    writer = arrivals.write.format(how.get("arrivals_format", "parquet")).option("header", True)
    writer.save(f"{folder}/arrivals")
    raw.write.option("header", True).csv(f"{folder}/temperatures")
    mapped.code_lines(spark, sf_dir).write.option("lineSep", "\r\n").text(f"{folder}/codes")
    mapped.state_lines(spark, sf_dir).write.text(f"{folder}/states")
    ports.write.text(f"{folder}/ports")
    codes = f"{folder}/codes"
    return warehouse.Inputs(
        arrivals=f"{folder}/arrivals",
        temperatures=f"{folder}/temperatures",
        countries=codes,
        travel_modes=codes,
        visas=codes,
        states=f"{folder}/states",
        ports=f"{folder}/ports",
        **how,
    )


def counted(table: str, rows: str) -> str:
    return f"""
  SELECT 'rows' AS item, '{table}' AS label, count(*) AS n, CAST(NULL AS DOUBLE) AS mean
  FROM {rows}
"""


@query(
    " UNION ALL ".join(
        [
            counted(fixed.STAGE_ARRIVALS, f"({EVENT_STAGE})"),
            counted(fixed.STAGE_TEMPERATURES, f"({EVENT_TEMPERATURES})"),
            counted(fixed.DIM_COUNTRIES, "customer"),
            counted(fixed.DIM_TRAVEL_MODES, "customer"),
            counted(fixed.DIM_VISAS, "customer"),
            counted(fixed.DIM_PORTS, f"({PORTS})"),
            counted(fixed.DIM_DATE, f"(SELECT DISTINCT arrdate FROM ({EVENT_VISITS}))"),
            counted(fixed.FACT_VISITS, f"({EVENT_VISITS})"),
        ]
        + [
            f"SELECT * FROM ({EVENT_RANKED.format(**r)})"
            for r in [
                dict(item="top_states", group="state_name", where="true", order="n", n=10),
                dict(item="warmest_states", group="state_name", where="true", order="mean", n=5),
                dict(item="top_cities", group="city", where="state = '12'", order="n", n=5),
            ]
        ]
    )
)
def warehouse_run(spark, sf_dir):
    """The whole job over landed files: the rows of every table, and the three rankings."""
    inputs, output = landing(spark, sf_dir), shared_folder(spark, "warehouse")
    done = warehouse.run(spark, inputs, output, 2024, 1, country="view", state="12")

    def rows(name: str) -> DataFrame:
        return read_table(spark, output, name).agg(F.count("*").alias("n")).select(
            F.lit("rows").alias("item"),
            F.lit(name).alias("label"),
            "n",
            F.lit(None).cast("double").alias("mean"),
        )

    def ranking(item: str, df: DataFrame, group: str) -> DataFrame:
        return df.select(
            F.lit(item).alias("item"),
            F.col(group).alias("label"),
            F.col("count").alias("n"),
            F.col("avg_temperature").alias("mean"),
        )

    tables = [
        fixed.STAGE_ARRIVALS, fixed.STAGE_TEMPERATURES, fixed.DIM_COUNTRIES,
        fixed.DIM_TRAVEL_MODES, fixed.DIM_VISAS, fixed.DIM_PORTS, fixed.DIM_DATE,
        fixed.FACT_VISITS,
    ]
    parts = [rows(name) for name in tables] + [
        ranking("top_states", done.top_states, "state_name"),
        ranking("warmest_states", done.warmest_states, "state_name"),
        ranking("top_cities", done.top_cities, "city"),
    ]
    return reduce(DataFrame.unionAll, parts)


EVENT_COVERAGE = f"""
  SELECT i94port, count(*) AS staged, count(code) AS with_port, count(day) AS with_temperature
  FROM ({EVENT_STAGE}) s LEFT JOIN ({PORTS}) p ON i94port = code
  LEFT JOIN ({EVENT_TEMPERATURES}) t ON day = arrdate AND t.city = p.city AND t.state = state_name
  GROUP BY i94port
"""


@query(f"""
  SELECT 'coverage' AS item, i94port AS code, staged, with_port, with_temperature
  FROM ({EVENT_COVERAGE})
  UNION ALL
  SELECT 'rejected', CAST(c_custkey AS VARCHAR), NULL, NULL, NULL
  FROM customer WHERE c_nationkey BETWEEN 3 AND 9
""")
def warehouse_rejects(spark, sf_dir):
    """The tables of a run about what it leaves out: rejected ports, and arrivals by port."""
    output = shared_folder(spark, "warehouse")
    warehouse.run(spark, landing(spark, sf_dir), output, 2024, 1, country="view", state="12")
    counts = ["staged", "with_port", "with_temperature"]
    coverage = read_table(spark, output, fixed.PORT_COVERAGE)
    rejected = read_table(spark, output, fixed.REJECTED_PORTS)
    none = [F.lit(None).cast("long").alias(c) for c in counts]
    return coverage.select(F.lit("coverage").alias("item"), F.col("i94port").alias("code"), *counts).unionAll(
        rejected.select(F.lit("rejected").alias("item"), "code", *none)
    )


EVENT_DAYS = """
  SELECT event_type, CAST(ts AS DATE) AS day, c_mktsegment, n_name
  FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
  GROUP BY ALL
"""
GOOD_VISITS = f"({EVENT_VISITS}) WHERE user_id % 50 NOT IN (7, 8, 9) AND day(arrdate) NOT IN (5, 6)"
GOOD_DAYS = f"({EVENT_DAYS}) WHERE event_type = 'view' AND day(day) NOT IN (5, 6)"
PORT_LINES = "(SELECT false AS bad FROM customer UNION ALL SELECT true FROM nation)"


def delivered(first: warehouse.Inputs, arrivals: DataFrame) -> warehouse.Inputs:
    """Further arrivals landed beside the files that came with the first, which are not written again."""
    folder = shared_folder(arrivals.sparkSession, "landing")
    arrivals.write.format(first.arrivals_format).option("header", True).save(f"{folder}/arrivals")
    return replace(first, arrivals=f"{folder}/arrivals")


def run_with_bad_rows(spark: SparkSession, sf_dir: str, output: str, only_dates: bool = False) -> warehouse.Outcome:
    """A run over CSV files into which bad rows of every kind are mixed."""
    kind = F.pmod(F.col("i94port").cast("int"), F.lit(50))
    arrivals = mapped.event_arrivals(spark, sf_dir)
    arrivals = arrivals.withColumns({
        "arrdate": F.when(kind == 9, F.col("arrdate") + 40).when(kind != 8, F.col("arrdate")),
        "depdate": F.concat(F.when(kind == 7, "x").otherwise(""), F.col("depdate").cast("string")),
    })
    days = mapped.event_temperatures(spark, sf_dir)
    value = F.when(F.col("Day") == 5, "n/a").otherwise(F.col("AvgTemperature").cast("string"))
    moved = F.col("Day") == 6
    days = days.withColumns({
        "AvgTemperature": value,
        "Month": F.when(moved, 2).otherwise(F.col("Month")),
        "Day": F.when(moved, 30).otherwise(F.col("Day")),
    })
    bad = mapped.table(spark, sf_dir, "nation").select(F.col("n_name").alias("value"))
    ports = mapped.port_lines(spark, sf_dir).unionAll(bad)
    inputs = landing(spark, sf_dir, arrivals, days, ports, arrivals_format="csv")
    allowed = warehouse.ALLOWED | {("well_formed", t) for t in ("arrivals", "temperatures", "ports")}
    return warehouse.run(
        spark, inputs, output, 2024, 1, country="view", state="12",
        only_dates=only_dates, lenient_dates=True, allowed=allowed,
    )


def counted_bad(name: str, table: str, column: str, bad: str, rows: str) -> str:
    found = f"count(*) FILTER ({bad})"
    return checked(name, table, column, f"{found} = 0", found, rows)


@query(
    " UNION ALL ".join([
        counted_bad("in_period", "arrivals", "arrdate", "user_id % 50 = 9", "events"),
        counted_bad("date_present", "arrivals", "arrdate", "user_id % 50 = 8", "events"),
        counted_bad("well_formed", "arrivals", "_corrupt_record", "user_id % 50 = 7", "events"),
        counted_bad("well_formed", "temperatures", "_corrupt_record", "day(day) = 5",
                    f"({EVENT_DAYS})"),
        counted_bad("possible_date", "temperatures", "year,month,day",
                    "day(day) = 6 AND event_type = 'view'", f"({EVENT_DAYS})"),
        counted_bad("well_formed", "ports", "value", "bad", PORT_LINES),
        counted_bad("unique_key", fixed.STAGE_TEMPERATURES, ",".join(DAY_KEY), "false", GOOD_DAYS),
        checked("has_rows", fixed.DIM_PORTS, "", "count(*) >= 1", "0::BIGINT", f"({PORTS})"),
        counted_bad("unique_key", fixed.DIM_PORTS, "code", "false", f"({PORTS})"),
        counted_bad("column_exists", fixed.FACT_VISITS, "cicid", "false", GOOD_VISITS),
        counted_bad("column_type", fixed.FACT_VISITS, "cicid", "false", GOOD_VISITS),
        counted_bad("in_period", fixed.FACT_VISITS, "arrdate", "false", GOOD_VISITS),
        counted_bad("date_present", fixed.FACT_VISITS, "arrdate", "false", GOOD_VISITS),
        checked("has_rows", fixed.FACT_VISITS, "", "count(*) >= 1", "0::BIGINT", GOOD_VISITS),
        counted_bad("unique_key", fixed.FACT_VISITS, "cicid", "false", GOOD_VISITS),
    ])
)
def warehouse_checks(spark, sf_dir):
    """All checks of a run over CSV files into which bad rows of every kind are mixed."""
    done = run_with_bad_rows(spark, sf_dir, shared_folder(spark, "warehouse"))
    types = ("check_name string, table_name string, column_name string, passed boolean, "
             "rows_checked long, violations long")
    return spark.createDataFrame([tuple(row) for row in done.checks], types)


@query(f"""
  SELECT arrdate, count(*) AS n, CAST(sum(cicid) AS BIGINT) AS ids
  FROM ({EVENT_VISITS}) WHERE day(arrdate) <> 3 GROUP BY arrdate
""")
def monthly_reload(spark, sf_dir):
    """A month loaded whole and then again without one of its days, which is gone afterwards."""
    output = shared_folder(spark, "warehouse")
    arrivals = mapped.event_arrivals(spark, sf_dir)
    less = arrivals.filter(F.dayofmonth(sas_date("arrdate")) != 3)
    first = landing(spark, sf_dir, arrivals)
    for inputs in (first, delivered(first, less)):
        warehouse.run(spark, inputs, output, 2024, 1, country="view", state="12", only_dates=True)
    fact = read_table(spark, output, fixed.FACT_VISITS)
    return fact.groupBy("arrdate").agg(
        F.count("*").alias("n"), F.sum("cicid").cast("long").alias("ids")
    )


# --- Loads, corrections and what is kept apart ---------------------------------------------


KEPT = "c_nationkey NOT IN (3, 4, 5)"
TIMES = "o_orderdate >= DATE '1998-05-01' AND o_orderdate < DATE '1998-07-01'"
JULY = "o_orderdate >= DATE '1998-07-01' AND o_orderdate < DATE '1998-08-01'"


@query(
    " UNION ALL ".join(
        f"""
  SELECT '{key}' AS label, count(*) FILTER (found) = 0 AS passed, count(*) AS rows_checked, count(*) FILTER (found) AS violations
  FROM (SELECT {key} IN (SELECT {key} FROM orders WHERE {TIMES}) AS found FROM orders WHERE {JULY})
"""
        for key in ("o_orderkey", "o_custkey")
    )
)
def dq_unique_across_months(spark, sf_dir):
    """Keys of July against those of May and June: order keys are new ones, customers come again."""
    orders = mapped.table(spark, sf_dir, "orders")
    results = []
    for key in ("o_orderkey", "o_custkey"):
        rows = orders.select(F.col(key).cast("double").alias("cicid"), mapped.serial(F.col("o_orderdate")).alias("arrdate"))
        root = shared_folder(spark, "warehouse")
        for month in (5, 6, 7):
            load = Load(spark, root)
            staged = load.write(rows.filter(serial_in_period("arrdate", 1998, month)), fixed.STAGE_ARRIVALS, "arrdate", lambda _: False)
            visits = staged.select("cicid", sas_date("arrdate").alias("arrdate"))
            visits = load.write(visits, fixed.FACT_VISITS, "arrdate", lambda _: False)
            own = warehouse.summarise(load, staged, lambda _: False)
            if month == 7:
                results.append((key, *warehouse.check_across(load, visits, own, 1998, month)[3:]))
                load.abandon()
            else:
                load.publish()
    return spark.createDataFrame(results, "label string, passed boolean, rows_checked long, violations long")


LATE_VERSIONS = f"""
  SELECT CAST(event_id AS DOUBLE) AS cicid, CAST(user_id AS VARCHAR) AS i94port,
         CAST(ts AS DATE) + CAST(delivered AS INTEGER) AS arrdate, delivered
  FROM events JOIN customer ON c_custkey = user_id, range(0, 3) AS r(delivered)
  WHERE event_type <> 'error' AND {KEPT} AND (delivered = 0 OR user_id % 10 = 3)
"""


@query(f"""
  SELECT arrdate, count(*) AS n, CAST(sum(cicid) AS BIGINT) AS ids,
         CAST(sum(round(avgtemperature * 100)) AS BIGINT) AS cents
  FROM (SELECT *, row_number() OVER (PARTITION BY cicid ORDER BY delivered DESC) AS version FROM ({LATE_VERSIONS})) s
  JOIN ({PORTS}) p ON i94port = code
  JOIN ({EVENT_TEMPERATURES}) t ON day = arrdate AND t.city = p.city AND t.state = state_name
  WHERE version = 1 GROUP BY arrdate
""")
def late_arrivals(spark, sf_dir):
    """A month, and then corrections of a tenth of its arrivals, each in two versions that move it by a day."""
    output = shared_folder(spark, "warehouse")
    first = landing(spark, sf_dir)
    warehouse.run(spark, first, output, 2024, 1, country="view", state="12")
    arrivals = mapped.event_arrivals(spark, sf_dir).filter(F.pmod(F.col("i94port").cast("int"), F.lit(10)) == 3)
    versions = arrivals.withColumn("delivered", F.explode(F.array(F.lit(1), F.lit(2))))
    late = versions.withColumns({c: F.col(c) + F.col("delivered") for c in ("arrdate", "depdate")})
    warehouse.amend(spark, delivered(first, late), output, country="view", order="delivered")
    fact = read_table(spark, output, fixed.FACT_VISITS)
    return fact.groupBy("arrdate").agg(
        F.count("*").alias("n"),
        F.sum("cicid").cast("long").alias("ids"),
        F.sum(F.round(F.col("avgtemperature") * 100).cast("long")).alias("cents"),
    )


def set_apart(source: str, why: str, label: str, rows: str) -> str:
    return f"""
  SELECT '{source}' AS source, '{why}' AS reason, {label} AS label, count(*) AS n FROM {rows} GROUP BY ALL
"""


EVENT_LABEL = "CAST(event_id AS VARCHAR)"


@query(
    " UNION ALL ".join([
        set_apart("arrivals", "well_formed", EVENT_LABEL, "events WHERE user_id % 50 = 7"),
        set_apart("arrivals", "date_present", EVENT_LABEL, "events WHERE user_id % 50 = 8"),
        set_apart("arrivals", "in_period", EVENT_LABEL, "events WHERE user_id % 50 = 9"),
        set_apart("temperatures", "well_formed", "n_name", f"({EVENT_DAYS}) WHERE day(day) = 5"),
        set_apart("temperatures", "possible_date", "n_name",
                  f"({EVENT_DAYS}) WHERE day(day) = 6 AND event_type = 'view'"),
        set_apart("ports", "well_formed", "n_name", "nation"),
    ])
)
def quarantined_rows(spark, sf_dir):
    """The lines that a run over the files of ``warehouse_checks`` keeps apart, by what they are about."""
    output = shared_folder(spark, "warehouse")
    run_with_bad_rows(spark, sf_dir, output, only_dates=True)
    fields = F.split("line", ",")
    label = (
        F.when(F.col("source") == "arrivals", F.get(fields, F.lit(0)).cast("double").cast("long").cast("string"))
        .when(F.col("source") == "temperatures", F.upper(F.get(fields, F.lit(1))))
        .otherwise(F.col("line"))
    )
    apart = read_table(spark, output, fixed.QUARANTINED)
    return apart.groupBy("source", "reason", label.alias("label")).agg(F.count("*").alias("n"))


@query(
    " UNION ALL ".join(
        f"SELECT * FROM ({EVENT_RANKED.format(**r)})"
        for r in [
            dict(item="top_states", group="state_name", where="day(arrdate) <> 3", order="n", n=10),
            dict(item="warmest_states", group="state_name", where="day(arrdate) <> 3", order="mean", n=5),
            dict(item="top_cities", group="city", where="state = '12' AND day(arrdate) <> 3", order="n", n=5),
        ]
    )
)
def rankings_from_partials(spark, sf_dir):
    """Rankings after a reload, from the totals by date and port that loads maintain."""
    output = shared_folder(spark, "warehouse")
    arrivals = mapped.event_arrivals(spark, sf_dir)
    first = landing(spark, sf_dir, arrivals)
    for inputs in (first, delivered(first, arrivals.filter(F.dayofmonth(sas_date("arrdate")) != 3))):
        warehouse.run(spark, inputs, output, 2024, 1, country="view", state="12", only_dates=True)
    named = zip(("top_states", "warmest_states", "top_cities"), warehouse.rankings(spark, output, "12"))
    return reduce(DataFrame.unionAll, [
        df.select(F.lit(item).alias("item"), F.col(df.columns[0]).alias("label"), F.col("count").alias("n"), F.col("avg_temperature").alias("mean"))
        for item, df in named
    ])


@query(
    " UNION ALL ".join(
        f"""
  SELECT '{state}' AS state, arrdate, count(*) AS n, CAST(sum(cicid) AS BIGINT) AS ids
  FROM ({EVENT_VISITS}) WHERE {where} GROUP BY arrdate
"""
        for state, where in [("broken_off", "true"), ("published", "day(arrdate) <> 3"), ("settled", "day(arrdate) <> 3")]
    )
)
def interrupted_reload(spark, sf_dir):
    """What a reader sees of a month while it is loaded again: after a load is broken off, published, and put into place."""
    output = shared_folder(spark, "warehouse")
    arrivals = mapped.event_arrivals(spark, sf_dir)
    how = dict(country="view", only_dates=True)
    warehouse.run(spark, landing(spark, sf_dir, arrivals), output, 2024, 1, state="12", **how)
    inputs = landing(spark, sf_dir, arrivals.filter(F.dayofmonth(sas_date("arrdate")) != 3))
    seen = []

    def look(state: str) -> None:
        fact = read_table(spark, output, fixed.FACT_VISITS)
        days = fact.groupBy("arrdate").agg(F.count("*").alias("n"), F.sum("cicid").cast("long").alias("ids"))
        seen.append(landed(spark, days.select(F.lit(state).alias("state"), "arrdate", "n", "ids"), state))

    load = Load(spark, output)
    staged, days, _ = warehouse.stage(load, inputs, 2024, 1, **how)
    places = warehouse.dimensions(load, inputs)
    warehouse.fact(load, staged, places, days, 2024, 1, only_dates=True)
    look("broken_off")
    load.publish(settled=False)
    look("published")
    settle(spark, output)
    look("settled")
    return reduce(DataFrame.unionAll, seen)


def content(table: str, rows: str, key: str, day: str, cents: str) -> str:
    return f"""
  SELECT '{table}' AS table_name, count(*) AS n, CAST(sum({key}) AS BIGINT) AS keys,
         CAST(sum({day}) AS BIGINT) AS days, CAST(sum(round({cents} * 100)) AS BIGINT) AS cents
  FROM {rows}
"""


@query(
    " UNION ALL ".join([
        content(fixed.STAGE_ARRIVALS, f"({EVENT_STAGE})", "cicid", "arrdate - DATE '1960-01-01'", "0"),
        content(fixed.STAGE_TEMPERATURES, f"({EVENT_TEMPERATURES})", "length(city || state)", "day(day)", "avgtemperature"),
        content(fixed.DIM_COUNTRIES, "customer", "c_custkey", "0", "0"),
        content(fixed.DIM_PORTS, f"({PORTS})", "CAST(code AS BIGINT)", "length(city || state || state_name)", "0"),
        content(fixed.DIM_DATE, f"(SELECT DISTINCT arrdate FROM ({EVENT_VISITS}))", "weekofyear(arrdate)", "arrdate - DATE '1960-01-01'", "0"),
        content(fixed.FACT_VISITS, f"({EVENT_VISITS})", "cicid", "arrdate - DATE '1960-01-01'", "avgtemperature"),
        content(fixed.PORT_TOTALS, f"({EVENT_VISITS})", "1", "arrdate - DATE '1960-01-01'", "avgtemperature").replace("count(*) AS n", "count(DISTINCT (i94port, arrdate)) AS n"),
    ])
)
def warehouse_content(spark, sf_dir):
    """Sums over keys, days and temperatures (in cents) of the tables of a run."""
    output = shared_folder(spark, "warehouse")
    warehouse.run(spark, landing(spark, sf_dir), output, 2024, 1, country="view", state="12")
    epoch = F.lit(fixed.SERIAL_EPOCH).cast("date")
    none = F.lit(0)
    wide = F.length(F.concat("city", "state"))
    sums = {
        fixed.STAGE_ARRIVALS: ("cicid", F.col("arrdate"), none),
        fixed.STAGE_TEMPERATURES: (wide, F.col("day"), F.col("avgtemperature")),
        fixed.DIM_COUNTRIES: ("code", none, none),
        fixed.DIM_PORTS: (F.col("code").cast("long"), wide + F.length("state_name"), none),
        fixed.DIM_DATE: ("week", F.date_diff("arrdate", epoch), none),
        fixed.FACT_VISITS: ("cicid", F.date_diff("arrdate", epoch), F.col("avgtemperature")),
        fixed.PORT_TOTALS: ("visits", F.date_diff("arrdate", epoch) * F.col("visits"), F.col("total")),
    }

    def summed(name: str) -> DataFrame:
        key, day, cents = sums[name]
        return read_table(spark, output, name).agg(
            F.count("*").alias("n"), F.sum(key).cast("long").alias("keys"), F.sum(day).cast("long").alias("days"),
            F.sum(F.round(cents * 100).cast("long")).alias("cents"),
        ).select(F.lit(name).alias("table_name"), "n", "keys", "days", "cents")

    return reduce(DataFrame.unionAll, [summed(name) for name in sums])
