"""The batch job: stage, dimensions, fact, checks and rankings.

All of a run is one load (``landfall.sources.loads``): readers see the warehouse as it was until the
run has passed its checks, and then all of what it wrote.
"""

from collections.abc import Callable, Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from math import floor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from landfall import fixed
from landfall.functions import date_from_parts, period_serials, sas_date, serial_in_period
from landfall.operators import (
    build_visits,
    cells_for,
    code_list,
    date_dim,
    distinct_where_repeated,
    keep_arrivals,
    keep_present,
    known_ports,
    latest,
    malformed_lines,
    merged,
    met_cells,
    port_coverage,
    port_rejects,
    port_totals,
    ports_dim,
    quarantined,
    rank_totals,
    reason,
    repeated_values,
    replaced,
    stage_temperatures,
    summarise_keys,
    suspects,
    well_formed_port,
)
from landfall.operators.quality import (
    Check,
    column_exists,
    column_type,
    date_present,
    has_rows,
    in_period,
    possible_date,
    raise_on_failure,
    report,
    verdict,
    well_formed,
)
from landfall.sources import (
    Load,
    exists,
    partitions_of,
    read_arrivals,
    read_lines,
    read_table,
    read_temperatures,
    settle,
    shared_folder,
    write_table,
)
from landfall.sources.readers import MALFORMED

# Up to this many rows, and this size as Spark estimates it, a table is broadcast to every executor.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 256 << 20

# Tables that may be empty, and then have no file to tell their types.
TOTALS = "i94port string, total decimal(38,10), measured long, visits long, arrdate date"
PLACES = "code string, city string, state string, state_name string"
SUMMARY = "cells long, bucket long, bits binary, low double, high double, month string"

# Names that the checks of input files go by.
ARRIVALS, TEMPERATURES, PORTS = "arrivals", "temperatures", "ports"

# Failed checks that are reported and do not stop a run, as (check, table): arrivals of other months or
# without a date have no place in the month's fact, and a month may have no visits.
ALLOWED = frozenset({
    ("in_period", ARRIVALS),
    ("date_present", ARRIVALS),
    ("has_rows", fixed.FACT_VISITS),
})


@dataclass(frozen=True)
class Inputs:
    """Full paths of the inputs, on any file system Spark reads."""

    arrivals: str
    temperatures: str
    countries: str
    travel_modes: str
    visas: str
    states: str
    ports: str
    arrivals_format: str = "parquet"
    csv_mode: str = "PERMISSIVE"


@dataclass(frozen=True)
class Outcome:
    """Results of the checks, and the three rankings over the written tables."""

    checks: list[Row]
    top_states: DataFrame
    warmest_states: DataFrame
    top_cities: DataFrame


def _together(spark: SparkSession, *steps: Callable) -> list:
    """What the steps return. Their jobs share the cluster, so that it is not idle while one has few tasks left. All have ended
    when one that fails raises."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


def distinct_arrivals(
    spark: SparkSession, kept: DataFrame, counted: DataFrame | None = None, folder: str | None = None
) -> DataFrame:
    """The distinct rows of columnar files, without shuffling those that cannot have a copy.

    A first pass reads little more than ``cicid``, which is nearly unique, and writes its
    repeated values to ``folder`` (else to the shared one). Only rows with one of these are compared as a whole.
    If the values are too many to broadcast, all rows are. The first pass reads ``counted`` where that is given: the same rows,
    under observation.
    """
    folder = folder or shared_folder(spark, "repeated")
    repeated = write_table(repeated_values(kept if counted is None else counted, "cicid"), folder, "cicid")
    number = repeated.count()
    if number == 0:
        return kept
    if number > BROADCAST_ROWS:
        return kept.distinct()
    return distinct_where_repeated(kept, "cicid", F.broadcast(repeated))


def _readable(rows: DataFrame) -> Check:
    """The check that every CSV row fits its types. Spark parses only fields that are asked for, so
    the condition asks for all."""
    fields = F.concat_ws("", *[F.col(c).cast("string") for c in rows.columns if c != MALFORMED])
    return well_formed(MALFORMED, F.col(MALFORMED).isNotNull() & (F.length(fields) >= 0))


def _arrival_checks(year: int, month: int) -> list[Check]:
    whole = ~F.isnan("arrdate") & (F.col("arrdate") != 0)
    return [
        Check("in_period", "arrdate", whole & ~serial_in_period("arrdate", year, month)),
        Check("date_present", "arrdate", ~F.coalesce(whole, F.lit(False))),
    ]


def _temperature_checks(daily: DataFrame, country: str) -> list[Check]:
    dates = possible_date("year", "month", "day")
    return [_readable(daily), Check(dates.name, dates.column, (F.col("country") == country) & dates.violates)]


def check_inputs(
    spark: SparkSession, inputs: Inputs, year: int, month: int, country: str = "US"
) -> DataFrame:
    """The checks of the input files by themselves, as rows; one pass over each file. ``run`` makes them as it reads.

    They count what later steps would leave out: CSV rows that do not fit their types, port
    lines that cannot be read, arrivals of other months or without a date, and temperatures of the country
    whose parts are no date.
    """
    csv = inputs.arrivals_format == "csv"
    arrivals = read_arrivals(spark, inputs.arrivals, inputs.arrivals_format, inputs.csv_mode, csv)
    on_arrivals = _arrival_checks(year, month) + ([_readable(arrivals)] if csv else [])
    daily = read_temperatures(spark, inputs.temperatures, inputs.csv_mode, malformed=True)
    lines = read_lines(spark, inputs.ports)
    return (
        report(arrivals, ARRIVALS, on_arrivals)
        .unionAll(report(daily, TEMPERATURES, _temperature_checks(daily, country)))
        .unionAll(report(lines, PORTS, [well_formed("value", ~well_formed_port())]))
    )


def _observed(rows: DataFrame, name: str, checks: Sequence[Check]) -> tuple[DataFrame, Callable[[], list[Row]]]:
    """The rows, and their checks once they have been read: counted on the way, without a pass of their own.

    A task that is done twice, as after a lost executor, may count twice; a count of none is always right.
    """
    seen = Observation(name)
    counts = [F.count_if(c.violates).alias(f"violations_{i}") for i, c in enumerate(checks)]

    def results() -> list[Row]:
        found = seen.get
        return [verdict(c, name, found["rows_checked"], found[f"violations_{i}"]) for i, c in enumerate(checks)]

    return rows.observe(seen, F.count("*").alias("rows_checked"), *counts), results


def _sorted(
    load: Load, rows: DataFrame, name: str, checks: Sequence[Check], apart: Collection[str], wanted: Column
) -> tuple[DataFrame, DataFrame, list[Row]]:
    """One pass over a CSV source: its ``wanted`` rows, the rows kept apart with their reason, and its checks.

    Rows that violate a check named in ``apart`` are kept apart.
    """
    reasons = {c.name: c.violates for c in checks if c.name in apart}
    observed, results = _observed(rows.withColumn("reason", reason(reasons)), name, checks)
    once = load.scratch(observed.filter(F.col("reason").isNotNull() | wanted), name)
    good = once.filter(F.col("reason").isNull()).drop("reason", MALFORMED)
    return good, quarantined(once.filter(F.col("reason").isNotNull()), name, MALFORMED), results()


MET_PORTS = "met-ports"


def _estimated(df: DataFrame) -> int:
    """The size of a table as Spark estimates it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _met_ports(load: Load, codes: DataFrame, present: DataFrame) -> DataFrame:
    """The codes to keep arrivals by. If Spark would not broadcast them, those that arrivals have, broadcast if they are few.

    One column of the arrivals is read for this, and no row of them is shuffled for the list then.
    """
    automatic = load.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if automatic < 0 or _estimated(codes) <= automatic:
        return codes
    named = present.select(F.col("i94port").alias("code")).distinct()
    met = load.scratch(codes.select("code").join(named, "code", "left_semi").distinct(), MET_PORTS)
    return F.broadcast(met) if met.count() <= BROADCAST_ROWS else met


def _places_met(load: Load, ports: DataFrame, broadcast_bytes: int) -> DataFrame:
    """The ports that staged arrivals may have, if ``stage`` listed these and the ports are too many to broadcast."""
    path = f"{load.folder}/scratch/{MET_PORTS}"
    if not exists(load.spark, path) or _broadcast_if_small(ports, broadcast_bytes)[1]:
        return ports
    met = load.spark.read.schema("code string").parquet(path)
    return load.scratch(ports.join(met, "code", "left_semi"), "places-met")


def month_name(year: int, month: int) -> str:
    return f"{year:04d}-{month:02d}"


def _value(kind: Callable, text: str):
    """A partition's value, None for the null partition."""
    try:
        return kind(text)
    except ValueError:
        return None


def _serials_of(year: int, month: int, only_dates: bool) -> Callable[[str], bool] | None:
    """Which partitions of the stage a load of a month replaces."""
    if not only_dates:
        return None
    first, after = period_serials(year, month)
    return lambda text: (day := _value(float, text)) is not None and first <= day < after


def _dates_of(year: int, month: int, only_dates: bool) -> Callable[[str], bool] | None:
    """Which partitions of the fact a load of a month replaces."""
    if not only_dates:
        return None
    return lambda text: (day := _value(date.fromisoformat, text)) is not None and (day.year, day.month) == (year, month)


def _this_month(year: int, month: int, only_dates: bool) -> Callable[[str], bool] | None:
    return (lambda text: text == month_name(year, month)) if only_dates else None


def stage(
    load: Load,
    inputs: Inputs,
    year: int,
    month: int,
    country: str = "US",
    only_dates: bool = False,
    allowed: Collection[tuple[str, str]] = ALLOWED,
) -> tuple[DataFrame, DataFrame, list[Row]]:
    """Read the arrivals and temperatures, check them and write both staging tables: these, and the checks.

    Each CSV file is read once: its checks are counted as it is read, and bad rows go to the table of quarantined rows. Of
    Parquet arrivals a few columns are read to count and to find repeated keys, and then the rows. With
    ``only_dates``, the month is replaced and other months are left alone: arrivals outside the month are left
    out, and are quarantined too. A check that fails and is not ``allowed`` raises ValueError before anything is staged.
    """
    spark, csv = load.spark, inputs.arrivals_format == "csv"
    raw = read_arrivals(spark, inputs.arrivals, inputs.arrivals_format, inputs.csv_mode, csv)
    lines = read_lines(spark, inputs.ports)
    codes = known_ports(lines)
    checks = _arrival_checks(year, month)
    outside = {c.name for c in checks} if only_dates else set()
    bad = []
    if csv:
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fixed.REQUIRED_COLUMNS])
        checks.append(_readable(raw))
        arrivals, apart, results = _sorted(load, raw, ARRIVALS, checks, {"well_formed"} | outside, present)
        codes = _met_ports(load, codes, arrivals)
        staged = distinct_arrivals(spark, keep_arrivals(arrivals, codes), folder=f"{load.folder}/scratch/repeated")
        bad.append(apart)
    else:
        inside = serial_in_period("arrdate", year, month) if only_dates else F.lit(True)
        codes = _met_ports(load, codes, keep_present(raw.filter(inside), fixed.REQUIRED_COLUMNS))
        kept = keep_arrivals(raw.filter(inside), codes)
        few = raw.select(*dict.fromkeys(["cicid", "i94port", "arrdate", *fixed.REQUIRED_COLUMNS]))
        observed, seen = _observed(few, ARRIVALS, checks)
        # No join stands above what is counted: one with an empty side would not read its other side at all.
        counted = keep_present(observed.filter(inside), fixed.REQUIRED_COLUMNS)
        staged = distinct_arrivals(spark, kept, counted, f"{load.folder}/scratch/repeated")
        results = seen()
        apart = [c for c in checks if c.name in outside]
        if any(r.violations for r in results) and apart:
            named = raw.withColumn("reason", reason({c.name: c.violates for c in apart}))
            bad.append(quarantined(named.filter(F.col("reason").isNotNull()), ARRIVALS))
    measured = read_temperatures(spark, inputs.temperatures, inputs.csv_mode, malformed=True)
    of_month = (F.col("country") == country) & (F.col("year") == year) & (F.col("month") == month)
    on_days = _temperature_checks(measured, country)
    days, apart, found = _sorted(load, measured, TEMPERATURES, on_days, {c.name for c in on_days}, of_month)
    bad.append(apart)
    bad.append(quarantined(malformed_lines(lines).withColumn("reason", F.lit("well_formed")), PORTS, "value"))
    results = results + found + report(lines, PORTS, [well_formed("value", ~well_formed_port())]).collect()
    raise_on_failure(results, allowed)
    apart = reduce(DataFrame.unionAll, bad).withColumn("month", F.lit(month_name(year, month)))
    staged, daily, _ = _together(
        spark,
        lambda: load.write(staged, fixed.STAGE_ARRIVALS, "arrdate", _serials_of(year, month, only_dates)),
        lambda: load.write(stage_temperatures(days, country, year, month), fixed.STAGE_TEMPERATURES),
        lambda: load.write(apart, fixed.QUARANTINED, "month", _this_month(year, month, only_dates)),
    )
    return staged, daily, results


def dimensions(load: Load, inputs: Inputs, state_parse: str = "exact") -> DataFrame:
    """Write the four dimensions that come from lookup files, and the ports left out. Returns the ports."""
    spark = load.spark
    countries = code_list(
        read_lines(spark, inputs.countries), fixed.JUNK_COUNTRIES, fixed.OTHER_COUNTRIES
    )
    modes = code_list(read_lines(spark, inputs.travel_modes))
    visas = code_list(read_lines(spark, inputs.visas))
    lines, states = read_lines(spark, inputs.ports), read_lines(spark, inputs.states)
    return _together(
        spark,
        lambda: load.write(countries, fixed.DIM_COUNTRIES),
        lambda: load.write(modes, fixed.DIM_TRAVEL_MODES),
        lambda: load.write(visas, fixed.DIM_VISAS),
        lambda: load.write(port_rejects(lines, states, state_parse), fixed.REJECTED_PORTS),
        lambda: load.write(ports_dim(lines, states, state_parse), fixed.DIM_PORTS),
    )[-1]


def check_before_joins(temperatures: DataFrame, ports: DataFrame) -> DataFrame:
    """The checks that the tables joined to arrivals match each at most once, as rows."""
    day = ["year", "month", "day", "city", "state"]
    return report(temperatures, fixed.STAGE_TEMPERATURES, key=day).unionAll(
        report(ports, fixed.DIM_PORTS, [has_rows()], key=["code"])
    )


def _broadcast_if_small(df: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The table with a hint, if its size and a count, which Parquet answers from its footers, allow it."""
    automatic = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = not automatic.startswith("-") and _estimated(df) <= most and df.count() <= BROADCAST_ROWS
    return (F.broadcast(df) if small else df), small


def fact(
    load: Load,
    arrivals: DataFrame,
    ports: DataFrame,
    temperatures: DataFrame,
    year: int,
    month: int,
    lenient_dates: bool = False,
    only_dates: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Write the month's visits, to be checked before they are published, and return them.

    The temperatures hold one month only, so other arrival dates could not join and are not
    read. Ports and temperatures are broadcast, each by its own size, if that is small. If both
    are, no row of the arrivals is shuffled, each task goes on holding few dates, and the
    visits need no gathering either.
    """
    arrivals = arrivals.filter(serial_in_period("arrdate", year, month))
    ports, few_ports = _broadcast_if_small(_places_met(load, ports, broadcast_bytes), broadcast_bytes)
    temperatures, few_days = _broadcast_if_small(temperatures, broadcast_bytes)
    coverage = port_coverage(arrivals, ports, temperatures, lenient_dates)
    visits = build_visits(arrivals, ports, temperatures, lenient_dates)
    gather = not (few_ports and few_days)
    return _together(
        load.spark,
        lambda: load.write(coverage, fixed.PORT_COVERAGE),
        lambda: load.write(visits, fixed.FACT_VISITS, "arrdate", _dates_of(year, month, only_dates), gather),
    )[-1]


def check(visits: DataFrame, year: int, month: int) -> DataFrame:
    """The checks of the month's visits, as rows."""
    checks = [
        column_exists(visits, "cicid"),
        column_type(visits, "cicid", "double"),
        in_period("arrdate", year, month),
        date_present("arrdate"),
        has_rows(),
    ]
    return report(visits, fixed.FACT_VISITS, checks, key=["cicid"])


NO_MONTH = "none"


def _staged_months(staged: DataFrame) -> DataFrame:
    month = F.date_format(sas_date("arrdate"), "yyyy-MM")
    return staged.withColumn("month", F.coalesce(month, F.lit(NO_MONTH)))


def summarise(load: Load, staged: DataFrame, replaces: Callable[[str], bool] | None) -> DataFrame:
    """Write the summary of the keys that each month's staged arrivals have, and return it."""
    summary = summarise_keys(_staged_months(staged), "cicid", cells_for(staged.count()))
    return load.write(summary, fixed.KEY_SUMMARIES, "month", replaces)


def _ranges(names: Collection[str]) -> list[tuple[date, date]]:
    firsts = [date.fromisoformat(f"{name}-01") for name in sorted(names) if name != NO_MONTH]
    return [(d, date(d.year + d.month // 12, d.month % 12 + 1, 1)) for d in firsts]


def _in_months(names: Collection[str]) -> Column:
    """True for a visit of one of the months; ranges of dates, so that partitions are pruned by it."""
    ranges = [(F.col("arrdate") >= first) & (F.col("arrdate") < after) for first, after in _ranges(names)]
    return reduce(lambda a, b: a | b, ranges, F.lit(False))


def _staged_in_months(names: Collection[str]) -> Column:
    """True for a staged arrival of one of the months; ranges of serials, so that partitions are pruned by it."""
    ranges = [serial_in_period("arrdate", first.year, first.month) for first, _ in _ranges(names)]
    if NO_MONTH in names:
        ranges.append(F.col("arrdate").isNull() | F.isnan("arrdate") | (F.col("arrdate") == 0))
    return reduce(lambda a, b: a | b, ranges, F.lit(False))


def _months_of(spark: SparkSession, root: str, table: str, value: Callable[[str], date | None]) -> set[str]:
    """The months that a table's partitions have."""
    days = [value(p.split("=", 1)[1]) for p in partitions_of(spark, f"{root}/{table}")]
    return {NO_MONTH if d is None else month_name(d.year, d.month) for d in days}


def _fact_day(text: str) -> date | None:
    return _value(date.fromisoformat, text)


def _stage_day(text: str) -> date | None:
    serial = _value(float, text)
    if not serial or serial != serial:
        return None
    return date.fromisoformat(fixed.SERIAL_EPOCH) + timedelta(days=floor(serial))


def _summaries(load: Load, months: Collection[str]) -> DataFrame:
    """The summaries of these months of the stage; those that are missing are made."""
    spark, root = load.spark, load.root
    have = {p.split("=", 1)[1] for p in partitions_of(spark, f"{root}/{fixed.KEY_SUMMARIES}")}
    found = []
    if have:
        old = read_table(spark, root, fixed.KEY_SUMMARIES, SUMMARY)
        found.append(old.filter(F.col("month").isin(list(months))))
    missing = set(months) - have
    if missing:
        staged = read_table(spark, root, fixed.STAGE_ARRIVALS).filter(_staged_in_months(missing))
        summary = summarise_keys(_staged_months(staged), "cicid", cells_for(staged.count()))
        found.append(load.scratch(summary, "missing-summaries"))
    return reduce(DataFrame.unionByName, found)


def months_with_keys(
    load: Load, rows: DataFrame, own: DataFrame, months: Collection[str]
) -> tuple[list[str], DataFrame | None]:
    """Of the ``months`` of the stage those that may hold keys of ``rows``, and the suspects there: ``month, cicid``.

    ``own`` is a summary that has all keys of the rows. Only summaries are read.
    """
    if not months:
        return [], None
    theirs = _summaries(load, months)
    sizes = [r.cells for r in theirs.select("cells").distinct().collect()]  # powers of two
    own_cells = own.agg(F.max("cells")).first()[0]
    if own_cells is None or not sizes:
        return [], None
    met = load.scratch(met_cells(own, theirs, own_cells, sizes), "met-cells")
    found = [r.month for r in met.select("month").distinct().collect()]  # months
    if not found:
        return [], None
    cells = {min(size, own_cells) for size in sizes}
    return found, load.scratch(suspects(rows, "cicid", met, cells).distinct(), "suspects")


def check_across(load: Load, visits: DataFrame, own: DataFrame, year: int, month: int) -> Row:
    """The check that no other month of the fact has a key of this month's visits.

    Its violations are the visits whose key another month has. Of other months only the keys are read, and only of
    those months that summaries leave in doubt.
    """
    spark, root = load.spark, load.root
    months = _months_of(spark, root, fixed.FACT_VISITS, _fact_day) - {month_name(year, month)}
    found, named = months_with_keys(load, visits, own, months)
    violations = 0
    if found:
        old = read_table(spark, root, fixed.FACT_VISITS, visits.schema).filter(_in_months(found)).select("cicid", "arrdate")
        old = old.withColumn("month", F.date_format("arrdate", "yyyy-MM"))
        shared = old.join(named, ["month", "cicid"], "left_semi").select("cicid").distinct()
        violations = visits.join(shared, "cicid", "left_semi").count()
    return verdict(Check("unique_across_months", "cicid", F.lit(True)), fixed.FACT_VISITS, visits.count(), violations)


def publish(load: Load, visits: DataFrame, replaces: Callable[[str], bool] | None) -> DataFrame:
    """Renew the date dimension and the totals by port, publish the load and return the fact."""
    spark, root = load.spark, load.root
    totals = port_totals(visits, "arrdate")
    if replaces is not None:
        # Dates from before there were totals.
        days = partitions_of(spark, f"{root}/{fixed.FACT_VISITS}")
        have = set(partitions_of(spark, f"{root}/{fixed.PORT_TOTALS}"))
        missing = [d for p in days if p not in have and (d := p.split("=", 1)[1]) and not replaces(d)]
        if missing:
            old = read_table(spark, root, fixed.FACT_VISITS, visits.schema)
            old = old.filter(F.col("arrdate").isin([date.fromisoformat(d) for d in missing]))
            totals = totals.unionByName(port_totals(old, "arrdate"))
    # The fact's partitions are its dates, so none of its files is opened for them.
    dates = [(_fact_day(p.split("=", 1)[1]),) for p in load.partitions(fixed.FACT_VISITS)]
    _together(
        spark,
        lambda: load.write(totals, fixed.PORT_TOTALS, "arrdate", replaces),
        lambda: load.write(date_dim(spark.createDataFrame(dates, "arrdate date").coalesce(1)), fixed.DIM_DATE),
    )
    load.publish()
    return read_table(spark, root, fixed.FACT_VISITS, visits.schema)


def rankings(spark: SparkSession, output: str, state: str = "CA") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Top states by visits, warmest states, and top cities of a state, from the totals by date and port.

    The totals are exact decimals and renewed with each load, so the fact is not scanned.
    """
    totals, ports = read_table(spark, output, fixed.PORT_TOTALS, TOTALS), read_table(spark, output, fixed.DIM_PORTS, PLACES)
    return (
        rank_totals(totals, ports, "state_name", "count", 10),
        rank_totals(totals, ports, "state_name", "avg_temperature", 5),
        rank_totals(totals, ports, "city", "count", 5, state),
    )


def run(
    spark: SparkSession,
    inputs: Inputs,
    output: str,
    year: int,
    month: int,
    country: str = "US",
    state: str = "CA",
    only_dates: bool = False,
    lenient_dates: bool = False,
    state_parse: str = "exact",
    allowed: Collection[tuple[str, str]] = ALLOWED,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Outcome:
    """Build the warehouse of a month under ``output``, check it and rank its visits.

    A failed check raises ValueError unless ``allowed`` names it: those of the inputs before
    anything is staged, those of the joined tables before the join, those of the visits
    before they are published. Rows that the job leaves out are all counted, by a check or in the tables
    ``rejected_us_ports`` and ``port_coverage``; those that cannot be read or have no place stand in ``quarantined_rows``.
    Nothing is seen by readers before all checks have passed, and then all of it; a run that fails leaves nothing behind, and
    what one leaves that is broken off is put right by the next.

    ``only_dates`` replaces the month in a warehouse that holds others, whose keys the month's visits must not have.
    ``lenient_dates`` leaves out temperatures whose parts are no date, and counts them. ``state_parse`` is that of ``ports_dim``.
    Ports and temperatures larger than ``broadcast_bytes`` are not broadcast.
    """
    skipped = {("possible_date", TEMPERATURES)} if lenient_dates else set()
    allowed = set(allowed) | skipped
    settle(spark, output)
    load = Load(spark, output)
    try:
        arrivals, temperatures, checks = stage(load, inputs, year, month, country, only_dates, allowed)
        ports = dimensions(load, inputs, state_parse)
        checks += raise_on_failure(check_before_joins(temperatures, ports), allowed)
        visits = fact(load, arrivals, ports, temperatures, year, month, lenient_dates, only_dates, broadcast_bytes)
        found, own = _together(
            spark,
            lambda: raise_on_failure(check(visits, year, month), allowed),
            lambda: summarise(load, arrivals, _this_month(year, month, only_dates)),
        )
        checks += found
        if only_dates and exists(spark, f"{output}/{fixed.FACT_VISITS}"):
            checks += raise_on_failure([check_across(load, visits, own, year, month)], allowed)
        publish(load, visits, _dates_of(year, month, only_dates))
    except BaseException:
        load.abandon()
        raise
    return Outcome(checks, *rankings(spark, output, state))


def _add_to_summaries(load: Load, late: DataFrame) -> None:
    """Add the keys to the summaries of their months. Keys that have left a month stay in its summary, as suspects only."""
    late = _staged_months(late)
    months = [r.month for r in late.select("month").distinct().collect()]  # months
    have = {p.split("=", 1)[1] for p in partitions_of(load.spark, f"{load.root}/{fixed.KEY_SUMMARIES}")}
    old = read_table(load.spark, load.root, fixed.KEY_SUMMARIES, SUMMARY).filter(F.col("month").isin(months)) if have else None
    most = (old.agg(F.max("cells")).first()[0] if have else None) or 0
    new = summarise_keys(late, "cicid", max(most, cells_for(late.count())))
    load.write(merged(old, new) if have else new, fixed.KEY_SUMMARIES, "month", lambda text: text in months)


def amend(
    spark: SparkSession,
    inputs: Inputs,
    output: str,
    country: str = "US",
    state: str = "CA",
    order: str | None = None,
    lenient_dates: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Outcome:
    """Put late and corrected arrivals of any month into the warehouse: of each ``cicid`` the latest version stays.

    ``inputs.arrivals`` are what was delivered late. They replace arrivals of the same key wherever these stand; of several
    versions of one key that of greatest ``order`` (a column of the input) counts. A late arrival without what staging asks for
    replaces nothing. Only the dates that lose or gain a row are written anew, in the stage and in the fact; files of other dates stay as they
    are. Summaries of keys tell which months can hold a key at all, and only these are searched.
    """
    settle(spark, output)
    load = Load(spark, output)
    try:
        raw = read_arrivals(spark, inputs.arrivals, inputs.arrivals_format, inputs.csv_mode)
        late = keep_arrivals(raw, known_ports(read_lines(spark, inputs.ports)))
        late = late.filter(sas_date("arrdate").isNotNull() & F.col("cicid").isNotNull())
        staged = read_table(spark, output, fixed.STAGE_ARRIVALS)
        late = load.scratch(latest(late, "cicid", order).select(*staged.columns), "late")
        own = summarise_keys(late.withColumn("month", F.lit("late")), "cicid", cells_for(late.count()))
        months = _months_of(spark, output, fixed.STAGE_ARRIVALS, _stage_day)
        found, named = months_with_keys(load, late, load.scratch(own, "late-keys"), months)
        held = late.select("arrdate")
        if found:
            old = _staged_months(staged.filter(_staged_in_months(found)).select("cicid", "arrdate"))
            held = held.unionAll(old.join(named, ["month", "cicid"], "left_semi").select("arrdate"))
        serials = [r.arrdate for r in held.distinct().collect()]  # dates that lose or gain a row
        known = [d for d in serials if d is not None]
        of_these = F.col("arrdate").isin(known) | (F.col("arrdate").isNull() & F.lit(None in serials))
        rows = replaced(staged.filter(of_these), late, "cicid")
        rows = load.write(rows, fixed.STAGE_ARRIVALS, "arrdate", lambda text: _value(float, text) in serials)
        dates = {d for d in map(_stage_day, map(str, known)) if d is not None}
        measured = read_temperatures(spark, inputs.temperatures, inputs.csv_mode, malformed=True)
        measured = measured.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
        measured = stage_temperatures(measured.filter(F.col("country") == country), country)
        day = date_from_parts("year", "month", "day", lenient=True)
        measured = load.scratch(measured.filter(day.isin(sorted(dates))), "temperatures")
        measured, few_days = _broadcast_if_small(measured, broadcast_bytes)
        ports = read_table(spark, output, fixed.DIM_PORTS)
        checks = raise_on_failure(check_before_joins(measured, ports))
        ports, few_ports = _broadcast_if_small(ports, broadcast_bytes)
        visits = build_visits(rows, ports, measured, lenient_dates)
        visits = load.write(visits, fixed.FACT_VISITS, "arrdate", lambda text: _fact_day(text) in dates, not (few_ports and few_days))
        checks += raise_on_failure(report(visits, fixed.FACT_VISITS, [date_present("arrdate")], key=["cicid"]))
        _add_to_summaries(load, late)
        publish(load, visits, lambda text: _fact_day(text) in dates)
    except BaseException:
        load.abandon()
        raise
    return Outcome(checks, *rankings(spark, output, state))
