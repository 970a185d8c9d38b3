from pyspark.sql import Column, DataFrame, functions as F

from landfall.fixed import JUNK_PORTS, OTHER_PORTS
from landfall.functions import halves, replace_junk, strip

PORT_LINE = r"^\s*'([^']*)'\s*=\s*'(.*)'\s*$"


def code_list(lines: DataFrame, junk: list[str] = (), other: str = "") -> DataFrame:
    """``code = 'name'`` lines as (code int, name). Names with a junk marker become ``other``."""
    code, name = halves(F.col("value"), "=")
    name = F.translate(name, "'", "")
    if junk:
        name = replace_junk(name, junk, other)
    return lines.select(strip(code).cast("int").alias("code"), strip(name).alias("name"))


def known_ports(lines: DataFrame) -> DataFrame:
    """The port codes that arrivals may carry, with the raw text of the place.

    The code is the first quoted text, so a doubled quote in the place does no harm.
    """
    parsed = lines.filter(well_formed_port()).select(
        F.regexp_extract("value", PORT_LINE, 1).alias("code"),
        F.regexp_extract("value", PORT_LINE, 2).alias("place"),
    )
    for marker in JUNK_PORTS:
        parsed = parsed.filter(~F.col("place").contains(marker))
    return parsed


def well_formed_port(line: str = "value") -> Column:
    """True for a line that ``known_ports`` can read."""
    return F.col(line).rlike(PORT_LINE)


def malformed_lines(lines: DataFrame) -> DataFrame:
    """The port lines that ``known_ports`` cannot read, whose arrivals would be left out."""
    return lines.filter(~well_formed_port())


def port_places(lines: DataFrame, state_parse: str = "exact") -> DataFrame:
    """Every port line as (code, city, state).

    ``exact`` takes all after the first comma as the state, null without a comma. ``lenient``
    takes a two-character state at the end or before a suffix such as ``(BPS)`` or ``#ARPT``.
    """
    code, place = halves(F.col("value"), "=")
    place = strip(replace_junk(F.translate(place, "'\t", ""), JUNK_PORTS, OTHER_PORTS))
    city, state = halves(place, ",")
    if state_parse == "lenient":
        ending = r"^(.*?)[\s,]+([A-Z0-9]{2})(?:\s*[(#].*)?$"
        found = place.rlike(ending)
        city = F.when(found, F.regexp_extract(place, ending, 1)).otherwise(city)
        state = F.when(found, F.regexp_extract(place, ending, 2)).otherwise(state)
    return lines.select(
        strip(F.translate(code, "'\t", "")).alias("code"),
        strip(city).alias("city"),
        strip(state).alias("state"),
    )


def state_names(lines: DataFrame) -> DataFrame:
    """``'code'='name'`` lines as (state, state_name)."""
    code, name = halves(F.col("value"), "=")
    return lines.select(
        strip(F.translate(code, "'\t", "")).alias("state"),
        strip(F.translate(name, "'\t", "")).alias("state_name"),
    )


def ports_dim(
    port_lines: DataFrame, state_lines: DataFrame, state_parse: str = "exact"
) -> DataFrame:
    """Ports whose state is in the state list, as (code, city, state, state_name)."""
    ports = port_places(port_lines, state_parse)
    joined = ports.join(state_names(state_lines), "state")
    return joined.select("code", "city", "state", "state_name")


def port_rejects(
    port_lines: DataFrame, state_lines: DataFrame, state_parse: str = "exact"
) -> DataFrame:
    """Ports left out of ``ports_dim``, as (code, city, state)."""
    ports = port_places(port_lines, state_parse)
    rejected = ports.join(state_names(state_lines), "state", "left_anti")
    return rejected.select("code", "city", "state")


def date_dim(df: DataFrame, column: str = "arrdate") -> DataFrame:
    """One row for each date of a column. Over a table partitioned by it, no column is read."""
    dates = df.select(column).distinct()
    return dates.withColumns({
        "day": F.dayofmonth(column),
        "weekday": F.date_format(column, "E"),
        "week": F.weekofyear(column),
        "month": F.month(column),
        "year": F.year(column),
    })
