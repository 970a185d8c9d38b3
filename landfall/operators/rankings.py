from pyspark.sql import Column, DataFrame, functions as F

# Enough for sums of any measure below 10**18, to ten decimals.
EXACT = "decimal(28,10)"


def _exact(measure: str) -> Column:
    """The measure as a decimal, whose sums do not depend on the order of rows. NaN counts as missing."""
    return F.nanvl(measure, F.lit(None).cast("double")).cast(EXACT)


def port_totals(visits: DataFrame, *by: str) -> DataFrame:
    """``total``, ``measured`` and ``visits`` of each port (and ``by``): what rankings need, and what adds up."""
    return visits.groupBy("i94port", *by).agg(
        F.sum(_exact("avgtemperature")).alias("total"),
        F.count(_exact("avgtemperature")).alias("measured"),
        F.count("*").alias("visits"),
    )


def rank_totals(
    totals: DataFrame,
    ports: DataFrame,
    group: str = "state_name",
    order: str = "count",
    n: int = 10,
    state: str | None = None,
) -> DataFrame:
    """``visits_by`` from totals of any days, which are added up by port first."""
    per_port = totals.groupBy("i94port").agg(*[F.sum(c).alias(c) for c in ("total", "measured", "visits")])
    return _ranked(per_port, ports, group, order, n, state)


def _ranked(
    per_port: DataFrame, ports: DataFrame, group: str, order: str, n: int, state: str | None
) -> DataFrame:
    places = ports if state is None else ports.filter(F.col("state") == state)
    places = places.select(F.col("code").alias("i94port"), group)
    mean = F.sum("total").cast("double") / F.nullif(F.sum("measured"), F.lit(0))
    ranked = (
        per_port.join(places, "i94port")
        .groupBy(group)
        .agg(F.round(mean, 2).alias("avg_temperature"), F.sum("visits").alias("count"))
    )
    return ranked.orderBy(F.desc(order), F.asc(group)).limit(n)


def visits_by(
    visits: DataFrame,
    ports: DataFrame,
    group: str = "state_name",
    order: str = "count",
    n: int = 10,
    state: str | None = None,
) -> DataFrame:
    """The top ``n`` states or cities by ``count`` of visits or by ``avg_temperature``.

    Visits are summed by port before the join, so the join and the second shuffle see one row
    per port and task however many visits a port has. Ties are ordered by name.
    """
    return _ranked(port_totals(visits), ports, group, order, n, state)
