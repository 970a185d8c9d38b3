from datetime import date

from pyspark.sql import Column, functions as F

from landfall.fixed import SERIAL_EPOCH
from landfall.functions.numbers import number


def sas_date(serial: str) -> Column:
    """Days since 1960-01-01 as a date. Fractions floor; 0, null and NaN give null."""
    days = number(serial)
    epoch = F.lit(SERIAL_EPOCH).cast("date")
    return F.when(days != 0, F.date_add(epoch, F.floor(days).cast("int")))


def stay_days(arrival: str, departure: str) -> Column:
    """Whole days between two serials, truncated toward zero; null if either is missing."""
    return (number(departure) - number(arrival)).cast("int")


def date_from_parts(year: str, month: str, day: str, lenient: bool = False) -> Column:
    """A date from its parts. An impossible date raises, or gives null if lenient."""
    if lenient:
        return F.try_to_date(F.concat_ws("-", year, month, day), "y-M-d")
    return F.make_date(year, month, day)


def outside_period(column: str, year: int, month: int) -> Column:
    """True for a date in another month. Null for a null date, which needs its own test."""
    return (F.year(column) != year) | (F.month(column) != month)


def period_serials(year: int, month: int) -> tuple[float, float]:
    """The serial of a month's first day, and that of the day after its last."""
    epoch = date.fromisoformat(SERIAL_EPOCH)
    first = (date(year, month, 1) - epoch).days
    return float(first), float((date(year + month // 12, month % 12 + 1, 1) - epoch).days)


def serial_in_period(serial: str, year: int, month: int) -> Column:
    """True for a serial in the month. A plain range, so it prunes partitions and row groups."""
    first, after = period_serials(year, month)
    return (F.col(serial) >= first) & (F.col(serial) < after)
