"""Column builders; every one is a composition of built-in Spark functions."""

from landfall.functions.dates import (
    date_from_parts,
    outside_period,
    period_serials,
    sas_date,
    serial_in_period,
    stay_days,
)
from landfall.functions.numbers import number, whole
from landfall.functions.text import halves, replace_junk, strip

__all__ = [
    "date_from_parts", "halves", "number", "outside_period", "period_serials",
    "replace_junk", "sas_date", "serial_in_period", "stay_days", "strip", "whole",
]
