from pyspark.sql import Column, functions as F


def number(name: str) -> Column:
    """The column as a double, with NaN read as missing."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def whole(name: str) -> Column:
    """The column as an int, with NaN read as missing."""
    return number(name).cast("int")
