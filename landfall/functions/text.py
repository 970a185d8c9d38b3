import re

from pyspark.sql import Column, functions as F


# The characters that count as blanks.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Text without any kind of blank at its ends (``trim`` alone takes only spaces)."""
    return F.btrim(text, F.lit(BLANKS))


def literal(text: str) -> str:
    """A pattern that matches exactly this text."""
    return re.sub(r"([^\w\s])", r"\\\1", text)


def halves(text: Column, separator: str) -> tuple[Column, Column]:
    """The text before and after the first separator; the second is null without one."""
    parts = F.split(text, literal(separator), 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def replace_junk(text: Column, markers: list[str], name: str) -> Column:
    """Text with everything from the first marker to the line end replaced by a name."""
    plain_name = re.sub(r"([\\$])", r"\\\1", name)
    return F.regexp_replace(text, f"(?:{'|'.join(map(literal, markers))}).*", plain_name)
