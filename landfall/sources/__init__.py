"""Reading and writing; the only modules that touch files."""

from landfall.sources.files import exists
from landfall.sources.loads import Load, partitions_of, read_table, settle
from landfall.sources.readers import (
    read_arrivals,
    read_delimited,
    read_lines,
    read_temperatures,
)
from landfall.sources.shared import shared_folder
from landfall.sources.writers import write_by_date, write_table

__all__ = [
    "Load", "exists", "partitions_of", "read_arrivals", "read_delimited", "read_lines", "read_table",
    "read_temperatures", "settle", "shared_folder", "write_by_date", "write_table",
]
