"""Which keys a month holds, in little room: a bitmap over hashes of its keys, with their range.

A summary is a table of ``month, cells, bucket, bits, low, high``: key hashes fall into ``cells`` cells (a power of
two, about sixteen to a key), and a row has those of one bucket of 32,768 cells. Summaries merge: of one month by
the union of their bits, and cells fold in two by the union of buckets. Months whose ranges meet
are compared bucket by bucket, and a key is a suspect in another month only where both have its cell: of the keys
that a month does not hold about one in sixteen. Only suspects are looked for in the months themselves.
"""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BUCKET = 32_768
CELLS_A_KEY = 16


def cells_for(keys: int) -> int:
    """The power of two of cells for so many keys."""
    return max(BUCKET, 1 << max(keys * CELLS_A_KEY - 1, 0).bit_length())


def _cell(key: str, cells: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(cells)) + 1


def summarise_keys(rows: DataFrame, key: str, cells: int, month: str = "month") -> DataFrame:
    """The summary of the keys of each month; null keys are left out. Bits are gathered within tasks first."""
    found = rows.filter(F.col(key).isNotNull()).withColumn("__cell", _cell(key, cells))
    bucket = F.bitmap_bucket_number("__cell")
    return found.groupBy(F.col(month).alias("month"), bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__cell")).alias("bits"), F.min(key).alias("low"), F.max(key).alias("high")
    ).select("month", F.lit(cells).cast("long").alias("cells"), "bucket", "bits", "low", "high")


def folded(summary: DataFrame, cells: int) -> DataFrame:
    """The summary with no more than ``cells`` cells."""
    fewer = F.least(F.col("cells"), F.lit(cells).cast("long"))
    bucket = F.pmod(F.col("bucket") - 1, fewer / BUCKET).cast("long") + 1
    return summary.groupBy("month", fewer.alias("cells"), bucket.alias("bucket")).agg(
        F.bitmap_or_agg("bits").alias("bits"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def merged(*summaries: DataFrame) -> DataFrame:
    """One summary of what several have of the same months, with the fewest cells that any of them has of a month."""
    rows = reduce(DataFrame.unionByName, summaries)
    fewest = rows.groupBy("month").agg(F.min("cells").alias("fewest"))
    rows = rows.join(fewest, "month")
    bucket = F.pmod(F.col("bucket") - 1, F.col("fewest") / BUCKET).cast("long") + 1
    return rows.groupBy("month", F.col("fewest").alias("cells"), bucket.alias("bucket")).agg(
        F.bitmap_or_agg("bits").alias("bits"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def met_cells(new: DataFrame, old: DataFrame, own: int, sizes: Iterable[int]) -> DataFrame:
    """``month, cells, bucket, bits``: the cells of ``old`` months that ``new`` keys have too, where there are any.

    ``new`` is the summary of one set of keys with ``own`` cells, ``sizes`` are the numbers of cells that old months have. Months beside its
    range are passed over, and both sides are folded to the fewer cells of the two.
    """
    span = new.agg(F.min("low").alias("from"), F.max("high").alias("to"))
    months = old.groupBy("month").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    near = (F.col("low") <= span.select("to").scalar()) & (F.col("high") >= span.select("from").scalar())
    old = old.join(months.filter(near).select("month"), "month", "left_semi")
    found = []
    for size in sorted(set(sizes)):
        cells = min(size, own)
        theirs = folded(old.filter(F.col("cells") == size), cells).select("month", "bucket", "bits")
        ours = folded(new, cells).select("bucket", F.col("bits").alias("ours"))
        ours = theirs.join(ours, "bucket").select("month", "bucket", F.col("ours").alias("bits"))
        both = theirs.unionAll(ours).groupBy("month", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("sides"))
        both = both.filter((F.col("sides") == 2) & (F.bitmap_count("bits") > 0))
        found.append(both.select("month", F.lit(cells).cast("long").alias("cells"), "bucket", "bits"))
    return reduce(DataFrame.unionAll, found)


def suspects(rows: DataFrame, key: str, met: DataFrame, cells: Iterable[int]) -> DataFrame:
    """``month`` and ``key`` of the rows whose cell a month has, ``cells`` being those that ``met`` has."""
    found = []
    for size in cells:
        named = rows.select(F.col(key).alias("__key"), _cell(key, size).alias("__cell")).withColumn("bucket", F.bitmap_bucket_number("__cell"))
        own = named.join(met.filter(F.col("cells") == size), "bucket")
        at = F.bitmap_bit_position("__cell")
        byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        found.append(own.filter(F.bit_get(byte, F.pmod(at, F.lit(8)).cast("int")) == 1).select("month", F.col("__key").alias(key)))
    return reduce(DataFrame.unionAll, found)
