"""Connected components over links, by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame, functions as F

from landfall.llm.tables import stored


def _stars(links: DataFrame) -> DataFrame:
    """Both directions of every link, and for each node the smallest of it and its neighbours."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a")


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; root is the smallest node reachable.

    Each round rewrites the links as stars around smaller nodes, large-star and then small-star,
    so long chains shrink in a logarithmic number of rounds. Rounds end when the set of links no
    longer changes, told by its size and an order-free hash. A node with very many links is a
    skewed join key, which adaptive execution splits; no list of neighbours is ever built.
    """
    links = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first())

    before = mark(links)
    while before[0]:
        large = _stars(links).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct(), name)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
        links = stored(small.filter("a <> b").distinct(), name)
        after = mark(links)
        if after == before:
            break
        before = after
    roots = links.groupBy("a").agg(F.min("b").alias("root"))
    tops = links.select("b").distinct().join(roots, F.col("b") == F.col("a"), "left_anti")
    return roots.select(F.col("a").alias("node"), "root").unionAll(tops.select(F.col("b").alias("node"), F.col("b").alias("root")))
