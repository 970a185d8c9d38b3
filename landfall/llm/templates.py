"""Lines of recurring templates, by a tree of fixed depth.

As in log parsing by a fixed-depth tree (Drain, He et al. 2017), words with figures are variable
fields from the start, and a line goes down the tree by its number of words and then by its first
``LEADING`` words. In the leaf that it comes to, a word stays where at least ``least`` documents
agree on it and is a variable field elsewhere; what results is the line's template. If
enough of its words stay (``share``) and ``least`` documents have lines of this template, it
recurs, and its lines are dropped from all documents but the first (of least ``doc_id``).

The tree is a key, and its leaves are groups of rows, so nothing depends on the order of
lines. A leaf's distinct lines are counted first, and everything after is weighed by these
counts: a line that a third of all documents have is one row.

Lines are compared after blanks are made one and trimmed, and are given back as they were. Blank ones are left
alone. Lines of fewer than ``WORDS`` words have no variable fields: all of such a line must recur.
A line of ``long`` words or more is dropped from its second document on, even if only two have it (None: no such rule). Documents that agree are counted by line: one with two
lines of a leaf counts for each. A null text is an empty one. Rows of one ``doc_id`` are one
document as to counts, and each has its own lines; a null ``doc_id`` is a document that is never the first.
Further columns pass through, whatever their names.
"""

from pyspark.sql import DataFrame, functions as F

from landfall.llm.tables import fresh, stored

# Words from which a line may have variable fields.
WORDS = 5
LEADING = 3
LEAST = 3
SHARE = 0.8
# Words from which a line in two documents is a repeat.
LONG = 20
FIELD = "<*>"
# Distinct lines of shared leaves are broadcast, to fetch their words, up to so many.
BROADCAST_ROWS = 500_000


def _even(raw):
    """A line with single blanks and none at its ends."""
    odd = raw.contains("  ")
    for blank in "\t\r\f\x0b":
        odd = odd | raw.contains(blank)
    return F.trim(F.when(odd, F.regexp_replace(raw, r"[ \t\r\f\x0B]+", " ")).otherwise(raw))


def _words(even):
    return F.length(even) - F.length(F.replace(even, F.lit(" "), F.lit(""))) + 1


def _masked(even):
    """Words with figures are variable fields, but for short lines."""
    return F.when(even.rlike("[0-9]") & (_words(even) >= WORDS), F.regexp_replace(even, r"[^ 0-9]*[0-9][^ ]*", FIELD)).otherwise(even)


def lines(docs: DataFrame, leading: int = LEADING) -> DataFrame:
    """``doc_id, row, at, n, leaf, line``: every line that is not blank, its place in the tree and its hash."""
    every = docs.select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    every = every.select("doc_id", "row", "at", _even(F.col("raw")).alias("even"))
    every = every.filter(F.col("even") != "").withColumn("n", _words(F.col("even")))
    every = every.select("doc_id", "row", "at", "n", _masked(F.col("even")).alias("masked"))
    leaf = F.xxhash64("n", F.substring_index("masked", " ", leading))
    return every.select("doc_id", "row", "at", "n", leaf.alias("leaf"), F.xxhash64("masked").alias("line"))


def recurring(
    docs: DataFrame, every: DataFrame, least: int = LEAST, share: float = SHARE, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``leaf, line, template, documents, first``: the distinct lines of templates that recur; ``every`` has the lines of ``docs``."""
    # Distinct lines with their documents, in leaves that enough documents share.
    counts = every.groupBy("leaf", "line", "doc_id").agg(F.min(F.struct("row", "at")).alias("place")).groupBy("leaf", "line")
    counts = counts.agg(F.count("*").alias("documents"), F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "place")).alias("one"))
    counts = stored(counts, "lines")
    leaves = counts.groupBy("leaf").agg(F.sum("documents").alias("d")).filter(F.col("d") >= least).select("leaf")
    counts = stored(counts.join(leaves, "leaf"), "shared-lines")
    # The words of each, from one place where it stands; those of one document are fetched together.
    wanted = counts.groupBy(F.col("one.doc_id").alias("of"), F.col("one.place.row").alias("row"))
    wanted = wanted.agg(F.collect_list(F.struct("leaf", "line", "documents", "first", F.col("one.place.at").alias("at"))).alias("wanted"))
    wanted = F.broadcast(wanted) if counts.count() <= broadcast_rows else wanted
    found = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("row")))
    found = found.select(F.split("text", "\n").alias("raw"), F.explode("wanted").alias("w")).select("w.*", F.expr("get(raw, w.at)").alias("raw"))
    found = found.withColumn("masked", _masked(_even(F.col("raw"))))
    spelled = stored(found.groupBy("leaf", "line", "documents", "first").agg(F.min("masked").alias("masked")), "spelled-lines")
    placed = spelled.select("leaf", "line", "documents", F.posexplode(F.split("masked", " ")).alias("at", "word"))
    agreed = placed.groupBy("leaf", "at", "word").agg(F.sum("documents").alias("d")).filter(F.col("d") >= least).select("leaf", "at", "word", F.lit(1).alias("stays"))
    placed = placed.join(agreed, ["leaf", "at", "word"], "left")
    parts = F.sort_array(F.collect_list(F.struct("at", F.when(F.col("stays") == 1, F.col("word")).otherwise(FIELD).alias("word"))))  # of one line
    shaped = placed.groupBy("leaf", "line").agg(F.array_join(F.transform(parts, lambda p: p["word"]), " ").alias("template"), F.avg(F.coalesce("stays", F.lit(0))).alias("stay"))
    shaped = shaped.filter(F.col("stay") >= share).join(spelled.select("leaf", "line", "documents", "first"), ["leaf", "line"])
    shaped = stored(shaped, "shaped-lines")
    found = shaped.groupBy("leaf", "template").agg(F.sum("documents").alias("documents"), F.min("first").alias("first"))
    found = found.filter(F.col("documents") >= least)
    return shaped.select("leaf", "line", "template").join(found, ["leaf", "template"]).select("leaf", "line", "template", "documents", "first")


def drop_recurring_lines(
    docs: DataFrame, least: int = LEAST, share: float = SHARE, leading: int = LEADING,
    broadcast_rows: int = BROADCAST_ROWS, long: int | None = LONG,
) -> DataFrame:
    """All columns of ``docs``, with ``text`` less the lines of recurring templates, and ``n_lines, n_dropped``."""
    own = docs.select("doc_id", "text")
    every = stored(lines(own, leading), "placed-lines")
    found = stored(recurring(own, every, least, share, broadcast_rows).select("leaf", "line", "first"), "recurring-lines")
    if long is not None:
        twice = every.filter(F.col("n") >= long).groupBy("leaf", "line", "doc_id").agg(F.lit(1).alias("one"))
        twice = twice.groupBy("leaf", "line").agg(F.count("*").alias("documents"), F.min("doc_id").alias("first"))
        found = found.unionAll(stored(twice.filter("documents > 1").select("leaf", "line", "first"), "long-lines"))
    dropped = every.join(found, ["leaf", "line"]).filter(F.coalesce(F.col("doc_id") != F.col("first"), F.lit(True)))
    dropped = dropped.groupBy("doc_id", "row").agg(F.collect_set("at").alias("places"))  # of one document
    of, row, places = fresh(docs, "of", "row", "places")
    dropped = dropped.select(F.col("doc_id").alias(of), F.col("row").alias(row), F.col("places").alias(places))
    same = F.col("doc_id").eqNullSafe(F.col(of)) & (F.xxhash64("text") == F.col(row))
    raw = F.split(F.coalesce("text", F.lit("")), "\n")
    left = F.array_join(F.filter(raw, lambda x, i: ~F.array_contains(places, i)), "\n")
    return docs.join(dropped, same, "left").select(
        *[c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")],
        F.when(F.col(places).isNull(), F.coalesce("text", F.lit(""))).otherwise(left).alias("text"),
        F.size(raw).alias("n_lines"),
        F.when(F.col(places).isNull(), 0).otherwise(F.size(places)).alias("n_dropped"),
    )
