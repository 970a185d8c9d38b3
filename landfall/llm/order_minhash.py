"""Fingerprints that feel the order of a text: Order MinHash.

After Marcais et al. 2019: occurrence-numbered k-mers of words are hashed, the least ones are selected,
put back into the order that they have in the text, and hashed together. Two texts agree in such a
value if they have the same least k-mers in the same order, so the share of values that agree follows
their edit distance, where a bag of k-mers would not see an exchange of halves.

One hash does for all values: its top bits deal k-mers to ``2 ** BINS_LOG`` bins, and each bin
selects its ``TUPLE`` (two) least. A bin's value is 16 bits. A bin without k-mers has none. The
likeness of two fingerprints is the share of bins, of those that either has, where they agree.

Everything is a SQL expression over a text's words; a row needs memory in proportion to its own text
alone. A text of fewer than ``KMER`` words is one k-mer. Null texts are empty, and the empty
text has a fingerprint as any other.
"""

from pyspark.sql import DataFrame, Window, functions as F

from landfall.llm.tables import partitions, texts

KMER = 3
BINS_LOG = 6

_SHIFT = 64 - BINS_LOG


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint of a column of text: an array of ints, bin and value in each."""
    kept = rows.columns
    step = rows.withColumn("_w", F.expr(f"transform(split({text}, '\\\\s+'), w -> xxhash64(w))"))
    hashed = ", ".join(f"get(_w, i + {j})" for j in range(KMER))
    step = step.withColumn(
        "_k",
        F.expr(
            f"if(size(_w) >= {KMER}, transform(sequence(0, size(_w) - {KMER}), i -> xxhash64({hashed})), array(xxhash64(_w)))"
        ),
    )
    # Bits that a place in the text needs; k-mers and places are packed into one number to be sorted.
    step = step.withColumn("_p", F.expr("length(bin(size(_k)))")).withColumn("_low", F.expr("shiftleft(1L, _p) - 1"))
    step = step.withColumn("_a", F.expr("sort_array(transform(_k, (h, i) -> shiftleft(h, _p) | bigint(i)))"))
    step = step.withColumn(
        "_s",
        F.expr(
            "filter(sequence(0, size(_a) - 1), i -> i = 0 or"
            " shiftrightunsigned(get(_a, i), _p) <> shiftrightunsigned(get(_a, i - 1), _p))"
        ),
    )
    # Equal k-mers lie in a row by place: the number of an occurrence is its distance from the first.
    number = "(xxhash64(get(_k, int(get(_a, i) & _low)), i - s) & ~_low) | (get(_a, i) & _low)"
    step = step.withColumn(
        "_o",
        F.expr(
            "sort_array(if(size(_s) = size(_a),"
            f" transform(_a, (x, i) -> {number.replace('i - s', '0')}),"
            f" flatten(transform(_s, (s, r) -> transform(sequence(s, coalesce(get(_s, r + 1), size(_a)) - 1), i -> {number})))))"
        ),
    )
    step = step.withColumn(
        "_b",
        F.expr(
            "filter(sequence(0, size(_o) - 1), i -> i = 0 or"
            f" shiftrightunsigned(get(_o, i), {_SHIFT}) <> shiftrightunsigned(get(_o, i - 1), {_SHIFT}))"
        ),
    )
    one, two = "int(get(_o, i) & _low)", "int(get(_o, i + 1) & _low)"
    value = (
        f"if(shiftrightunsigned(get(_o, i + 1), {_SHIFT}) = shiftrightunsigned(get(_o, i), {_SHIFT}),"
        f" xxhash64(get(_k, least({one}, {two})), get(_k, greatest({one}, {two}))), xxhash64(get(_k, {one})))"
    )
    step = step.withColumn(
        name,
        F.expr(f"transform(_b, i -> int(shiftrightunsigned(get(_o, i), {_SHIFT})) * 65536 + int({value} & 65535))"),
    )
    return step.select(*kept, name)


def as_text(fingerprint: str):
    """A fingerprint as a string: six hexadecimal digits for each bin that has a value."""
    return F.expr(f"array_join(transform({fingerprint}, v -> lpad(lower(hex(v)), 6, '0')), '')")


def likeness(a: str, b: str):
    """The share of bins, of those that either fingerprint has, with the same value."""
    bins = f"size(array_union(transform({a}, v -> v div 65536), transform({b}, v -> v div 65536)))"
    return F.expr(f"size(array_intersect({a}, {b})) / {bins}")


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """``docs`` with ``next_text`` and ``next_print``: those of the next row by descending ``doc_id``, round the end.

    Documents are cut into ranges of ids at quantiles; each range is ordered by itself, and the first
    row of the range below is put beside it. The driver sees one number or two for each of ``buckets``
    ranges. Rows of one id are in the order of their texts; null ids come last.
    """
    cuts = docs.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0] if buckets > 1 else []
    cuts = sorted(set(cuts or []))
    bucket = F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("doc_id"))), F.lit(0)) if cuts else F.lit(0)
    ids = docs.select("doc_id", bucket.alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()  # one for each bucket
    tops = sorted((r.bucket, r.top) for r in ids)
    above = {tops[i][1]: tops[(i + 1) % len(tops)][0] for i in range(len(tops))}
    rows = docs.withColumn("bucket", bucket).withColumn("guest", F.lit(False))
    for_null = above.pop(None, None)
    if above:
        pairs = F.create_map(*[F.lit(x) for pair in above.items() for x in pair])
        guests = docs.filter(F.col("doc_id").isin(list(above))).withColumn("bucket", pairs[F.col("doc_id")]).withColumn("guest", F.lit(True))
        rows = rows.unionAll(guests)
    if for_null is not None:
        rows = rows.unionAll(docs.filter("doc_id is null").withColumn("bucket", F.lit(for_null)).withColumn("guest", F.lit(True)))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_print", F.lead("print").over(order))
    return rows.filter("not guest").drop("bucket", "guest")


def order_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_text, print, edited_print, next_print`` of every row.

    The edited text has its last half replaced by the beginning of the next document's.
    """
    own = with_fingerprint(texts(docs), "text", "print")
    both = with_next(own, 4 * partitions(docs.sparkSession))
    half = "int(length(text) div 2)"
    edited = F.expr(f"concat(substring(text, 1, length(text) - {half}), substring(next_text, 1, {half}))")
    both = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited_text"), "print", "next_print")
    return with_fingerprint(both, "edited_text", "edited_print")
