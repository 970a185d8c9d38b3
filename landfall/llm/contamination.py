"""Benchmark items inside documents, by size-partitioned MinHash containment search.

An item is found in a document that has at least ``share`` (0.8) of the item's distinct shingles of five
words. Documents may be far longer than items, so it is containment that counts and not
resemblance. Items are partitioned by their number of shingles, in powers of two, and every item
keeps a bottom-k sketch whose k belongs to its partition: with at most u shingles there and
share s, any ``u - ceil(s * u) + 1`` of an item's shingles have one in every document that holds it.
So the sketch misses nothing, and of an item about a fifth of the shingles is searched for. Which fifth is
free: the sketch takes the shingles that the fewest documents have, and of these the least hashes, so a phrase that
items and documents have in common makes no candidates. All shingles of all documents are looked up once among
those of the items; what meets a sketch is a candidate, and its shingles themselves are then compared.

Words are what stands between blanks, in lower case. An item of fewer words than a shingle has one shingle, all
of it, and is looked up among the document's shingles of as many words. Null and empty texts have none, and are never found. Rows of one
``doc_id`` are one document, rows of one ``item_id`` one item (of rows with fewer words than a shingle too), a null id is an id.
Further columns are ignored. Repeats within a text count once.
"""

from pyspark.sql import DataFrame, functions as F

from landfall.llm.tables import stored

WORDS = 5
SHARE = 0.8
# Sketches, and shingles of items, up to so many rows are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def word_list(text: str = "text"):
    """The words of a text."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[ \t\n\r\f\x0B]+")
    return F.filter(words, lambda w: w != "")


def _sized(rows: DataFrame, key: str, size: int) -> DataFrame:
    """``key, w, k``: the words of items and the length of their shingles, fewer than ``size`` for a short one."""
    words = rows.select(key, word_list().alias("w")).filter(F.size("w") > 0)
    return words.withColumn("k", F.least(F.size("w"), F.lit(size)))


def lengths(items: DataFrame, size: int = WORDS) -> list[int]:
    """The lengths of shingles that items have, ``size`` and those of short items."""
    return sorted(r.k for r in _sized(items, "item_id", size).select("k").distinct().collect())


def _hashes(k: int):
    at = lambda i, j: F.get(F.col("w"), i + j)
    return F.transform(F.sequence(F.lit(0), F.size("w") - k), lambda i: F.xxhash64(*[at(i, j) for j in range(k)]))


def _texts(k: int):
    return F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.concat_ws(" ", F.slice("w", i, k)))


def _of_length(rows: DataFrame, key: str, sizes: list[int], shingles, hashed: bool, own: bool) -> DataFrame:
    """``key`` and every shingle of these lengths, repeats included; only of the row's ``own`` length for items."""
    name = "h" if hashed else "s"
    words = _sized(rows, key, max(sizes, default=WORDS))
    if hashed:
        words = words.withColumn("w", F.transform("w", lambda w: F.xxhash64(w)))
    of = [F.when((F.col("k") == k) if own else (F.size("w") >= k), shingles(k)).otherwise(F.array().cast(f"array<{'bigint' if hashed else 'string'}>")) for k in sizes]
    return words.select(key, F.explode(F.concat(*of)).alias(name)) if of else words.select(key, F.lit(0 if hashed else "").alias(name)).limit(0)


def sketches(hashes: DataFrame, met: DataFrame, share: float = SHARE) -> DataFrame:
    """``item_id, h``: for each item the shingles that fewest documents have, as many as its partition by size asks for.

    ``hashes`` has the items' shingles and ``met`` where documents have them: ``doc_id, h``, each once.
    """
    counts = met.groupBy("h").agg(F.count("*").alias("documents"))
    ranked = hashes.distinct().join(counts, "h", "left").select("item_id", F.struct(F.coalesce("documents", F.lit(0)).alias("n"), "h").alias("r"))
    ranked = ranked.groupBy("item_id").agg(F.sort_array(F.collect_list("r")).alias("rs"))  # of one item
    most = F.pow(F.lit(2.0), F.floor(F.log2(F.size("rs"))) + 1) - 1
    k = most - F.ceil(F.round(most * F.lit(share), 6)) + 1
    kept = ranked.select("item_id", F.explode(F.slice("rs", F.lit(1), F.least(k.cast("int"), F.size("rs")))).alias("r"))
    return kept.filter("r.n > 0").select("item_id", "r.h")


def _small(df: DataFrame, most: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def contained_items(
    docs: DataFrame, items: DataFrame, size: int = WORDS, share: float = SHARE, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_found, containment`` of every item in every document that holds it."""
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    sizes = lengths(items, size)
    hashes = stored(_of_length(items, "item_id", sizes, _hashes, True, True).distinct(), "item-hashes")
    named = _small(hashes.select("h").distinct(), broadcast_rows)
    met = _of_length(docs, "doc_id", sizes, _hashes, True, False).join(named, "h", "left_semi").distinct()
    met = stored(met, "met-shingles")
    found = _small(stored(sketches(hashes, met, share), "sketches"), broadcast_rows)
    candidates = stored(met.join(found, "h").select("doc_id", "item_id").distinct(), "candidates")
    shingles = stored(_of_length(items, "item_id", sizes, _texts, False, True).distinct(), "item-shingles")
    whole = shingles.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    suspects = _small(candidates.select("doc_id").distinct(), broadcast_rows).withColumnRenamed("doc_id", "suspect")
    own = docs.join(suspects, F.col("doc_id").eqNullSafe(F.col("suspect")), "left_semi")
    both = _of_length(own, "doc_id", sizes, _texts, False, False).distinct().join(_small(shingles, broadcast_rows), "s")
    named = candidates.select(F.col("doc_id").alias("d"), F.col("item_id").alias("i"))
    counts = both.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_found"))
    counts = counts.join(named, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("item_id").eqNullSafe(F.col("i")), "left_semi")
    whole = whole.withColumnRenamed("item_id", "i")
    counts = counts.join(whole, F.col("item_id").eqNullSafe(F.col("i")))
    enough = F.col("n_found") >= F.ceil(F.round(F.col("n_shingles") * F.lit(share), 6))
    return counts.filter(enough).select(
        "doc_id", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment")
    )
