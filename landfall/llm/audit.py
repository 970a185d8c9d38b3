"""What each filter of a chain removes, in every order that the filters can have.

Each document fails or passes each filter by itself, whatever stands before, so a part's documents are
told by one count for each combination of failures: a contingency tensor with an axis a filter, index
0 for pass and 1 for failure (2x2x2x2x2 for five). Whatever a chain does is a contraction of that tensor: along the
axis of each filter it takes pass, fail or all. The tensors come from one pass over the documents and one
row for each combination and part is what the contractions see, however many documents there are.

Filters are conditions on a text; the last of the five, ``E``, asks whether an equal text stands under a smaller
``doc_id`` anywhere in the table (by SHA-256). Texts are neither shuffled nor joined for it: their digests
are, after rows of one digest, part and ``doc_id`` are counted, so a text that a third of the documents share is a row for each
part by the time it matters.

A null text is an empty one and fails A alone of A to D. A null ``part`` is the empty string. Rows of equal ``doc_id`` and text are each no copy of
the other; a null ``doc_id`` comes after all others. Labels are matched by ``doc_id``; of several for one the
greatest counts, and a null matches none. An empty table has no parts and gives no rows. Further columns are ignored.
"""

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from landfall.llm.tables import stored

COPY = "E"
ROW = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_filters(text: str = "text") -> dict[str, Column]:
    """The conditions that fail a text, by letter."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(text),
        "D": F.col(text).rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, cell, n, good, toxic``: documents, and those labelled good or toxic, of every combination of failures.

    Bit i of ``cell`` is set where the i-th filter in the order of letters fails.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    failed = list(text_filters().values())
    bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))
    own = own.select("doc_id", "part", bits.alias("cell"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("text"))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    own = own.join(known, "doc_id", "left")
    sums = [F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")]
    own = own.groupBy("text", "cell", "part", "doc_id").agg(*sums)
    # Of each text and part: its least doc_id with the counts there, and the counts of all.
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    least = F.min(F.struct(order.alias("place"), "n", "good", "toxic")).alias("least")
    groups = stored(own.groupBy("text", "cell", "part").agg(least, *[F.sum(c).alias(c) for c in ("n", "good", "toxic")]), "audit-texts")
    # Texts of one part stand for themselves; the others are told their least place of all.
    places = groups.groupBy("text").agg(F.min("least.place").alias("first"))
    groups = groups.join(places, "text")
    here = F.col("least.place") == F.col("first")
    first = [F.when(here, F.col(f"least.{c}")).otherwise(0).alias(c) for c in ("n", "good", "toxic")]
    rest = [(F.col(c) - F.when(here, F.col(f"least.{c}")).otherwise(0)).alias(c) for c in ("n", "good", "toxic")]
    cells = groups.select("part", F.explode(F.array(
        F.struct("cell", *first), F.struct((F.col("cell") + (1 << len(failed))).alias("cell"), *rest)
    )).alias("c")).select("part", "c.*")
    return cells.groupBy("part", "cell").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def _chosen(tensor: np.ndarray, takes: Sequence[np.ndarray]) -> int:
    """The tensor contracted with one selection along each axis."""
    axes = "abcdefghijklmnopqrstuvwxyz"[: tensor.ndim]
    return int(np.einsum(f"{axes},{','.join(axes)}->", tensor, *takes))


PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])


def contract(n: np.ndarray, good: np.ndarray, toxic: np.ndarray, letters: str) -> Iterator[tuple]:
    """``filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` of all orders of the filters."""

    def takes(passed: Sequence[int], failed: int | None = None, others: np.ndarray = ALL) -> list[np.ndarray]:
        return [FAIL if i == failed else PASS if i in passed else others for i in range(len(letters))]

    rows, shapley = [], [0] * len(letters)
    unique = [_chosen(n, takes((), i, PASS)) for i in range(len(letters))]
    fails = [_chosen(n, takes((), i)) for i in range(len(letters))]
    for order in permutations(range(len(letters))):
        for step, i in enumerate(order):
            before = order[:step]
            gone = takes(before, i)
            removed = _chosen(n, gone)
            shapley[i] += removed
            kept = _chosen(n, takes(order[: step + 1]))
            rows.append((order, step, i, kept, removed, fails[i] - removed, unique[i], _chosen(good, gone), _chosen(toxic, gone)))
    for order, step, i, *counts in rows:
        yield ("".join(letters[j] for j in order), step + 1, *counts, shapley[i])


def _contracts(letters: str):
    names = [c.split()[0] for c in ROW.split(", ")]
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    kinds = [types[c.split()[1]] for c in ROW.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tensors = {c: np.zeros((2,) * len(letters), np.int64) for c in ("n", "good", "toxic")}
                for cell in row["cells"]:
                    at = tuple(cell["cell"] >> i & 1 for i in range(len(letters)))
                    for c, tensor in tensors.items():
                        tensor[at] += cell[c]
                found = [(row["part"], *x) for x in contract(tensors["n"], tensors["good"], tensors["toxic"], letters)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

    return run


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row a part, order of the filters and step, with the counts that ``contract`` names."""
    letters = "".join(text_filters()) + COPY
    # 32 cells a part at most.
    parts = failures(docs, labels, part).groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("cells"))
    return parts.mapInArrow(_contracts(letters), ROW)
