"""SimHash near-duplicates, searched by the generalised pigeonhole principle.

Fingerprints within ``radius`` bits are linked; a document's class is its component of links.

The 64 bits are cut into groups of correlated bits. A pair within the radius must, in at least one
group i, differ in at most t_i bits, as long as the thresholds sum to ``radius - groups + 1``
(a threshold of -1 leaves its group out). Correlated bits in one group make that group worse at
telling fingerprints apart, and the others better, so unequal thresholds pay. How many groups,
and which thresholds, is chosen by dynamic programming on estimated numbers of probes and
candidates; the choice changes the cost and never the result.

Fingerprints that share a probe key form a bucket. Pairs of small buckets are compared. A bucket
of more than ``hot`` fingerprints is linked without comparing pairs: every fingerprint in it puts
down itself and its neighbours at one bit; any two at most 2 bits apart share such a point,
and any two that share one are at most 2 bits apart, so a star around the least of each
point has exactly the links' components. Equal texts are one fingerprint from the start.

A null text counts as empty; empty texts have fingerprint 0 and are linked like any other. Rows of
a null ``doc_id`` are kept, in a class with their twins. Further columns are ignored.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from landfall.llm.components import components
from landfall.llm.tables import stored, texts

RADIUS = 2
SHINGLE = 3
HOT = 64

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8) * 256).astype(np.uint16)


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles, repeats included."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    whole = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(whole, 42)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = [0, *(ends[: len(parts) - words]).tolist()]
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(starts)
    for at in range(0, total, 65536):
        some = zip(starts[at : at + 65536], stops[at : at + 65536])
        hashes = np.fromiter((digest(whole[i:j], 42) for i, j in some), np.uint64)
        lanes = hashes.view(np.uint8).reshape(-1, 8) + _LANES
        counts += (np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(t) for t in batch.column("text").to_pylist()), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)``, fp the fingerprint as a signed long."""
    return texts(docs).mapInArrow(_fingerprints, "doc_id long, fp long")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each two bits are set together: 64 rows of a partition, however large."""
    both = np.zeros((64, 64))
    for batch in batches:
        fps = batch.column("fp").to_numpy().view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(fps, axis=1, bitorder="little").astype(np.float32)
        both += bits.T @ bits
    i, j = np.divmod(np.arange(4096), 64)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(both.ravel().astype(np.int64))], ["i", "j", "n"])


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, share of each bit, and the correlation of each two bits."""
    counts = fps.select("fp").mapInArrow(_together, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both = np.zeros((64, 64))
    for i, j, n in counts.collect():  # 4096 rows
        both[i, j] = n
    total = fps.count()
    share = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.clip(share * (1 - share), 1e-9, None))
    return total, share, (both / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)


def bit_groups(correlation: np.ndarray, groups: int) -> list[list[int]]:
    """Bits cut into groups of nearly equal size, each grown by the bit most correlated with it."""
    left, cut = set(range(64)), []
    for g in range(groups):
        width = 64 // groups + (g < 64 % groups)
        strength = np.abs(correlation)
        first = max(left, key=lambda b: (strength[b, sorted(left)].sum(), -b))
        group = [first]
        left.remove(first)
        while len(group) < width:
            best = max(left, key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        cut.append(sorted(group))
    return cut


def thresholds(costs: list[dict[int, float]], total: int) -> tuple[float, tuple[int, ...]]:
    """The cheapest thresholds, one for each group and ``total`` in sum, by dynamic programming."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for cost in costs:
        step: dict[int, tuple[float, tuple[int, ...]]] = {}
        for so_far, (paid, chosen) in best.items():
            for t, c in cost.items():
                found = (paid + c, (*chosen, t))
                if found < step.get(so_far + t, (np.inf, ())):
                    step[so_far + t] = found
        best = step
    return best[total]


def _mask(bits: list[int]) -> int:
    return int(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0])


def _flips(bits: list[int]) -> list[int]:
    return [0, *(_mask([b]) for b in bits)]


def plan(fps: DataFrame, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """The groups of bits to probe, each with its threshold.

    Candidates at threshold 0 are counted over all fingerprints: the pairs that agree in the
    group. For a threshold above, that count is scaled by the odds of each bit to differ.
    A fingerprint puts down one key for threshold 0. For 1 or 2 it puts down its neighbours at one
    bit as well: two keys at most 2 bits apart share one of these.
    """
    total, share, correlation = bit_statistics(fps)
    cuts = {m: bit_groups(correlation, m) for m in range(1, radius + 2)}
    keys = F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(g).alias("g"), F.col("fp").bitwiseAND(F.lit(_mask(bits))).alias("key"))
        for m, cut in cuts.items()
        if m > 1
        for g, bits in enumerate(cut)
    ])
    agree = fps.select(F.explode(keys).alias("k")).groupBy("k.m", "k.g", "k.key").agg(F.count("*").alias("n"))
    agree = agree.groupBy("m", "g").agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("pairs"))
    pairs = {(m, g): float(n) for m, g, n in agree.collect()}  # five rows
    differ = 2 * share * (1 - share)
    odds = np.clip(differ, 1e-9, None) / np.clip(1 - differ, 1e-9, None)
    choices = []
    for m, cut in cuts.items():
        costs = []
        for g, bits in enumerate(cut):
            near = pairs.get((m, g), 0.0) * (1 + odds[bits].sum())
            spread = total * (1.0 + len(bits))
            costs.append({-1: 0.0, 0: total + pairs.get((m, g), 0.0), **{t: spread + t * near for t in range(1, radius + 1)}})
        choices.append((*thresholds(costs, radius - m + 1), cut))
    _, chosen, cut = min(choices, key=lambda c: c[0])
    return [(bits, t) for bits, t in zip(cut, chosen) if t >= 0]


def _spread(fp: Column, flips: list[int]) -> Column:
    return F.explode(F.transform(F.array(*map(F.lit, flips)), lambda flip: fp.bitwiseXOR(flip)))


def links(fps: DataFrame, probes: list[tuple[list[int], int]], radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs within ``radius`` (1 or 2) bits."""
    parts = [
        fps.select("fp", F.lit(g).alias("g"), _spread(F.col("fp").bitwiseAND(F.lit(_mask(bits))), _flips(bits) if t else [0]).alias("key"))
        for g, (bits, t) in enumerate(probes)
    ]
    entries = parts[0]
    for part in parts[1:]:
        entries = entries.unionAll(part)
    sizes = entries.groupBy("g", "key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(entries.join(sizes, ["g", "key"]), "simhash-buckets")
    few = shared.filter(F.col("n") <= hot).select("g", "key", F.col("fp").alias("a"))
    pairs = few.join(few.withColumnRenamed("a", "b"), ["g", "key"])
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = pairs.filter((F.col("a") > F.col("b")) & near).select("a", "b").distinct()
    many = shared.filter(F.col("n") > hot).select("fp").distinct()
    if radius == 1:
        # The exact neighbour instead of a common point, which would allow 2 bits.
        ends = many.select("fp", _spread(F.col("fp"), _flips(list(range(64)))[1:]).alias("b"))
        star = ends.join(many.withColumnRenamed("fp", "b"), "b").select(F.col("fp").alias("a"), "b")
    else:
        points = many.select("fp", _spread(F.col("fp"), _flips(list(range(64)))).alias("point"))
        least = points.groupBy("point").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
        star = points.join(least.select("point", "b"), "point").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return pairs.unionAll(star)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``."""
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    own = stored(fingerprints(docs), "simhash")
    distinct = stored(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    found = components(links(distinct.select("fp"), plan(distinct, radius), radius, hot), "simhash-links")
    roots = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = roots.join(least, "root").select("fp", "component_id")
    return own.join(classes, "fp").select("doc_id", "fp", "component_id")
