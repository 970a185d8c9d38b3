"""Removal of bytes that lie in a repeated string of ``length`` bytes.

Suffixes are sorted bucket by bucket and ties are settled by precomputed ranks of a sample, as a
difference cover does it, but the sample is chosen by content rather than by position. A cover of
residues needs 12 of 133 suffixes for strings of 200 bytes; a sample that picks, for every window
of ``length`` bytes, the window's least hashed ``gram`` needs about 1 in 80, and equal windows pick
the same place wherever they stand. So

1. each document lists its samples with the span of windows that picked them. The bucket of a
   sample is the rank of its gram: buckets of one sample hold no repeat and end here;
2. inside a bucket the samples are ranked by the whole span of bytes that their windows cover. Spans
   met twice are repeated altogether;
3. ties of the gram that differ in the span, where a repeat begins or ends, are settled window
   by window: those samples, and one of each repeated span beside them, hand in the bytes of their
   span, and each window is ranked. Windows met twice are repeated.

Buckets of up to ``SAMPLES_TOGETHER`` samples, and in step 3 ``SPANS_TOGETHER`` spans, are sorted one after the
other, each as a whole, in some 20 MB. The samples of larger ones are counted by key instead, aggregated before they are shuffled and joined
back with joins that adaptive execution splits; so a bucket may hold a third of all samples.
Ranks are 64-bit hashes, and two of them must agree. Texts are processed in blocks of ``BLOCK`` bytes.

Null texts are empty. Rows of a null or repeated ``doc_id`` are documents of their own (rows equal in both
``doc_id`` and text repeat each other). Texts shorter than ``length`` stay as they are. Further
columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from landfall.llm.tables import stored, texts

LENGTH = 200
GRAM = 64
# Samples, and distinct spans of bytes, of a bucket that one task sorts: some 20 MB, and 3 MB with 20 MB of ranks.
SAMPLES_TOGETHER, SPANS_TOGETHER = 500_000, 10_000
BLOCK = 1 << 22

_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Sampler:
    """Samples of texts; holds the powers that rolling hashes need."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram = length, gram
        self.up = self.down = np.zeros(0, np.uint64)

    def _grams(self, data: np.ndarray) -> np.ndarray:
        """A hash of each ``gram`` bytes."""
        n = len(data)
        if len(self.up) <= n:
            self.up = _powers(_BASE, 2 * n + 1)
            self.down = _powers(pow(_BASE, -1, 1 << 64), 2 * n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        h = (sums[self.gram :] - sums[: -self.gram]) * self.down[: n - self.gram + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h

    def spans(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(gram hash, first window, last window)`` of every sample of at most a block."""
        windows = len(data) - self.length + 1
        width = self.length - self.gram + 1
        h = self._grams(data)
        # The least of each ``width`` hashes, and of equal ones the leftmost: its place is in the low bits.
        low = np.uint64((1 << 23) - 1)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        done = 1
        while done < width:
            step = min(done, width - done)
            least = np.minimum(least[: len(least) - step], least[step:])
            done += step
        at = (least[:windows] & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:] - 1, windows - 1]
        return h[at[first]], first, last


def _samples(length: int, gram: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, digest = Sampler(length, gram), xxhash.xxh3_64_intdigest
        for batch in batches:
            bucket, span, keys, lows, highs = [], [], [], [], []
            for key, text in zip(batch.column("dk").to_pylist(), batch.column("text").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                for at in range(0, max(len(raw) - length + 1, 0), BLOCK):
                    data = raw[at : at + BLOCK + length - 1]
                    grams, first, last = sampler.spans(np.frombuffer(data, np.uint8))
                    bucket.append(grams)
                    span += [digest(data[i : j + length]) for i, j in zip(first.tolist(), last.tolist())]
                    keys.append(np.full(len(grams), key))
                    lows.append(first + at)
                    highs.append(last + at)
            if bucket:
                columns = [
                    np.concatenate(bucket).view(np.int64), np.array(span, np.uint64).view(np.int64), np.concatenate(keys),
                    np.concatenate(lows), (np.concatenate(highs) - np.concatenate(lows)).astype(np.int32),
                ]
                whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "span", "dk", "low", "more"])
                for at in range(0, len(whole), 50_000):
                    yield whole.slice(at, 50_000)

    return run


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        zipped = [pack(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("dk"), pa.array(zipped, pa.binary())], ["doc_id", "dk", "zipped"])


def _by_bucket(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Rows that lie sorted by bucket, in tables of whole buckets and about ``least`` rows."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= least:
            together = pa.Table.from_batches(held)
            buckets = together["bucket"].to_numpy()
            cut = int(np.searchsorted(buckets, buckets[-1], "left"))
            if cut:
                yield together.slice(0, cut)
                held, rows = together.slice(cut).to_batches(), len(together) - cut
    if rows:
        yield pa.Table.from_batches(held)


def _met(buckets: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by bucket and rank, and where in it a (bucket, rank) begins."""
    order = np.lexsort((ranks, buckets))
    b, r = buckets[order], ranks[order]
    return order, np.r_[True, (b[1:] != b[:-1]) | (r[1:] != r[:-1])]


def _sorted_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Steps 2: spans met twice, and those to be asked for their windows."""
    for rows in _by_bucket(batches, 20_000):
        buckets, spans = rows["bucket"].to_numpy(), rows["span"].to_numpy()
        order, begins = _met(buckets, spans)
        group = np.cumsum(begins) - 1
        repeated = np.bincount(group)[group] > 1
        first_of_bucket = np.r_[True, np.diff(buckets[order]) != 0]
        bucket = np.cumsum(first_of_bucket) - 1
        spans_of = np.bincount(bucket, weights=begins).astype(np.int64)[bucket]
        for which, ask in ((repeated, False), ((spans_of > 1) & begins, True)):
            some = rows.take(pa.array(order[which])).select(["bucket", "dk", "low", "more"])
            some = some.append_column("n", pa.array(spans_of[which])).append_column("ask", pa.array(np.full(which.sum(), ask)))
            yield from some.combine_chunks().to_batches()


def _bytes_of_spans(length: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for key, zipped, asked in zip(*(batch.column(c).to_pylist() for c in ("dk", "zipped", "asked"))):
                raw = unpack(zipped)
                for at in range(0, len(asked), 5000):
                    some = asked[at : at + 5000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([a["bucket"] for a in some]), pa.array([a["n"] for a in some], pa.int64()), pa.array([key] * len(some)),
                            pa.array([a["low"] for a in some]),
                            pa.array([raw[a["low"] : a["low"] + a["more"] + length] for a in some], pa.binary()),
                        ],
                        ["bucket", "n", "dk", "low", "bytes"],
                    )

    return run


def _ranked(rows: pa.Table, length: int) -> tuple[np.ndarray, ...]:
    """Bucket, rank, document and place of every window of the spans."""
    digest = xxhash.xxh3_64_intdigest
    spans = rows["bytes"].to_pylist()
    counts = np.array([len(b) - length + 1 for b in spans])
    ranks = np.fromiter((digest(b[i : i + length]) for b in spans for i in range(len(b) - length + 1)), np.uint64, int(counts.sum()))
    within = np.arange(len(ranks)) - np.repeat(np.cumsum(counts) - counts, counts)
    return (
        np.repeat(rows["bucket"].to_numpy(), counts), ranks.view(np.int64), np.repeat(rows["dk"].to_numpy(), counts),
        np.repeat(rows["low"].to_numpy(), counts) + within,
    )


def _sorted_windows(length: int) -> callable:
    """Step 3 for buckets sorted as a whole: runs of windows met twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches, 2_000):
            buckets, ranks, keys, lows = _ranked(rows, length)
            order, begins = _met(buckets, ranks)
            group = np.cumsum(begins) - 1
            met = np.zeros(len(order), bool)
            met[order] = np.bincount(group)[group] > 1
            at = np.flatnonzero(met)
            if len(at):
                starts = np.r_[True, (np.diff(at) != 1) | (np.diff(lows[at]) != 1) | (np.diff(keys[at]) != 0)]
                first = at[starts]
                last = at[np.r_[np.flatnonzero(starts)[1:] - 1, len(at) - 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[first]), pa.array(lows[first]), pa.array((last - first).astype(np.int32))], ["dk", "low", "more"]
                )

    return run


def _windows(length: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for at in range(0, len(rows), 500):
                columns = _ranked(rows.slice(at, 500), length)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "window", "dk", "low"])

    return run


def _kept(length: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            ids, sizes, removed, spans, kept = [], [], [], [], []
            for doc, zipped, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "zipped", "found"))):
                raw, runs = unpack(zipped), []
                for low, more in sorted((f["low"], f["more"]) for f in found or ()):
                    if runs and low <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], low + more + length)
                    else:
                        runs.append([low, low + more + length])
                edges = [0, *(e for run in runs for e in run), len(raw)]
                ids.append(doc)
                sizes.append(len(raw))
                removed.append(sum(j - i for i, j in runs))
                spans.append([{"start": i, "stop": j} for i, j in runs])
                kept.append(b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, samples_together: int = SAMPLES_TOGETHER, spans_together: int = SPANS_TOGETHER
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` of every row: what is removed, and what is left of its UTF-8 bytes."""
    if not 0 < gram <= length:
        raise ValueError("gram must be from 1 to length")
    own = texts(docs).withColumn("dk", F.xxhash64("doc_id", "text"))
    kind = "bucket long, span long, dk long, low long, more int"
    samples = own.filter(F.octet_length("text") >= length).select("dk", "text").mapInArrow(_samples(length, gram), kind)
    # 1. Buckets of more than one sample.
    often = samples.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    samples = stored(samples.join(often, "bucket"), "repeats-samples")
    # 2. Spans.
    kind = "bucket long, dk long, low long, more int, n long, ask boolean"
    few = samples.filter(F.col("n") <= samples_together).repartition("bucket").sortWithinPartitions("bucket")
    many = samples.filter(F.col("n") > samples_together)
    by_span = many.groupBy("bucket", "span").agg(F.count("*").alias("c"), F.min(F.struct("dk", "low", "more")).alias("one"))
    whole = many.join(by_span.filter("c > 1").select("bucket", "span"), ["bucket", "span"])
    several = by_span.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    asked = by_span.join(several, "bucket").select("bucket", "one.*", "n")
    columns = ["bucket", "dk", "low", "more", "n"]
    decided = few.mapInArrow(_sorted_spans, kind)
    decided = decided.unionAll(whole.select(*columns, F.lit(False))).unionAll(asked.select(*columns, F.lit(True)))
    decided = stored(decided, "repeats-spans")
    # 3. Windows. The texts by document are shuffled once for this and for the result.
    text = own.mapInArrow(_zipped, "doc_id long, dk long, zipped binary")
    asked = decided.filter("ask").groupBy("dk").agg(F.collect_list(F.struct("bucket", "n", "low", "more")).alias("asked"))
    spans = text.join(asked, "dk").mapInArrow(_bytes_of_spans(length), "bucket long, n long, dk long, low long, bytes binary")
    few = spans.filter(F.col("n") <= spans_together).repartition("bucket").sortWithinPartitions("bucket")
    found = few.mapInArrow(_sorted_windows(length), "dk long, low long, more int")
    if decided.filter(F.col("ask") & (F.col("n") > spans_together)).limit(1).count():
        many = spans.filter(F.col("n") > spans_together).mapInArrow(_windows(length), "bucket long, window long, dk long, low long")
        met = many.groupBy("bucket", "window").agg(F.count("*").alias("c")).filter("c > 1").select("bucket", "window")
        found = found.unionAll(many.join(met, ["bucket", "window"]).select("dk", "low", F.lit(0).alias("more")))
    found = decided.filter("not ask").select("dk", "low", "more").unionAll(found)
    found = found.groupBy("dk").agg(F.collect_list(F.struct("low", "more")).alias("found"))
    joined = text.join(found, "dk", "left")
    kind = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept binary"
    return joined.mapInArrow(_kept(length), kind)
