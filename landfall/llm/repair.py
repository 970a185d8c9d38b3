"""Token ids in binary shards, compressed by Re-Pair grammars.

Documents are put in ascending order of ``doc_id``, and consecutive ones form shards of about
``shard_tokens`` ids. In each shard frequent pairs of neighbouring symbols are replaced by a new
symbol, round by round, until no pair occurs ``LEAST`` times or no symbol is left; a pair never spans two documents. What is stored for a shard:

====================  =====================================================================
``symbols``           the documents' symbols in a row, little-endian unsigned 16-bit
``rules``             left and right symbol of every nonterminal, unsigned 16-bit pairs
``expansions``        number of ids that each nonterminal stands for, unsigned 32-bit
``doc_ids``           signed 64-bit; -2^63 for null
``symbol_ends``       where each document's symbols end, unsigned 32-bit
``token_ends``        where each document's ids end in the shard, unsigned 32-bit
====================  =====================================================================

Symbols below ``first_symbol`` are ids themselves. The expansion lengths say where in a document's
symbols an id lies without expanding any, so ``decode`` reads any range of ids by itself. Shards
are rows of a Parquet table. ``task`` and ``shard`` are their order, ``start`` the number of ids
before the shard in its task; ids of the tasks before are summed on reading.

A null text is an empty document, which has its end id alone. Null ``doc_id`` come first; repeated
ones stand in a row, ordered by text. A document longer than a shard has one of its own. Further
columns are ignored; an empty table gives no shards.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm.tables import partitions, texts
from landfall.llm.tokens import END, tokenizer

SHARD_TOKENS = 1 << 18
BUCKET_BITS = 18
# Pairs replaced in one round at most; the next round goes on.
PAIRS_A_ROUND = 4096
LEAST = 8

SHARD = (
    "task int, shard int, start long, n_tokens long, first_symbol int, symbols binary, rules binary,"
    " expansions binary, doc_ids binary, symbol_ends binary, token_ends binary"
)
NULL_ID = -(1 << 63)


def _often(pair: np.ndarray, bucket: np.ndarray, sizes: np.ndarray, limit: int, least: int, exact: bool):
    """Places of one pair for each bucket of ``limit`` pairs, and the buckets whose pair occurs ``least`` times.

    The pair is any of its bucket, or with ``exact`` one that occurs often wherever there is one.
    """
    at = np.flatnonzero((sizes >= limit)[bucket])
    one = np.zeros(len(sizes), np.uint32)
    one[bucket[at]] = pair[at]
    if exact:
        values, counts = np.unique(pair[at], return_counts=True)
        values = values[counts >= least]
        one[_bucket(values, len(sizes))] = values
    at = at[one[bucket[at]] == pair[at]]
    n = np.bincount(bucket[at], minlength=len(sizes))
    return at, one, n, np.flatnonzero(n >= least)


def _bucket(pair: np.ndarray, buckets: int) -> np.ndarray:
    return (pair * np.uint32(0x9E3779B1)) >> np.uint32(33 - buckets.bit_length())


def compress(ids: np.ndarray, ends: np.ndarray, first: int, most: int = PAIRS_A_ROUND, least: int = LEAST):
    """``(symbols, symbol_ends, rules, expansions)`` of ids whose documents end at ``ends``.

    A symbol knows where those before and after it in its document are; place ``size`` stands for none. Only places
    whose pair may be frequent are looked at again: a pair that is rare stays so until one of its symbols is replaced.
    """
    size = len(ids)
    symbols = np.r_[ids, 0].astype(np.uint32)
    after, before = np.arange(1, size + 2), np.arange(-1, size)
    after[ends - 1] = after[size] = size  # every document has an id, its end
    before[np.r_[0, ends]] = size
    there = np.ones(size, bool)
    rules: list[np.ndarray] = []
    expansions = np.ones(first, np.uint32)
    live = np.flatnonzero(after[:size] < size)
    while True:
        free = (1 << 16) - len(expansions)
        if free <= 0 or not len(live):
            break
        # Pairs as one number, counted in buckets; a frequent bucket stands for one pair in it.
        pair = (symbols[live] << np.uint32(16)) | symbols[after[live]]
        buckets = 1 << min(BUCKET_BITS, (4 * len(live)).bit_length())
        bucket = _bucket(pair, buckets)
        sizes = np.bincount(bucket, minlength=buckets)
        may = (sizes >= least)[bucket]
        live, pair, bucket = live[may], pair[may], bucket[may]
        often = sizes[sizes >= least]
        limit = least if len(often) <= most else int(np.partition(often, -most)[-most])
        found, one, n, chosen = _often(pair, bucket, sizes, limit, least, False)
        if not len(chosen):
            # A frequent pair may stand behind another of its bucket.
            found, one, n, chosen = _often(pair, bucket, sizes, least, least, True)
        if len(chosen) > free:
            chosen = chosen[np.argsort(-n[chosen], kind="stable")[:free]]
        if not len(chosen):
            break
        number = np.zeros(buckets, np.uint32)
        number[chosen] = len(expansions) + np.arange(len(chosen), dtype=np.uint32)
        new = number[bucket[found]]
        at, new = live[found[new > 0]], new[new > 0]
        # Of pairs that overlap, every other one, from the left.
        starts = np.r_[True, at[1:] != after[at[:-1]]]
        run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - run) % 2 == 0
        at, new = at[taken], new[taken]
        left, right = one[chosen] >> np.uint32(16), one[chosen] & np.uint32(0xFFFF)
        rules.append(np.stack([left, right], axis=1))
        expansions = np.r_[expansions, expansions[left] + expansions[right]]
        gone = after[at]
        symbols[at], there[gone] = new, False
        after[at] = after[gone]
        before[after[at]] = at
        again = np.zeros(size + 1, bool)
        again[live] = again[at] = again[before[at]] = True
        again[gone] = again[size] = False
        live = np.flatnonzero(again)
        live = live[after[live] < size]
    pairs = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return symbols[:size][there], np.flatnonzero((after[:size] == size)[there]) + 1, pairs, expansions[first:]


def expand(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids that symbols stand for."""
    symbols = symbols.astype(np.uint32)
    while (inner := symbols >= first).any():
        width = np.where(inner, 2, 1)
        at = np.cumsum(width) - width
        out = np.empty(int(width.sum()), np.uint32)
        out[at[~inner]] = symbols[~inner]
        pairs = rules[symbols[inner] - first]
        out[at[inner]], out[at[inner] + 1] = pairs[:, 0], pairs[:, 1]
        symbols = out
    return symbols


def expand_all(symbols: np.ndarray, rules: np.ndarray, expansions: np.ndarray, first: int) -> np.ndarray:
    """``expand`` of many symbols: each rule is expanded once, and its ids copied to wherever it stands."""
    lengths = expansions.astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    ids = expand(np.arange(first, first + len(rules), dtype=np.uint32), rules, first)
    inner = symbols >= first
    rule = symbols[inner].astype(np.int64) - first
    width = np.ones(len(symbols), np.int64)
    width[inner] = lengths[rule]
    at = np.cumsum(width) - width
    out = np.empty(int(width.sum()), np.uint32)
    out[at[~inner]] = symbols[~inner]
    wide = width[inner]
    one_by_one = np.arange(int(wide.sum()))
    own = np.cumsum(wide) - wide
    out[np.repeat(at[inner] - own, wide) + one_by_one] = ids[np.repeat(starts[rule] - own, wide) + one_by_one]
    return out


def decode(shard: dict, document: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of one document of a shard; only symbols that reach into the range are expanded."""
    first = shard["first_symbol"]
    rules = np.frombuffer(shard["rules"], "<u2").reshape(-1, 2)
    ends = np.frombuffer(shard["symbol_ends"], "<u4")
    own = np.frombuffer(shard["symbols"], "<u2")[ends[document - 1] if document else 0 : ends[document]]
    lengths = np.ones(len(own), np.int64)
    lengths[own >= first] = np.frombuffer(shard["expansions"], "<u4")[own[own >= first] - first]
    until = np.cumsum(lengths)
    stop = int(until[-1]) if stop is None else min(stop, int(until[-1]))
    if start >= stop:
        return np.zeros(0, np.uint32)
    i, j = np.searchsorted(until, start, "right"), np.searchsorted(until, stop, "left") + 1
    before = int(until[i - 1]) if i else 0
    return expand(own[i:j], rules, first)[start - before : stop - before]


def _writes(path: str, shard_tokens: int) -> callable:
    end = END.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        first = words.whole.get_vocab_size(with_added_tokens=True)
        if first >= 1 << 16:
            raise ValueError("symbols are 16 bits wide: the vocabulary is too large")
        names = SHARD.replace(",", " ").split()[::2]
        task, shard, start = TaskContext.get().partitionId(), 0, 0
        docs: list[int] = []
        ids: list[bytes] = []

        def row() -> pa.RecordBatch:
            nonlocal shard, start
            lengths = np.array([len(b) // 4 for b in ids])
            ends, total = np.cumsum(lengths), int(lengths.sum())
            symbols, symbol_ends, rules, expansions = compress(np.frombuffer(b"".join(ids), "<u4"), ends, first)
            values = [
                task, shard, start, total, first, symbols.astype("<u2").tobytes(), rules.astype("<u2").tobytes(),
                expansions.astype("<u4").tobytes(), np.array(docs, "<i8").tobytes(), symbol_ends.astype("<u4").tobytes(),
                ends.astype("<u4").tobytes(),
            ]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 6]
            shard, start = shard + 1, start + total
            docs.clear()
            ids.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        held = 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                docs.append(NULL_ID if doc is None else doc)
                ids.append(words.encode(text) + end)
                held += len(ids[-1]) // 4
                if held >= shard_tokens:
                    held = 0
                    yield row()
        if docs:
            yield row()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the shards of all documents to a Parquet table at ``path``."""
    ordered = texts(docs).repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_writes(tokenizer_path, shard_tokens), SHARD).write.parquet(path)


def _reads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard in batch.to_pylist():
            docs = np.frombuffer(shard["doc_ids"], "<i8")
            ends = np.frombuffer(shard["token_ends"], "<u4").astype(np.int64)
            symbols, rules = np.frombuffer(shard["symbols"], "<u2"), np.frombuffer(shard["rules"], "<u2").reshape(-1, 2)
            ids = expand_all(symbols, rules, np.frombuffer(shard["expansions"], "<u4"), shard["first_symbol"])
            starts = np.r_[0, ends[:-1]]
            raw = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, mask=docs == NULL_ID),
                    pa.array(starts + shard["start"] + shard["before"]),
                    pa.array(ends - starts),
                    pa.array([raw[4 * i : 4 * j] for i, j in zip(starts.tolist(), ends.tolist())], pa.binary()),
                ],
                ["doc_id", "start", "n_tokens", "ids"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document; ``start`` counts the ids of all before it."""
    shards = spark.read.schema(SHARD).parquet(path)
    sums = shards.groupBy("task").agg(F.sum("n_tokens").alias("n")).collect()  # one row for each task that wrote
    before, total = {}, 0
    for task, n in sorted(map(tuple, sums)):
        before[task] = total
        total += n
    rows = spark.createDataFrame(list(before.items()), "task int, before long")
    return shards.join(F.broadcast(rows), "task").mapInArrow(_reads, "doc_id long, start long, n_tokens long, ids binary")
