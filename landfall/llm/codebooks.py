"""Vectors as short codes: part by part the index of the nearest entry of a codebook.

Each component becomes the integer ``floor(scale * x)``, and a vector is cut into ``parts`` equal consecutive
parts. The codebook of a part position starts as that part of the ``entries`` vectors of least ``vec_id``; a
round assigns every part to the nearest entry (squared distance, ties to the lower index) and then moves
each entry to ``floor(sum / count)`` of its parts; entries without parts stay. All of it is integer
arithmetic, so results do not depend on the order or the dealing of rows.

Distances come from value dictionaries. Vectors are stored in blocks, and a block has for every dimension
its distinct integers and a code a vector. A round tabulates the squared differences of every
distinct integer to all entries once, and the distance of a part is gathered from these tables by code and added
up. A round reads the blocks and shuffles only sums of entries; its codebooks, ``entries`` vectors in all, are all
that the driver holds.

Vectors that are null or hold a null, NaN or infinite component are dropped. Rows of equal ``vec_id`` are vectors of their
own; at the start they come in the order of their components, and a null ``vec_id`` comes last. With fewer vectors than
``entries`` the codebooks are as short. Vectors of unequal length are filled up with zeros to the longest, and lengths to a
multiple of ``parts``. Integers end at 2**62 on both sides, errors at the greatest long. No rows give no rows. Further columns are ignored.
"""

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, ArrayType, BinaryType, LongType, StringType

from landfall.llm.tables import stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096

LIMIT = 1 << 62
LONGEST = (1 << 63) - 1
# Above this, integers are Python's own, since a squared difference might not fit a long.
SAFE = 1 << 24
# Vectors of a block at most.
BLOCK = 16384

SUMS = "part int, entry int, at int, sum decimal(38,0), n long"


def usable(column: str = "embedding") -> Column:
    """True for a vector of finite components."""
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd, F.lit(False))


def _integers(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """One row a vector, filled up with zeros."""
    ends = vectors.offsets.to_numpy()
    sizes = np.diff(ends)
    rows = np.zeros((len(vectors), width))
    rows[np.arange(width) < sizes[:, None]] = vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    with np.errstate(over="ignore"):
        floors = np.floor(rows * scale)
    far = np.abs(floors) >= LIMIT
    whole = np.where(far, 0, floors).astype(np.int64)
    return np.where(far, np.where(floors < 0, -LIMIT, LIMIT), whole)


def _encodes(width: int, scale: int, schema: pa.Schema):
    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        vectors = table.column("embedding").combine_chunks()
        values = _integers(vectors, width, scale)
        found = [np.unique(values[:, d], return_inverse=True) for d in range(width)]
        cells = {
            "vec_ids": [table.column("vec_id").to_pylist()],
            "labels": [table.column("label").to_pylist()],
            "dictionaries": [[v for v, _ in found]],
            "codes": [[c.astype("<u2").tobytes() for _, c in found]],
        }
        return pa.RecordBatch.from_arrays([pa.array(cells[f.name], f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(start, BLOCK)
                if n + piece.num_rows > BLOCK:
                    yield block(held)
                    held, n = [], 0
                held, n = [*held, piece], n + piece.num_rows
        if n:
            yield block(held)

    return run


def _blocks(kept: DataFrame, width: int, scale: int) -> DataFrame:
    """``vec_ids, labels, dictionaries, codes`` of up to ``BLOCK`` vectors a row."""
    types = {f.name: f.dataType for f in kept.schema}
    schema = StructType([
        StructField("vec_ids", ArrayType(types["vec_id"])),
        StructField("labels", ArrayType(types["label"])),
        StructField("dictionaries", ArrayType(ArrayType(LongType()))),
        StructField("codes", ArrayType(BinaryType())),
    ])
    from pyspark.sql.pandas.types import to_arrow_schema

    return stored(kept.mapInArrow(_encodes(width, scale, to_arrow_schema(schema)), schema), "vector-blocks")


def nearest(dictionaries: list[np.ndarray], codes: list[np.ndarray], book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of ``book`` (entries by dimensions) for each vector of a part.

    ``dictionaries`` and ``codes`` hold the part's dimensions.
    """
    largest = max((int(abs(x).max()) for x in [*dictionaries, book] if x.size), default=0)
    book = book if largest <= SAFE else book.astype(object)
    distances = np.zeros((len(codes[0]) if codes else 0, len(book)), book.dtype)
    for d, (values, code) in enumerate(zip(dictionaries, codes)):
        table = (values.astype(book.dtype)[:, None] - book[None, :, d]) ** 2
        distances += table[code]
    best = distances.argmin(axis=1)
    return best, distances[np.arange(len(best)), best]


def _read(batch: pa.RecordBatch) -> Iterator[tuple[list, list, list[np.ndarray], list[np.ndarray]]]:
    for row in range(batch.num_rows):
        ids, labels, words, codes = (batch.column(c)[row] for c in ("vec_ids", "labels", "dictionaries", "codes"))
        yield ids, labels, [w.values.to_numpy() for w in words], [np.frombuffer(c.as_py(), "<u2") for c in codes]


def _sums(books: np.ndarray):
    """Sums and counts of the parts of each entry, ``books`` being parts by entries by dimensions."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, _, words, codes in _read(batch):
                for p in range(parts):
                    own = slice(p * width, (p + 1) * width)
                    best, _ = nearest(words[own], codes[own], books[p])
                    counts[p] += np.bincount(best, minlength=entries)
                    for d, (values, code) in enumerate(zip(words[own], codes[own])):
                        # How often each distinct integer went to each entry, times the integer.
                        met = np.bincount(best * len(values) + code, minlength=entries * len(values)).reshape(entries, -1)
                        whole = values if abs(values).max() <= SAFE else values.astype(object)
                        sums[p, :, d] += (met * whole).sum(axis=1)
        where = [(p, e, d) for p, e in zip(*np.nonzero(counts)) for d in range(width)]
        columns = [[x[i] for x in where] for i in range(3)]
        columns += [[int(sums[x]) for x in where], [int(counts[x[:2]]) for x in where]]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "entry", "at", "sum", "n"])

    return run


def _codes(books: np.ndarray, schema: pa.Schema):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, words, codes in _read(batch):
                found = [nearest(words[p * width : (p + 1) * width], codes[p * width : (p + 1) * width], books[p]) for p in range(parts)]
                if not width:
                    found = [(np.zeros(len(ids), np.int64),) * 2] * parts
                text = np.stack([b for b, _ in found], 1).astype(np.uint8).tobytes().hex()
                error = np.minimum(sum(e.astype(object) for _, e in found), LONGEST).tolist()
                cells = {
                    "vec_id": ids.values,
                    "label": labels.values,
                    "code": [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)],
                    "error": error,
                }
                yield pa.RecordBatch.from_arrays([pa.array(cells[f.name], f.type) for f in schema], schema=schema)

    return run


def learn_codebooks(
    blocks: DataFrame, first: list[list[int]], parts: int = PARTS, rounds: int = ROUNDS
) -> np.ndarray:
    """The codebooks after all rounds, parts by entries by dimensions; ``first`` are the vectors that they start from."""
    width = len(first[0]) // parts
    books = np.array(first, np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if width else 0):
        found = blocks.mapInArrow(_sums(books), SUMS).groupBy("part", "entry", "at").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
        for row in found.collect():  # one row a component of the codebooks
            books[row.part, row.entry, row.at] = int(row["sum"]) // row.n
    return books


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every usable vector, and the codebooks (parts by entries by dimensions).

    ``code`` has two hex digits a part, so ``entries`` is 256 at most.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256.")
    kept = vectors.filter(usable()).select("vec_id", "label", "embedding")
    width = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-width // parts) * parts
    # ``entries`` rows at most.
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select(F.col("embedding").cast("array<double>")).collect()
    types = {f.name: f.dataType for f in kept.schema}
    schema = StructType([
        StructField("vec_id", types["vec_id"]), StructField("label", types["label"]), StructField("code", StringType()), StructField("error", LongType()),
    ])
    if not first:
        return vectors.sparkSession.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    start = _integers(pa.array([r.embedding for r in first], pa.list_(pa.float64())), width, scale)
    blocks = _blocks(kept, width, scale)
    books = learn_codebooks(blocks, start.tolist(), parts, rounds)
    from pyspark.sql.pandas.types import to_arrow_schema

    return blocks.mapInArrow(_codes(books, to_arrow_schema(schema)), schema), books


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``codes`` with ``vector``: the middle of the steps that its entries stand for."""
    entries = [[[(int(x) + 0.5) / scale for x in entry] for entry in book] for book in books]
    at = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    pieces = [F.get(F.array(*[F.array(*map(F.lit, e)) for e in book]), at(p)) for p, book in enumerate(entries)]
    return codes.withColumn("vector", F.concat(*pieces))


def books_sha256(books: np.ndarray) -> str:
    """The lowercase hex digest of all integers, by part, entry and position, joined by commas."""
    return sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the sum of ``error`` over the rows of equal labels; nulls are one label."""
    codes = stored(codes, "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)"))
    sums = codes.groupBy(F.col("label").alias("__label")).agg(total.cast("long").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
