"""Bounded-space online packing of documents into training sequences.

Every task packs its own documents as they come. It keeps ``open_windows`` windows open and puts a
piece where it leaves the least room. When it fits into none, the fullest window is closed: with
padding if little room is left in it, and else filled up by a cut of the piece. What remains open
when a task ends is packed again by fewer tasks, and so on until one is left, which sees no more
than ``FAN_IN`` times ``open_windows`` windows. Memory is that of the open windows.

A document may be cut anywhere; its pieces follow one another by ``start``. A null text is an
empty document of one id, its end. Rows of a null or repeated ``doc_id`` are documents of their
own. Texts of any length pass; further columns are ignored; no rows give no sequences.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from landfall.llm.tables import stored, texts
from landfall.llm.tokens import END, tokenizer

WINDOW = 4096
OPEN_WINDOWS = 16
# Room that may be left as padding rather than cut a document for it.
SLACK = 16
FAN_IN = 64

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, closed boolean"
_NAMES = [c.split()[0] for c in PIECES.split(", ")]
_SCHEMA = pa.schema(
    [(n, pa.bool_() if n == "closed" else pa.binary() if n == "ids" else pa.int64()) for n in _NAMES]
)


class _Packer:
    """Open windows, each its pieces and its fill; ``done`` gathers rows of closed ones."""

    def __init__(self, window: int, open_windows: int, slack: int, first: int) -> None:
        self.window, self.most, self.slack, self.next = window, open_windows, slack, first
        self.open: list[tuple[list, int]] = []
        self.done: list[tuple] = []
        self.bytes = 0

    def close(self, at: int, closed: bool = True) -> None:
        pieces, _ = self.open.pop(at)
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.done.append((doc, start, n, ids, total, self.next, offset, closed))
            self.bytes += len(ids)
            offset += n
        self.next += 1

    def _put(self, at: int, piece: tuple) -> None:
        pieces, fill = self.open[at]
        pieces.append(piece)
        self.open[at] = (pieces, fill + len(piece[2]) // 4)
        if self.open[at][1] == self.window:
            self.close(at)

    def add(self, doc: int | None, start: int, ids: bytes, total: int) -> None:
        while ids:
            n = len(ids) // 4
            if n >= self.window:
                # Whole windows of a long document stand alone.
                self.open.append(([], 0))
                self._put(len(self.open) - 1, (doc, start, ids[: 4 * self.window], total))
                start, ids = start + self.window, ids[4 * self.window :]
                continue
            fits = [(self.window - fill - n, i) for i, (_, fill) in enumerate(self.open) if fill + n <= self.window]
            if fits:
                self._put(min(fits)[1], (doc, start, ids, total))
                return
            if len(self.open) < self.most:
                self.open.append(([], 0))
                self._put(len(self.open) - 1, (doc, start, ids, total))
                return
            fullest = max(range(len(self.open)), key=lambda i: self.open[i][1])
            room = self.window - self.open[fullest][1]
            if room <= self.slack:
                self.close(fullest)
                continue
            self._put(fullest, (doc, start, ids[: 4 * room], total))
            start, ids = start + room, ids[4 * room :]

    def rows(self) -> pa.RecordBatch:
        columns = zip(*self.done) if self.done else [[] for _ in _NAMES]
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)
        self.done, self.bytes = [], 0
        return batch


def _pack(pieces: Iterator[tuple], round_: int, last: bool, window: int, open_windows: int, slack: int) -> Iterator[pa.RecordBatch]:
    first = (round_ << 56) + (TaskContext.get().partitionId() << 32)
    packer = _Packer(window, open_windows, slack, first)
    for piece in pieces:
        packer.add(*piece)
        if packer.bytes > 8 << 20:
            yield packer.rows()
    while packer.open:
        packer.close(0, closed=last)
    yield packer.rows()


def _packs_texts(path: str, **settings) -> callable:
    end = END.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode

        def pieces() -> Iterator[tuple]:
            for batch in batches:
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    ids = encode(text) + end
                    yield doc, 0, ids, len(ids) // 4

        return _pack(pieces(), **settings)

    return run


def _packs_pieces(**settings) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")))

        return _pack(pieces(), **settings)

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, slack: int = SLACK
) -> DataFrame:
    """The pieces of all sequences: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit integers; the ids of a sequence are those of its
    pieces by ``offset``. ``doc_tokens`` counts a document's ids with the end id.
    """
    settings = {"window": window, "open_windows": open_windows, "slack": slack}
    run = _packs_texts(tokenizer_path, round_=0, last=False, **settings)
    packed = stored(texts(docs).mapInArrow(run, PIECES), "packed")
    whole = packed.filter("closed")
    source_task = F.expr("shiftrightunsigned(sequence_id, 32) & 16777215")  # it is in the number
    tasks = 1 + (packed.agg(F.max(source_task)).first()[0] or 0)
    round_ = 0
    while round_ == 0 or tasks > 1:
        tasks, round_ = -(-tasks // FAN_IN), round_ + 1
        left = packed.filter("not closed").repartitionByRange(tasks, source_task).sortWithinPartitions("sequence_id", "offset")
        packed = stored(left.mapInArrow(_packs_pieces(round_=round_, last=tasks == 1, **settings), PIECES), "packed-left")
        whole = whole.unionAll(packed.filter("closed"))
    return whole.drop("closed")
