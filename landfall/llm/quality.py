"""A quality classifier on statistics of whole texts.

Random Fourier features (cosines of random projections, Rahimi and Recht 2007) stand for a Gaussian
kernel over about thirty statistics of a text. Ridge regression on them is a matter of sums, which
tasks add up by themselves; the driver solves a system of fixed size. An isotonic fit over sums in
bins of the score turns it into a share of good documents. It uses scores of models that have not
seen the row: rows fall into ``FOLDS`` by a hash, and there is a model without each.

Statistics and scores cover whole texts of any length. A null text is an empty one and is scored
like it. Labels that are null, or of unknown documents, teach nothing; of repeated labels each
counts. With none at all, or of one kind only, every score is the share of good labels (1 without
any). Further columns are ignored, so neither language nor source is an input.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from landfall.llm.sums import matrix, summed
from landfall.llm.tables import stored, texts

FEATURES = 256
WIDTH = 4.0
RIDGE = 1e-3
FOLDS = 4
BINS = 2048
SEED = 20161
THRESHOLD = 0.7

_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@\\^_`{|}~", np.uint8)
_MARKS = np.frombuffer(b"!\"'(),-.:;?[]", np.uint8)
_WORD_END = re.compile(r"[^\w\s]{2,}(?=\s|$)")


def statistics(text: str) -> list[float]:
    """What the classifier knows of a text."""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    size = max(int(raw.sum()), 1)
    words = text.split()
    n = max(len(words), 1)
    lines = [s for s in text.split("\n") if s.strip()]
    m = max(len(lines), 1)
    counts = Counter(words)
    distinct = len(counts)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    pairs = len(set(zip(words, words[1:])))
    triples = len(set(zip(words, words[1:], words[2:])))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    share = raw[raw > 0] / size
    letters = int(raw[65:91].sum() + raw[97:123].sum() + raw[128:].sum())
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        math.log1p(len(lines)),
        float(lengths.mean()),
        float(lengths.std()),
        math.log1p(int(lengths.max())),
        letters / size,
        float(raw[65:91].sum()) / max(letters, 1),
        float(raw[48:58].sum()) / size,
        float(raw[_SYMBOLS].sum()) / size,
        float(raw[_MARKS].sum()) / size,
        float(raw[128:].sum()) / size,
        float(raw[33]) / n,
        float(raw[124]) / n,
        float(raw[46]) / n,
        float(raw[44]) / n,
        len(_WORD_END.findall(text)) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(str.istitle, words)) / n,
        distinct / n,
        distinct / math.sqrt(n),
        pairs / n,
        triples / n,
        repeats / n,
        max(counts.values(), default=0) / n,
        len(set(lines)) / m,
        len(text) / m / 1000,
        float(-(share * np.log2(share)).sum()) if len(words) else 0.0,
        float((lengths == 1).mean()),
        sum(1 for c in counts.values() if c == 1) / max(distinct, 1),
    ]


SIZE = len(statistics(""))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "x"])


def remainder(key: Column, by: int) -> Column:
    """The row's part in a split of rows, by the CRC-32 of its id as text."""
    return F.crc32(key.cast("string").cast("binary")) % by


@dataclass(frozen=True)
class Model:
    """Everything that scoring needs; a few hundred KB whatever the corpus."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    share: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.c_[np.cos(z @ self.directions + self.shifts) * math.sqrt(2 / len(self.shifts)), np.ones(len(x))]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.features(x) @ self.weights, self.raw, self.share), 0, 1)


def isotonic(positive: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The non-decreasing shares nearest to ``positive / total``, by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for p, t in zip(positive, total):
        pools.append([p, t, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            p2, t2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + p2, pools[-1][1] + t2, pools[-1][2] + k2]
    return np.concatenate([np.full(int(k), p / t) for p, t, k in pools]) if pools else np.zeros(0)


def fit(known: DataFrame, everything: DataFrame) -> Model:
    """A model from ``known(doc_id, x, y)``; the scale of each statistic comes from all documents."""

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch, "x")
        return np.r_[len(x), x.sum(0), (x * x).sum(0)]

    sums = summed(everything.select("x"), moments, 1 + 2 * SIZE)
    n = max(sums[0], 1)
    mean = sums[1 : 1 + SIZE] / n
    spread = np.sqrt(np.clip(sums[1 + SIZE :] / n - mean**2, 1e-9, None))
    rng = np.random.default_rng(SEED)
    directions = rng.standard_normal((SIZE, FEATURES)) / WIDTH
    shifts = rng.uniform(0, 2 * math.pi, FEATURES)
    none = np.zeros(0)
    blank = Model(mean, spread, directions, shifts, none, none, none)
    known = known.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int"))
    d = FEATURES + 1

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z, y, fold = blank.features(matrix(batch, "x")), batch.column("y").to_numpy().astype(np.float64), batch.column("fold").to_numpy()
        parts = []
        for f in range(FOLDS):
            own = z[fold == f]
            parts.append(np.r_[(own.T @ own).ravel(), own.T @ y[fold == f], len(own), y[fold == f].sum()])
        return np.concatenate(parts)

    width = d * d + d + 2
    folds = summed(known.select("x", "y", "fold"), equations, FOLDS * width).reshape(FOLDS, width)
    whole = folds.sum(0)
    rows, good = whole[-2], whole[-1]
    if good in (0, rows):
        return Model(mean, spread, directions, shifts, np.zeros(d), np.array([0.0]), np.array([good / rows if rows else 1.0]))

    def solve(s: np.ndarray) -> np.ndarray:
        return np.linalg.solve(s[: d * d].reshape(d, d) + RIDGE * max(s[-2], 1) / FEATURES * np.eye(d), s[d * d : d * d + d])

    weights, without = solve(whole), np.stack([solve(whole - s) for s in folds])

    def binned(batch: pa.RecordBatch) -> np.ndarray:
        z, y, fold = blank.features(matrix(batch, "x")), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
        at = np.clip((((z * without[fold]).sum(1) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return np.r_[np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)].astype(np.float64)

    counts = summed(known.select("x", "y", "fold"), binned, 2 * BINS).reshape(2, BINS)
    used = np.flatnonzero(counts[0])
    # One good and one bad row of weight a half at either end keep the share off 0 and 1.
    share = isotonic(counts[1][used], counts[0][used])
    share = (share * rows + 0.5) / (rows + 1)
    raw = (used + 0.5) / BINS * 2 - 0.5
    # Steps become slopes, so that ranks within a step stay.
    return Model(mean, spread, directions, shifts, weights, np.r_[raw[0] - 1, raw, raw[-1] + 1], np.r_[0.0, share, 1.0])


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score`` of every row; ``labels(doc_id, y)`` are the rows to learn from."""
    own = stored(texts(docs).mapInArrow(_statistics, "doc_id long, x array<double>"), "quality")
    known = own.join(labels.filter("y is not null").select("doc_id", F.col("y").cast("int").alias("y")), "doc_id")
    model = fit(known, own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(matrix(batch, "x")) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return own.mapInArrow(run, "doc_id long, score double")
