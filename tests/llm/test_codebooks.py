"""Vector codes against a plain version, on awkward rows."""

import math
from hashlib import sha256

import numpy as np
import pytest

from landfall.llm import codebooks

SCHEMA = "vec_id long, embedding array<double>, label int, code string, __label int"
NAN, INF = float("nan"), float("inf")


def vectors(n, width=16, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(0, 0.2, width).round(3).tolist(), int(rng.integers(0, 3)), "x", 1) for i in range(n)]


def brute(rows, width, parts=8):
    kept = [(i, [math.floor(4096 * x) for x in v] + [0] * (width - len(v)), v, label) for i, v, label, *_ in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    w = width // parts
    books = [[r[1][p * w : p * w + w] for r in kept[:16]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[p]))

    for _ in range(6):
        for p in range(parts):
            own = {}
            for r in kept:
                x = r[1][p * w : p * w + w]
                own.setdefault(near(p, x)[1], []).append(x)
            books[p] = [[sum(c) // len(own[j]) for c in zip(*own[j])] if j in own else e for j, e in enumerate(books[p])]
    out = []
    for i, x, _, label in kept:
        found = [near(p, x[p * w : p * w + w]) for p in range(parts)]
        out.append((i, label, "".join(f"{j:02x}" for _, j in found), min(sum(d for d, _ in found), codebooks.LONGEST)))
    sums = {}
    for _, label, _, error in out:
        sums[label] = min(sums.get(label, 0) + error, codebooks.LONGEST)
    return [(*r, sums[r[1]]) for r in out], sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


ODD = [
    (500, None, 1, "x", 1), (501, [0.1] * 15 + [None], 1, "x", 1), (502, [NAN] + [0.1] * 15, 1, "x", 1), (503, [INF] + [0.1] * 15, 1, "x", 1),
    (504, [-INF] + [0.1] * 15, 1, "x", 1), (3, [0.25] * 16, None, None, None), (3, [0.25] * 16, None, "y", 2), (None, [-0.5] * 16, None, "x", 1), (505, [], 2, "x", 1),
    (506, [0.3, 0.4], 2, "x", 1),
]
CASES = {
    "odd": (vectors(60) + ODD, 16),
    "few": (vectors(5), 16),
    "one": (vectors(1), 16),
    "equal": ([(i, [0.5] * 8, 1, "x", 1) for i in range(30)], 8),
    "no multiple": (vectors(40, 13), 16),
    "no components": ([(i, [], 1, "x", 1) for i in range(3)], 0),
    "far": (vectors(30, 8) + [(100, [1e6] * 8, 1, "x", 1), (101, [-1e300] * 8, 1, "x", 1)], 8),
}


@pytest.mark.parametrize("case", list(CASES))
def test_codes(spark, monkeypatch, case):
    monkeypatch.setattr(codebooks, "BLOCK", 7)
    rows, width = CASES[case]
    if case == "far":
        rows = [(i, [min(max(x, -2.0**50), 2.0**50) for x in v], *rest) for i, v, *rest in rows]
        limit = codebooks.LIMIT
        assert all(abs(4096 * x) <= limit for _, v, *_ in rows for x in v)
    df = spark.createDataFrame(CASES[case][0], SCHEMA).repartition(3)
    codes, books = codebooks.compress(df)
    got = codebooks.with_label_error(codes).select("vec_id", "label", "code", "error", "label_error").collect()
    want, digest = brute(rows, width)
    assert order(map(tuple, got)) == order(want)
    assert codebooks.books_sha256(books) == digest


def test_nothing_usable(spark):
    for rows in ([], [(1, None, 1, "x", 1)]):
        codes, books = codebooks.compress(spark.createDataFrame(rows, SCHEMA))
        assert codebooks.with_label_error(codes).collect() == []
        assert books.size == 0


def test_decoded_vectors_are_near(spark):
    rows = vectors(200)
    codes, books = codebooks.compress(spark.createDataFrame(rows, SCHEMA))
    got = {r.vec_id: r.vector for r in codebooks.decode(codes, books).collect()}
    errors = {r.vec_id: r.error for r in codes.collect()}
    for i, v, *_ in rows:
        off = sum((a - b) ** 2 for a, b in zip(v, got[i])) * 4096**2
        assert abs(off**0.5 - errors[i] ** 0.5) <= 4  # what the floors leave


def test_values_are_tabulated_once():
    """Gathered distances are those of the vectors themselves."""
    rng = np.random.default_rng(1)
    x, book = rng.integers(-9, 9, (50, 3)), rng.integers(-9, 9, (4, 3))
    found = [np.unique(x[:, d], return_inverse=True) for d in range(3)]
    best, distance = codebooks.nearest([v for v, _ in found], [c for _, c in found], book)
    plain = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (best == plain.argmin(1)).all() and (distance == plain.min(1)).all()
