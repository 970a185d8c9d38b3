"""The filter audit against a plain version that walks every chain document by document."""

import random
import re
from itertools import permutations

import numpy as np

from landfall.llm import audit

random.seed(11)
VOCABULARY = [f"w{i}" for i in range(400)]
POOL = [
    None, "", "a b c", "SHOUT " * 30, "#tag", "x " * 250, " ".join(VOCABULARY), " ".join(VOCABULARY[:210]) + " $5", "  \x0b\x1c \n",
    "É " * 210, " ".join(VOCABULARY).upper(), "é" * 50_000,
]
ROWS = [(i, random.choice(POOL), random.choice(["en", "de", None, ""]), "x", 1) for i in range(150)] + [
    (3, "a b c", "en", "x", 1), (3, "a b c", "en", "x", 1), (None, "a b c", "de", "x", 1), (None, "only here", "de", "x", 1), (None, "only here", "en", "x", 1),
]
LABELS = [(i, random.choice([0, 1, None]), random.choice([0, 1])) for i in range(0, 160, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
SCHEMA = "doc_id long, text string, lang string, part string, cell int"


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = {}
    for doc, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        same = [d for d, t, *_ in rows if (t or "") == text]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": any(d is not None and (doc is None or d < doc) for d in same),
        }
        docs.setdefault(lang or "", []).append((fails, doc in good, doc in toxic))
    out = []
    for part, own in docs.items():
        found, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if d[0][letter]]
                before = sum(d[0][letter] for d in own) - len(gone)
                left = [d for d in left if not d[0][letter]]
                only = sum(d[0][letter] and sum(d[0].values()) == 1 for d in own)
                shapley[letter] += len(gone)
                found.append((part, "".join(order), step, len(left), len(gone), before, only, sum(d[1] for d in gone), sum(d[2] for d in gone), letter))
        out += [(*r[:-1], shapley[r[-1]]) for r in found]
    return sorted(out)


def test_audit(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = sorted(map(tuple, audit.filter_audit(docs, labels).collect()))
    assert got == brute(ROWS, LABELS)
    none = sorted(map(tuple, audit.filter_audit(docs, labels.limit(0)).collect()))
    assert none == brute(ROWS, [])


def test_empty_table(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert audit.filter_audit(spark.createDataFrame([], SCHEMA), labels).collect() == []


def test_contractions_of_two_filters():
    n = np.array([[5, 3], [2, 1]])  # passes both, fails the second, the first, both
    rows = {(r[0], r[1]): r[2:] for r in audit.contract(n, n, n * 0, "AB")}
    assert rows["AB", 1] == (8, 3, 0, 2, 3, 0, 3 + 2)
    assert rows["AB", 2] == (5, 3, 1, 3, 3, 0, 4 + 3)
    assert rows["BA", 1] == (7, 4, 0, 3, 4, 0, 7)
    assert rows["BA", 2] == (5, 2, 1, 2, 2, 0, 5)
