"""Toxicity of whole texts, read through their disguises.

A disguised word is taken for a noisy spelling: letters may have been swapped for figures and signs
that look alike, pulled apart by separators or blanks, or repeated. All its readings form a lattice, and
Viterbi decoding under a trigram model of characters, counted over the whole corpus, picks the
likeliest. Words that look plain have one reading and are left alone.

Restored words, and what they begin with, are then weighed by how much likelier they are in toxic
texts than in others, as far as that is sure (a lower confidence bound). The weights of distinct words, less
what their number lets expect, are evidence. A text has that of its strongest block: blocks of ``BLOCK_WORDS`` words, each
half over the next, cover all of it, so a passage counts the same however long the text around it is. A text
without a weighed word has that of all its words. An isotonic fit makes a share of it.

Words of any length are read by one rule, in pieces of ``PIECE`` characters; what has no letter is nothing. A run of more than
``MASKS`` asterisks says nothing about letters and only parts them.

What is learnt from labels comes from at most ``fit_rows`` labelled rows, those of least hash. Character
counts cover all documents. Labels that are null or of unknown documents teach nothing. A null text is
an empty one and is scored like it; without toxic and other labels the score is their share (0 without any).
Texts of any length pass; further columns are ignored.
"""

import math
import re
import sys
import types
from collections import Counter
from collections.abc import Collection, Iterable, Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from landfall.llm.quality import isotonic
from landfall.llm.sums import summed
from landfall.llm.tables import stored, texts

FIT_ROWS = 20_000
LEAST_TEXTS = 4
SURE = 2.5
LEAST_WEIGHT = 0.7
PREFIXES = range(3, 9)
THRESHOLD = 0.5
BINS = 1200
LOW, HIGH = -20.0, 40.0
BLOCK_WORDS = 256
PIECE = 48
MASKS = 4
# Rows that a worker holds as Python objects at a time.
ROWS = 500
# Characters whose trigrams are counted at a time, in some 50 MB.
BLOCK = 1 << 20

LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
SIZE = len(LETTERS) + 1

# Signs that stand for letters.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = ".-_*~^'`·,:;/\\"
SWAPPED, SPLIT, MASKED, DOUBLED = -0.7, -0.3, -3.0, -2.0

_CODES = np.zeros(0x180, np.int32)
for _i, _c in enumerate(LETTERS, 1):
    _CODES[ord(_c)] = _i
_CODE = {c: i for i, c in enumerate(LETTERS, 1)}
_EDGES = re.compile(r"^[^\w@$!|+(€£¡*]+|[^\w]+$")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_APART = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}[.,;:!?]*(?!\S)")


def _blocks(texts_: list[str]) -> Iterator[str]:
    """Texts with edges around them, about ``BLOCK`` characters at a time; the pieces of a longer one overlap by two."""
    held, n = [""], 0
    for text in texts_:
        if len(text) > BLOCK:
            edged = f"\n\n{text}\n\n"
            yield from (edged[at : at + BLOCK + 2] for at in range(0, len(edged) - 2, BLOCK))
            continue
        held.append(text)
        n += len(text)
        if n >= BLOCK:
            yield "\n\n".join([*held, ""])
            held, n = [""], 0
    if len(held) > 1:
        yield "\n\n".join([*held, ""])


def trigram_counts(texts_: list[str]) -> np.ndarray:
    """How often each three characters follow each other; whatever is no letter is a word's edge."""
    counts = np.zeros(SIZE**3)
    for block in _blocks(texts_):
        points = np.frombuffer(block.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = _CODES[np.where(points < len(_CODES), points, 0)].astype(np.int64)
        counts += np.bincount((codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], minlength=SIZE**3)
    return counts


@dataclass(frozen=True)
class Restorer:
    """Readings of disguised words under character counts; ``logs`` has log P(c | a, b)."""

    logs: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> "Restorer":
        n = counts.reshape(SIZE, SIZE, SIZE)
        one = (n.sum((0, 1)) + 1) / (n.sum() + SIZE)
        two = (n.sum(0) + 20 * one) / (n.sum(0).sum(1, keepdims=True) + 20)
        three = (n + 5 * two[None]) / (n.sum(2, keepdims=True) + 5)
        return Restorer(np.log(three))

    def _options(self, word: str) -> list[list[tuple[str, float]]]:
        steps, i = [], 0
        while i < len(word):
            c, j = word[i], i + 1
            while j < len(word) and word[j] == c:
                j += 1
            as_letters = [(c, 0.0)] if c in _CODE else [(a, SWAPPED) for a in LOOK_ALIKES.get(c, "")]
            if c == "*" and j - i <= MASKS:
                as_letters = [("", SPLIT), *((a, MASKED) for a in LETTERS[:26])]
            elif c in SEPARATORS or not as_letters:
                as_letters = [*as_letters, ("", SPLIT if c in SEPARATORS else MASKED)]
            if j - i == 1 or c == "*" and j - i <= MASKS:
                steps += [as_letters] * (j - i)
            else:
                once, twice = (DOUBLED, 0.0) if j - i == 2 else (0.0, SPLIT)
                steps.append([o for a, p in as_letters for o in ((a, p + once), (a * 2, p + twice))])
            i = j
        return steps

    def read(self, word: str) -> str:
        """The likeliest letters behind a word in lower case; of a long one those of its pieces."""
        if len(word) > PIECE:
            return "".join([self.read(word[i : i + PIECE]) for i in range(0, len(word), PIECE)])
        best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for options in self._options(word):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (p, said) in best.items():
                for letters, q in options:
                    x, y, total = a, b, p + q
                    for c in letters:
                        k = _CODE[c]
                        total += self.logs[x, y, k]
                        x, y = y, k
                    if total > after.get((x, y), (-math.inf,))[0]:
                        after[x, y] = (total, said + letters)
            best = after
        return max((p + self.logs[a, b, 0], said) for (a, b), (p, said) in best.items())[1]

    def word(self, word: str) -> str:
        """A word in lower case without marks around it, restored if it looks disguised."""
        lower = word.lower()
        bare = lower if lower.isalpha() else _EDGES.sub("", lower)
        if bare.isalpha():
            return self.read(bare) if _TRIPLE.search(bare) and all(c in _CODE for c in bare) else bare
        return self.read(bare) if any(map(str.isalpha, bare)) else ""

    def restore(self, text: str) -> str:
        """The whole text, word by word; letters set apart by blanks are one word."""
        joined = _APART.sub(lambda m: re.sub(r"[ \t]", "·", m[0]), text)
        return re.sub(r"\S+", lambda m: self.word(m[0]), joined)


@dataclass(frozen=True)
class Model:
    restorer: Restorer
    weights: dict[str, float] = field(default_factory=dict)
    miss: float = 0.0
    raw: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    share: np.ndarray = field(default_factory=lambda: np.array([0.0]))

    heads: frozenset[str] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "heads", frozenset(f[: PREFIXES[0]] for f in self.weights))

    def weight(self, word: str) -> float:
        # All that is weighed of a word begins alike.
        if f"{word}$"[: PREFIXES[0]] not in self.heads:
            return 0.0
        return max([self.weights.get(f, 0.0) for f in begins(word)], default=0.0)


def begins(word: str) -> list[str]:
    """What is weighed of a restored word: its beginnings, and itself."""
    return [*(word[:k] for k in PREFIXES if k <= len(word)), word + "$"] if word else []


def tokens(text: str) -> list[str]:
    """The words of a text in order; letters set apart by blanks are one word."""
    # Blanks two apart are cheap to look for; few texts have them.
    if _may_be_apart(text):
        text = _APART.sub(lambda m: re.sub(r"[ \t]", "·", m[0]), text)
    return text.split()


def distinct_words(words: list[str], restored) -> set[str]:
    """The distinct restored words; ``restored`` restores one word."""
    found = set(map(restored, set(words)))
    found.discard("")
    return found


def blocks(words: list[str]) -> Iterator[list[str]]:
    """Blocks that cover all words, each half over the next."""
    half = BLOCK_WORDS // 2
    yield from (words[i : i + BLOCK_WORDS] for i in range(0, max(len(words) - half, 1), half))


def _may_be_apart(text: str) -> bool:
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = np.r_[True, (raw == 32) | (raw == 9) | (raw == 10), True]
    if len(blank) < 7:
        return False
    single = blank[:-2] & ~blank[1:-1] & blank[2:]
    return bool((single[:-4] & single[2:-2] & single[4:]).any())


class _Memory(dict):
    """What a function said of each word. Beyond so many words they become the last generation: those met again move on, others
    are forgotten."""

    def __init__(self, of, most: int = 100_000) -> None:
        super().__init__()
        self.of, self.most, self.last = of, most, {}

    def __missing__(self, word: str):
        value = self.last.get(word)
        if value is None:
            value = self.of(word)
            if len(word) >= 64:
                return value
            # A word that is said again as it is is held once.
            value = word if value == word else value
        if len(self) >= self.most:
            self.last = dict(self)
            self.clear()
        self[word] = value
        return value


def _kept() -> dict:
    """What this process keeps from task to task."""
    return sys.modules.setdefault("_landfall_llm_kept", types.ModuleType("_landfall_llm_kept")).__dict__


def _few_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(at, ROWS) for at in range(0, batch.num_rows, ROWS))


_WORDS = pa.list_(pa.string())


def _words(restorer: Restorer) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _kept().pop("toxicity", None)  # a former job's words
        memory = _Memory(restorer.word)
        for batch in _few_rows(batches):
            read = [tokens(t) for t in batch.column("text").to_pylist()]
            found = [sorted(distinct_words(t, memory.__getitem__)) for t in read]
            by_block = [[sorted(distinct_words(b, memory.__getitem__)) for b in blocks(t)] for t in read]
            columns = [batch.column("y"), pa.array(found, _WORDS), pa.array(by_block, pa.list_(_WORDS))]
            yield pa.RecordBatch.from_arrays(columns, ["y", "words", "blocks"])

    return run


def _counts(candidates: frozenset | None) -> callable:
    """In how many texts each beginning is, of those named or of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in _few_rows(batches):
            for words in batch.column("words").to_pylist():
                own = {f for w in words for f in begins(w)}
                counts.update(own if candidates is None else own & candidates)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["f", "n"])

    return run


def fit(known: DataFrame, restorer: Restorer) -> Model:
    """A model from ``known(y, words)``, whose rows are bounded by ``fit_rows``."""

    def counted(rows: DataFrame, candidates: frozenset | None) -> DataFrame:
        return rows.select("words").mapInArrow(_counts(candidates), "f string, n long").groupBy("f").agg(F.sum("n").alias("n"))

    toxic, other = known.filter("y = 1"), known.filter("y = 0")

    def totals(batch: pa.RecordBatch) -> np.ndarray:
        y = batch.column("y").to_numpy()
        n = batch.column("words").value_lengths().to_numpy()
        return np.array([(y == 1).sum(), (y == 0).sum(), n[y == 1].sum(), n[y == 0].sum()], np.float64)

    texts1, texts0, words1, words0 = summed(known, totals, 4)
    if not texts1 or not texts0:
        return Model(restorer, share=np.array([1.0 if texts1 else 0.0]))
    n1 = {r.f: r.n for r in counted(toxic, None).filter(F.col("n") >= LEAST_TEXTS).collect()}
    n0 = {r.f: r.n for r in counted(other, frozenset(n1)).collect()}
    weights = {}
    for f, a in n1.items():
        b = n0.get(f, 0)
        gain = math.log((a + 0.5) / (words1 + 1)) - math.log((b + 0.5) / (words0 + 1))
        sure = gain - SURE * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        if sure >= LEAST_WEIGHT:
            weights[f] = sure
    model = Model(restorer, weights)

    def hits(batch: pa.RecordBatch) -> np.ndarray:
        memory = _Memory(model.weight)
        total = np.zeros(2)
        for some in _few_rows([batch]):
            for y, words in zip(some.column("y").to_pylist(), some.column("words").to_pylist()):
                total[y] += sum(memory[w] > 0 for w in words)
        return total

    hits0, hits1 = summed(known, hits, 2)
    rate = lambda h, n: min((h + 0.5) / (n + 1), 0.5)
    miss = math.log1p(-rate(hits1, words1)) - math.log1p(-rate(hits0, words0))
    model = Model(restorer, weights, min(miss, 0.0))

    def binned(batch: pa.RecordBatch) -> np.ndarray:
        memory = _Memory(model.weight)
        y = batch.column("y").to_numpy()
        rows = (row for b in _few_rows([batch]) for row in zip(b.column("words").to_pylist(), b.column("blocks").to_pylist()))
        e = np.array([strongest(words, by_block, memory, model.miss) for words, by_block in rows])
        at = np.clip((e - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)
        return np.r_[np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)].astype(np.float64)

    counts = summed(known, binned, 2 * BINS).reshape(2, BINS)
    used = np.flatnonzero(counts[0])
    rows = counts[0].sum()
    share = (isotonic(counts[1][used], counts[0][used]) * rows + 0.5) / (rows + 1)
    raw = LOW + (used + 0.5) / BINS * (HIGH - LOW)
    return Model(restorer, weights, model.miss, np.r_[raw[0] - 40, raw, raw[-1] + 200], np.r_[0.0, share, 1.0])


def evidence(weights: list[float], miss: float) -> float:
    return sum(w if w > 0 else miss for w in weights)


def strongest(words: Collection[str], by_block: Iterable[Collection[str]], weight: dict[str, float], miss: float) -> float:
    """The greatest evidence of blocks with a weighed word, that of all ``words`` where there is none."""
    if not any(weight[w] > 0 for w in words):
        return evidence([weight[w] for w in words], miss)
    found = [[weight[w] for w in block] for block in by_block]
    return max(evidence(ws, miss) for ws in found if max(ws, default=0) > 0)


def text_evidence(text: str, restored: dict[str, str], weight: dict[str, float], miss: float) -> float:
    """``strongest`` of a text, looking at its blocks only where it has a weighed word."""
    words = tokens(text)
    whole = distinct_words(words, restored.__getitem__)
    if len(words) <= BLOCK_WORDS or not any(weight[w] > 0 for w in whole):
        return evidence([weight[w] for w in whole], miss)
    return strongest(whole, (distinct_words(b, restored.__getitem__) for b in blocks(words)), weight, miss)


def corpus_restorer(docs: DataFrame) -> Restorer:
    """The restorer under the character counts of all ``docs``."""

    def counts(batch: pa.RecordBatch) -> np.ndarray:
        return sum(trigram_counts(b.column("text").to_pylist()) for b in _few_rows([batch]))

    return Restorer.of(summed(texts(docs).select("text"), counts, SIZE**3))


def restore_texts(docs: DataFrame, restorer: Restorer) -> DataFrame:
    """``doc_id, restored`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [restorer.restore(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "restored"])

    return texts(docs).mapInArrow(run, "doc_id long, restored string")


def score_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, score`` of every row; ``labels(doc_id, y)`` are the rows to learn from."""
    own = texts(docs)
    restorer = corpus_restorer(docs)
    some = labels.filter("y is not null and doc_id is not null").select("doc_id", F.col("y").cast("int").alias("y"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(fit_rows)
    known = own.join(F.broadcast(some), "doc_id").select("y", "text")  # fit_rows ids
    known = stored(known.mapInArrow(_words(restorer), "y int, words array<string>, blocks array<array<string>>"), "toxicity")
    model = fit(known, restorer)

    mark = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Words that this process has seen in earlier tasks of the job.
        kept = _kept()
        if kept.get("toxicity", (None,))[0] != mark:
            kept["toxicity"] = mark, _Memory(model.restorer.word), _Memory(model.weight)
        _, restored, weight = kept["toxicity"]
        for batch in _few_rows(batches):
            found = [text_evidence(text, restored, weight, model.miss) for text in batch.column("text").to_pylist()]
            scores = np.clip(np.interp(found, model.raw, model.share), 0, 1) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return own.mapInArrow(run, "doc_id long, score double")
