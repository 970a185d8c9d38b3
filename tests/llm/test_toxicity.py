"""Toxicity: the decoder against enumeration, and long texts."""

import itertools
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from landfall.llm import toxicity


@pytest.fixture(scope="module")
def restorer():
    words = ["idiot", "trash", "plain", "stupid", "the", "and", "loser", "pathetic", "of", "bottle", "free"]
    random.seed(2)
    return toxicity.Restorer.of(toxicity.trigram_counts([" ".join(random.choices(words, k=2000))]))


def score(restorer, letters):
    a = b = 0
    total = 0.0
    for c in letters:
        k = toxicity._CODE[c]
        total += restorer.logs[a, b, k]
        a, b = b, k
    return total + restorer.logs[a, b, 0]


@pytest.mark.parametrize("word", ["1d10t", "i.d.i.o.t", "idiooot", "l0$er", "tr@sh", "b0ttl3", "s7up!d", "fr**", "a", "€|0", "ttt", "ßüa", "5__5t"])
def test_the_decoder_finds_the_likeliest_reading(restorer, word):
    """Of all readings of the lattice, scored one by one."""
    every = {}
    for path in itertools.product(*restorer._options(word)):
        letters = "".join(a for a, _ in path)
        every[letters] = max(every.get(letters, -np.inf), sum(q for _, q in path) + score(restorer, letters))
    assert every[restorer.read(word)] == pytest.approx(max(every.values()))


def test_long_words_take_no_time(restorer):
    for word in ("*" * 100_000, "a1" * 20_000, "x" * 100_000, "s-" * 20_000, "a****" * 40):
        start = time.perf_counter()
        restorer.word(word)
        assert time.perf_counter() - start < 5
    assert restorer.word("1" * 30 + "." * 30) == ""
    # One rule for all lengths: a disguised word is read where marks outnumber its letters, too.
    assert restorer.word("i" + "._" * 12 + "diot") == "idiot"


class Plain(dict):
    def __missing__(self, word):
        return word


def test_a_passage_counts_the_same_in_any_text():
    weight = {"bad": 3.0, "worse": 4.0}

    class Weights(dict):
        def __missing__(self, word):
            return weight.get(word, 0.0)

    passage = ["bad", "worse", *[f"p{i}" for i in range(40)]]
    alone = toxicity.text_evidence(" ".join(passage), Plain(), Weights(), -0.02)
    assert alone == pytest.approx(7 - 0.02 * 40)
    for before, behind in [(0, 10_000), (10_000, 0), (5_003, 777), (100, 100_000)]:
        text = " ".join([f"a{i}" for i in range(before)] + passage + [f"b{i}" for i in range(behind)])
        got = toxicity.text_evidence(text, Plain(), Weights(), -0.02)
        assert got >= 7 - 0.02 * toxicity.BLOCK_WORDS
        words = text.split()
        assert got == toxicity.strongest(set(words), map(set, toxicity.blocks(words)), Weights(), -0.02)
    clean = " ".join(f"c{i}" for i in range(3000))
    assert toxicity.text_evidence(clean, Plain(), Weights(), -0.02) == pytest.approx(-60)
    assert toxicity.text_evidence("", Plain(), Weights(), -0.02) == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 384, 385, 1000])
def test_blocks_cover_all_words(n):
    words = [str(i) for i in range(n)]
    found = list(toxicity.blocks(words))
    assert sorted(set(sum(found, [])), key=int) == words and all(len(b) <= toxicity.BLOCK_WORDS for b in found)
    half = toxicity.BLOCK_WORDS // 2
    assert all(any(set(words[i : i + half]) <= set(b) for b in found) for i in range(0, max(n - half, 1), 7))


def test_words_that_are_met_again_are_remembered():
    asked = []
    memory = toxicity._Memory(lambda word: asked.append(word) or word, most=2)
    for word in ["often", "a", "often", "b", "often", "c", "d", "often", "e", "f", "often"]:
        assert memory[word] == word
    assert asked.count("often") == 1
    assert len(memory) + len(memory.last) <= 4


def test_a_worker_holds_few_rows_at_a_time():
    batch = pa.RecordBatch.from_pydict({"text": ["a"] * (2 * toxicity.ROWS + 1)})
    assert [b.num_rows for b in toxicity._few_rows([batch])] == [toxicity.ROWS, toxicity.ROWS, 1]


def test_a_weight_is_that_of_the_strongest_beginning():
    model = toxicity.Model(None, {"abc": 1.0, "abcd": 2.0, "ab$": 3.0, "x$": 4.0})
    words = ["abcde", "abcx", "ab", "x", "a", "", "xyz", "ab$c"]
    assert [model.weight(w) for w in words] == [2.0, 1.0, 3.0, 4.0, 0.0, 0.0, 0.0, 3.0]
