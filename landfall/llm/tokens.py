"""Token ids of whole texts by a public tokenizer, with each distinct word encoded once a process.

The tokenizers of this kind never merge across white space, so a text's ids are those of its words
in a row. A word is what stands between blanks and line ends; whatever else is in it, other white
space included, is the tokenizer's own business.
"""

import re
import struct
import sys
import types

from tokenizers import Tokenizer

END = 2
# Words that a worker keeps in a generation. When it has so many, they become the last generation and a new one starts;
# words that are met again move on, others are forgotten. Two generations take about 160 MB.
WORDS = 500_000
# Of these, words with marks at their end whose letters had been met before, kept as they stand.
MARKED = 100_000

_LETTERS_ONLY = re.compile(r"[A-Za-zÀ-ÖØ-öø-ſ]+\Z")
# Not İ, whose dot is a mark in lower case.
_LETTERS_AND_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ſ]+)([!-/:-@\[-`{-~]+)\Z")


def _kept() -> dict:
    """What this process keeps from task to task."""
    return sys.modules.setdefault("_landfall_llm_kept", types.ModuleType("_landfall_llm_kept")).__dict__


class WordTokenizer:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        # Words are remembered here, and those that are new are not in the model's own cache either.
        self.model._resize_cache(0)
        self.ids: dict[str, bytes] = {}
        self.last: dict[str, bytes] = {}
        self.marked = 0
        # The tokenizer's own stand-ins for bytes, found by asking it; they serve words of letters,
        # which its normalizer only lower-cases.
        self.bytes_as = {}
        for letter in {chr(c) for c in range(0xC0, 0x180)} | set("abcdefghijklmnopqrstuvwxyz"):
            pieces = self.whole.pre_tokenizer.pre_tokenize_str(letter)
            self.bytes_as[letter] = "".join(p for p, _ in pieces)

    def _word(self, word: str) -> bytes:
        lower = word.lower()
        if lower.isascii() and lower.isalpha():
            ids = [t.id for t in self.model.tokenize(lower)]
        elif _LETTERS_ONLY.match(word) and all(c in self.bytes_as for c in lower):
            ids = [t.id for t in self.model.tokenize("".join([self.bytes_as[c] for c in lower]))]
        else:
            ids = self.whole.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        found = list(map(self.ids.get, words))
        if None in found:
            if len(self.ids) > WORDS:
                self.last, self.ids, self.marked = self.ids, {}, 0
            for at in [i for i, b in enumerate(found) if b is None]:
                found[at] = self._learnt(words[at])
        return b"".join(found)

    def _learnt(self, word: str) -> bytes:
        """Letters with marks at their end are the most common kind that is met once: two pieces, each kept, but not the whole
        unless the letters were known."""
        m = _LETTERS_AND_MARKS.match(word)
        if m is None:
            return self._piece(word)
        known = self.marked < MARKED and len(word) < 64 and m[1] in self.ids
        b = self._piece(m[1]) + self._piece(m[2])
        if known:
            self.marked += 1
            self.ids[word] = b
        return b

    def _piece(self, piece: str) -> bytes:
        b = self.ids.get(piece)
        if b is None:
            b = self.last.get(piece) or self._word(piece)
            # A very long word is not worth keeping.
            if len(piece) < 64:
                self.ids[piece] = b
        return b


def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a file on each executor, made once a process with all that it has learnt."""
    kept = _kept()
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]
