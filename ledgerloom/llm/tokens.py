"""Token ids of whole texts by a public word BPE, through a cache of distinct words.

The tokenizer drops white space and merges only within a word, so a text's ids
are its words' ids in order.  Most words repeat; each distinct one is taken
apart once, with the tokenizer's own normaliser, splitter and model (words that
may hold a special token go through the whole tokenizer), and a batch is put
together from the cache by array operations.  When the cache is full, the words
used once since then are forgotten and of the others the most used half of it
stays; that costs time, not results.  A worker process keeps its tokenizer and
cache from one task to the next (``shared``).
"""

from __future__ import annotations

import re
import sys
import types
from itertools import chain

import numpy as np

MOST_WORDS = 400_000
MARKS = ",.;:!?"
#: White space of which every kind certainly ends a word for the tokenizer.
SPACES = bytes.maketrans(b"\t\n\r", b"   ")
#: The same with A-Z in lower case, for ASCII texts without special tokens: lower case is all the tokenizer does to them next.
LOWER_SPACES = SPACES.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
#: ASCII and the Latin-1 letters: composed, with simple lower case, so these patterns read them as the tokenizer does.
LATIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


class Numbers(dict):
    """Word -> its number; a new word gets the next one, and its ids are kept in ``ids`` until they are stored."""

    def __init__(self, ids_of):
        super().__init__({b"": 0})
        self.ids_of, self.ids = ids_of, []

    def __missing__(self, word: bytes) -> int:
        self.ids.append(self.ids_of(word.decode()))
        self[word] = number = len(self)
        return number


class WordIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize        # the model's own merges; looking it up each time costs as much again
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        # The byte alphabet's spelling of the letters beyond ASCII.
        self.spelling = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7}
        self.marks = {m: self._part(m) for m in MARKS}
        self.clear()

    def clear(self) -> None:
        self.index = Numbers(self._word)
        self.size = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.hits = np.zeros(1, np.int64)

    def forget(self) -> None:
        """Keeps the words that were used again, the most used MOST_WORDS / 2 at most."""
        at = np.flatnonzero(self.hits > 1)
        at = at[at > 0]
        if len(at) > MOST_WORDS // 2:
            at = np.sort(at[np.argsort(-self.hits[at], kind="stable")[:MOST_WORDS // 2]])
        words = list(self.index)
        upto = np.cumsum(self.size)
        index = Numbers(self._word)
        index.update((words[i], k) for k, i in enumerate(at.tolist(), 1))
        n = self.size[at]
        place = np.arange(n.sum()) + np.repeat(upto[at] - n - (np.cumsum(n) - n), n)
        self.flat = self.flat[place]
        self.size = np.concatenate([[0], n])
        self.hits = np.concatenate([[0], self.hits[at] // 2])
        self.index = index

    def _part(self, part: str) -> list[int]:
        return [t.id for t in self.tokenize(part if part.isascii() else part.translate(self.spelling))]

    def _word(self, word: str) -> list[int]:
        stem = word[:-1] if word[-1] in MARKS else word
        if stem.isalpha() and (stem.isascii() or LETTERS.fullmatch(stem)):   # most words: letters, perhaps with one mark after them
            ids = self._part(stem.lower())
            return ids if stem is word else ids + self.marks[word[-1]]
        if "<" in word and any(s in word for s in self.special):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        if LATIN.fullmatch(word):
            return [i for p in PARTS.findall(word.lower()) for i in (self.marks[p] if p in self.marks else self._part(p))]
        spelled = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(word))
        return [t.id for p, _ in spelled for t in self.tokenize(p)]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, bounds of each text's ids) of UTF-8 texts."""
        if len(self.index) > MOST_WORDS:
            self.forget()
        split = [text.translate(LOWER_SPACES if text.isascii() and b"<|" not in text else SPACES).split(b" ") for text in texts]
        count = sum(map(len, split))
        used = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, count)
        if self.index.ids:
            self.size = np.concatenate([self.size, np.fromiter(map(len, self.index.ids), np.int64, len(self.index.ids))])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(self.index.ids), np.uint32)])
            self.index.ids = []
            self.hits = np.concatenate([self.hits, np.zeros(len(self.size) - len(self.hits), np.int64)])
        self.hits += np.bincount(used, minlength=len(self.hits))
        begin = np.cumsum(self.size) - self.size
        n = self.size[used]
        upto = np.cumsum(n)
        place = np.arange(upto[-1] if len(upto) else 0) + np.repeat(begin[used] - (upto - n), n)
        words_upto = np.cumsum([0, *map(len, split)])
        return self.flat[place], np.concatenate([[0], upto])[words_upto]


def shared(path: str) -> WordIds:
    """This process's WordIds of ``path``; that of another path is dropped.

    The package is pickled by value, so its own module variables are new in every task; this one is not.
    """
    held = sys.modules.setdefault("_ledgerloom_worker", types.ModuleType("_ledgerloom_worker"))
    if getattr(held, "path", None) != path:
        held.words, held.path = WordIds(path), path
    return held.words
