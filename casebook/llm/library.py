"""Vocabulary files of public tokenizers, run through their libraries over distinct words."""

from __future__ import annotations

import base64
import os
from functools import cache
from itertools import chain

import numpy as np

from casebook.llm.bpe import byte_letters, encode_texts
from casebook.llm.words import Words

#: Words that a worker remembers; when there are more it forgets those that it met once.
REMEMBERED = 450_000


def byte_bpe_path() -> str:
    """The vocabulary of the registered queries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def many_languages_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Growing:
    """An array that is added to."""

    def __init__(self, kind: type, values: np.ndarray | None = None):
        self.held = np.zeros(0, kind) if values is None else values
        self.size = len(self.held)

    def add(self, values: np.ndarray) -> None:
        if (size := self.size + len(values)) > len(self.held):
            held = np.empty(size + size // 2, self.held.dtype)
            held[: self.size] = self.values
            self.held = held
        self.held[self.size : size] = values
        self.size = size

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.size]


def within_spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Every place in the spans, one span after another."""
    return np.arange(length.sum()) + np.repeat(start - (np.cumsum(length) - length), length)


class Remembered:
    """Words and their ids in arrays. A word is found by its hash and then compared point by point."""

    def __init__(self):
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # rising hashes; the word of each
        self.points, self.begin, self.length = Growing(np.uint32), Growing(np.int64), Growing(np.int64)
        self.ids, self.first, self.sizes = Growing(np.uint32), Growing(np.int64), Growing(np.int64)
        self.uses = Growing(np.int64)

    def places(self, words: Words) -> np.ndarray:
        """The place of each distinct word, or -1."""
        found = np.full(len(words.first), -1)
        if not len(self.keys):
            return found
        start = words.start[words.first]
        length = words.end[words.first] - start
        at = np.minimum(np.searchsorted(self.keys, words.key), len(self.keys) - 1)
        own = self.place[at]
        like = np.flatnonzero((self.keys[at] == words.key) & (self.length.values[own] == length))
        if not len(like):
            return found
        own, start, length = own[like], start[like], length[like]
        same = words.points[within_spans(start, length)] == self.points.values[within_spans(self.begin.values[own], length)]
        same = np.logical_and.reduceat(same, np.cumsum(length) - length)
        found[like[same]] = own[same]
        return found

    def add(self, words: Words, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Remember these of the distinct words with their ids; returns their places."""
        start = words.start[words.first[numbers]]
        length = words.end[words.first[numbers]] - start
        places = self.uses.size + np.arange(len(numbers))
        self.begin.add(self.points.size + np.cumsum(length) - length)
        self.length.add(length)
        self.points.add(words.points[within_spans(start, length)])
        self.first.add(self.ids.size + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.ids.add(ids)
        self.uses.add(np.ones(len(numbers), np.int64))
        # of words that share a hash only one is found again
        key, one = np.unique(words.key[numbers], return_index=True)
        at = np.searchsorted(self.keys, key)
        free = np.append(self.keys, ~key[-1:])[at] != key
        self.keys = np.insert(self.keys, at[free], key[free])
        self.place = np.insert(self.place, at[free], places[one[free]])
        return places

    def used_again(self, most: int) -> Remembered:
        """The words that were met again since they were remembered or kept, at most so many."""
        uses = self.uses.values
        kept = np.flatnonzero(uses > 1)
        if len(kept) > most:
            kept = np.sort(kept[np.argsort(-uses[kept], kind="stable")[:most]])
        stays = np.zeros(len(uses), bool)
        stays[kept] = True
        found, places = Remembered(), np.cumsum(stays) - 1
        found.keys, found.place = self.keys[stays[self.place]], places[self.place[stays[self.place]]]
        found.length, found.sizes = Growing(np.int64, self.length.values[kept]), Growing(np.int64, self.sizes.values[kept])
        found.points = Growing(np.uint32, self.points.values[within_spans(self.begin.values[kept], found.length.values)])
        found.ids = Growing(np.uint32, self.ids.values[within_spans(self.first.values[kept], found.sizes.values)])
        found.begin = Growing(np.int64, np.cumsum(found.length.values) - found.length.values)
        found.first = Growing(np.int64, np.cumsum(found.sizes.values) - found.sizes.values)
        found.uses = Growing(np.int64, np.ones(len(kept), np.int64))
        return found


class Library:
    """A byte-level vocabulary: ``.json`` for the tokenizers library, ``.tiktoken`` for tiktoken."""

    def __init__(self, path: str):
        self.remembered = Remembered()
        self.special: dict[str, int] = {}
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            self.special = {token.content: k for k, token in tokenizer.get_added_tokens_decoder().items()}
            # words are cut already, so the library's model gets them as they are, in its letters for bytes
            tokenize = tokenizer.model.tokenize
            letters = {byte: letter for letter, byte in byte_letters().items()}
            self.run = lambda words: [
                [token.id for token in tokenize(word.encode().decode("latin-1").translate(letters))]
                for word in words
            ]
        else:
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            encoding = tiktoken.Encoding(
                "casebook", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
            self.run = lambda words: encoding.encode_ordinary_batch(words, num_threads=1)

    def encode_words(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each of the distinct words where its own begin and how many they are."""
        known = self.remembered
        place = known.places(words)
        met, missing = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        known.uses.held[place[met]] += 1
        if len(missing):
            encoded = self.run(words.strings(missing))
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
            ids = np.fromiter(chain.from_iterable(encoded), np.uint32, int(sizes.sum()))
            place[missing] = known.add(words, missing, ids, sizes)
        found = known.ids.values, known.first.values[place], known.sizes.values[place]
        if known.uses.size > REMEMBERED:
            self.remembered = known.used_again(REMEMBERED // 2)
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of every text."""
        return encode_texts(texts, self.encode_words, self.special)


@cache
def library(path: str) -> Library:
    return Library(path)
