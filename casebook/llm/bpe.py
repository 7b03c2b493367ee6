"""Byte-pair encoding by a walk over the trie of a chunk's distinct words, and decoding.

A BPE encoding is valid when each two neighbouring tokens, joined and encoded, give themselves
again. Every prefix of a word therefore has exactly one last token: the one that ends the prefix
and fits the last token of what stands before it. The walk visits the trie depth first, keeps the
last token of each prefix on its path, and so finds a prefix shared by many words once.

A null text is empty; an empty text has no token. Very long texts are cut where no token spans.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.shipping import ship
from casebook.llm.words import CHUNK, Words, bpe_words, by_chunks, chunks, pieces

#: Code points that are encoded at a time; the words remembered serve all chunks.
ENCODED = 400_000
#: Words and token pairs that a worker remembers; it forgets all when there are more.
REMEMBERED = 150_000
PAIRS = 600_000


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + k): byte for k, byte in enumerate(moved)}


class Codec:
    """One vocabulary: encoding by the trie walk, decoding by table."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = byte_letters()
        model = content["model"]
        self.bytes_of = {k: bytes(letters[c] for c in token) for token, k in model["vocab"].items()}
        self.id_of = {token: k for k, token in self.bytes_of.items()}
        merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        self.merges = {
            (model["vocab"][a], model["vocab"][b]): (rank, model["vocab"][a + b])
            for rank, (a, b) in enumerate(merges)
        }
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.parts = {token: (rank, *pair) for pair, (rank, token) in self.merges.items()}
        self.size_of = {k: len(token) for k, token in self.bytes_of.items()}
        self.backwards: dict = {}  # the vocabulary as a trie from the last byte; -1: the token that begins here
        for k, token in self.bytes_of.items():
            node = self.backwards
            for byte in reversed(token):
                node = node.setdefault(byte, {})
            node[-1] = k
        self.fitting: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        table = self.bytes_of | {k: text.encode() for text, k in self.special.items()}
        self.sizes = np.zeros(max(table) + 1, np.int64)
        for k, token in table.items():
            self.sizes[k] = len(token)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(table.get(k, b"") for k in range(len(self.sizes))), np.uint8)

    def merged(self, word: bytes) -> list[int]:
        """The textbook encoding: merge the pair of lowest rank until none is left."""
        tokens = [self.id_of[word[k : k + 1]] for k in range(len(word))]
        while len(tokens) > 1:
            ranks = [self.merges.get(pair, (len(self.merges), 0)) for pair in zip(tokens, tokens[1:], strict=False)]
            rank, token = min(ranks)
            if rank == len(self.merges):
                break
            pair, out, k = tokens[ranks.index((rank, token)) :][:2], [], 0
            while k < len(tokens):
                if tokens[k : k + 2] == pair:
                    out.append(token)
                    k += 2
                else:
                    out.append(tokens[k])
                    k += 1
            tokens = out
        return tokens

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` can follow; before -1: whether it can begin a word.

        Undoes the later of the two merges beside the border, again and again. The pair fits if no
        pair that meets at the border would have been merged before the merge just undone; of equal
        merges the left one comes first.
        """
        if before < 0:
            return self.merged(self.bytes_of[token]) == [token]
        limit = len(self.merges)
        while True:
            if (across := self.merges.get((before, token))) and across[0] < limit:
                return False
            left, right = self.parts.get(before, (-1, 0, 0)), self.parts.get(token, (-1, 0, 0))
            if left[0] > right[0]:
                limit, before = left[0], left[2]
            elif right[0] >= 0:
                limit, token = right[0] + 1, right[1]
            else:
                return True

    def walk(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Tokens of every word. Sorted words are the trie's leaves in depth-first order."""
        found: list[tuple[int, ...]] = [()] * len(words)
        sizes, fitting, span = self.size_of, self.fitting, len(self.sizes)
        last, previous = [-1], b""  # last[d]: last token of the path's first d bytes
        for k in sorted(range(len(words)), key=words.__getitem__):
            word = words[k]
            shared = 0
            for a, b in zip(previous, word, strict=False):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :]
            for depth in range(shared + 1, len(word) + 1):
                node, low, ending = self.backwards, depth, []
                while low and (node := node.get(word[low - 1])):
                    low -= 1
                    if (token := node.get(-1)) is not None:
                        ending.append((low, token))
                for low, token in reversed(ending):
                    pair = last[low] * span + token
                    if (answer := fitting.get(pair)) is None:
                        if len(fitting) >= PAIRS:
                            fitting.clear()
                        answer = fitting[pair] = self.fits(last[low], token)
                    if answer:
                        last.append(token)
                        break
            previous = word
            tokens, depth = [], len(word)
            while depth:
                tokens.append(token := last[depth])
                depth -= sizes[token]
            tokens.reverse()
            found[k] = tuple(tokens)
        return found

    def encode_words(self, cut: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each of the distinct words where its own begin and how many they are."""
        words = cut.distinct
        found = [self.known.get(word) for word in words]
        missing = [k for k, tokens in enumerate(found) if tokens is None]
        if len(self.known) + len(missing) > REMEMBERED:
            self.known.clear()
        for k, tokens in zip(missing, self.walk([words[k].encode() for k in missing]), strict=True):
            found[k] = tokens
            if len(self.known) < REMEMBERED:
                self.known[words[k]] = tokens
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        return flat, np.cumsum(sizes) - sizes, sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of every text."""
        return encode_texts(texts, self.encode_words, self.special, ENCODED)

    def decode(self, tokens: np.ndarray) -> bytes:
        """The text of the ids, as UTF-8; bytes that are no UTF-8 become U+FFFD."""
        sizes = self.sizes[tokens]
        where = np.repeat(self.starts[tokens] - (np.cumsum(sizes) - sizes), sizes)
        where += np.arange(len(where))
        return self.flat[where].tobytes().decode("utf-8", "replace").encode()


def encode_texts(texts: list[str], encode_words, special: dict[str, int], size: int = CHUNK) -> list[np.ndarray]:
    """Token ids of every text, from a function that encodes distinct words.

    It returns ids, and for each word where its own begin and how many they are. size: code points at a time.

    The strings of special tokens in a text become those tokens, as the tokenizers library does.
    """
    parts: list[str] = []
    owner: list[int] = []
    after: list[int] = []  # the special token after each part, or -1
    for row, text in enumerate(texts):
        rest = [(text, -1)]
        for string, token in special.items():
            if string in text:
                rest = [
                    (part, token if k < count else then)
                    for whole, then in rest
                    for count in [whole.count(string)]
                    for k, part in enumerate(whole.split(string))
                ]
        for part, then in rest:
            cut = pieces(part, size)
            parts += cut
            owner += [row] * len(cut)
            after += [-1] * (len(cut) - 1) + [then]
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for low, high in chunks(list(map(len, parts)), size):
        words = bpe_words(parts[low:high])
        flat, first, sizes = encode_words(words)
        each = sizes[words.word]
        where = np.repeat(first[words.word] - (np.cumsum(each) - each), each)
        where += np.arange(len(where))
        tokens = flat[where]
        total = np.concatenate([[0], np.cumsum(each)])
        bounds = total[np.searchsorted(words.text, np.arange(high - low + 1))]
        for k in range(low, high):
            found[owner[k]].append(tokens[bounds[k - low] : bounds[k - low + 1]])
            if after[k] >= 0:
                found[owner[k]].append(np.array([after[k]], np.uint32))
    return [parts[0] if len(parts) == 1 else np.concatenate(parts) for parts in found]


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its key, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``.

    Rows are independent: no shuffle, and a lost task is run again on its own input. Repeated keys
    give repeated rows; other columns are not kept.
    """
    ship(df.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(vocabulary)

        def both(rows: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            tokens = code.encode(texts)
            return pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([ids.astype("<u4").tobytes() for ids in tokens], pa.binary()),
                    pa.array([code.decode(ids) for ids in tokens], pa.binary()).cast(pa.string()),
                ],
                names=[key, "ids", "decoded"],
            )

        return by_chunks(batches, 1, both, ENCODED)

    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, ids binary, decoded string"
    return df.select(key, text).mapInArrow(rows, schema)


def digests(df: DataFrame, vocabulary: str) -> DataFrame:
    """Number of tokens and checksums of ids and decoded text for each document."""
    both = encode_decode(df, vocabulary)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
