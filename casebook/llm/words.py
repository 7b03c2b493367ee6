"""Texts cut into words with numpy, each distinct word known once.

The texts of a chunk are one array of code points. Words are found by comparing neighbours, and
numbered by a hash that is then checked point by point, so equal numbers always mean equal words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Code points handled at a time; bounds a worker's memory. A longer text makes a chunk of its own.
CHUNK = 1_500_000
#: Code points of spans that are hashed and compared at a time.
HASHED = 1 << 18

OTHER, LETTER, NUMBER, SPACE = range(4)


@dataclass
class Words:
    """start, end: code points of each word. text: the row it stands in. word: its number.

    first: a span of each number. key: its hash, which different words may share. points: all code points.
    """

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    word: np.ndarray
    first: np.ndarray
    key: np.ndarray
    points: np.ndarray
    joined: str

    def strings(self, numbers: np.ndarray) -> list[str]:
        """The words of these numbers."""
        chosen = self.first[numbers]
        return [self.joined[a:b] for a, b in zip(self.start[chosen].tolist(), self.end[chosen].tolist(), strict=True)]

    @property
    def distinct(self) -> list[str]:
        return self.strings(np.arange(len(self.first)))


@cache
def all_points() -> str:
    """Every code point that a text can hold, in order."""
    return "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))


def point_table(patterns: dict[int, str]) -> np.ndarray:
    """A class for every code point: the number whose pattern it matches, else 0."""
    table = np.zeros(0x110000, np.uint8)
    for number, pattern in patterns.items():
        for run in regex.finditer(f"(?:{pattern})+", all_points()):
            low, high = ord(run[0][0]), ord(run[0][-1])
            table[low : high + 1] = number
    table[0xD800:0xE000] = 0
    return table


@cache
def bpe_classes() -> np.ndarray:
    return point_table({LETTER: r"\p{L}", NUMBER: r"\p{N}", SPACE: r"\s"})


def to_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after another, and where each text begins (and the end)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(text) for text in texts], out=begins[1:])
    return points, begins


def chunks(lengths: list[int], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Consecutive rows, from and to, of about ``size`` code points together; never part of a row."""
    low = total = 0
    for row, length in enumerate(lengths):
        if row > low and total + length > size:
            yield low, row
            low, total = row, 0
        total += length
    if low < len(lengths):
        yield low, len(lengths)


def by_chunks[T](
    batches: Iterator[pa.RecordBatch], column: int, work: Callable[[pa.RecordBatch, list[str]], T], size: int = CHUNK
) -> Iterator[T]:
    """``work`` of the rows of each chunk and their texts (null: empty).

    Only a chunk's texts are strings at a time. A batch is let go before the next is read, and what
    Arrow kept of its memory given back: workers live on beside the stages that follow.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_pylist()
        for low, high in chunks(lengths, size):
            rows = batch.slice(low, high - low)
            yield work(rows, [text or "" for text in rows.column(column).to_pylist()])
        batch = rows = None
        pa.default_memory_pool().release_unused()


def pieces(text: str, size: int = CHUNK) -> list[str]:
    """A long text cut before single blanks between other characters, where no token spans.

    A text without such a blank stays whole.
    """
    found, low = [], 0
    while len(text) - low > size:
        cut = text.rfind(" ", low + 1, low + size)
        while cut > low and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.rfind(" ", low + 1, cut)
        if cut <= low:
            cut = text.find(" ", low + size)
            while 0 < cut < len(text) - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
                cut = text.find(" ", cut + 1)
            if cut < 0 or cut >= len(text) - 1:
                break
        found.append(text[low:cut])
        low = cut
    found.append(text[low:])
    return found


def span_keys(points: np.ndarray, within: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each span: of its code points, each with its place in the span."""
    mixed = points.astype(np.uint64)
    mixed += np.uint64(0x9E3779B97F4A7C15)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    places = within.astype(np.uint64)
    places *= np.uint64(2)
    places += np.uint64(0x94D049BB133111EB)
    mixed *= places
    mixed ^= np.right_shift(mixed, np.uint64(32), out=places)
    return np.add.reduceat(mixed, first)


def _places(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every place in the spans, its place within its span, and where each span begins among them."""
    first = np.cumsum(length) - length
    within = np.arange(length.sum(), dtype=np.int64)
    within -= np.repeat(first, length)
    return within + np.repeat(start, length), within, first


def _block_keys(points: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    place, within, first = _places(start, length)
    return span_keys(points[place], within, first)


def _block_same(points: np.ndarray, start: np.ndarray, other: np.ndarray, length: np.ndarray) -> bool:
    """Whether the spans from ``start`` are those from ``other``."""
    return np.array_equal(points[_places(start, length)[0]], points[_places(other, length)[0]])


def numbered(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each span, equal for equal spans, and the first span of each number."""
    return numbered_with_keys(points, start, end)[:2]


def numbered_with_keys(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each span, the first span of each number, and its hash."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    length = end - start
    blocks = list(chunks(length.tolist(), HASHED))
    keys = np.concatenate([_block_keys(points, start[low:high], length[low:high]) for low, high in blocks])
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    first = np.minimum.reduceat(order, np.flatnonzero(new))
    like = first[number]
    if (length == length[like]).all() and all(
        _block_same(points, start[low:high], start[like[low:high]], length[low:high]) for low, high in blocks
    ):
        return number, first, ranked[new]
    known: dict[bytes, int] = {}  # two spans share a hash: number them by their content
    number = np.fromiter(
        (known.setdefault(points[a:b].tobytes(), len(known)) for a, b in zip(start.tolist(), end.tolist(), strict=True)),
        np.int64,
        len(start),
    )
    first = np.unique(number, return_index=True)[1]
    return number, first, keys[first]


def _collected(points: np.ndarray, begins: np.ndarray, joined: str, start: np.ndarray, end: np.ndarray) -> Words:
    word, first, key = numbered_with_keys(points, start, end)
    text = np.searchsorted(begins, start, side="right") - 1
    return Words(start, end, text, word, first, key, points, joined)


def runs(texts: list[str], inside: np.ndarray) -> Words:
    """Words are the longest runs of code points that ``inside`` marks."""
    points, begins = to_points(texts)
    start, end = run_spans(points, begins, inside)
    return _collected(points, begins, "".join(texts), start, end)


def run_spans(points: np.ndarray, begins: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of marked code points; no run crosses from text to text."""
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marked = inside[points].astype(bool)
    opens = marked.copy()
    opens[1:] &= ~marked[:-1]
    closes = marked.copy()
    closes[:-1] &= ~marked[1:]
    edges = begins[(begins > 0) & (begins < len(points))]
    opens[edges] = marked[edges]
    closes[edges - 1] = marked[edges - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def bpe_words(texts: list[str]) -> Words:
    """Words as the byte-level BPE pattern cuts them.

    The pattern: ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
    """
    points, begins = to_points(texts)
    n = len(points)
    if not n:
        return _collected(points, begins, "", *[np.zeros(0, np.int64)] * 2)
    kind = bpe_classes()[points]
    edge = np.zeros(n + 1, bool)
    edge[begins] = True
    cut = edge[:-1].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n)
    # the last blank before a word stands apart from the others; a simple blank joins the word
    before = end[(kind[start] == SPACE) & ~edge[end]]
    cut[before - 1] = True
    cut[before[points[before - 1] == ord(" ")]] = False
    # an apostrophe that begins a word takes the ending after it
    quote = start[(end - start == 1) & (points[start] == ord("'"))]
    quote = quote[cut[quote] & ~edge[quote + 1]]
    after = points[quote + 1]
    third = np.minimum(quote + 2, n - 1)
    then = np.where(edge[np.minimum(quote + 2, n)], 0, points[third])
    one = np.isin(after, [ord(c) for c in "stmd"])
    two = ((after == ord("r")) | (after == ord("v"))) & (then == ord("e")) | (after == ord("l")) & (then == ord("l"))
    cut[quote[one | two] + 1] = False
    stop = np.concatenate([quote[one] + 2, quote[two] + 3])
    cut[stop[stop < n]] = True
    start = np.flatnonzero(cut)
    return _collected(points, begins, "".join(texts), start, np.append(start[1:], n))
