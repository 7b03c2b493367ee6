"""Near-duplicate documents by Order MinHash and banded alignment.

A text is a sequence of five-word shingles, each labelled with how often it occurred before. One
sketch hashes all labelled shingles, takes the ``LENGTH`` smallest and keeps them in the order of the
text, so texts share a sketch only if they share those shingles in that order. Texts that share any
of ``SKETCHES`` sketches are candidates. If M of U different labelled shingles are in both texts, a
sketch is shared with probability C(M, 5) / C(U, 5). At a similarity of 0.8 all 32 are missed 16
times in a million with 25 different shingles, 7 times with 50, 5 times with 100 and 3 times in
long texts.

Of texts of at most ``SHORT`` shingles the sketches say too little: five of few shingles are drawn
without replacement. They have more keys, which are exact. Texts with a similarity of 0.8 must share
one of their rarest labelled shingles, so short texts, and those long enough to be like one, have
these as keys, too.

Candidates are compared by aligning their shingles: M shingles of A and B match in order, and
M / (A + B - M) must be ``SIMILARITY`` or more. The alignment stays within the band that such
texts cannot leave.

Equal texts are one class from the start. Others are compared step by step, so that each step's pairs
are in proportion to the texts and what is in one component already is not compared again. Each
bucket of a key has a leader, the text that shares most buckets. First every text meets the greatest
of its buckets' leaders, one pair for each text. Then it meets the leaders of its buckets that are
in other components. What buckets still hold apart, the texts of those that have several components
without their leader, whom all have met, is filtered by the bound for short texts: all their
labelled shingles are counted, and only texts
that share one of their rarest ones can be alike. So texts that have a passage in common, however
many, drop out. Components that still share such a key are gathered into groups, and the texts of a
group are compared in blocks of bounded size; there another bound comes first: texts cannot match in
more shingles than they have in common, whatever the order.

Texts of fewer than five words are one shingle of all their words. Null texts and those without
words are no one's duplicates. Rows of equal key and text stay or go together. A null key's class
has the smallest known key of its class, else null.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.components import components
from casebook.llm.quality_rules import word_points
from casebook.llm.shipping import ship
from casebook.llm.words import HASHED, by_chunks, run_spans, span_keys, to_points
from casebook.workspace import write_table

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 32
LENGTH = 5
#: Shingles up to which a text's candidates are found by its rarest shingles.
SHORT = 20
#: Texts and bytes of a block, about; a task compares two blocks.
BLOCK_TEXTS = 1000
BLOCK_BYTES = 1_500_000
#: Shingles from which an alignment keeps places as lists instead of bits.
LONG = 8192
#: Hashes that a worker holds at a time.
HASHES = 1 << 21
#: Ranks of a text that are looked at for its smallest ones, about.
NEAR = 16

_random = np.random.default_rng(20_240_501)
_SEEDS = _random.integers(1, 1 << 63, SKETCHES, np.uint64)
_ODDS = _random.integers(1, 1 << 63, SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ values >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ values >> np.uint64(32)


def folded(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of several columns, by their order."""
    total = np.full(columns[0].shape, 0x51ED270B, np.uint64)
    for column in columns:
        total = mix(total * np.uint64(0x2545F4914F6CDD1D) + column)
    return total


def word_hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's code points, each with its place in the word; words in text order.

    What stands between words is hashed with them and left out of the sums, so that nothing is gathered.
    """
    found = np.empty(len(start), np.uint64)
    low = 0
    while low < len(start):
        high = max(low + 1, int(np.searchsorted(end, start[low] + HASHED, side="right")))
        first, last, own = start[low], end[high - 1], start[low:high]
        within = np.arange(last - first) - np.repeat(own - first, np.diff(own, append=last))
        edges = np.stack([own, end[low:high]], axis=1).ravel()[:-1] - first
        found[low:high] = span_keys(points[first:last], within, edges)[::2]
        low = high
    return mix(found)


def shingle_labels(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all occurrence-labelled shingles in text order, and where each text's begin."""
    points, begins = to_points(texts)
    start, end = run_spans(points, begins, word_points())
    own = word_hashes(points, start, end)
    low = np.searchsorted(start, begins)
    size, low = np.diff(low), low[:-1]
    text = np.repeat(np.arange(len(texts)), size)
    n = max(0, len(own) - SHINGLE + 1)
    inside = text[:n] == text[len(text) - n :]
    shingles = folded([own[k : k + n] for k in range(SHINGLE)])[inside]
    owner = text[:n][inside]
    if ((size > 0) & (size < SHINGLE)).any():
        for words in range(1, SHINGLE):
            short = np.flatnonzero(size == words)
            shingles = np.concatenate([shingles, folded([own[low[short] + k] for k in range(words)])])
            owner = np.concatenate([owner, short])
        by_text = np.argsort(owner, kind="stable")
        shingles, owner = shingles[by_text], owner[by_text]
    labels = mix(shingles + earlier(shingles, owner) * np.uint64(0xD6E8FEB86659FD93))
    return labels, np.searchsorted(owner, np.arange(len(texts) + 1))


def earlier(shingles: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """How often each shingle stands earlier in its text; only those that may stand there twice are put in order."""
    before = np.zeros(len(shingles), np.uint64)
    keys = mix(shingles ^ owner.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    ranked = np.sort(keys)
    several = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if len(several):
        found = np.minimum(np.searchsorted(several, keys), len(several) - 1)
        places = np.flatnonzero(several[found] == keys)
        places = places[np.lexsort((shingles[places], owner[places]))]
        same = np.zeros(len(places), bool)
        same[1:] = (shingles[places][1:] == shingles[places][:-1]) & (owner[places][1:] == owner[places][:-1])
        count = np.arange(len(places))
        before[places] = count - np.maximum.accumulate(np.where(same, 0, count))
    return before


def sketch(labels: np.ndarray) -> np.ndarray:
    """The hashes of all sketches of one text."""
    return text_sketches(labels, np.array([0, len(labels)]))[0]


def text_sketches(labels: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The hashes of all sketches of texts that have shingles, a row for each text.

    The smallest ranks of a text are found among those under a limit, which about ``NEAR`` of its ranks
    are; where fewer than ``LENGTH`` are, among all.
    """
    low, size = bounds[:-1], np.diff(bounds)
    found = np.empty((len(size), SKETCHES), np.uint64)
    for n in range(1, LENGTH + 1):
        few = np.flatnonzero(size == n)
        chosen = [np.broadcast_to(labels[low[few] + k, None], (len(few), SKETCHES)) for k in range(n)]
        found[few] = folded([np.broadcast_to(_SEEDS, (len(few), SKETCHES)), *chosen])
    many = np.flatnonzero(size > LENGTH)
    limit = np.full(len(size), np.iinfo(np.uint64).max, np.uint64)
    large = size > NEAR
    limit[large] = (2.0**64 * NEAR / size[large]).astype(np.uint64)
    limits = np.repeat(limit, size)
    for k, (seed, odd) in enumerate(zip(_SEEDS, _ODDS, strict=True)):
        places, ranks = ranks_within(labels, limits, seed, odd)
        first = np.searchsorted(places, low[many])
        n = np.searchsorted(places, bounds[1:][many]) - first
        enough = n >= LENGTH
        at = np.empty((len(many), LENGTH), np.int64)
        column = np.arange(n.max(initial=0))
        grid = np.minimum(first[enough, None] + column, len(ranks) - 1)
        grid = np.where(column < n[enough, None], ranks[grid], np.iinfo(np.uint64).max)
        at[enough] = places[first[enough, None] + least_places(grid)] if enough.any() else 0
        for row in np.flatnonzero(~enough):
            own = labels[low[many[row]] : bounds[many[row] + 1]]
            at[row] = low[many[row]] + least_places(((own ^ seed) * odd)[None, :])[0]
        found[many, k] = folded([np.full(len(many), seed), *(labels[at[:, j]] for j in range(LENGTH))])
    return found.view(np.int64)


def ranks_within(labels: np.ndarray, limits: np.ndarray, seed: np.uint64, odd: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Places and ranks of the labels whose ranks are at most their limits."""
    places, ranks = [], []
    for low in range(0, len(labels), HASHES):
        rank = (labels[low : low + HASHES] ^ seed) * odd
        place = np.flatnonzero(rank <= limits[low : low + HASHES])
        places.append(place + low)
        ranks.append(rank[place])
    return np.concatenate([np.zeros(0, np.int64), *places]), np.concatenate([np.zeros(0, np.uint64), *ranks])


def least_places(ranks: np.ndarray) -> np.ndarray:
    """Where the ``LENGTH`` smallest ranks of each row are, in order."""
    return np.sort(np.argpartition(ranks, LENGTH - 1, axis=1)[:, :LENGTH], axis=1)


def sketched(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, content (a digest of the text), n (its shingles), keys (its sketches) and few.

    few: all labelled shingles of texts that may be like a short one.
    """
    longest = int(SHORT / least + 1e-9)
    ship(docs.sparkSession)

    def sketches(rows: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        labels, bounds = shingle_labels(texts)
        size = np.diff(bounds)
        flat = text_sketches(labels, np.append(bounds[:-1][size > 0], bounds[-1])).ravel()
        offsets = np.concatenate([[0], np.cumsum((size > 0) * SKETCHES)]).astype(np.int32)
        short = size <= longest
        few = labels[np.repeat(short, size)].view(np.int64)
        ends = np.concatenate([[0], np.cumsum(size * short)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                rows.column(0),
                rows.column(1),
                pa.array(size.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(few)),
            ],
            names=["doc_id", "content", "n", "keys", "few"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_chunks(batches, 2, sketches)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, content binary, n long, keys array<long>, few array<long>"
    return docs.select("doc_id", digest(F.col("text")).alias("content"), "text").mapInArrow(rows, schema)


def digest(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def shared(keyed: DataFrame, size: str) -> DataFrame:
    """The rows whose key is in several rows, with that number. Rows are sent by their keys once and not joined to counts."""
    return keyed.withColumn(size, F.count("*").over(Window.partitionBy("key"))).filter(F.col(size) > 1)


def rarest(equal: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """id, n and key of the rarest labelled shingles of each text in ``few``; similar texts share one.

    Of n shingles at least ``least`` * n are in a similar text, so two texts that have none of their
    n - ``least`` * n + 1 first ones in common, in one order for all texts, are not similar.
    Shingles of a single text come first in the order and make no keys.
    """
    few = shared(equal.select("id", "n", F.explode("few").alias("key")), "often")
    order = F.array_sort(F.collect_list(F.struct("often", "key")))
    ordered = few.groupBy("id", "n").agg(order.alias("order"))
    first = F.col("n") - F.ceil(least * F.col("n") - 1e-9) + 1 - (F.col("n") - F.size("order"))
    taken = F.slice("order", 1, F.greatest(first, F.lit(0)).cast("int"))
    return ordered.select("id", "n", F.explode(F.transform(taken, lambda x: x["key"])).alias("key"))


def shingled(text: str) -> list[tuple[bytes, ...]]:
    words = text.encode("utf-8", "surrogatepass").split()  # at the blanks of ``word_points``
    if len(words) < SHINGLE:
        return [tuple(words)] if words else []
    return list(zip(*(words[k:] for k in range(SHINGLE)), strict=False))


def bits_of(b: list[int]) -> Callable[[int, int, int], int]:
    """Where ``b`` has a value, as bits of the ``width`` columns from ``low`` on; the square of ``b`` in memory."""
    places: dict[int, int] = {}
    for k, value in enumerate(b):
        places[value] = places.get(value, 0) | 1 << k
    return lambda value, low, width: places.get(value, 0) >> low & (1 << width) - 1


def lists_of(b: list[int]) -> Callable[[int, int, int], int]:
    """The same from sorted places, in memory that grows with ``b`` only."""
    places: dict[int, array] = {}
    for k, value in enumerate(b):
        places.setdefault(value, array("q")).append(k)

    def bits(value: int, low: int, width: int) -> int:
        own = places.get(value)
        if own is None:
            return 0
        first = bisect_left(own, low)
        last = bisect_left(own, low + width, first)
        if last - first <= 16:
            return sum(1 << place - low for place in own[first:last])
        flags = np.zeros(width, bool)
        flags[np.frombuffer(own, np.int64)[first:last] - low] = True
        return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")

    return bits


def banded_matches(a: list[int], b: list[int], band: int) -> int:
    """Most elements of ``a`` and ``b`` that match in order, at places at most ``band`` apart.

    Row by row over ``a``; the columns of ``b`` within the band are the bits of one integer, a
    cleared bit for each match won so far. Columns that the band has left are counted and shifted out.
    """
    places = bits_of(b) if len(b) < LONG else lists_of(b)
    low = width = matches = 0
    state = 0
    for k, value in enumerate(a):
        if k - band > low:
            shift = min(k - band, len(b)) - low
            out = min(shift, width)
            matches += out - (state & (1 << out) - 1).bit_count()
            state >>= out
            low, width = low + shift, width - out
            if low >= len(b):
                break
        wanted = min(k + band + 1, len(b)) - low
        if wanted > width:
            state |= (1 << wanted) - (1 << width)
            width = wanted
        hits = places(value, low, width) & state
        if hits:
            state = (state + hits | state - hits) & (1 << width) - 1
    return matches + width - state.bit_count()


def similarity(a: list, b: list, least: float = SIMILARITY) -> float:
    """Shingles matched in order by all different ones; 0 if that is below ``least``."""
    total = len(a) + len(b)
    needed = least * total / (1 + least)
    if not total or min(len(a), len(b)) < needed - 1e-9:
        return 0.0
    shared, limit = 0, min(len(a), len(b))
    while shared < limit and a[shared] == b[shared]:
        shared += 1
    tail = 0
    while tail < limit - shared and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[shared : len(a) - tail], b[shared : len(b) - tail]
    common = (Counter(a) & Counter(b)).total()
    if shared + tail + common < needed - 1e-9:
        return 0.0
    if common:
        numbers: dict = {}
        ids = [[numbers.setdefault(value, len(numbers)) for value in values] for values in (a, b)]
        common = banded_matches(*ids, int(total - 2 * needed + 1e-9) + 1)
    matched = shared + tail + common
    found = matched / (total - matched)
    return found if found >= least - 1e-12 else 0.0


def linked(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs a and b whose texts are similar, with their similarity."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("right"))

    def compared(rows: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        others = rows.column(3).to_pylist()
        found = [similarity(shingled(x), shingled(y), least) for x, y in zip(texts, others, strict=True)]
        value = pa.array(found, pa.float64())
        both = pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), value], names=["a", "b", "similarity"])
        return both.filter(pa.array([x > 0 for x in found], pa.bool_()))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_chunks(batches, 2, compared)

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(rows, "a long, b long, similarity double")


def alike_in_size(n: str, m: str, least: float) -> Column:
    return F.least(n, m) >= least * F.greatest(n, m) - 1e-9


def ordered_pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def labelled_by(ids: DataFrame, links: DataFrame) -> DataFrame:
    """id and label of all texts by their first links."""
    found = ids.join(components(links), "id", "left")
    return write_table(found.select("id", F.coalesce("label", "id").alias("label")), "labels")


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """id and label of all texts after more links; labels: id and label of all texts before."""
    if links.isEmpty():
        return labels
    a = labels.select(F.col("id").alias("a"), F.col("label").alias("x"))
    b = labels.select(F.col("id").alias("b"), F.col("label").alias("y"))
    joined = links.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    moved = components(joined).select(F.col("id").alias("label"), F.col("label").alias("to"))
    return write_table(labels.join(moved, "label", "left").select("id", F.coalesce("to", "label").alias("label")), "labels")


def still_apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their labels, of keys that hold several components."""
    placed = members.join(labels, "id")
    several = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return placed.join(several.select("key"), "key")


def all_shingles(texts: DataFrame) -> DataFrame:
    """id, n and few (all labelled shingles) of some texts."""

    def shingles(rows: pa.RecordBatch, own: list[str]) -> pa.RecordBatch:
        labels, bounds = shingle_labels(own)
        few = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(labels.view(np.int64)))
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(bounds).astype(np.int64)), few], names=["id", "n", "few"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_chunks(batches, 1, shingles)

    return texts.select("id", "text").mapInArrow(rows, "id long, n long, few array<long>")


def block_links(table: pa.Table, least: float = SIMILARITY) -> pa.Table:
    """Links that join components of a block's texts, or of two blocks' texts to each other.

    table: first and second (numbers of the blocks), block, id, label (its component) and text.
    """
    ids, label, block = (table.column(name).to_numpy() for name in ("id", "label", "block"))
    texts = table.column("text").to_pylist()
    across = table.column("first")[0] != table.column("second")[0]
    labels, bounds = shingle_labels(texts)
    size = np.diff(bounds)
    # bits of the labelled shingles that two texts have
    _, number, times = np.unique(labels, return_inverse=True, return_counts=True)
    column = (np.cumsum(times > 1) - 1)[number]
    shared = (times > 1)[number]
    bits = np.zeros((len(ids), int((times > 1).sum()) // 64 + 1), np.uint64)
    owner = np.repeat(np.arange(len(ids)), size)[shared]
    column = column[shared]
    np.bitwise_or.at(bits, (owner, column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    _, component = np.unique(label, return_inverse=True)
    cut: dict[int, list] = {}

    def of(k: int) -> list:
        if k not in cut:
            cut[k] = shingled(texts[k])
        return cut[k]

    found: list[tuple[int, int, float]] = []
    for x in range(len(ids) - 1):
        other = component[x + 1 :] != component[x]
        if across:
            other &= block[x + 1 :] != block[x]
        other = np.flatnonzero(other) + x + 1
        needed = least * (size[other] + size[x]) / (1 + least) - 1e-9
        other, needed = other[(size[other] >= needed) & (size[x] >= needed)], needed[(size[other] >= needed) & (size[x] >= needed)]
        if not len(other):
            continue
        common = np.bitwise_count(bits[other] & bits[x]).sum(axis=1)
        for y in other[common >= needed][np.argsort(-common[common >= needed], kind="stable")].tolist():
            if component[x] != component[y] and (value := similarity(of(x), of(y), least)):
                component[component == component[y]] = component[x]
                found.append((int(ids[x]), int(ids[y]), value))
    return pa.Table.from_pylist([dict(zip(("a", "b", "similarity"), row, strict=True)) for row in found], LINKS)


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])


def grouped_links(members: DataFrame, labels: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Links between texts that share a key and are in different components.

    members: key and id. Components that share keys, directly or through others, make a group; the
    texts of a group that have such a key are compared in blocks of bounded size.
    """
    here = write_table(still_apart(members.select("key", "id"), labels), "apart")
    heads = here.groupBy("key").agg(F.min("label").alias("b"))
    edges = here.join(heads, "key").select(F.col("label").alias("a"), "b").distinct()
    groups = components(edges).select(F.col("id").alias("label"), F.col("label").alias("group"))
    rows = here.select("id", "label").distinct().join(groups, "label").join(texts, "id")
    rows = write_table(rows.select("group", "id", "label", "text"), "grouped")
    sizes = rows.groupBy("group").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    rows = rows.join(sizes.select("group", parts.alias("parts")), "group")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    # every text meets its own block and each other one
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = [F.least("block", "with").alias("first"), F.greatest("block", "with").alias("second")]
    rows = rows.select("group", *pair, "block", "id", "label", "text")

    def compare(table: pa.Table) -> pa.Table:
        return block_links(table, least)

    return rows.groupBy("group", "first", "second").applyInArrow(compare, "a long, b long, similarity double")


def near_classes(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Classes of similar texts and the links found.

    First, for every row: doc_id, content, class_id (the smallest doc_id of its class) and kept.
    Second: a, b and similarity of linked texts, by the numbers of this run's classes of equal texts;
    enough of them to hold each class together.
    """
    rows = write_table(sketched(docs, least), "sketches")
    equal = rows.filter("n > 0").groupBy("content").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("few").alias("few")
    )
    equal = write_table(equal.withColumn("id", F.monotonically_increasing_id()), "equal-texts")
    keyed = equal.select("id", "n", F.explode("keys").alias("key"))
    keyed = keyed.union(write_table(rarest(equal, least), "rarest"))
    members = write_table(shared(keyed, "size"), "buckets")
    degree = write_table(members.groupBy("id").agg(F.sum("size").alias("degree")), "degrees")
    chosen = equal.join(degree, "id", "left_semi").select("id", "content", F.col("doc_id").alias("own_id"))
    chosen = write_table(chosen, "chosen")
    # four bytes a text are few enough to leave most others where they lie; what is left meets the whole digest
    hashes = write_table(chosen.select(F.hash("content").alias("hash")).distinct(), "hashes")
    texts = docs.select("doc_id", digest(F.col("text")).alias("content"), "text").withColumn("hash", F.hash("content"))
    texts = texts.join(hashes, "hash", "left_semi").drop("hash").join(chosen, "content")
    texts = texts.filter(F.col("doc_id").eqNullSafe(F.col("own_id")))
    if not rows.groupBy("doc_id", "content").count().filter("count > 1").isEmpty():
        texts = texts.dropDuplicates(["id"])
    texts = write_table(texts.select("id", "text"), "texts")
    # one pair for each text: with the greatest of its buckets' leaders
    leaders = members.join(degree, "id").groupBy("key").agg(F.max(F.struct("degree", "id", "n")).alias("top"))
    led = write_table(members.join(leaders, "key").filter(F.col("id") != F.col("top.id")), "led")
    candidates = led.filter(alike_in_size("n", "top.n", least)).select("id", "top").distinct()
    candidates = write_table(candidates, "candidates")
    best = candidates.groupBy("id").agg(F.max("top").alias("top")).select(*ordered_pair("id", "top.id")).distinct()
    best = write_table(best, "pairs")
    links = write_table(linked(best, texts, least), "links")
    labels = labelled_by(degree.select("id"), links)
    # then with the leaders that are in other components
    others = candidates.select("id", F.col("top.id").alias("lead")).join(labels, "id")
    others = others.join(labels.select(F.col("id").alias("lead"), F.col("label").alias("own")), "lead")
    others = others.filter("label <> own").select(*ordered_pair("id", "lead")).distinct()
    others = write_table(others.join(best, ["a", "b"], "left_anti"), "pairs")
    if not others.isEmpty():
        more = write_table(linked(others, texts, least), "links")
        labels = relabelled(labels, more)
        links = links.union(more)
    # texts of buckets that are still apart, by their rarest shingles; each has met its buckets' leaders
    apart = write_table(still_apart(led.select("key", "id"), labels).select("id").distinct(), "apart")
    if not apart.isEmpty():
        few = write_table(all_shingles(texts.join(apart, "id", "left_semi")), "shingles")
        more = write_table(grouped_links(write_table(rarest(few, least), "rarest"), labels, texts, least), "links")
        labels = relabelled(labels, more)
        links = links.union(more)
    found = equal.select("content", "id", "doc_id").join(labels, "id", "left")
    found = found.withColumn("label", F.coalesce("label", "id"))
    # the smallest key; of equal keys the smallest digest
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "content")
    first = found.groupBy("label").agg(F.min(order).alias("first"))
    found = found.join(first, "label").select("content", "first")
    classes = rows.select("doc_id", "content", "n").join(found, "content", "left")
    some = F.col("n") > 0
    own = F.when(some, F.col("first.doc_id")).otherwise(F.col("doc_id"))
    kept = ~some | F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("content") == F.col("first.content"))
    return classes.select("doc_id", "content", own.alias("class_id"), kept.alias("kept")), links


def deduplicated(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id and kept: whether it is the document of its class that stays."""
    return near_classes(docs, least)[0].drop("content")


def without_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each class."""
    kept = near_classes(docs, least)[0].filter("kept")
    kept = kept.select(F.col("doc_id").alias("own_id"), F.col("content").alias("own_content"))
    same = docs["doc_id"].eqNullSafe(F.col("own_id")) & (digest(docs["text"]).eqNullSafe(F.col("own_content")))
    return docs.join(kept, same, "left_semi")
