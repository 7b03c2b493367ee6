"""Exact removal of byte strings that the corpus has before, by two-stage suffix sorting.

A byte goes if a string of ``SIZE`` bytes that covers it also starts earlier: in a document of
smaller key or earlier in the same one. Strings are those of the input and never cross documents.

Suffix arrays are built over blocks that each hold all places of the strings they decide on. Every
window of SIZE bytes chooses the leftmost smallest hash of its ``GRAM``-byte strings; equal windows
choose the same hash at the same place, so sending windows by that hash brings equal ones together.
Windows with one choice are sent as one context, a stretch of text. Only hashes that occur twice are
sent at all; the others cannot hold a repeated window.

In a block, suffixes of all contexts are sorted in two stages: only those smaller than their
successors are sorted directly, the others follow by a scan over the buckets of first bytes. Equal
windows are then neighbours with a common prefix of SIZE bytes, and all but the first are repeats.
Where the contexts of one hash would fill more than a block, as at the edge of a passage that very
many documents have, each of its windows is sent alone, by a hash of all its bytes.

Documents with equal texts are compared once, through the first of them; the others go whole. A
context that a task meets twice leaves it once. Null texts are empty. Null keys come last. Rows of
equal key are ordered by a hash of their text; rows of equal key and text are one document, and each
gets its result. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.shipping import ship
from casebook.llm.words import chunks
from casebook.workspace import new_folder, write_table

SIZE = 100
GRAM = 24
#: Bytes of text whose windows are hashed at a time; a longer text makes a step of its own.
STEP = 2_000_000
#: Bytes of contexts in a block, about, and of one hash from which its windows are dealt one by one.
BLOCK = 2_000_000
#: Neighbours compared at a time, and contexts that a task hands over at once.
PIECE = 1 << 17
ROWS = 20_000
LAST_KEY = (1 << 63) - 1


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    n = len(data) - GRAM + 1
    total = np.full(n, 0x243F6A8885A308D3, np.uint64)
    words = np.ndarray(len(data) - 7, "<u8", data.tobytes(), strides=(1,))
    for place in range(0, GRAM, 8):
        total = (total ^ words[place : place + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    return total


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbouring values."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def choices(data: np.ndarray, begins: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, ...]:
    """Which windows chose which hash: hash, first and last window and the text they are in.

    data: all texts' bytes, begins: where each begins, and the end. Windows are named by their first
    byte within the text. A row stands for neighbouring windows that chose the same place.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < size:
        return np.zeros(0, np.uint64), empty, empty, empty
    hashes = gram_hashes(data)
    width = size - GRAM + 1
    least = window_minima(hashes, width)
    text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))[: len(least)]
    inside = np.arange(len(least)) + size <= begins[text + 1]
    opens = inside.copy()
    opens[1:] &= (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= opens[1:] | ~inside[1:]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    found = []
    while len(first):
        # the leftmost place of the minimum; windows after it need the next place
        place, value = first.copy(), least[first]
        waiting = np.flatnonzero(hashes[place] != value)
        while len(waiting):
            place[waiting] += 1
            waiting = waiting[hashes[place[waiting]] != value[waiting]]
        found.append((first, np.minimum(last, place)))
        first, last = place[last > place] + 1, last[last > place]
    first, last = (np.concatenate([pair[k] for pair in found]) for k in range(2)) if found else (empty, empty)
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    own = text[first]
    return least[first], first - begins[own], last - begins[own], own


def rises(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """1 where the next different byte is larger, -1 where it is smaller or the context ends before."""
    step = np.zeros(len(data), np.int8)
    step[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    step[ends - 1] = -1
    where = np.where(step != 0, np.arange(len(data), dtype=np.int32), np.int32(len(data)))
    return step[np.minimum.accumulate(where[::-1])[::-1]]


def sort_suffixes(data: np.ndarray, context: np.ndarray, place: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes in order of their first SIZE bytes; a context's end is smaller than any byte.

    data: the contexts' bytes. place: the suffixes' first bytes, ascending. context, ends: of each
    suffix its context, and of each context its end. Within a context the places are neighbours, and
    the last is smaller than its successor or ends the context.
    """
    n = len(place)
    first = data[place]
    smaller = (rises(data, ends) > 0)[place]
    chained = np.zeros(n, bool)  # the successor is a suffix here, too
    chained[:-1] = (context[1:] == context[:-1]) & (place[1:] == place[:-1] + 1)
    direct = np.flatnonzero(smaller | ~chained).astype(np.int32)
    direct = direct[np.argsort(first[direct], kind="stable")]
    edges = np.searchsorted(first[direct], np.arange(257))
    strings = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(SIZE, np.uint8)]), SIZE)
    for low, high in itertools.pairwise(edges.tolist()):  # one bucket's keys at a time
        own = direct[low:high]
        keys = strings[place[own]]
        room = ends[context[own]] - place[own]
        short = np.flatnonzero(room < SIZE)
        keys[short] *= np.arange(SIZE) < room[short][:, None]
        direct[low:high] = own[np.argsort(keys.view(f"S{SIZE}").reshape(-1), kind="stable")]
    # larger ones follow from their successors, bucket by bucket of the first byte
    follows = np.full(n, -1, np.int32)  # the suffix one byte longer, if it is to be induced
    induced = np.flatnonzero(chained & ~smaller)
    follows[induced + 1] = induced
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []

    def induce(scanned: np.ndarray) -> None:
        longer = follows[scanned]
        longer = longer[longer >= 0]
        if len(longer):
            bucket = first[longer]
            longer = longer[np.argsort(bucket, kind="stable")]
            counts = np.bincount(bucket, minlength=256)
            stops = np.cumsum(counts)
            for byte in np.flatnonzero(counts).tolist():
                waiting[byte].append(longer[stops[byte] - counts[byte] : stops[byte]])

    for byte in range(256):
        own = direct[edges[byte] : edges[byte + 1]]
        ended = ~smaller[own]  # ends of contexts: one byte, before all others of the bucket
        order.append(own[ended])
        induce(own[ended])
        while waiting[byte]:
            scanned = waiting[byte].pop(0)
            order.append(scanned)
            induce(scanned)
        order.append(own[~ended])
        induce(own[~ended])
    return np.concatenate(order)


def common_prefixes(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Bytes, up to SIZE, that each suffix has in common with the one before it; 0 for the first."""
    found = np.zeros(len(place), np.uint8)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).tobytes()
    words = np.ndarray(len(data), "<u8", padded, strides=(1,))
    for low in range(1, len(place), PIECE):
        alike = np.arange(low, min(low + PIECE, len(place)))
        for depth in range(0, SIZE, 8):
            differ = words[place[alike] + depth] ^ words[place[alike - 1] + depth]
            if SIZE - depth < 8:
                differ &= np.uint64((1 << 8 * (SIZE - depth)) - 1)
            same = differ == 0
            stopped = differ[~same]
            lowest = stopped & (~stopped + np.uint64(1))
            found[alike[~same]] = depth + (np.log2(lowest.astype(np.float64)) // 8).astype(np.uint8)
            alike = alike[same]
        found[alike] = SIZE
    return found


def repeats(contexts: list[bytes], rank: np.ndarray, start: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Windows that an earlier one equals: the context and the window's place in it.

    rank: order of each context's document; start: the context's place in the document.
    """
    data = np.frombuffer(b"".join(contexts), np.uint8)
    length = np.fromiter(map(len, contexts), np.int32, len(contexts))
    ends = np.cumsum(length, dtype=np.int32)
    begins = ends - length
    # all windows of a context, then on to a suffix smaller than its successor
    last = ends - size
    risen = np.where(rises(data, ends) > 0, np.arange(len(data), dtype=np.int32), np.int32(len(data)))
    stop = np.minimum(np.minimum.accumulate(risen[::-1])[::-1][last], ends - 1)
    del risen
    count = stop - begins + 1
    context = np.repeat(np.arange(len(contexts), dtype=np.int32), count)
    place = np.arange(count.sum(), dtype=np.int32)
    place -= np.repeat((np.cumsum(count) - count - begins).astype(np.int32), count)
    order = sort_suffixes(data, context, place, ends)
    order = order[place[order] <= last[context[order]]]
    sorted_place, own = place[order], context[order]
    del place, context, order
    prefix = common_prefixes(data, sorted_place)
    # windows next to an equal one; no others matter
    same = prefix >= size
    same[:-1] |= same[1:]
    sorted_place, own, prefix = sorted_place[same], own[same], prefix[same]
    order = np.arange(len(own))
    position = rank[own].astype(np.int64), start[own] + sorted_place - begins[own]
    group = np.cumsum(prefix < size)
    by_time = np.lexsort((position[1], position[0], group))
    later = np.zeros(len(order), bool)
    later[by_time[1:]] = group[by_time][1:] == group[by_time][:-1]
    return own[later], (sorted_place - begins[own])[later]


def spans_of(context: np.ndarray, place: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, first and past-last byte of the stretches that neighbouring windows cover."""
    order = np.lexsort((place, context))
    context, place = context[order], place[order]
    opens = np.ones(len(place), bool)
    opens[1:] = (context[1:] != context[:-1]) | (place[1:] > place[:-1] + size)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(place)) - 1
    return context[first], place[first], place[last] + size if len(place) else place


def bucketed(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """A table in the run's folder whose later joins on ``keys`` do not move its rows."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, *keys).option("path", new_folder(spark, "texts")).saveAsTable(table)
    return spark.table(table)


def sent_hashes(texts: DataFrame) -> DataFrame:
    """doc, part, hash, windows (first, and how many follow) and ``apart`` of all choices.

    Choices with a hash that their task has met already are known to be repeated: all but the first
    are dealt by their document in ``apart``, so a hash that many documents have does not gather
    them in one task. For the others ``apart`` is -1, or -2 if the task met the hash again.
    """
    ship(texts.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        for batch in batches:
            content = [text.encode() for text in batch.column(2).to_pylist()]
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(2)]
            for low, high in chunks(list(map(len, content)), STEP):
                data = np.frombuffer(b"".join(content[low:high]), np.uint8)
                begins = np.concatenate([[0], np.cumsum([len(x) for x in content[low:high]])])
                value, first, last, text = choices(data, begins)
                _, where, number, times = np.unique(value, return_index=True, return_inverse=True, return_counts=True)
                once = np.zeros(len(value), bool)
                once[where] = True
                sure = times[number] > 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[0][low:high][text]),
                        pa.array(keys[1][low:high][text]),
                        pa.array(value.view(np.int64)),
                        pa.array(first << 7 | last - first),
                        pa.array(np.where(once, np.where(sure, -2, -1), text + row)),
                    ],
                    names=["doc", "part", "hash", "windows", "apart"],
                )
                row += high - low

    return texts.mapInArrow(rows, "doc long, part long, hash long, windows long, apart long")


def repeated_choices(texts: DataFrame) -> DataFrame:
    """The choices whose hash occurs twice in the corpus."""
    together = Window.partitionBy("hash", F.greatest("apart", F.lit(-1)))
    sent = sent_hashes(texts).withColumn("times", F.count("*").over(together))
    return sent.filter("times > 1 or apart <> -1").select("doc", "part", "hash", "windows")


def crowded_hashes(chosen: DataFrame) -> DataFrame:
    """The hashes whose contexts would fill more than a block."""
    size = F.expr("windows & 127") + SIZE
    return chosen.groupBy("hash").agg(F.sum(size).alias("bytes")).filter(F.col("bytes") > BLOCK).select("hash")


def contexts_of(texts: DataFrame, chosen: DataFrame, crowded: DataFrame) -> DataFrame:
    """The contexts to compare: hash, doc, part, start and context.

    A context that the task has met goes as a span already decided: ``context`` is null, and
    ``start`` and ``stop`` are the bytes it covers. Which of two is first follows from doc and part.
    Contexts of a crowded hash are taken apart: each window is a context of its own, by the hash of
    all its bytes, so that they meet in many blocks.
    """
    flagged = chosen.join(crowded.withColumn("crowded", F.lit(True)), "hash", "left")
    mark = F.struct("hash", "windows", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    marks = flagged.groupBy("doc", "part").agg(F.collect_list(mark).alias("marks"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, bytes]] = set()
        out: list[list] = [[], [], [], [], [], []]
        size = 0

        def add(value: int, doc: int, part: int, start: int, context: bytes) -> None:
            nonlocal size
            known = (value, context) in met
            if not known:
                met.add((value, context))
                size += len(context)
            row = (value, doc, part, start, start + len(context), None if known else context)
            for column, x in zip(out, row, strict=True):
                column.append(x)

        for batch in batches:
            met.clear()  # of what a batch holds, its order tells which was first
            size = 0
            docs, parts = (batch.column(k).to_pylist() for k in range(2))
            marked = batch.column(3)
            offsets = marked.offsets.to_numpy()
            value = marked.values.field("hash").to_numpy()
            windows = marked.values.field("windows").to_numpy()
            many = marked.values.field("crowded").to_numpy(zero_copy_only=False)
            first = windows >> 7
            for row in sorted(range(batch.num_rows), key=lambda row: (docs[row], parts[row])):
                data = batch.column(2)[row].as_py().encode()
                own = range(int(offsets[row]), int(offsets[row + 1]))
                for k in sorted(own, key=lambda k: first[k]):
                    begin, after = int(first[k]), int(first[k] + (windows[k] & 127)) + 1
                    if many[k]:
                        for start in range(begin, after):
                            window = data[start : start + SIZE]
                            digest = xxhash.xxh3_64_intdigest(window) - (1 << 63)
                            add(digest, docs[row], parts[row], start, window)
                    else:
                        add(int(value[k]), docs[row], parts[row], begin, data[begin : after - 1 + SIZE])
                    if size > BLOCK or len(out[0]) > ROWS:
                        yield _context_batch(out)
                        for column in out:
                            column.clear()
                    if size > BLOCK:
                        met.clear()
                        size = 0
        yield _context_batch(out)

    return texts.join(marks, ["doc", "part"]).select("doc", "part", "text", "marks").mapInArrow(rows, CONTEXTS)


CONTEXTS = "hash long, doc long, part long, start long, stop long, context binary"
SPANS = "doc long, part long, start long, stop long"


def _context_batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.binary()]
    names = ["hash", "doc", "part", "start", "stop", "context"]
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names=names)


def _span_batch(doc, part, start, stop) -> pa.RecordBatch:
    columns = [pa.array(np.asarray(x, np.int64)) for x in (doc, part, start, stop)]
    return pa.RecordBatch.from_arrays(columns, names=["doc", "part", "start", "stop"])


def decided(contexts: DataFrame) -> DataFrame:
    """Spans to remove, from the suffix arrays of all blocks."""

    def block(hashes, doc, part, start, content) -> pa.RecordBatch:
        order = np.lexsort((part, doc))
        rank = np.empty(len(doc), np.int64)
        different = np.ones(len(doc), np.int64)
        different[1:] = (doc[order][1:] != doc[order][:-1]) | (part[order][1:] != part[order][:-1])
        rank[order] = np.cumsum(different)
        context, place = repeats(content, rank, start)
        own, first, stop = spans_of(context, place)
        return _span_batch(doc[own], part[own], start[own] + first, start[own] + stop)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            value, doc, part, start, stop = (batch.column(k).to_numpy() for k in range(5))
            known = batch.column(5).is_null().to_numpy(zero_copy_only=False)
            if known.any():
                yield _span_batch(doc[known], part[known], start[known], stop[known])
            rest = batch.filter(pa.array(~known))
            if not rest.num_rows:
                continue
            # blocks end where the hash changes
            value = rest.column(0).to_numpy()
            changes = np.append(np.flatnonzero(value[1:] != value[:-1]) + 1, len(value))
            lengths = np.cumsum((stop - start)[~known])
            low = 0
            if held and held[-1].column(0)[-1].as_py() != value[0] and size >= BLOCK:
                yield block(*_joined(held))
                held, size = [], 0
            for change in changes.tolist():
                here = int(lengths[change - 1] - (lengths[low - 1] if low else 0))
                if size + here >= BLOCK and change < len(value):
                    held.append(rest.slice(low, change - low))
                    yield block(*_joined(held))
                    held, size, low = [], 0, change
            held.append(rest.slice(low))
            size += int(lengths[-1] - (lengths[low - 1] if low else 0))
        if held:
            yield block(*_joined(held))

    # spans that are decided only pass through: anywhere will do
    place = F.when(F.col("context").isNull(), F.xxhash64("doc", "part")).otherwise(F.col("hash"))
    together = contexts.repartition(place).sortWithinPartitions("hash")
    return together.mapInArrow(rows, SPANS)


def _joined(held: list[pa.RecordBatch]) -> tuple:
    table = pa.Table.from_batches(held)
    numbers = (table.column(k).to_numpy() for k in range(4))
    return *numbers, table.column(5).to_pylist()


def cut(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """doc, part, n_removed, n_spans and kept (the remaining bytes) of texts that lose something."""
    by_text = spans.groupBy("doc", "part").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, number, kept = [], [], []
            for text, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                data, left, at, n = text.encode(), [], 0, 0
                for start, stop in sorted((span["start"], span["stop"]) for span in own):
                    if start > at or not n:
                        left.append(data[at:start])
                        n += 1
                    at = max(at, stop)
                left.append(data[at:])
                kept.append(b"".join(left))
                number.append(n)
                removed.append(len(data) - len(kept[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc", "part", "n_removed", "n_spans", "kept"],
            )

    joined = texts.join(by_text, ["doc", "part"]).select("doc", "part", "text", "spans")
    return joined.mapInArrow(rows, "doc long, part long, n_removed long, n_spans long, kept binary")


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    text = F.coalesce("text", F.lit(""))
    data = F.encode(text, "UTF-8")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_KEY))
    keyed = docs.select("doc_id", key.alias("doc"), F.xxhash64(text).alias("part"), text.alias("text"))
    rows = docs.select(
        "doc_id",
        key.alias("doc"),
        F.xxhash64(text).alias("part"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(data, 256)).alias("content"),
    )
    rows = write_table(rows, "texts")
    first = rows.groupBy("content").agg(F.min(F.struct("doc", "part")).alias("first"))
    rows = write_table(
        rows.join(first, "content").withColumn("is_first", F.struct("doc", "part") == F.col("first")).drop("first"), "texts"
    )
    own = rows.filter("is_first").filter(F.col("n_bytes") >= SIZE).select("doc", "part")
    texts = keyed.select("doc", "part", "text").filter(F.octet_length("text") >= SIZE)
    texts = texts.join(own, ["doc", "part"], "left_semi")
    if not own.groupBy("doc", "part").count().filter("count > 1").isEmpty():
        texts = texts.dropDuplicates(["doc", "part"])
    table = f"texts_{uuid.uuid4().hex}"
    texts = bucketed(texts, table, ["doc", "part"])
    chosen = write_table(repeated_choices(texts), "choices")
    crowded = write_table(crowded_hashes(chosen), "crowded")
    spans = write_table(decided(contexts_of(texts, chosen, crowded)), "spans")
    changed = cut(texts, spans).select("doc", "part", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    changed = write_table(changed, "changed")
    docs.sparkSession.sql(f"drop table {table}")  # its files go with the run's others
    copy = ~F.col("is_first") & (F.col("n_bytes") >= SIZE)
    return rows.join(changed, ["doc", "part"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("sha", F.lower(F.hex("content"))))
        .alias("kept_sha256"),
    )
