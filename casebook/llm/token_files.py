"""Token ids in binary files of patched frame-of-reference blocks.

A shard file holds the tokens of consecutive documents, each ended by the end id::

    magic | packed blocks | exception places (1 byte each) | exception values (4 bytes each) |
    block index | document index | sizes | magic

All numbers are little-endian. A block holds 256 ids (the last one is filled up with its minimum).
From each id the block's minimum is subtracted; the rest is packed at the number of bits that the
block's ``PERCENTILE`` needs, and ids that need more have their whole difference in the exception
lists. The block index has each block's start byte, minimum, width and first exception, so any
block can be read alone. The document index has each document's key and first token in the shard.

Shards go to the folder that all executors share, each attempt of a task to a file of its own name.
The table of shards, written by Spark when all tasks are done, names the files that count; a lost
executor's tasks are run again and leave at most a file that nothing names.

Null texts are empty: the end id alone. Documents with a null key come first; equal keys follow in
order of their texts. An empty table gives an empty index.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm.library import library
from casebook.llm.shipping import ship
from casebook.llm.words import chunks
from casebook.workspace import new_folder, write_table

MAGIC = b"PFORTOK1"
BLOCK = 256
PERCENTILE = 90
#: Blocks packed or read at a time.
GROUP = 4096
INDEX = np.dtype([("start", "<u8"), ("low", "<u4"), ("width", "u1"), ("exceptions", "<u8")])
DOCUMENTS = np.dtype([("key", "<i8"), ("known", "u1"), ("first", "<u8")])
TAIL = struct.Struct("<QQQQ")


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below 2**width, as bytes; the lowest bits of the first value come first."""
    rows = len(values)
    if width <= 16:
        eight = values.astype(np.uint64).reshape(rows, -1, 8)
        shifts = np.arange(4, dtype=np.uint64) * np.uint64(width)
        low = np.bitwise_or.reduce(eight[..., :4] << shifts, axis=-1)
        high = np.bitwise_or.reduce(eight[..., 4:] << shifts, axis=-1)
        both = np.empty((rows, low.shape[1], 2), "<u8")
        half = np.uint64(4 * width)
        if width == 16:
            both[..., 0], both[..., 1] = low, high
        else:
            both[..., 0] = low | high << half
            both[..., 1] = high >> (np.uint64(64) - half) if width else 0
        return both.view(np.uint8)[..., :width].reshape(rows, -1)
    bits = values[..., None] >> np.arange(width, dtype=values.dtype) & values.dtype.type(1)
    return np.packbits(bits.astype(np.uint8).reshape(rows, -1), axis=1, bitorder="little")


def unpack(packed: np.ndarray, width: int) -> np.ndarray:
    """The inverse of ``pack``."""
    rows = len(packed)
    if not width:
        return np.zeros((rows, BLOCK), np.uint32)
    if width <= 16:
        both = np.zeros((rows, BLOCK // 8, 16), np.uint8)
        both[..., :width] = packed.reshape(rows, BLOCK // 8, width)
        both = both.view("<u8")
        half, mask = np.uint64(4 * width), np.uint64((1 << width) - 1)
        if width == 16:
            low, high = both[..., 0], both[..., 1]
        else:
            low, high = both[..., 0], both[..., 0] >> half | both[..., 1] << (np.uint64(64) - half)
        shifts = np.arange(4, dtype=np.uint64) * np.uint64(width)
        found = np.concatenate([low[..., None] >> shifts & mask, high[..., None] >> shifts & mask], axis=-1)
        return found.reshape(rows, BLOCK).astype(np.uint32)
    bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(rows, BLOCK, width)
    return (bits.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=-1).astype(np.uint32)


def bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


class ShardWriter:
    """Writes one shard as tokens come; keeps the indexes and exceptions in memory until the end."""

    def __init__(self, stream):
        self.stream, self.size = stream, len(MAGIC)
        stream.write(MAGIC)
        self.index: list[np.ndarray] = []
        self.places: list[bytes] = []
        self.values: list[bytes] = []
        self.documents: list[np.ndarray] = []
        self.rest = np.zeros(0, np.uint32)
        self.exceptions = self.tokens = 0

    def add(self, keys: list, tokens: list[np.ndarray]) -> None:
        sizes = np.fromiter(map(len, tokens), np.uint64, len(tokens))
        rows = np.zeros(len(keys), DOCUMENTS)
        rows["key"], rows["known"] = [key or 0 for key in keys], [key is not None for key in keys]
        rows["first"] = self.tokens + np.cumsum(sizes) - sizes
        self.documents.append(rows)
        self.tokens += int(sizes.sum())
        waiting = np.concatenate([self.rest, *tokens])
        whole = len(waiting) // BLOCK * BLOCK
        for low in range(0, whole, GROUP * BLOCK):
            self.blocks(waiting[low : min(whole, low + GROUP * BLOCK)].reshape(-1, BLOCK))
        self.rest = waiting[whole:]

    def blocks(self, values: np.ndarray) -> None:
        lowest = values.min(axis=1)
        rest = values - lowest[:, None]
        widths = bit_lengths(np.percentile(rest, PERCENTILE, axis=1, method="higher"))
        large = rest >= np.uint64(1) << widths.astype(np.uint64)[:, None]
        row, place = np.nonzero(large)
        index = np.zeros(len(values), INDEX)
        sizes = widths.astype(np.int64) * (BLOCK // 8)
        starts = np.cumsum(sizes) - sizes
        counts = large.sum(axis=1)
        index["start"], index["low"], index["width"] = self.size + starts, lowest, widths
        index["exceptions"] = self.exceptions + np.cumsum(counts) - counts
        out = np.empty(int(sizes.sum()), np.uint8)
        for width in np.unique(widths).tolist():
            own = np.flatnonzero(widths == width)
            packed = pack(rest[own] & np.uint32((1 << width) - 1), width)
            out[starts[own][:, None] + np.arange(packed.shape[1])] = packed
        self.stream.write(out.tobytes())
        self.index.append(index)
        self.places.append(place.astype(np.uint8).tobytes())
        self.values.append(rest[row, place].astype("<u4").tobytes())
        self.size += len(out)
        self.exceptions += len(place)

    def close(self) -> None:
        if len(self.rest):
            last = np.full((1, BLOCK), self.rest.min(), np.uint32)
            last[0, : len(self.rest)] = self.rest
            self.blocks(last)
        index = np.concatenate([np.zeros(0, INDEX), *self.index])
        documents = np.concatenate([np.zeros(0, DOCUMENTS), *self.documents])
        for part in (*self.places, *self.values, index.tobytes(), documents.tobytes()):
            self.stream.write(part)
        self.stream.write(TAIL.pack(self.exceptions, len(index), len(documents), self.tokens) + MAGIC)


class ShardReader:
    """Reads a shard by its indexes."""

    def __init__(self, file):
        self.file = file
        end = file.size() - TAIL.size - len(MAGIC)
        tail = file.read_at(TAIL.size + len(MAGIC), end)
        if tail[TAIL.size :] != MAGIC:
            raise ValueError("not a token shard, or cut short")
        exceptions, blocks, documents, self.tokens = TAIL.unpack(tail[: TAIL.size])
        end -= documents * DOCUMENTS.itemsize
        self.documents = np.frombuffer(file.read_at(documents * DOCUMENTS.itemsize, end), DOCUMENTS)
        end -= blocks * INDEX.itemsize
        self.index = np.frombuffer(file.read_at(blocks * INDEX.itemsize, end), INDEX)
        self.values_at = end - 4 * exceptions
        self.places_at = self.values_at - exceptions
        self.exceptions = exceptions

    def blocks(self, low: int, high: int) -> np.ndarray:
        """Ids of the blocks from ``low`` up to ``high``, one row each."""
        index = self.index[low:high]
        starts = index["start"].astype(np.int64)
        begin = int(starts[0])
        sizes = index["width"].astype(np.int64) * (BLOCK // 8)
        data = np.frombuffer(self.file.read_at(int(starts[-1] + sizes[-1]) - begin, begin), np.uint8)
        found = np.empty((len(index), BLOCK), np.uint32)
        for width in np.unique(index["width"]).tolist():
            own = np.flatnonzero(index["width"] == width)
            where = (starts[own] - begin)[:, None] + np.arange(width * (BLOCK // 8))
            found[own] = unpack(data[where], width)
        first = index["exceptions"].astype(np.int64)
        last = int(self.index["exceptions"][high]) if high < len(self.index) else self.exceptions
        count = last - int(first[0])
        places = np.frombuffer(self.file.read_at(count, self.places_at + int(first[0])), np.uint8)
        values = np.frombuffer(self.file.read_at(4 * count, self.values_at + 4 * int(first[0])), "<u4")
        row = np.repeat(np.arange(len(index)), np.diff(np.append(first, last)))
        found[row, places] = values
        return found + index["low"][:, None]

    def read(self) -> Iterator[tuple[int, np.ndarray]]:
        """Document by document: its place in the document index and its ids, in parts if long."""
        ends = np.append(self.documents["first"][1:], np.uint64(self.tokens)).astype(np.int64)
        document = 0
        for low in range(0, len(self.index), GROUP):
            high = min(low + GROUP, len(self.index))
            ids = self.blocks(low, high).reshape(-1)[: self.tokens - low * BLOCK]
            at, stop = 0, low * BLOCK + len(ids)
            while document < len(ends) and low * BLOCK + at < stop:
                to = min(int(ends[document]), stop) - low * BLOCK
                yield document, ids[at:to]
                at = to
                document += int(ends[document]) <= stop

    def between(self, first: int, last: int) -> np.ndarray:
        """Tokens from ``first`` up to ``last`` of the shard; only their blocks are read."""
        if first >= last:
            return np.zeros(0, np.uint32)
        low = first // BLOCK
        return self.blocks(low, -(-last // BLOCK)).reshape(-1)[first - low * BLOCK : last - low * BLOCK]


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder's address."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_shards(docs: DataFrame, vocabulary: str, end_id: int, folder: str) -> DataFrame:
    """Encode documents in ascending order of their key and write them; returns the table of shards.

    Tasks get key ranges, so the order holds across shards; a range's documents pass through its
    task in batches. Columns: shard, path, n_docs, n_tokens and ``base``, the tokens before it.
    """
    ship(docs.sparkSession)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batches = (batch for batch in batches if batch.num_rows)
        first = next(batches, None)
        if first is None:
            return
        number = TaskContext.get().partitionId()
        system, root = opened(folder)
        system.create_dir(root)
        path = f"{root}/shard-{number:06d}-{uuid.uuid4().hex}.pfor"
        code, end, count = library(vocabulary), np.array([end_id], np.uint32), 0
        with system.open_output_stream(path) as stream:
            writer = ShardWriter(stream)
            for batch in chain([first], batches):
                keys = batch.column(0).to_pylist()
                texts = [text or "" for text in batch.column(1).to_pylist()]
                for low, high in chunks(list(map(len, texts))):
                    tokens = [np.concatenate([ids, end]) for ids in code.encode(texts[low:high])]
                    writer.add(keys[low:high], tokens)
                    count += high - low
            writer.close()
        yield pa.RecordBatch.from_pydict(
            {"shard": [number], "path": [path], "n_docs": [count], "n_tokens": [writer.tokens]}
        )

    key = F.col("doc_id").cast("long")
    # rows of a null or repeated key are dealt over ranges by a digest of their texts
    order = ["doc_id", "tie"]
    ordered = docs.select(key.alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    shards = ordered.mapInArrow(shard, "shard long, path string, n_docs long, n_tokens long")
    shards = write_table(shards, "shards")
    # one row for each shard: few enough for one task
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(shards: DataFrame, folder: str, tasks: int) -> DataFrame:
    """Read every shard back: each document's key, start, number of tokens, and their checksum."""
    ship(shards.sparkSession)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_file(path) as file:
                    reader = ShardReader(file)
                    rows = reader.documents
                    size, check = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
                    for row, ids in reader.read():
                        size[row] += len(ids)
                        check[row] = zlib.crc32(ids.astype("<u4").tobytes(), int(check[row]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(rows["key"], pa.int64(), mask=rows["known"] == 0),
                            pa.array(base + rows["first"].astype(np.int64)),
                            pa.array(size),
                            pa.array(check),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    chosen = shards.select("path", "base").repartition(tasks)
    return chosen.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def written_and_read(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Write all documents' tokens to shards in the shared folder and read the shards."""
    folder = new_folder(spark, "tokens")
    shards = write_shards(docs, vocabulary, end_id, folder)
    return read_shards(shards, folder, max(1, shards.count()))
