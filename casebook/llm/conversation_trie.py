"""Prefix trie of conversations, built in sorted shards around a skeleton.

A conversation is the path of its turns' digests, 16 bytes for each turn, so that sorting paths as
bytes brings equal beginnings together. Splitters, some of the conversations themselves, cut the
sorted order into shards; equal paths are cut between keys, so copies of one conversation fill many
shards. A trie node has members in several shards only if it is on the path of a splitter next to
them. The trie of the splitters' paths, the skeleton, is broadcast.

Each shard is walked once in order, with the open path as a stack. Nodes off the skeleton are
finished there. For skeleton nodes a shard hands over what it saw of them: smallest key, members,
children, leaves and bytes below. An aggregation adds these up, and what the skeleton itself adds
(its nodes as children and leaves, its own bytes) follows from the trie of the splitters.

Broadcast are the splitters' paths, at most ``SAMPLED`` times as many as shards while they are
chosen, then one for each shard. A task holds one batch of conversations, the open path, and the
nodes of its shard whose parents are still open, some 100 bytes each.

Turns follow each other by turn, null first, rows of equal turn by digest. Rows without conv_id
belong to no conversation. A null role or text is empty. Repeated rows are turns of their own. An
empty table has no nodes. A conversation may be very long but is one row, of 24 bytes for each turn.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.shipping import ship
from casebook.workspace import write_table

WIDTH = 16
#: Turns that a shard should hold, about, and conversations looked at for each splitter.
TURNS = 200_000
SAMPLED = 32
#: Finished nodes, and bytes of keys, that a worker holds before it hands them over.
HELD = 100_000
KEYS = 1 << 20
#: Seed of the digest that picks the conversations looked at.
SEED = 20_240_601

INSIDE, BELOW, PARTIAL, ENDS = range(4)
_NOTHING = hashlib.sha256().hexdigest()


def turns_of(rows: DataFrame) -> DataFrame:
    """conv_id and turns (place, digest in hex, and bytes of the text) of every conversation, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.encode(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    size = F.octet_length(text).cast("long")
    turns = F.sort_array(F.collect_list(F.struct(F.col("turn").alias("place"), "digest", "size")))
    rows = rows.filter("conv_id is not null").select("conv_id", "turn", digest.alias("digest"), size.alias("size"))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def paths_of(turns: DataFrame) -> DataFrame:
    """conv_id, path and sizes (bytes of each turn's text) of every conversation."""
    digests = F.array_join(F.transform("turns", lambda turn: turn["digest"]), "")
    return turns.select("conv_id", F.unhex(digests).alias("path"), F.col("turns.size").alias("sizes"))


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at the beginning."""
    low, limit = 0, min(len(a), len(b)) // WIDTH
    step = 1
    while low < limit:  # ever larger pieces, then back to the one that differs
        high = min(low + step, limit)
        if a[low * WIDTH : high * WIDTH] == b[low * WIDTH : high * WIDTH]:
            low, step = high, step * 2
        elif high - low == 1:
            return low
        else:
            step = max(1, (high - low) // 2)
    return limit


@dataclass
class Skeleton:
    """The trie of the splitters' paths.

    A node is named by the first splitter on whose path it is, its owner, and its depth. The root is
    (0, 0). fresh: the depth from which a splitter's nodes are its own. runs: owners along each path,
    as (greatest depth, owner).
    """

    splitters: list[tuple[bytes, int]]
    sizes: list[np.ndarray]
    fresh: list[int] = field(default_factory=list)
    runs: list[list[tuple[int, int]]] = field(default_factory=list)

    def __post_init__(self) -> None:
        before: list[tuple[int, int]] = []
        for k, (path, _) in enumerate(self.splitters):
            common = shared_turns(self.splitters[k - 1][0], path) if k else -1
            runs = []
            for high, owner in before:
                runs.append((min(high, common), owner))
                if high >= common:
                    break
            if len(path) // WIDTH > common:
                runs.append((len(path) // WIDTH, k))
            self.fresh.append(common + 1)
            self.runs.append(runs)
            before = runs

    def owner(self, splitter: int, depth: int) -> int:
        return next(owner for high, owner in self.runs[splitter] if depth <= high)

    def below(self, own: list[np.ndarray]) -> list[np.ndarray]:
        """For values of all nodes, by owner from its first own depth on: the sums over their subtrees."""
        total = [values.copy() for values in own]
        for k in range(len(total) - 1, -1, -1):
            total[k] = np.cumsum(total[k][::-1])[::-1]
            if k and len(total[k]):
                owner = self.owner(k - 1, self.fresh[k] - 1)
                total[owner][self.fresh[k] - 1 - self.fresh[owner]] += total[k][0]
        return total

    def own_sizes(self) -> list[np.ndarray]:
        """Bytes of each node's last turn; the root has none."""
        found = []
        for first, sizes in zip(self.fresh, self.sizes, strict=True):
            found.append(np.concatenate([[0], sizes])[first:].astype(np.int64))
        return found

    def children(self) -> list[np.ndarray]:
        """Children of each node that are in the skeleton."""
        found = []
        for first, (path, _) in zip(self.fresh, self.splitters, strict=True):
            count = np.ones(max(0, len(path) // WIDTH + 1 - first), np.int64)
            count[-1:] = 0
            found.append(count)
        for k in range(1, len(found)):
            if len(found[k]):
                owner = self.owner(k - 1, self.fresh[k] - 1)
                found[owner][self.fresh[k] - 1 - self.fresh[owner]] += 1
        return found

    def parents(self) -> list[np.ndarray]:
        """Owner of each node's parent; -1 for the root."""
        found = []
        for k, (first, (path, _)) in enumerate(zip(self.fresh, self.splitters, strict=True)):
            above = np.full(max(0, len(path) // WIDTH + 1 - first), k, np.int64)
            if len(above):
                above[0] = self.owner(k - 1, first - 1) if k else -1
            found.append(above)
        return found

    def values_at(self, values: list[np.ndarray], owner: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """One value for each of some nodes."""
        begins = np.cumsum([0, *map(len, values)])
        place = begins[owner] + depth - np.array(self.fresh, np.int64)[owner]
        return np.concatenate(values)[place]


def skeleton_of(paths: DataFrame, turns: int = TURNS) -> Skeleton:
    """Splitters that cut the sorted paths into shards of about ``turns`` turns.

    They are chosen among conversations that a digest of the key picks, so a retried task chooses the same.
    """
    spark = paths.sparkSession
    total = paths.agg(F.count("*").alias("n"), F.sum(F.size("sizes") + 1).alias("turns")).first()
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, min(total["n"], max(parallel, -(-(total["turns"] or 0) // turns))))
    share = min(1.0, SAMPLED * shards / max(total["n"], 1))
    picked = F.pmod(F.xxhash64(F.lit(SEED), "conv_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = sorted((bytes(row.path), row.conv_id, row.sizes) for row in paths.filter(picked).collect())
    weight = np.cumsum([len(sizes) + 1 for _, _, sizes in sample]) if sample else np.zeros(0)
    wanted = np.arange(1, shards) * (weight[-1] / shards) if sample else []
    chosen = np.unique(np.minimum(np.searchsorted(weight, wanted), len(sample) - 1)) if sample else []
    if sample and not len(chosen):
        chosen = [len(sample) // 2]
    splitters = [sample[k] for k in chosen]
    return Skeleton([s[:2] for s in splitters], [np.array(s[2], np.int64) for s in splitters])


SHARD = pa.schema(
    [
        ("kind", pa.int32()),
        *((name, pa.int64()) for name in ("owner", "depth", "conv_id", "parent_conv_id", "above")),
        *((name, pa.int64()) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        ("ends_sha256", pa.string()),
        *((name, pa.int64()) for name in ("shard", "part")),
        ("ids", pa.binary()),
    ]
)
SHARD_DDL = (
    "kind int, owner long, depth long, conv_id long, parent_conv_id long, above long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string, shard long, part long, ids binary"
)


class Shard:
    """The walk over one shard: nodes as parallel arrays, the open path as a stack of places in them.

    owner and above are those of the node and of its parent if they are of the skeleton, else -1.
    """

    NAMES = ("conv", "depth", "size", "members", "children", "leaves", "saved", "parent", "owner", "above")

    def __init__(self, number: int, skeleton: Skeleton):
        self.number, self.skeleton = number, skeleton
        splitters = skeleton.splitters
        self.low = splitters[number - 1][0] if number else b""
        self.high = splitters[number][0] if number < len(splitters) else b""
        self.last: bytes | None = None
        self.near_low = 0
        self.nodes = {name: array("q") for name in self.NAMES}
        self.ends: list[str] = []
        self.hashes: dict[int, object] = {}
        self.keys: dict[int, list[bytes]] = {}
        self.key_bytes = 0
        self.part = 0
        self.stack: list[int] = []
        self.done: list[pa.RecordBatch] = []
        self.open(0, 0, 0)

    def open(self, depth: int, size: int, owner: int) -> None:
        parent = self.stack[-1] if self.stack else -1
        above = self.nodes["owner"][parent] if self.stack else -1
        values = ((1 << 63) - 1, depth, size, 0, 0, 0, 0, parent, owner, above)
        for column, value in zip(self.nodes.values(), values, strict=True):
            column.append(value)
        self.ends.append(_NOTHING)
        self.stack.append(len(self.ends) - 1)

    def add(self, path: bytes, conv: int, sizes: np.ndarray) -> None:
        """The next conversation of the sorted shard."""
        if self.last is None:
            common, self.near_low = 0, shared_turns(self.low, path)
        else:
            common = shared_turns(self.last, path)
            self.near_low = min(self.near_low, common)
        self.last = path
        while len(self.stack) - 1 > common:
            self.close()
        depth = len(path) // WIDTH
        if depth > common:
            near_high = shared_turns(self.high, path)
            for d in range(common + 1, depth + 1):
                owner = -1
                if d <= self.near_low:
                    owner = self.skeleton.owner(self.number - 1, d)
                elif d <= near_high:
                    owner = self.skeleton.owner(self.number, d)
                self.open(d, int(sizes[d - 1]), owner)
        node = self.stack[-1]
        self.nodes["members"][node] += 1
        self.nodes["conv"][node] = min(self.nodes["conv"][node], conv)
        if self.nodes["owner"][node] >= 0:
            key = b"%d" % conv
            self.keys.setdefault(node, []).append(key)
            self.key_bytes += len(key) + 1
            if self.key_bytes > KEYS:
                self.hand_keys()
        elif node in self.hashes:
            self.hashes[node].update(b",%d" % conv)
        else:
            self.hashes[node] = hashlib.sha256(b"%d" % conv)

    def close(self) -> None:
        """Finish the deepest open node and add it to its parent."""
        node = self.stack.pop()
        n = self.nodes
        members, skeletal = n["members"][node], n["owner"][node] >= 0
        if skeletal:
            n["saved"][node] += members * n["size"][node]
        else:
            n["saved"][node] += (members - 1) * n["size"][node]
            if not n["children"][node]:
                n["leaves"][node] = 1
            if node in self.hashes:
                self.ends[node] = self.hashes.pop(node).hexdigest()
        if not self.stack:
            return
        parent = self.stack[-1]
        for name in ("members", "leaves", "saved"):
            n[name][parent] += n[name][node]
        n["children"][parent] += not skeletal
        n["conv"][parent] = min(n["conv"][parent], n["conv"][node])
        # all below this node know their parents; so does the node, if its parent is of the skeleton
        ready = node if n["above"][node] >= 0 else node + 1
        if len(self.ends) - ready > HELD:
            self.hand_over(ready)

    def hand_keys(self) -> None:
        """Keys of conversations that end at skeleton nodes, in order."""
        self.key_bytes = 0
        for node, keys in self.keys.items():
            row = dict.fromkeys(SHARD.names)
            row |= {"kind": ENDS, "owner": self.nodes["owner"][node], "depth": self.nodes["depth"][node]}
            row |= {"shard": self.number, "part": self.part, "ids": b",".join(keys)}
            self.done.append(pa.RecordBatch.from_pylist([row], SHARD))
            self.part += 1
        self.keys.clear()

    def hand_over(self, first: int) -> None:
        """All nodes from ``first`` on; they are closed."""
        if self.keys:
            self.hand_keys()
        n = {name: np.array(column[first:], np.int64) for name, column in self.nodes.items()}
        size = len(n["conv"])
        local = n["above"] < 0
        inside = local & (n["owner"] < 0)
        parent = np.array(self.nodes["conv"], np.int64)[np.where(inside, n["parent"], 0)]
        kind = np.where(n["owner"] >= 0, PARTIAL, np.where(inside, INSIDE, BELOW))
        columns = [
            pa.array(kind, pa.int32()),
            *(pa.array(n[name]) for name in ("owner", "depth", "conv")),
            pa.array(parent, mask=~inside),
            *(pa.array(n[name]) for name in ("above", "members", "children", "leaves", "saved")),
            pa.array(self.ends[first:], pa.string()),
            pa.array(np.full(size, self.number, np.int64)),
            pa.nulls(size, pa.int64()),
            pa.nulls(size, pa.binary()),
        ]
        self.done.append(pa.RecordBatch.from_arrays(columns, schema=SHARD))
        for column in self.nodes.values():
            del column[first:]
        del self.ends[first:]

    def finish(self) -> None:
        while self.stack:
            self.close()
        self.hand_over(0)

    def taken(self) -> list[pa.RecordBatch]:
        done, self.done = self.done, []
        return done


def shards_of(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """What all shards hand over, see SHARD."""
    trie = paths.sparkSession.sparkContext.broadcast(skeleton)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = trie.value.splitters
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)
            number = pa.array([bisect_right(splitters, key) for key in keys], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, number], names=["conv_id", "path", "sizes", "shard"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            sizes = batch.column(2)
            values, offsets = sizes.values.to_numpy(), sizes.offsets.to_pylist()
            for k, (conv, path, number) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in (0, 1, 3)), strict=True)
            ):
                if shard is None or shard.number != number:
                    if shard:
                        shard.finish()
                        yield from shard.taken()
                    shard = Shard(number, trie.value)
                shard.add(path, conv, values[offsets[k] : offsets[k + 1]])
                if shard.done:
                    yield from shard.taken()
        if shard:
            shard.finish()
            yield from shard.taken()

    schema = "conv_id long, path binary, sizes array<long>, shard long"
    rows = paths.select(F.col("conv_id").cast("long").alias("conv_id"), "path", "sizes").mapInArrow(dealt, schema)
    return rows.repartition("shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(walk, SHARD_DDL)


def end_digests(shards: DataFrame) -> DataFrame:
    """owner, depth and ends_sha256 of the skeleton nodes where conversations end, streamed in order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one() -> pa.RecordBatch:
            columns = [pa.array([node[0]]), pa.array([node[1]]), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, names=["owner", "depth", "ends_sha256"])

        node = digest = None
        for batch in batches:
            for *own, ids in zip(*(batch.column(c).to_pylist() for c in (0, 1, 4)), strict=True):
                if own == node:
                    digest.update(b"," + ids)
                else:
                    if node:
                        yield one()
                    node, digest = own, hashlib.sha256(ids)
        if node:
            yield one()

    ends = shards.filter(F.col("kind") == ENDS).select("owner", "depth", "shard", "part", "ids")
    ends = ends.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "shard", "part")
    return ends.mapInArrow(rows, "owner long, depth long, ends_sha256 string")


def skeleton_nodes(shards: DataFrame, skeleton: Skeleton) -> DataFrame:
    """owner, depth, above and the node's values: what shards saw, and what the skeleton itself adds."""
    sums = [F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    partial = shards.filter(F.col("kind") == PARTIAL).groupBy("owner", "depth")
    partial = write_table(partial.agg(F.min("conv_id").alias("conv_id"), *sums), "skeleton")
    # a splitter's last node is a leaf if nothing goes on from it: at most one for each splitter
    last = [(k, len(path) // WIDTH) for k, (path, _) in enumerate(skeleton.splitters)]
    tips = partial.sparkSession.createDataFrame(last, "owner long, depth long")
    bare = {(row.owner, row.depth) for row in partial.join(tips, ["owner", "depth"]).filter("n_children = 0").collect()}
    children = skeleton.children()
    leaves = [np.zeros_like(values) for values in children]
    for k, depth in last:
        if len(leaves[k]) and (k, depth) in bare and not children[k][-1]:
            leaves[k][-1] = 1
    added = (children, skeleton.below(leaves), [-x for x in skeleton.below(skeleton.own_sizes())], skeleton.parents())
    known = partial.sparkSession.sparkContext.broadcast((skeleton, added))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, values = known.value
        for batch in batches:
            if not batch.num_rows:
                continue
            owner, depth, conv, members, *sums = (column.to_numpy() for column in batch.columns)
            more = [trie.values_at(value, owner, depth) for value in values]
            columns = [owner, depth, more[3], conv, members, *(a + b for a, b in zip(sums, more, strict=False))]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=names)

    names = ["owner", "depth", "above", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return partial.mapInArrow(rows, ", ".join(f"{name} long" for name in names))


def trie(paths: DataFrame, turns: int = TURNS) -> DataFrame:
    """All nodes of the trie of the given paths (conv_id, path and sizes, one row for each conv_id).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256.
    """
    ship(paths.sparkSession)
    paths = write_table(paths, "paths")
    skeleton = skeleton_of(paths, turns)
    shards = write_table(shards_of(paths, skeleton), "shards")
    values = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    bones = write_table(skeleton_nodes(shards, skeleton), "skeleton-nodes")
    names = bones.select(
        F.col("owner").alias("above"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id")
    )
    digests = end_digests(shards)
    nodes = bones.join(digests, ["owner", "depth"], "left").fillna(_NOTHING, ["ends_sha256"])
    below = shards.filter(F.col("kind") == BELOW).select("above", *values).unionByName(nodes.select("above", *values))
    below = below.join(names, ["above", "depth"], "left").select(*values, "parent_conv_id")
    inside = shards.filter(F.col("kind") == INSIDE).select(*values, "parent_conv_id")
    order = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return inside.unionByName(below).select(*order)


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of the nearest conversation below with a key divisible by five.

    How many is the checksum of the key modulo nine; a conversation's own turns follow after as many.
    """
    heads = turns.filter(F.col("conv_id") % 5 == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    joined = turns.join(heads, F.col("conv_id") - F.col("conv_id") % 5 == F.col("base"), "left")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), taken)
    own = F.slice("turns", taken + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def prefixes(rows: DataFrame) -> DataFrame:
    """All nodes of the rebuilt conversations of ``rows`` (conv_id, turn, role and text)."""
    return trie(paths_of(rebuilt(write_table(turns_of(rows), "turns"))))


ORACLE = """
with bytes(v, c, k) as (select i, i::bigint, 0 from range(256) t(i)),
steps as (
  with recursive r(v, c, k) as (
    select * from bytes
    union all
    select v, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, k + 1 from r where k < 8)
  select v, c from r where k = 8),
crc as (select list(c order by v) as entry from steps),
ids as (
  select conv_id, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda a, b: xor(entry[xor(a, b) % 256 + 1], a // 256)), 4294967295) % 9 as h
  from (select distinct conv_id from conversations where conv_id is not null), crc),
digested as (
  select conv_id, turn, octet_length(encode(coalesce(text, ''))) as size,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as t
  from conversations),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, t) as i from digested),
sizes as (select conv_id, count(*) as n from ordered group by 1),
turns as (
  select c.conv_id, o.i as d, o.t, o.size
  from ids c join ordered o on o.conv_id = c.conv_id - c.conv_id % 5 and o.i <= c.h
  union all
  select c.conv_id, o.i - c.h + least(c.h, coalesce(s.n, 0)), o.t, o.size
  from ids c join ordered o on o.conv_id = c.conv_id and o.i > c.h
  left join sizes s on s.conv_id = c.conv_id - c.conv_id % 5),
paths as (
  select conv_id, d, size, string_agg(t, '') over (partition by conv_id order by d) as path from turns
  union all select conv_id, 0, 0, '' from ids),
lengths as (select conv_id, max(d) as n from paths group by 1),
nodes as (
  select p.d, p.path, min(p.conv_id) as conv_id, count(*) as n_convs, max(p.size) as size,
         sha256(coalesce(string_agg(p.conv_id::varchar, ',' order by p.conv_id) filter (l.n = p.d), '')) as ends_sha256
  from paths p join lengths l on p.conv_id = l.conv_id group by p.d, p.path),
children as (select left(path, (32 * (d - 1))::int) as path, d - 1 as d, count(*) as n from nodes where d > 0 group by 1, 2),
own as (
  select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c on n.path = c.path and n.d = c.d),
above as (
  select path as own_path, (n_children = 0)::int as leaf, (n_convs - 1) * size as saved, unnest(range(d + 1)) as a from own),
totals as (
  select left(own_path, (32 * a)::int) as path, a as d, sum(leaf)::bigint as n_leaves, sum(saved)::bigint as saved_tokens
  from above group by 1, 2)
select o.conv_id, o.d as depth, p.conv_id as parent_conv_id, o.n_convs, o.n_children, t.n_leaves, t.saved_tokens,
       o.ends_sha256
from own o join totals t on o.path = t.path and o.d = t.d
left join nodes p on p.d = o.d - 1 and p.path = left(o.path, (32 * (o.d - 1))::int)
"""
