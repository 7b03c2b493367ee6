"""The conversation trie against brute force."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from casebook.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn int, role string, text string"


def rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, role or "", text or ""))
    own = {conv: [turn[3:] for turn in sorted(turns)] for conv, turns in own.items()}
    made = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        made[conv] = own.get(conv - conv % 5, [])[:h] + turns[h:]
    return made


def brute_nodes(paths: dict[int, list]) -> set[tuple]:
    members = {}
    for conv, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def totals(node):
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves = 0 if node in children else 1
        for child in children.get(node, []):
            a, b = totals(child)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    found = set()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.add((min(convs), len(node), parent, len(convs), len(children.get(node, [])), *totals(node), digest))
    return found


def sample(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    hot = [("user", "hello there"), ("assistant", "é" * 9), ("user", ""), ("tool", "z")]
    rows = []
    for conv in range(n):
        turns = hot[: rng.randint(0, 4)] if rng.random() < 0.5 else []
        turns = turns + [(rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "ccé", None, ""])) for _ in range(rng.randint(0, 5))]
        rows += [(conv, k if rng.random() < 0.9 else None, *turn) for k, turn in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("turns", [1, 3, 50, trie.TURNS])
def test_nodes_equal_brute_force(spark, turns):
    """Whatever shards the conversations are cut into; copies of one fill several."""
    rows = sample(300, 3)
    rows += [(1000 + k, t, "user", f"copied {t}") for k in range(200) for t in range(6)]
    paths = trie.paths_of(trie.rebuilt(trie.turns_of(spark.createDataFrame(rows, SCHEMA))))
    found = [tuple(row) for row in trie.trie(paths, turns).collect()]
    assert len(found) == len(set(found)) and set(found) == brute_nodes(rebuilt(rows))


def test_workers_hand_over_what_is_finished(monkeypatch, spark):
    monkeypatch.setattr(trie, "HELD", 3)
    monkeypatch.setattr(trie, "KEYS", 10)
    rows = sample(120, 8)
    paths = rebuilt(rows)
    ordered = []
    for conv, turns in paths.items():
        digests = [hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest() for r, t in turns]
        ordered.append((b"".join(digests), conv, [len(t.encode()) for _, t in turns]))
    ordered.sort()
    skeleton = trie.Skeleton([ordered[40][:2], ordered[80][:2]], [ordered[k][2] for k in (40, 80)])
    got = []
    for number, part in enumerate((ordered[:40], ordered[40:80], ordered[80:])):
        shard = trie.Shard(number, skeleton)
        for path, conv, sizes in part:
            shard.add(path, conv, sizes)
            got += shard.taken()
        assert len(shard.ends) < 40
        shard.finish()
        got += shard.taken()
    rows = [row for batch in got for row in batch.to_pylist()]
    inside = {tuple(row[k] for k in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for row in rows if row["kind"] == trie.INSIDE}
    assert inside and inside <= brute_nodes(paths)
    members = sum(row["n_convs"] for row in rows if row["kind"] == trie.PARTIAL and row["depth"] == 0)
    assert members == len(paths)


def test_long_conversations(spark):
    """Two conversations of 30,000 turns that part at the end, and one that is a prefix of them."""
    rows = [(10 * c, t, "user", f"turn {t}" if t < 29_990 else f"{c} {t}") for c in (1, 2) for t in range(30_000)]
    rows += [(1000, t, "user", f"turn {t}") for t in range(20_000)]
    paths = trie.paths_of(trie.turns_of(spark.createDataFrame(rows, SCHEMA)))
    found = trie.trie(paths, 20_000)
    assert found.count() == 1 + 29_990 + 20
    assert found.filter("depth = 0").first().n_leaves == 2
    fork = found.filter("depth = 29990").first()
    assert (fork.n_convs, fork.n_children, fork.conv_id, fork.parent_conv_id) == (2, 2, 10, 10)


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "lost"), (-7, None, None, None), (-7, None, None, None), (-7, 3, "user", "x" * 500_000)]
    rows += [(5, 0, "a", "bc"), (6, 0, "ab", "c"), (7, 0, "a", "bc")]
    table = spark.createDataFrame(rows, SCHEMA)
    clashing = table.withColumns({name: F.lit(1) for name in ("path", "size", "owner", "depth", "turns", "n_convs")})
    turns = trie.turns_of(clashing)
    assert turns.count() == 4
    paths = {}
    for row in trie.paths_of(turns).collect():
        paths[row.conv_id] = (len(row.path) // 16, list(row.sizes))
    assert paths[-7] == (3, [0, 0, 500_000]) and paths[5][0] == 1
    found = trie.trie(trie.paths_of(turns))
    # role and text do not run into each other: two children besides the one of conversation -7
    assert found.filter("depth = 0").first().n_children == 3
    assert trie.prefixes(table.limit(0)).count() == 0


def test_skeleton_names_each_node_once():
    paths = [bytes([a]) * 16 + bytes([b]) * 16 for a in range(3) for b in range(3)]
    skeleton = trie.Skeleton([(p, k) for k, p in enumerate(paths)], [[1, 2]] * 9)
    assert sum(map(len, skeleton.children())) == 1 + 3 + 9
    assert skeleton.children()[0].tolist() == [3, 3, 0]
    assert skeleton.below(skeleton.own_sizes())[0].tolist() == [3 * 1 + 9 * 2, 1 + 3 * 2, 2]
