"""The trie of conversations against brute force, with one node a shard and a queue of two, and on odd rows."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from shelfspark.llm import prefix_trie as T

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
RESULT = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h, foot = zlib.crc32(str(c).encode()) % 6, c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(foot, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(m) - 1) * (len(node[-1][1]) if node else 0)
            leaves[node[:d]] += not children[node]
    out = {}
    for node, m in members.items():
        ended = ",".join(str(c) for c in sorted(m) if built[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out[min(m), len(node)] = (parent, len(m), children[node], leaves[node], saved[node], hashlib.sha256(ended.encode()).hexdigest())
    return out


def found(df):
    got = T.prefix_trie(df).collect()
    assert len({(r["conv_id"], r["depth"]) for r in got}) == len(got)
    return {(r["conv_id"], r["depth"]): tuple(r[c] for c in RESULT) for r in got}


def test_equals_brute_force(spark):
    talks = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = brute([tuple(r) for r in talks.collect()])
    assert max(v[1] for v in want.values()) > 5 and found(talks) == want


def shared_prefixes():
    """Conversations of one letter a turn over many hundreds, so that parents lie in other shards."""
    rows = []
    for c in range(0, 6000, 37):
        word = f"{c % 7}{c % 5}{c % 3}{c % 2}{c % 11}{c % 13}"[: 2 + c % 5]
        rows += [(c, k, "user", letter * (1 + k)) for k, letter in enumerate(word)]
    return rows


@pytest.mark.parametrize(("shard_nodes", "queue"), [(1, 100), (50, 2), (10**9, 1)])
def test_shards_and_spills(spark, shard_nodes, queue):
    rows = shared_prefixes()
    nodes = T.stored(spark, T.trie_nodes(T.rebuilt_paths(spark.createDataFrame(rows, SCHEMA))), "nodes")
    got = {(r["conv_id"], r["depth"]): (r["n_leaves"], r["saved_tokens"]) for r in T.subtree_totals(nodes, shard_nodes, queue).collect()}
    assert got == {k: v[3:5] for k, v in brute(rows).items()}


def test_queue_spills_the_shallow_half():
    late = []
    queue = T.SpillingQueue(4, lambda to, a, b: late.append((to, a, b)))
    for depth in (5, 9, 7, 1, 3):
        queue.push(depth, 1, depth, 0)
        queue.push(depth, 1, 1, 2)
    assert sorted(late) == [((1, 1), 2, 2), ((3, 1), 3, 0), ((5, 1), 6, 2)]
    assert queue.pop(9, 1) == (10, 2) and queue.pop(8, 1) == (0, 0) and queue.pop(7, 1) == (8, 2)
    assert queue.pop(3, 1) == (1, 2)  # what came after the spill


def test_pieces_of_digests(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 3)
    rows = [(100 * c, 0, "user", "same") for c in range(50)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and got[0, 1][1] == 50


def test_odd_rows(spark):
    rows = [
        (200, None, "user", "first"), (200, 1, None, "x"), (200, 1, None, "x"), (200, 2, "user", None), (200, 3, "a", ""),
        (201, 0, "user", "first"), (203, 5, "b", "y"), (204, 1, "", "x" * 300_000), (None, 1, "user", "lost"),
        (-150, 1, "u", "minus"), (-100, 1, "u", "foot"), (305, 1, "u", "no foot"), (7, 1, "a1", "b"), (8, 1, "a", "1b"),
        *[(210, k, "u", "z") for k in range(400)],
    ]
    talks = spark.createDataFrame([(*r, 1, b"k") for r in rows], SCHEMA + ", depth int, key binary")
    want = brute(rows)
    assert found(talks) == want and any(k[1] == 0 for k in want)
    assert found(talks.limit(0)) == {} and found(talks.where("conv_id IS NULL")) == {}
