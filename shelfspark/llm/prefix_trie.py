"""Prefix trie of conversations, with subtree totals by time-forward processing.

*Conversations.* Turns are ordered by turn (null first), then role and text; null roles and texts are empty. Each
conversation is rebuilt: it begins with the first h turns of the conversation at the foot of its hundred (``c - c % 100``,
the sign of ``c`` kept) and goes on with its own turns behind its first h, h being crc32 of its id modulo ``HEADS``. One
stream over rows sorted by hundred holds no more than those few first turns and a running hash.

*Nodes.* A node is a distinct sequence of turns, named by a running SHA-256, of which 16 bytes are kept. Counts and
smallest members come from one aggregation, parents from one join.

*Totals.* Leaves and saved tokens of a subtree are sums over its nodes. Nodes are dealt to shards by the hundred of their
smallest member; a shard's nodes are sorted by falling depth (Spark's external sort), and a priority queue takes each
node's total to its parent, which comes later. Totals for parents elsewhere leave the shard. They are summed by parent
and are the messages of the next pass, over the shards that have some, until none is left. The queue holds
``QUEUE`` messages; beyond that the ones for the least depths are spilled the same way, as rows for Spark's shuffle, and
arrive one pass later: sums do not mind. A pass yields what it adds to each node, and the passes are added up.

Rows without a conversation id belong to no conversation. Repeated rows are turns of their own. An empty table gives no
rows. Other columns are not read. Lists of members are never gathered: their digests are fed in order from pieces of
``PIECE`` ids. A single conversation is one stream, whatever its length, in constant memory.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import stored

HUNDRED, HEADS = 100, 6
SHARD_NODES = 4096
QUEUE, PIECE = 100_000, 8192
_ROWS = 8192
_KEY = 16

_PATHS = "key binary, parent binary, depth long, chars long, conv_id long, ends boolean"


def _base(conv: str = "conv_id"):
    return F.col(conv) - F.col(conv) % HUNDRED


class _Rows:
    """Rows gathered for Arrow batches of a schema."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows = schema, []

    def add(self, *row) -> None:
        self.rows.append(row)

    def batches(self, least: int = _ROWS) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= max(least, 1):
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema
            )
            self.rows = []


def _turn(role: str, text: str) -> bytes:
    """A turn as bytes from which role and text can be told."""
    a, b = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
    return b"%d,%d:" % (len(a), len(b)) + a + b


def heads(conv: int) -> int:
    return zlib.crc32(str(conv).encode()) % HEADS


class _Conversation:
    """A conversation on its way: first its borrowed turns, then its own."""

    def __init__(self, conv: int, borrowed: list[tuple[bytes, int]], out: _Rows):
        self.conv, self.out, self.depth, self.own = conv, out, 0, 0
        self.skip = heads(conv)
        self.hash, self.last = hashlib.sha256(), None
        self._is(None, 0)
        for turn, chars in borrowed[: self.skip]:
            self._go(turn, chars)

    def _is(self, parent: bytes | None, chars: int) -> None:
        """The node reached is kept back until it is known whether another follows."""
        self.last = (self.hash.digest()[:_KEY], parent, self.depth, chars, self.conv)

    def _go(self, turn: bytes, chars: int) -> None:
        self.out.add(*self.last, False)
        self.hash.update(turn)
        self.depth += 1
        self._is(self.last[0], chars)

    def turn(self, turn: bytes, chars: int) -> None:
        self.own += 1
        if self.own > self.skip:
            self._go(turn, chars)

    def end(self) -> None:
        self.out.add(*self.last, True)


def rebuilt_paths(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each beginning of each rebuilt conversation: ``key`` and ``parent`` of its node, ``depth``, ``chars``
    of its last text, ``conv_id``, and whether the conversation ``ends`` there."""
    schema = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("chars", pa.int64()), ("conv_id", pa.int64()), ("ends", pa.bool_())])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, base, first, now = _Rows(schema), None, [], None
        for batch in batches:
            for b, c, r, t in zip(*(batch[k].to_pylist() for k in ("base", "conv_id", "role", "text")), strict=True):
                if b != base:
                    base, first = b, []
                said = _turn(r, t)
                if c == base and len(first) < HEADS:
                    first.append((said, len(t)))
                if now is None or now.conv != c:
                    if now:
                        now.end()
                    # The foot of a hundred borrows from itself, which is what it would say anyway
                    now = _Conversation(c, first if c != base else [], out)
                    if c == base:
                        now.skip = 0
                now.turn(said, len(t))
                yield from out.batches()
        if now:
            now.end()
        yield from out.batches(0)

    known = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    known = known.withColumn("base", _base())
    order = ["base", F.col("conv_id") != F.col("base"), "conv_id", F.asc_nulls_first("turn"), "role", "text"]
    return known.repartition("base").sortWithinPartitions(*order).mapInArrow(rebuild, _PATHS)


def _end_digests(paths: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of nodes at which conversations end. Ids are sorted over all tasks and joined to pieces;
    only pieces of one node meet in a task."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))
        key, ids = None, []
        for batch in batches:
            for k, c in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if ids and (k != key or len(ids) == PIECE):
                    out.add(key, ids[0], ",".join(map(str, ids)))
                    ids = []
                    yield from out.batches(256)
                key = k
                ids.append(c)
        if ids:
            out.add(key, ids[0], ",".join(map(str, ids)))
        yield from out.batches(0)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())]))
        key, state = None, None
        for batch in batches:
            for k, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if k != key:
                    if state:
                        out.add(key, state.hexdigest())
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield from out.batches()
        if state:
            out.add(key, state.hexdigest())
        yield from out.batches(0)

    ended = paths.where("ends").select("key", "conv_id").repartitionByRange("key", "conv_id")
    joined = ended.sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first long, ids string")
    sorted_ = joined.repartition("key").sortWithinPartitions("key", "first")
    return sorted_.mapInArrow(digests, "key binary, ends_sha256 string")


def trie_nodes(paths: DataFrame) -> DataFrame:
    """A row for each node: ``conv_id, depth, parent_conv_id, n_convs, n_children, ends_sha256`` and what it adds to its
    subtrees, ``leaf`` and ``saved``."""
    nodes = stored(
        paths.sparkSession,
        paths.groupBy("key").agg(
            F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("chars").alias("chars"),
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        ),
        "trie-nodes",
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(above, "parent", "left")
        .join(children, "key", "left")
        .join(_end_digests(paths), "key", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
            F.isnull("n_children").cast("long").alias("leaf"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        )
    )


# --- time-forward processing


class SpillingQueue:
    """Sums waiting for nodes, by falling depth. Beyond ``most`` destinations the shallower half is spilled."""

    def __init__(self, most: int, spill: Callable[[tuple[int, int], int, int], None]):
        self.most, self.spill, self.heap, self.sums = most, spill, [], {}

    def push(self, depth: int, conv: int, leaves: int, saved: int) -> None:
        at = (-depth, conv)
        if at in self.sums:
            a, b = self.sums[at]
            self.sums[at] = (a + leaves, b + saved)
            return
        self.sums[at] = (leaves, saved)
        heapq.heappush(self.heap, at)
        if len(self.heap) > self.most:
            self.heap.sort()
            for late in self.heap[self.most // 2 :]:
                self.spill((-late[0], late[1]), *self.sums.pop(late))
            del self.heap[self.most // 2 :]

    def pop(self, depth: int, conv: int) -> tuple[int, int]:
        """What waits for this node; it must be the first in order if anything does."""
        if self.heap and self.heap[0] == (-depth, conv):
            return self.sums.pop(heapq.heappop(self.heap))
        return 0, 0


_MOVES = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("message", pa.bool_())])


def pass_totals(rows: DataFrame, queue: int = QUEUE) -> DataFrame:
    """One pass over shards. ``rows``: nodes (``leaf`` and ``saved`` are what they add themselves) and messages
    (``message``: what arrives for a node), sorted within their shards. Gives what each node gains and, as messages,
    what goes to nodes of other shards."""

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, shard, arrived = _Rows(_MOVES), None, [0, 0]
        waiting = SpillingQueue(queue, lambda to, a, b: out.add(to[1], to[0], a, b, True))
        names = ("shard", "conv_id", "depth", "parent_conv_id", "parent_shard", "leaf", "saved", "message")
        for batch in batches:
            for s, c, d, p, ps, leaf, saved, message in zip(*(batch[n].to_pylist() for n in names), strict=True):
                if s != shard:
                    shard, arrived = s, [0, 0]
                if message:  # one row at most for a node, right before it
                    arrived = [leaf, saved]
                    continue
                a, b = waiting.pop(d, c)
                leaf, saved, arrived = leaf + a + arrived[0], saved + b + arrived[1], [0, 0]
                if leaf or saved:
                    out.add(c, d, leaf, saved, False)
                    if p is None:
                        pass
                    elif ps == s:
                        waiting.push(d - 1, p, leaf, saved)
                    else:
                        out.add(p, d - 1, leaf, saved, True)
            yield from out.batches()
        yield from out.batches(0)

    return rows.mapInArrow(forward, "conv_id long, depth long, leaves long, saved long, message boolean")


def subtree_totals(nodes: DataFrame, shard_nodes: int = SHARD_NODES, queue: int = QUEUE) -> DataFrame:
    """``conv_id, depth, n_leaves, saved_tokens`` of each node's subtree."""
    spark = nodes.sparkSession
    shards = F.lit(nodes.count() // shard_nodes + 1)

    def shard(conv):
        return F.pmod(F.xxhash64(_base(conv)), shards)

    own = nodes.select(
        shard("conv_id").alias("shard"), "conv_id", "depth", "parent_conv_id", shard("parent_conv_id").alias("parent_shard"),
        "leaf", "saved", F.lit(False).alias("message"),
    )
    rows, gains = own, None
    while True:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = ["shard", F.desc("depth"), "conv_id", F.desc("message")]
        moves = stored(spark, pass_totals(rows.repartition(parts, "shard").sortWithinPartitions(*order), queue), "moves")
        gained = moves.where("NOT message").select("conv_id", "depth", "leaves", "saved")
        gains = gained if gains is None else gains.unionByName(gained)
        messages = moves.where("message").groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaf"), F.sum("saved").alias("saved"))
        messages = stored(spark, messages.withColumn("shard", shard("conv_id")), "messages")
        if messages.isEmpty():
            break
        none = F.lit(None).cast("long")
        arrived = messages.select(
            "shard", "conv_id", "depth", none.alias("parent_conv_id"), none.alias("parent_shard"), "leaf", "saved",
            F.lit(True).alias("message"),
        )
        # From now on nodes add nothing of their own
        silent = own.join(messages.select("shard").distinct(), "shard", "left_semi")
        zero = F.lit(0).cast("long")
        rows = silent.withColumn("leaf", zero).withColumn("saved", zero).select(*own.columns).unionByName(arrived)
    return gains.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of rebuilt conversations, with their totals."""
    spark = conversations.sparkSession
    paths = stored(spark, rebuilt_paths(conversations), "paths")
    nodes = stored(spark, trie_nodes(paths), "nodes")
    return nodes.join(subtree_totals(nodes), ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
