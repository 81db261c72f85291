"""Packing: token ids of documents into sequences of at most ``capacity`` ids, first-fit decreasing in random groups.

A document longer than a sequence is cut into full sequences and a rest. The pieces are dealt into groups by a hash
(of document, piece and position in the input, so that neither a hot source nor a repeated id makes a large group) and
each group is packed by itself: pieces by falling length, each into the first sequence with room for it. A tournament
tree over the room left in each sequence finds that first one in logarithmic time. Some thousand pieces a group leave
little padding: what first-fit decreasing wastes lies in a group's last sequences.

Nulls and ties: a null or empty text is a document with just the end id. A null or repeated ``doc_id`` is packed row by
row like any other. Pieces of one length are taken by id, start and checksum. An empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import slices
from shelfspark.llm.tokens import encoder, ids_crc32

CAPACITY = 4096
GROUP_PIECES = 4096


class RoomTree:
    """Tournament tree over the room in bins: every node holds the most room below it."""

    def __init__(self, capacity: int, bins: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Put ``length`` into the first bin with that much room; the bin and the room it had."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < length:
                at += 1
        before = room[at]
        room[at] = before - length
        bin_number = at - self.leaves
        at //= 2
        while at:
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
            at //= 2
        return bin_number, before


def first_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """For lengths in falling order: the bin of each, and its place in the bin."""
    tree = RoomTree(capacity, max(1, len(lengths)))
    placed = (tree.place(n) for n in lengths)
    return [(b, capacity - room) for b, room in placed]


def token_pieces(
    docs: DataFrame, vocabulary: str, doc_id: str, text: str, end_id: int, capacity: int, with_ids: bool = True
) -> DataFrame:
    """``doc_id, start long, length long, doc_tokens long, row long, ids_crc32 long, ids binary``. ``row`` numbers the
    documents of a task; the checksum is that of unsigned 32-bit ids; ``ids`` are little-endian unsigned 16 or 32 bit
    as the vocabulary needs, or null."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = named.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = encoder(vocabulary), 0
        width, end = enc.dtype.itemsize, np.array([end_id], enc.dtype).tobytes()
        for batch in slices(batches, "text", rows=4096):
            which, starts, lengths, totals, rows, sums, out = [], [], [], [], [], [], []
            for k, ids in enumerate(enc.encode_array(batch["text"], end).to_pylist()):
                n = len(ids) // width
                for s in range(0, n, capacity):
                    piece = ids[s * width : (s + capacity) * width]
                    which.append(k)
                    starts.append(s)
                    lengths.append(len(piece) // width)
                    totals.append(n)
                    rows.append(row)
                    sums.append(ids_crc32(np.frombuffer(piece, enc.dtype)))
                    out.append(piece if with_ids else None)
                row += 1
            longs = [pa.array(x, pa.int64()) for x in (starts, lengths, totals, rows, sums)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(which, pa.int64())), *longs, pa.array(out, pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "row", "ids_crc32", "ids"],
            )

    return named.mapInArrow(
        cut, f"doc_id {id_type}, start long, length long, doc_tokens long, row long, ids_crc32 long, ids binary"
    )


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    seed: int = 7,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``sequence_id long, offset long, doc_id, start long, length long, doc_tokens long, ids_crc32
    long, ids binary``. A sequence is its pieces in the order of ``offset``, which is gapless from 0. Without
    ``with_ids`` the ids, which make up nearly all bytes, are not moved, and ``ids`` is null."""
    # A text has at most as many ids as bytes, and mostly a third; this sizes the groups and nothing else.
    guess = docs.agg(F.sum(F.lit(1) + F.coalesce(F.length(text), F.lit(0)) / F.lit(3 * capacity))).first()[0] or 0
    n_groups = max(1, round(guess / group_pieces))
    pieces = token_pieces(docs, vocabulary, doc_id, text, end_id, capacity, with_ids).withColumn(
        "pack_group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "row"), F.lit(n_groups))
    )
    id_type = pieces.schema["doc_id"].dataType.simpleString()

    names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"]

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        group = group.select(names).take(pc.sort_indices(group, sort_keys=order, null_placement="at_end"))
        placed = np.array(first_fit_decreasing(group["length"].to_pylist(), capacity), np.int64).reshape(-1, 2)
        sequence = (np.int64(key[0].as_py()) << 32) + placed[:, 0]
        return pa.Table.from_arrays(
            [pa.array(sequence), pa.array(placed[:, 1]), *group.columns], ["sequence_id", "offset", *names]
        )

    return (
        pieces.drop("row")
        .groupBy("pack_group")
        .applyInArrow(
            pack,
            f"sequence_id long, offset long, doc_id {id_type}, start long, length long, doc_tokens long, ids_crc32 long, "
            "ids binary",
        )
    )
