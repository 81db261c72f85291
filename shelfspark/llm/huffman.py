"""Token ids on disk as canonical, length-limited Huffman codes, and their way back.

Writing takes three steps. The texts are tokenised once into a table of packed ids. Global counts of ids (one row per
id, at most a vocabulary) give code lengths by package-merge, none above ``max_length``. The table is then ordered by
document id with range partitions, and every partition becomes one self-contained file:

    magic, the code lengths (zlib), then blocks of at most ``BLOCK_IDS`` ids, each with
      its head: number of ids, of pieces of documents, of payload bytes
      pieces: document id (int64), ids of the piece (uint32), flags (1: ends the document, 2: the id is null)
      checkpoints: the bit offset of every ``CHECK``-th id (uint32)
      payload: the codes, first bit highest

A block can be decoded without any other one. Checkpoints cut it into lanes, and all lanes are decoded in step with a
table that maps the next ``max_length`` bits to an id and the length of its code.

Nulls and ties: a null or empty text is its end id alone. Rows are ordered by ``doc_id`` (null first), then by the hash
of their ids, then by their place in the input; each row stays a document of its own. An empty table gives no files.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import slices, stored
from shelfspark.llm.token_files import open_file, write_file
from shelfspark.llm.tokens import encoder
from shelfspark.sources.scratch import scratch_path

MAX_LENGTH = 18
BLOCK_IDS, CHECK = 1 << 18, 256
FILE_IDS = 6_000_000

_MAGIC, _HEAD = b"SHELFHUF", struct.Struct("<III")
_LAST, _NULL = 1, 2
_PIECE = np.dtype([("doc_id", "<i8"), ("ids", "<u4"), ("flags", "u1")])


def code_lengths(counts: np.ndarray, max_length: int = MAX_LENGTH) -> np.ndarray:
    """Package-merge: the lengths (0 for ids that do not occur) of a shortest prefix code of at most ``max_length``."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if 1 << max_length < len(used):
        raise ValueError(f"{len(used)} ids need codes longer than {max_length} bits")
    coins = used[np.argsort(counts[used], kind="stable")]
    weights = counts[coins].astype(np.float64)
    is_coin, packages = [], np.empty(0)
    for _ in range(max_length):
        both = np.concatenate((weights, packages))
        order = np.argsort(both, kind="stable")
        is_coin.append(order < len(weights))
        both = both[order]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(coins) - 2
    for level in reversed(is_coin):
        n_coins = int(level[:take].sum())
        lengths[coins[:n_coins]] += 1
        take = 2 * (take - n_coins)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by rising length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        n = lengths[order].astype(np.int64)
        longest = n[-1]
        firsts = np.concatenate(([0], np.cumsum(np.left_shift(1, longest - n))[:-1]))
        codes[order] = (firsts >> (longest - n)).astype(np.uint64)
    return codes


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ``ids`` as bytes, and the bit offset of every ``CHECK``-th id."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    at = ends - n
    wide = codes[ids] << (64 - n - (at & 31)).astype(np.uint64)
    word = at >> 5
    firsts = np.flatnonzero(np.diff(word, prepend=-1))
    out = np.zeros(int(ends[-1] >> 5) + 3, np.uint64)
    out[word[firsts]] += np.add.reduceat(wide >> np.uint64(32), firsts)
    out[word[firsts] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), firsts)
    return out.astype(">u4").tobytes(), at[::CHECK].astype("<u4")


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For every value of the next bits: the id in the upper and the code's length in the lower bits."""
    longest = int(lengths.max(initial=1))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = np.left_shift(1, longest - lengths[order].astype(np.int64))
    entries = np.repeat((order.astype(np.uint32) << 8) | lengths[order], spans)
    return np.concatenate((entries, np.zeros((1 << longest) - len(entries), np.uint32))), longest


def unpack_bits(payload: bytes, checkpoints: np.ndarray, n_ids: int, table: np.ndarray, longest: int) -> np.ndarray:
    words = np.frombuffer(payload, ">u4").astype(np.uint64)
    wide = (words[:-1] << np.uint64(32)) | words[1:]
    at = checkpoints.astype(np.int64)
    out = np.empty((CHECK, len(at)), np.uint32)
    top, mask = 64 - longest, np.uint64((1 << longest) - 1)
    last = len(wide) - 1
    for step in range(CHECK):
        bits = (wide[np.minimum(at >> 5, last)] >> (top - (at & 31)).astype(np.uint64)) & mask
        found = table[bits]
        out[step] = found >> 8
        at += found & 0xFF
    return out.T.reshape(-1)[:n_ids]


def _blocks(pieces: Iterator[tuple[int | None, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cut documents into blocks of ``BLOCK_IDS`` ids: the ids of each, and its table of pieces."""
    held, rows, room = [], [], BLOCK_IDS
    for doc_id, ids in pieces:
        while True:
            part, ids = ids[:room], ids[room:]
            held.append(part)
            rows.append((doc_id or 0, len(part), (_LAST if not len(ids) else 0) | (_NULL if doc_id is None else 0)))
            room -= len(part)
            if not room:
                yield np.concatenate(held), np.array(rows, _PIECE)
                held, rows, room = [], [], BLOCK_IDS
            if not len(ids):
                break
    if held:
        yield np.concatenate(held), np.array(rows, _PIECE)


def file_chunks(pieces: Iterator[tuple[int | None, np.ndarray]], lengths: np.ndarray) -> Iterator[bytes]:
    codes, packed = canonical_codes(lengths), zlib.compress(lengths.tobytes(), 6)
    yield _MAGIC + struct.pack("<I", len(packed)) + packed
    for ids, rows in _blocks(pieces):
        payload, checkpoints = pack_bits(ids, codes, lengths)
        yield _HEAD.pack(len(ids), len(rows), len(payload)) + rows.tobytes() + checkpoints.tobytes() + payload


def read_blocks(stream) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The blocks of a file: ids, table of pieces."""
    head = stream.read(len(_MAGIC) + 4)
    if head[: len(_MAGIC)] != _MAGIC:
        raise ValueError("not a file of Huffman-coded ids")
    lengths = np.frombuffer(zlib.decompress(stream.read(struct.unpack("<I", head[len(_MAGIC) :])[0])), np.uint8)
    table, longest = decode_table(lengths)
    while head := stream.read(_HEAD.size):
        n_ids, n_rows, n_bytes = _HEAD.unpack(head)
        rows = np.frombuffer(stream.read(n_rows * _PIECE.itemsize), _PIECE)
        checkpoints = np.frombuffer(stream.read(-(-n_ids // CHECK) * 4), "<u4")
        yield unpack_bits(stream.read(n_bytes), checkpoints, n_ids, table, longest), rows


def tokenized(docs: DataFrame, vocabulary: str, doc_id: str, text: str, end_id: int) -> DataFrame:
    """``doc_id long, ids binary``: packed ids with the end id."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in slices(batches, "text", rows=4096):
            ids = enc.encode_array(batch["text"], end).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids], ["doc_id", "ids"])

    return named.mapInArrow(encode, "doc_id long, ids binary")


def id_counts(tokens: DataFrame, dtype: str) -> np.ndarray:
    """How often each id occurs; at most a vocabulary of numbers reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(iter([batch]), "ids"):
                got = np.bincount(np.frombuffer(b"".join(part["ids"].to_pylist()), dtype))
                if len(got) > len(total):
                    total = np.concatenate((total, np.zeros(len(got) - len(total), np.int64)))
                total[: len(got)] += got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    counts[rows["id"]] = rows["n"]
    return counts


def write_token_files(
    docs: DataFrame,
    vocabulary: str,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    max_length: int = MAX_LENGTH,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the files; one row each: ``file int, path string, n_ids long, n_bytes long``, in document order."""
    spark = docs.sparkSession
    dtype = encoder(vocabulary).dtype.str
    tokens = stored(spark, tokenized(docs, vocabulary, doc_id, text, end_id), "token-ids")
    counts = id_counts(tokens, dtype)
    lengths = code_lengths(counts, max_length)
    n_files = max(1, -(-int(counts.sum()) // file_ids))
    # Equal document ids spread by their text and place, so no range is larger than the others.
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), F.col("place")]
    ordered = (
        tokens.withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(n_files, *keys)
        .sortWithinPartitions(*keys)
        .select(F.spark_partition_id().alias("file"), "doc_id", "ids")
    )
    shared = spark.sparkContext.broadcast(lengths)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        number, seen = first["file"][0].as_py(), 0

        def pieces():
            nonlocal seen
            for batch in itertools.chain([first], batches):
                for part in slices(iter([batch]), "ids"):
                    for i, ids in zip(part["doc_id"].to_pylist(), part["ids"].to_pylist(), strict=True):
                        ids = np.frombuffer(ids, dtype)
                        seen += len(ids)
                        yield i, ids

        name = f"ids-{number:08d}.huf"
        size = write_file(folder, name, file_chunks(pieces(), shared.value))
        yield pa.RecordBatch.from_pydict(
            {"file": pa.array([number], pa.int32()), "path": [f"{folder}/{name}"], "n_ids": [seen], "n_bytes": [size]}
        )

    return stored(
        spark, ordered.mapInArrow(write, "file int, path string, n_ids long, n_bytes long"), "token-file-list"
    )


def read_token_files(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """``file int, place long, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary`` of every document
    in the files. ``place`` and ``start`` count the documents and ids before it in its file; ``ids`` are little-endian
    unsigned 32-bit integers, over which the checksum goes, or null without ``with_ids``."""
    n = files.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, path in zip(batch["file"].to_pylist(), batch["path"].to_pylist(), strict=True):
                place, start, held = 0, 0, []
                with open_file(path) as stream:
                    for ids, rows in read_blocks(stream):
                        docs, places, starts, sizes, sums, out, at = [], [], [], [], [], [], 0
                        for i, k, flags in rows.tolist():
                            held.append(ids[at : at + k])
                            at += k
                            if flags & _LAST:
                                whole = np.concatenate(held) if len(held) > 1 else held[0]
                                docs.append(None if flags & _NULL else i)
                                places.append(place)
                                starts.append(start)
                                packed = whole.astype("<u4").tobytes()
                                sizes.append(len(whole))
                                sums.append(zlib.crc32(packed))
                                out.append(packed if with_ids else None)
                                place, start, held = place + 1, start + len(whole), []
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([number] * len(docs), pa.int32()),
                                pa.array(places, pa.int64()),
                                pa.array(docs, pa.int64()),
                                pa.array(starts, pa.int64()),
                                pa.array(sizes, pa.int64()),
                                pa.array(sums, pa.int64()),
                                pa.array(out, pa.binary()),
                            ],
                            ["file", "place", "doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                        )

    return (
        files.select("file", "path")
        .repartition(max(1, n))
        .mapInArrow(
            read, "file int, place long, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
        )
    )


def file_starts(files: DataFrame) -> DataFrame:
    """``file int, before long``: ids in the files before each one, by a running sum over one row per file."""
    before = F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    return files.select("file", F.coalesce(before, F.lit(0)).alias("before"))


def round_trip(docs: DataFrame, vocabulary: str, **named) -> DataFrame:
    """Write the files, read them back: ``doc_id, start long, n_tokens long, ids_crc32 long`` of each document."""
    files = write_token_files(docs, vocabulary, scratch_path(docs.sparkSession, "token-files"), **named)

    found = read_token_files(files, with_ids=False).drop("ids", "place")
    return found.join(F.broadcast(file_starts(files)), "file").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
