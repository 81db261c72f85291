"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark texts, each document scanned once.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. A window is ``WINDOW`` consecutive
words of an item; an item with fewer words, but not none, is one window. Every window, as its words between single
spaces, is a pattern of the automaton. A document is brought into the same form, scanned once, and the position of
each match is mapped to the words it covers and to characters of the original text.

Normalising works on UTF-8 bytes (every byte of a non-ASCII character is a word byte), which a ``latin-1`` string
carries one to one.

Size: the windows are dealt into blocks of about ``BLOCK_BYTES`` of pattern text and item ids by a hash, so what is
broadcast at a time, and the automaton a worker holds, has a bound (some 60 bytes for each byte of pattern). Documents
are read once: a benchmark within one block, some 30,000 windows, takes one scan of each; for a larger one a task
gathers documents of about ``PIECE_BYTES``, passes them through the automata of all blocks in turn and merges the spans
of each row. The report keeps the number of words, the hit words and the items of a row, each once, and no span; the
spans name the items of their windows, so a window of very many items is long there wherever it occurs.

Nulls: a null or empty text has no words, no hits and no items. A null item text has no windows; an item with a null
id is left out. Repeated items with one id count once. Columns other than the id and the text are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import slices

WINDOW = 10
BLOCK_BYTES = 2_000_000
PIECE_BYTES = 32_000_000

_SPACE = ord(" ")
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else _SPACE for c in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split() if text else []


def item_windows(text: str | None, window: int = WINDOW) -> list[bytes]:
    """The distinct windows of an item, as patterns that begin and end with a space."""
    words = normal_words(text)
    starts = range(max(1, len(words) - window + 1)) if words else ()
    return list(dict.fromkeys(b" " + b" ".join(words[i : i + window]) + b" " for i in starts))


def window_table(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """``pattern binary, n_words int, items array<string>``: each distinct window and the items that hold it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [
                (i, p, p.count(b" ") - 1)
                for i, t in zip(batch["item"].to_pylist(), batch["text"].to_pylist(), strict=True)
                for p in item_windows(t, window)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.binary(), pa.int32()))],
                ["item", "pattern", "n_words"],
            )

    named = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return (
        named.where("item IS NOT NULL")
        .mapInArrow(cut, "item string, pattern binary, n_words int")
        .groupBy("pattern", "n_words")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


_AUTOMATA: dict[int, tuple] = {}


def _automaton(key: int, patterns: list[bytes]):
    """Built once in each Python worker; only that of the last block is kept."""
    if key not in _AUTOMATA:
        found = ahocorasick.Automaton()
        for i, p in enumerate(patterns):
            found.add_word(p.decode("latin-1"), i)
        found.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[key] = found
    return _AUTOMATA[key]


def find_spans(text: str | None, automaton, n_words: np.ndarray) -> tuple[int, list[int], list[int]]:
    """Words of the text, and of each match the pattern and the number of its first word."""
    words = normal_words(text)
    if not words or not len(automaton):
        return len(words), [], []
    line = " " + b" ".join(words).decode("latin-1") + " "
    matches = list(automaton.iter(line))
    if not matches:
        return len(words), [], []
    ends = np.array([end for end, _ in matches])
    which = np.array([i for _, i in matches])
    spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == _SPACE)
    last = np.searchsorted(spaces, ends)  # the k-th space ends word k
    return len(words), which.tolist(), (last - n_words[which]).tolist()


def original_offsets(text: str, first: list[int], n_words: list[int]) -> tuple[list[int], list[int]]:
    """Characters ``[start, end)`` of the original text that runs of words cover."""
    raw = text.encode("utf-8", "surrogatepass")
    is_word = np.frombuffer(raw.translate(_NORMAL), np.uint8) != _SPACE
    edges = np.diff(np.concatenate(([0], is_word.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    f, n = np.array(first, int), np.array(n_words, int)
    return chars[starts[f]].tolist(), chars[ends[f + n - 1]].tolist()


def contaminated_spans(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, n_words long, spans array<struct<items, first_word, n_words, start, end>>``.

    ``start`` and ``end`` are characters of the original text. A document row stays one row, repeated rows included.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text"))
    return _scan(named, window_blocks(window_table(items, item_id, item_text, window), block_bytes))


def window_blocks(windows: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The windows in blocks of bounded size; one of them if all fit."""
    ids = F.aggregate("items", F.lit(0).cast("long"), lambda n, item: n + F.octet_length(item))
    total = windows.agg(F.coalesce(F.sum(F.length("pattern") + ids), F.lit(0))).first()[0]
    if total <= block_bytes:
        return [windows]
    # Hashing deals patterns evenly; a block is sized for two thirds of the bound.
    n = -(-total * 3 // (2 * block_bytes))
    return [windows.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == b) for b in range(n)]


def clean_documents(
    docs: DataFrame,
    items: DataFrame,
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no window of an item occurs."""
    blocks = _shared(window_blocks(window_table(items, item_id, item_text, window), block_bytes), "n_words")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, doc_text, len(blocks)):
            texts = [batch[doc_text].to_pylist() for batch in piece]
            clean = [[True] * len(t) for t in texts]

            def look(automaton, n_words, texts=texts, clean=clean):
                for t, rows in zip(texts, clean, strict=True):
                    for k, text in enumerate(t):
                        rows[k] = rows[k] and not find_spans(text, automaton, n_words)[1]

            _each_block(blocks, look)
            for batch, rows in zip(piece, clean, strict=True):
                yield batch.filter(pa.array(rows, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def _shared(blocks: list[DataFrame], *columns: str) -> list[tuple]:
    """Of each block a key, and what is broadcast: the patterns, in order, and the columns of each. The values of an
    automaton are positions in that order."""
    out = []
    for block in blocks:
        rows = sorted(block.select("pattern", *columns).collect(), key=lambda r: bytes(r[0]))  # at most block_bytes of patterns
        patterns = [bytes(r[0]) for r in rows]
        n_words = np.array([r[1] for r in rows], int)
        more = [[r[k] for r in rows] for k in range(2, len(columns) + 1)]
        shared = block.sparkSession.sparkContext.broadcast((patterns, n_words, *more))
        out.append((hash(tuple(patterns)), shared))
    return out


def _each_block(blocks: list[tuple], look: Callable) -> None:
    """Calls ``look`` with the automaton of each block and its columns; of several blocks one is held at a time."""
    for key, shared in blocks:
        patterns, *columns = shared.value
        look(_automaton(key, patterns), *columns)
        if len(blocks) > 1 and shared._path:
            shared.__dict__.pop("_value", None)  # read again from the worker's file


def _pieces(batches: Iterator[pa.RecordBatch], text: str, n_blocks: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches that go through all blocks together: one, or if automata have to be built again about ``PIECE_BYTES``."""
    piece, size = [], 0
    for batch in slices(batches, text):
        piece.append(batch)
        size += batch[text].nbytes
        if n_blocks == 1 or size >= PIECE_BYTES:
            yield piece
            piece, size = [], 0
    if piece:
        yield piece


SPANS = "array<struct<items:array<string>,first_word:int,n_words:int,start:int,end:int>>"


def _scan(docs: DataFrame, windows: list[DataFrame]) -> DataFrame:
    blocks = _shared(windows, "n_words", "items")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct(
            [("items", pa.list_(pa.string())), *((k, pa.int32()) for k in ("first_word", "n_words", "start", "end"))]
        )
        for piece in _pieces(batches, "text", len(blocks)):
            texts = [batch["text"].to_pylist() for batch in piece]
            counts = [[0] * len(t) for t in texts]
            spans = [[[] for _ in t] for t in texts]

            def look(automaton, n_words, items, texts=texts, counts=counts, spans=spans):
                for t, numbers, rows in zip(texts, counts, spans, strict=True):
                    for row, text in enumerate(t):
                        numbers[row], which, first = find_spans(text, automaton, n_words)
                        if not which:
                            continue
                        lengths = n_words[which].tolist()
                        start, end = original_offsets(text, first, lengths)
                        rows[row] += [
                            {"items": items[w], "first_word": f, "n_words": k, "start": s, "end": e}
                            for w, f, k, s, e in zip(which, first, lengths, start, end, strict=True)
                        ]

            _each_block(blocks, look)
            for batch, numbers, rows in zip(piece, counts, spans, strict=True):
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(numbers, pa.int64()), pa.array(rows, pa.list_(span))],
                    ["doc_id", "n_words", "spans"],
                )

    return docs.mapInArrow(scan, f"doc_id {id_type}, n_words long, spans {SPANS}")


def contamination_report(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``; ``contaminated_spans`` has the places.

    ``n_hit`` counts words inside any occurrence of a window; ``items_sha256`` is that of the ids of the items with
    occurring windows, sorted as strings and joined by commas. A document row stays one row, repeated rows included.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text"))
    blocks = _shared(window_blocks(window_table(items, item_id, item_text, window), block_bytes), "n_words", "items")
    id_type = named.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, "text", len(blocks)):
            texts = [batch["text"].to_pylist() for batch in piece]
            counts = [[0] * len(t) for t in texts]
            found: dict[tuple[int, int], tuple[set[int], set[str]]] = {}  # rows with matches: hit words, items

            def look(automaton, n_words, items, texts=texts, counts=counts, found=found):
                for b, t in enumerate(texts):
                    for row, text in enumerate(t):
                        counts[b][row], which, first = find_spans(text, automaton, n_words)
                        if not which:
                            continue
                        hit, held = found.setdefault((b, row), (set(), set()))
                        for f, n in zip(first, n_words[which].tolist(), strict=True):
                            hit.update(range(f, f + n))
                        for w in set(which):
                            held.update(items[w])

            _each_block(blocks, look)
            for b, batch in enumerate(piece):
                rows = [found.get((b, row), ((), ())) for row in range(batch.num_rows)]
                digests = [hashlib.sha256(",".join(sorted(held)).encode()).hexdigest() for _, held in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"],
                        pa.array(counts[b], pa.int64()),
                        pa.array([len(hit) for hit, _ in rows], pa.int64()),
                        pa.array([len(held) for _, held in rows], pa.int64()),
                        pa.array(digests, pa.string()),
                    ],
                    ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"],
                )

    report = named.mapInArrow(scan, f"doc_id {id_type}, n_words long, n_hit long, n_items long, items_sha256 string")
    return report.withColumn("contaminated", F.col("n_hit") > 0)
