"""Spelling variant grouping: words at an edit distance of one, found by a trie over letter counts.

*Words.* Maximal runs of letters (``A-Z a-z`` and U+00C0 to U+00FF) with A-Z lower-cased, counted over all documents.
A run whose checksum with its document's id is divisible by ``EVERY`` loses one code point first, so that slips of the
pen exist in any corpus. Results of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences are words.

*Search.* The letters are dealt into ``SHARD_GROUPS`` coarse and ``LEVELS`` fine groups of about equal use. One inserted,
deleted or replaced letter raises at most one group's count by one and lowers at most one by one. Words with the same
coarse counts form a shard, cut into packs of about ``PACK`` words; a pack meets only the packs of shards within that
budget (half of them: each pair of words is looked for from one side). Within two packs, one is a trie whose levels are
its fine counts, and a depth-first search carries the other pack's words down, each with a surplus and a deficit of one
to spend. Words that reach a leaf are compared letter by letter. Nothing is lost: the budget is necessary for a pair,
and every pair of packs within it is searched. Packs are made by hash, so a shard of any size is many bounded packs.

*Forms.* A word's form is its near word of largest count, if that is twice its own at least. Counts at least double
along forms, so roots are found by doubling pointers in a few joins.

Null texts have no words; a null id counts as an empty one; repeated rows count as often as they occur; other columns
are not read. Empty tables give no rows. Texts of any length are read in pieces that end between runs. Counts are kept
in at most ``KEPT`` entries a task and then passed on, so memory does not grow with the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import slices, stored
from shelfspark.sources.scratch import delete_path

EVERY = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
SHARD_GROUPS, LEVELS = 5, 16
PACK, LEAF, BATCH = 2048, 8, 32_768
KEPT = 200_000
_PIECE = 1 << 20
_RUN = re.compile("[a-zÀ-ÿ]+")
_GAP = re.compile("[^a-zÀ-ÿ]")


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > _PIECE:
        gap = _GAP.search(text, start + _PIECE)
        if not gap:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:] if start else text


def _slip(run: str, check: int) -> str:
    if check % EVERY:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word string, n long`` of the whole corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return out

        for batch in slices(batches, "text"):
            for name, body in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if not body:
                    continue
                begun = zlib.crc32(f"{name or ''}:".encode())
                # bytes.lower() touches A-Z only
                lowered = body.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                for piece in _pieces(lowered):
                    for run, n in Counter(_RUN.findall(piece)).items():
                        word = _slip(run, zlib.crc32(run.encode(), begun))
                        if len(word) >= LEAST_LENGTH:
                            counts[word] += n
                    if len(counts) > KEPT:
                        yield passed()
        yield passed()

    named = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    parts = named.mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- letter groups and packs


def _letters(data: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array and each value's end therein."""
    flat = pa.concat_arrays([data])
    offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
    return np.frombuffer(flat.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def letter_uses(words: DataFrame) -> np.ndarray:
    """How often each of the 256 code points occurs in ``words``; no more than 256 rows reach the driver."""

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            total += np.bincount(_letters(batch["data"])[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["letter", "n"])

    rows = words.select("data").mapInArrow(uses, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    total = np.zeros(256, np.int64)
    for row in rows.collect():
        total[row["letter"]] = row["n"]
    return total


def deal_letters(uses: np.ndarray, groups: int) -> np.ndarray:
    """Group of each letter: letters by falling use, each to the group used least so far."""
    load, group = np.zeros(groups, np.int64), np.zeros(256, np.uint8)
    for letter in sorted(range(256), key=lambda x: (-uses[x], x)):
        group[letter] = load.argmin()
        load[group[letter]] += uses[letter]
    return group


def group_counts(letters: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Counts by group, for words that are the rows of ``letters``."""
    cells = group[letters] + (np.arange(len(letters)) * groups)[:, None]
    return np.bincount(cells.ravel(), minlength=len(letters) * groups).reshape(-1, groups)


def _neighbours(key: str) -> list[str]:
    """Keys that a word of ``key`` is looked for in: its own, one count higher by one, or one higher and a later one
    lower. The other half of the budget is covered from the other side."""
    counts = [int(c) for c in key.split(",")]
    out = [counts]
    for i in range(len(counts)):
        higher = counts[:i] + [counts[i] + 1] + counts[i + 1 :]
        out.append(higher)
        out += [higher[:j] + [higher[j] - 1] + higher[j + 1 :] for j in range(i + 1, len(counts)) if higher[j]]
    return [",".join(map(str, c)) for c in out]


# --- search


class Trie:
    """Words as rows of letters, sorted by their counts: a node is a range of rows that agree in the first levels."""

    def __init__(self, letters: np.ndarray, counts: np.ndarray):
        self.letters, self.counts = letters, counts

    def search(self, letters: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the trie and of the given words that are at an edit distance of one."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        everyone = np.arange(len(letters))
        none = np.zeros(len(letters), np.int8)
        self._down(0, len(self.letters), 0, everyone, none, none, counts, letters, found)
        if not found:
            return everyone[:0], everyone[:0]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _down(self, low, high, level, who, surplus, deficit, counts, letters, found) -> None:
        if high - low <= LEAF or level == self.counts.shape[1]:
            self._verify(low, high, who, letters, found)
            return
        column, asked = self.counts[low:high, level], counts[who, level]
        edges = np.flatnonzero(column[1:] != column[:-1]) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), high - low], strict=True):
            more = asked - column[a]
            up, down = surplus + (more > 0), deficit + (more < 0)
            stay = np.flatnonzero((np.abs(more) <= 1) & (up <= 1) & (down <= 1))
            if len(stay):
                self._down(low + a, low + b, level + 1, who[stay], up[stay], down[stay], counts, letters, found)

    def _verify(self, low, high, who, letters, found) -> None:
        for a in range(low, high, LEAF):
            mine = np.repeat(np.arange(a, min(a + LEAF, high)), len(who))
            theirs = np.tile(who, min(a + LEAF, high) - a)
            near = one_apart(self.letters[mine], letters[theirs])
            if near.any():
                found.append((mine[near], theirs[near]))


def one_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` differ from ``b`` by one replaced letter or, where ``a`` is longer by one, one inserted."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    n = b.shape[1]
    end = np.ones((len(a), 1), bool)
    head = np.concatenate((a[:, :n] != b, end), 1).argmax(1)
    tail = np.concatenate(((a[:, 1:] != b)[:, ::-1], end), 1).argmax(1)
    return head + tail >= n


_PACK_SCHEMA = "key string, block long, data binary, n binary"
_PAIR_SCHEMA = "a binary, a_n long, b binary, b_n long"


def _unpacked(data: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(n, np.int64)
    return np.frombuffer(data, np.uint8).reshape(len(numbers), -1), numbers


def _values(letters: np.ndarray) -> pa.Array:
    """Rows of letters as a binary array."""
    ends = np.arange(len(letters) + 1, dtype=np.int32) * np.int32(letters.shape[1])
    return pa.Array.from_buffers(
        pa.binary(), len(letters), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(letters))]
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: each unordered pair of ``words`` (``data`` in Latin-1, ``n``) at an edit distance of one."""
    spark = words.sparkSession
    uses = letter_uses(words)
    coarse, fine = deal_letters(uses, SHARD_GROUPS), deal_letters(uses, LEVELS)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, ends = _letters(batch["data"])
            dealt = coarse[letters]
            keys = []
            for g in range(SHARD_GROUPS):
                sums = np.concatenate(([0], np.cumsum(dealt == g)))[np.concatenate(([0], ends))]
                keys.append(np.diff(sums).tolist())
            names = pa.array([",".join(map(str, k)) for k in zip(*keys, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([names, batch["data"], batch["n"]], ["key", "data", "n"])

    def packed(group: pa.Table) -> pa.Table:
        letters, ends = _letters(group["data"].combine_chunks())
        letters = letters.reshape(len(ends), -1)
        order = np.lexsort(group_counts(letters, fine, LEVELS).T[::-1])
        number = group["n"].to_numpy()[order].astype(np.int64)
        columns = [[group["key"][0].as_py()], [group["block"][0].as_py()], [letters[order].tobytes()], [number.tobytes()]]
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "block", "data", "n"]
        )

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A pack comes first, and behind it those that are looked for in it; words of one length go down together."""
        trie, trie_n, waiting = None, None, {}

        def answers(width: int) -> Iterator[pa.RecordBatch]:
            theirs, theirs_n, same = (np.concatenate(x) for x in zip(*waiting.pop(width), strict=True))
            i, j = trie.search(theirs, group_counts(theirs, fine, LEVELS))
            twice = same[j]  # such pairs are found from both sides
            if twice.any():
                ours, other = trie.letters[i[twice]], theirs[j[twice]]
                at = ((ours != other).argmax(1))[:, None]
                keep = ~twice
                keep[twice] = (np.take_along_axis(ours, at, 1) < np.take_along_axis(other, at, 1))[:, 0]
                i, j = i[keep], j[keep]
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [_values(trie.letters[i]), pa.array(trie_n[i]), _values(theirs[j]), pa.array(theirs_n[j])],
                    ["a", "a_n", "b", "b_n"],
                )

        for batch in batches:
            for row in batch.select(["role", "data", "n"]).to_pylist():
                letters, number = _unpacked(row["data"], row["n"])
                if row["role"] == 0:
                    for width in list(waiting):
                        yield from answers(width)
                    trie, trie_n = Trie(letters, group_counts(letters, fine, LEVELS)), number
                    continue
                held = waiting.setdefault(letters.shape[1], [])
                held.append((letters, number, np.full(len(number), row["role"] == 1)))
                if sum(len(h[1]) for h in held) >= BATCH:
                    yield from answers(letters.shape[1])
        for width in list(waiting):
            yield from answers(width)

    shards = stored(spark, words.mapInArrow(keyed, "key string, data binary, n long"), "shards")
    sizes = shards.groupBy("key").agg(F.ceil(F.count("*") / PACK).alias("blocks"))
    placed = shards.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("data"), F.col("blocks")))
    packs = stored(spark, placed.drop("blocks").groupBy("key", "block").applyInArrow(packed, _PACK_SCHEMA), "packs")
    delete_path(spark, shards.inputFiles()[0].rpartition("/")[0])

    beside = F.udf(_neighbours, "array<string>")  # over one row for each pack
    asking = packs.select(F.col("key").alias("key2"), F.col("block").alias("block2"), F.explode(beside("key")).alias("key"))
    met = packs.select("key", "block").join(asking, "key")
    asked = packs.select(F.col("key").alias("key2"), F.col("block").alias("block2"), "data", "n")
    role = F.when(F.col("key") == F.col("key2"), 1).otherwise(2)
    rows = packs.select("key", "block", F.lit(0).alias("role"), "data", "n").unionByName(
        met.join(asked, ["key2", "block2"]).select("key", "block", role.alias("role"), "data", "n")
    )
    # The number is given, so that AQE does not merge partitions of few bytes and much work
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "key", "block").sortWithinPartitions("key", "block", "role")
    return dealt.mapInArrow(searched, _PAIR_SCHEMA)


# --- forms


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for words that have a form: the last word that forms lead to."""
    spark = forms.sparkSession
    now = stored(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        after = now.join(ahead, "root", "left")
        moved = stored(
            spark,
            after.select("word", F.coalesce("beyond", "root").alias("root"), F.isnotnull("beyond").alias("moved")),
            "roots",
        )
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for each word of ``docs``."""
    spark = docs.sparkSession
    words = stored(spark, word_counts(docs, doc_id, text), "words")
    if words.isEmpty():
        return words.select(
            "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n",
            F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"),
        )
    pairs = near_pairs(words.select(F.encode("word", "ISO-8859-1").alias("data"), "n"))
    ways = F.array(
        F.struct(F.col("a").alias("data"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("data"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    # Latin-1 bytes sort as code points do
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    near = (
        pairs.select(F.inline(ways))
        .groupBy("data", "n")
        .agg(F.count("*").alias("n_near"), best.alias("best"))
        .select(
            F.decode("data", "ISO-8859-1").alias("word"),
            "n_near",
            F.when(-F.col("best.minus") >= 2 * F.col("n"), F.decode("best.near", "ISO-8859-1")).alias("form"),
            F.when(-F.col("best.minus") >= 2 * F.col("n"), -F.col("best.minus")).alias("form_n"),
        )
    )
    near = stored(spark, near, "near-words")
    roots = _roots(near.where("form IS NOT NULL"))
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_n").cast("long").alias("form_n"),
        )
    )
