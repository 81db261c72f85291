import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.llm import token_counts, tokens
from shelfspark.llm.common import stored
from shelfspark.llm.huffman import (
    CHECK,
    canonical_codes,
    code_lengths,
    decode_table,
    pack_bits,
    read_token_files,
    round_trip,
    unpack_bits,
    write_token_files,
)
from shelfspark.llm.packing import first_fit_decreasing, pack_documents
from shelfspark.llm.token_files import write_file
from shelfspark.llm.tokens import Encoder, vocabulary_path
from shelfspark.sources.scratch import scratch_path

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
ROWS = [
    (5, "Hello world, hello!  \n\tA  b."), (2, None), (9, ""), (2, "twice"), (2, "twice"), (None, "no id"),
    (7, " ".join(f"word{i % 977}" for i in range(9000))), (8, "# # #"), (10, "<|endoftext|> inside"),
]


@pytest.fixture(scope="module")
def encoders():
    return {n: Encoder(vocabulary_path(n)) for n in (BYTE, WORD)}


@pytest.mark.parametrize("name", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet="aéEß'.,!-_ \t\n\r  \x1c\x85İΣσ中́र<|>1²\U0001f600", max_size=25), max_size=4))
def test_units_give_the_library_s_ids(encoders, name, texts):
    e = encoders[name]
    want = [x.ids for x in e.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, e.dtype).tolist() for x in e.encode(texts)] == want
    end = np.array([2], e.dtype).tobytes()
    array = pa.array(["cut off", None, *texts, "cut off"], pa.string())[1:-1]
    at_once = [np.frombuffer(x, e.dtype).tolist() for x in e.encode_array(array, end).to_pylist()]
    assert at_once == [[2], *([*x, 2] for x in want)]


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_arrays_of_texts_beyond_the_memory(encoders, name, monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 50)
    e = Encoder(vocabulary_path(name))
    rng = random.Random(4)
    for _ in range(6):
        texts = ["".join(rng.choices("ab \n.é\u3000", k=rng.randint(0, 40))) for _ in range(60)]
        want = [x.ids for x in e.library.encode_batch(texts, add_special_tokens=False)]
        got = e.encode_array(pa.array(texts, pa.string()))
        assert [np.frombuffer(x, e.dtype).tolist() for x in got.to_pylist()] == want
    assert e.encode_array(pa.array([], pa.string())).to_pylist() == []


def ids_of(text, name, end):
    e = Encoder(vocabulary_path(name))
    return [*e.library.encode(text or "", add_special_tokens=False).ids, end]


def docs(spark):
    return spark.createDataFrame(
        [(i, t, 1, 2) for i, t in ROWS], "doc_id long, text string, start int, ids int"
    ).repartition(3)


def test_huffman_bits():
    rng = np.random.default_rng(0)
    for n, alphabet in ((1, 1), (300, 2), (5000, 700), (CHECK * 3, 5)):
        ids = (rng.zipf(1.3, n) % alphabet).astype(np.uint16)
        counts = np.bincount(ids)
        lengths = code_lengths(counts, 12)
        assert lengths.max() <= 12 and sum(2.0 ** -int(x) for x in lengths if x) <= 1
        payload, checks = pack_bits(ids, canonical_codes(lengths), lengths)
        assert (unpack_bits(payload, checks, n, *decode_table(lengths)) == ids).all()


def test_code_lengths_are_optimal_without_the_limit():
    import heapq

    counts = np.array([50, 1, 0, 7, 7, 20, 3, 1])
    heap = [(int(c), k, (k,)) for k, c in enumerate(counts) if c]
    depth = dict.fromkeys((k for _, k, _ in heap), 0)
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for k in a[2] + b[2]:
            depth[k] += 1
        heapq.heappush(heap, (a[0] + b[0], a[1], a[2] + b[2]))
    assert (code_lengths(counts, 16) * counts).sum() == sum(depth[k] * counts[k] for k in depth)
    with pytest.raises(ValueError, match="longer than"):
        code_lengths(np.ones(9, int), 3)


def test_round_trip(spark):
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted((tuple(r) for r in round_trip(docs(spark), vocabulary_path(BYTE), file_ids=4000).collect()), key=lambda r: r[1])
    want = sorted((i is not None, i or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t in ordered for x in [ids_of(t, BYTE, 2)])
    assert sorted((i is not None, i or 0, n, c) for i, _, n, c in got) == want
    start = 0
    for _, s, n, _ in got:
        assert s == start
        start += n
    assert [r[0] for r in got] == [r[0] for r in ordered]
    files = write_token_files(docs(spark), vocabulary_path(BYTE), scratch_path(spark, "f"))
    held = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in read_token_files(files).collect()}
    assert held[7] == ids_of(ROWS[6][1], BYTE, 2)
    assert round_trip(docs(spark).limit(0), vocabulary_path(BYTE)).count() == 0


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_separator_scan(spark, block):
    rng, folder = random.Random(block), scratch_path(spark, "flat")
    want = []
    for f, n in enumerate((0, 1, 50, 300)):
        ids = [rng.choice((9, 9, 1, 2, 3)) for _ in range(n)]
        write_file(folder, f"t{f}.ids", [np.array(ids, "<u2").tobytes()])
        at = place = 0
        for k, x in enumerate([*ids, None]):
            if x == 9 or (x is None and at < k):
                want.append((f"t{f}.ids", place, at, k - at, x == 9))
                at, place = k + 1, place + 1
    got = token_counts.count_tokens(spark, folder, 9, "<u2", block)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_document_counts_of_odd_tables(spark):
    rows = spark.createDataFrame(ROWS * 2, "doc_id long, text string")
    clashing = rows.selectExpr("*", "1 AS file", "2 AS place", "3 AS n_tokens")
    got = sorted(map(tuple, token_counts.document_counts(clashing, vocabulary_path(BYTE), 50256).collect()), key=str)
    assert len(got) == 2 * len(ROWS) and got == sorted(map(tuple, got[::2] + got[::2]), key=str)
    nothing = spark.createDataFrame(spark.sparkContext.emptyRDD(), rows.schema)
    assert token_counts.document_counts(nothing, vocabulary_path(BYTE), 50256).count() == 0
    assert token_counts.document_counts(rows.limit(0), vocabulary_path(BYTE), 50256).count() == 0


def test_document_counts(spark):
    got = token_counts.document_counts(docs(spark), vocabulary_path(BYTE), 50256).collect()
    special = Encoder(vocabulary_path(BYTE))
    special.library.encode_special_tokens = True
    want = [(i, len(special.library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit(lengths):
    lengths.sort(reverse=True)
    room, want = [], []
    for n in lengths:
        k = next((k for k, r in enumerate(room) if r >= n), len(room))
        if k == len(room):
            room.append(50)
        want.append((k, 50 - room[k]))
        room[k] -= n
    assert first_fit_decreasing(lengths, 50) == want


@pytest.mark.parametrize("group", [4096, 3])
def test_packing(spark, group):
    rows = pack_documents(docs(spark), vocabulary_path(WORD), capacity=64, group_pieces=group).collect()
    sequences, found = {}, {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == r["length"] and zlib.crc32(ids.astype("<u4").tobytes()) == r["ids_crc32"]
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
        found.setdefault((r["doc_id"], r["start"]), []).append(ids.tolist())
    assert max(sequences.values()) <= 64
    for i, t in ROWS:
        want = ids_of(t, WORD, 2)
        for s in range(0, len(want), 64):
            assert want[s : s + 64] in found[i, s]
    assert sum(r["length"] for r in rows) == sum(len(ids_of(t, WORD, 2)) for _, t in ROWS)
    assert pack_documents(docs(spark).limit(0), vocabulary_path(WORD)).count() == 0


def test_packing_keeps_large_ids_beside_null(spark):
    big = 9007199254740992
    rows = [(big + 1, "one two"), (None, "three"), (big + 3, "four five six"), (None, None), (-(2**63), "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = pack_documents(frame, vocabulary_path(WORD), capacity=64).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u2").tolist() for r in got if r["doc_id"]} == {
        i: ids_of(t, WORD, 2) for i, t in rows if i
    }
    names = spark.createDataFrame([("b", "x"), (None, "y"), ("a", "x")], "doc_id string, text string")
    assert {r["doc_id"] for r in pack_documents(names, vocabulary_path(WORD)).collect()} == {"a", "b", None}


def test_stored_survives_its_source(spark):
    assert stored(spark, spark.range(5).toDF("x"), "t").count() == 5
