"""Words one edit apart: against brute force, at small packs and batches, and on odd rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfspark.llm import spelling

SF = "/root/testdata/sf0.001"
COLUMNS = ("n", "n_near", "form", "form_n", "root")


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in "".join(c if "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in lowered).split(" "):
            if not run:
                continue
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(words):
    """By the words' deletions and holes, which is another way than letter counts."""
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[i, w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 2 * n:
                form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (n, len(near[w]), form.get(w), words.get(form.get(w)), root)
    return out


def found(docs):
    return {r["word"]: tuple(r[c] for c in COLUMNS) for r in spelling.spelling_variants(docs).collect()}


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(spelling, "PACK", 3)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = brute(brute_words([tuple(r) for r in docs.collect()]))
    assert any(v[2] for v in want.values()) and found(docs) == want


def test_random_words_with_chains(spark):
    rng = np.random.default_rng(1)
    words = {"".join(rng.choice(list("abé"), rng.integers(5, 8))): int(rng.integers(3, 3000)) for _ in range(400)}
    rows = [(w.encode("latin-1"), n) for w, n in words.items()]
    pairs = spelling.near_pairs(spark.createDataFrame(rows, "data binary, n long")).collect()
    got = sorted(tuple(sorted((bytes(r["a"]).decode("latin-1"), bytes(r["b"]).decode("latin-1")))) for r in pairs)
    want = brute(words)
    assert len(set(got)) == len(got) and 2 * len(got) == sum(v[1] for v in want.values())
    assert all(words[bytes(r[k]).decode("latin-1")] == r[f"{k}_n"] for r in pairs for k in "ab")


def test_kept_words_pass_through(spark, monkeypatch):
    monkeypatch.setattr(spelling, "KEPT", 2)
    monkeypatch.setattr(spelling, "_PIECE", 7)
    rows = [(1, "Hellos hellos HELLOS helloß helloß helloß " * 3), (2, "hello")]
    got = {r["word"]: r["n"] for r in spelling.word_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_words(rows)


def test_odd_rows(spark):
    long = "x" * 70_000
    rows = [(1, None), (2, ""), (None, "alpha alpha alpha alphas"), (3, "alphas alphas ALPHAS Alphá"), (3, "alphas alphas ALPHAS Alphá"),
            (4, f"{long} {long} {long} {long}y {long}y {long}y"), (5, "÷×ÀÿÖ " * 3), (6, "12 34 !!")]
    docs = spark.createDataFrame([(*r, 7, "w") for r in rows], "doc_id long, text string, n int, word string")
    want = brute(brute_words(rows))
    assert want[long][1] == 1 and found(docs) == want
    assert found(docs.limit(0)) == {} and found(docs.where("doc_id = 1")) == {}
    assert spelling.spelling_variants(docs).columns == spelling.spelling_variants(docs.limit(0)).columns


def test_roots_follow_long_chains(spark):
    links = spark.createDataFrame([(str(i), str(i + 1)) for i in range(100, 137)], "word string, form string")
    assert {r["root"] for r in spelling._roots(links).collect()} == {"137"}


def test_one_apart():
    def one(a, b):
        return bool(spelling.one_apart(*(np.frombuffer(x.encode(), np.uint8)[None] for x in (a, b)))[0])

    assert one("abcde", "abXde") and not one("abcde", "abcde") and not one("abcde", "baXde")
    assert one("abcde", "abce") and one("abcde", "bcde") and one("abcde", "abcd") and one("aaaa", "aaa")
    assert not one("abcde", "abec") and not one("abcde", "bacd")
