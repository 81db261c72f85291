"""N-gram join, embeddings and the graph they use, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm.embed_dedup import (
    TARGET_RECALL, MultiIndex, along_tree, blocks_of, near_duplicates, planted_values,
)
from shelfspark.llm.graph import connected_components
from shelfspark.llm.ngram_join import prefix_length, required_overlap, similar_groups, trie_matches
from shelfspark.llm.shingles import shingle_sets


def reached(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {(i, len(sets[i]), c) for i, c in reached(ids, links).items()}


def corpus(seed, n=160):
    """Families around originals at all similarities, with passages and lines that many texts share."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randint(1, 4)
    originals = [[word() for _ in range(rng.choice((3, 5, 8, 40, 120)))] for _ in range(8)]
    passage = [word() for _ in range(30)]
    rows = []
    for i in range(n):
        w = list(rng.choice(originals))
        for _ in range(rng.choice((0, 0, 1, 2, 3, 6))):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:
            w = passage + w
        rows.append((i * 3, rng.choice((" ", "\t", "\n ")).join(w).title() if rng.random() < 0.3 else " ".join(w)))
    return [*rows, (1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE")]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(
        [(i, t, 7, "z") for i, t in rows], "doc_id long, text string, component_id int, family string"
    ).repartition(5)
    assert {tuple(r) for r in similar_groups(docs).collect()} == brute_groups(rows)


def test_odd_rows(spark):
    text = "the same words again and again in one text"
    rows = [(4, text), (4, text), (None, text), (9, text), (None, None), (9, "something else that is not like it")]
    got = [tuple(r) for r in similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(4, 5, 4), (4, 5, 4), (None, 5, None), (9, 5, 4), (None, 0, None), (9, 3, 9)], key=str)
    assert similar_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shingle_sets_count_as_words_do():
    texts = ["", None, "a", "a b c d", "a b c d e", "a a a a a a a", "É é é X\x0by z w q", "x " * 100]
    assert [len(s) for s in shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    assert all(np.array_equal(a, shingle_sets([t])[0]) for a, t in zip(shingle_sets(texts), texts, strict=True))


def test_bounds():
    for a in range(1, 60):
        for b in range(1, 60):
            least = min(i for i in range(200) if 100 * i >= 75 * (a + b - i))
            assert required_overlap(a, b) == least
        assert prefix_length(a) == a - min(required_overlap(a, b) for b in range(1, 200) if 4 * min(a, b) >= 3 * max(a, b)) + 1


def test_trie_equals_brute_force():
    rng = np.random.default_rng(3)
    base = rng.choice(400, 60, replace=False)
    sets = []
    for _ in range(80):
        s = base.copy()
        change = rng.integers(0, 25)
        s[rng.choice(60, change, replace=False)] = rng.choice(np.arange(400, 800), change, replace=False)
        sets.append(np.unique(s[: rng.integers(40, 61)]).astype(np.uint64))
    sets += [np.empty(0, np.uint64), sets[0]]
    want = {
        (p, k, len(np.intersect1d(a, b)))
        for p, a in enumerate(sets)
        for k, b in enumerate(sets)
        if len(a) and len(b) and 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
    }
    assert set(trie_matches(sets, sets)) == want


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(40)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120)]
    links += [(500, k) for k in range(501, 600)] + [(700, 700), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == reached({x for e in real for x in e}, real)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(seed=0, n=300, dims=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dims))
    x = base[rng.integers(0, 12, n)] + rng.normal(size=(n, dims)) * rng.choice((0.05, 0.15, 0.3), n)[:, None]
    rows = [(i, x[i].astype(np.float32).tolist(), 1) for i in range(n)]
    rows += [(n + k, x[k].astype(np.float32).tolist(), 2) for k in range(20)]
    return rows


def test_embeddings_against_brute_force(spark):
    rows = vectors()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    want = reached(ids.tolist(), [(ids[a], ids[b]) for a, b in np.argwhere(link) if a != b])
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [float("inf")] * 16, 1),
           (904, [1.0, None] + [1.0] * 14, 1), (905, [1.0], 1), (906, [], 1), (None, rows[0][1], 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, cell int").repartition(4)
    got = {r["vec_id"]: r for r in near_duplicates(frame).collect()}
    assert len(got) == len(rows) + len(odd)
    found = sum(got[i]["n_links"] for i in ids.tolist())
    assert all(got[i]["n_links"] <= link[k].sum() - 1 for k, i in enumerate(ids.tolist()))
    assert found >= 0.9 * (link.sum() - len(ids))
    assert np.mean([got[i]["component_id"] == want[i] for i in ids.tolist()]) > 0.9
    for i in (*range(900, 907), None):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert near_duplicates(frame.limit(0)).count() == 0


def test_rare_links_outside_the_sample_are_found(spark):
    # The pairs have the ids that the sample takes last, so no sampled query has a link to another row.
    rng = np.random.default_rng(4)
    ids = [r["id"] for r in spark.range(4000).orderBy(F.xxhash64("id"), "id").collect()]
    x = rng.normal(size=(4000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for k in range(3940, 4000, 2):
        other = rng.normal(size=16)
        other -= (other @ x[k]) * x[k]
        x[k + 1] = 0.955 * x[k] + (1 - 0.955**2) ** 0.5 * other / np.linalg.norm(other)
    links = (x @ x.T >= 0.95).sum(1) - 1
    assert not links[:2048].any() and links[3940:].all()
    frame = spark.createDataFrame(list(zip(ids, x.tolist(), strict=True)), "vec_id long, embedding array<double>")
    for target in (1.0, TARGET_RECALL, 0.9):
        got = {r["vec_id"]: r["n_links"] for r in near_duplicates(frame, target_recall=target).collect()}
        found = [got[i] for i in ids]
        assert all(f <= n for f, n in zip(found, links.tolist(), strict=True))
        assert found == links.tolist() if target == 1 else sum(found) >= 0.9 * links.sum()


def test_visited_cells_hold_every_link():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 6))
    x = np.concatenate((base, base + rng.normal(size=base.shape) * 0.2))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = MultiIndex(np.concatenate((x[:12, :3], x[:2, :3])), x[20:31, 3:])  # two codewords twice
    cells = index.cells(x)
    for k, (a, b) in enumerate(zip(*index.costs(x), strict=True)):
        assert set(cells[x @ x[k] >= 0.95]) <= set(index.visited(a, b, 0.1 + 1e-6))
        upto = {c for v, c in index.traverse(a, b) if v <= 0.1}
        assert set(index.visited(a, b, 0.1)) == upto


def test_traversal_visits_all_cells_in_order():
    rng = np.random.default_rng(1)
    index = MultiIndex(rng.normal(size=(5, 3)), rng.normal(size=(4, 3)))
    first, second = index.costs(rng.normal(size=(3, 6)))
    for a, b in zip(first, second, strict=True):
        got = list(index.traverse(a, b))
        assert sorted(c for _, c in got) == list(range(20))
        assert [v for v, _ in got] == sorted((a[:, None] + b[None, :]).ravel().tolist())


def test_boxes_hold_all_cells_and_follow_geometry():
    rng = np.random.default_rng(5)
    cells = np.sort(rng.choice(40 * 30, 700, replace=False))
    counts = rng.integers(1, 30, 700)
    counts[100] = 5000
    block = blocks_of(cells, counts, 256, (40, 30))
    assert (block[cells] >= 0).all() and (np.delete(block, cells) == -1).all()
    for k in range(block.max() + 1):
        mine = np.isin(cells, np.flatnonzero(block == k))
        assert mine.sum() == 1 or counts[mine].sum() <= 256
    i, j = np.divmod(cells, 30)
    spread = [np.ptp(i[block[cells] == k]) * np.ptp(j[block[cells] == k]) for k in range(block.max() + 1)]
    assert np.mean(spread) < 0.1 * 40 * 30
    assert (blocks_of(np.array([], int), np.array([], int), 4, (2, 2)) == -1).all()


def test_codewords_follow_a_tree():
    words = np.random.default_rng(6).normal(size=(64, 2))
    sorted_words = along_tree(words)
    assert sorted(map(tuple, sorted_words)) == sorted(map(tuple, words))
    step = lambda w: np.linalg.norm(np.diff(w, axis=0), axis=1).mean()
    assert step(sorted_words) < 0.6 * step(words)
    assert along_tree(words[:1]).tolist() == words[:1].tolist()


def test_planted_copies_reach_the_target():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = MultiIndex(along_tree(x[:20, :16]), along_tree(x[20:40, 16:]))
    limit = planted_values(index, x, 0.95)[int(0.99 * 500 * 16)]
    other = planted_values(index, x, 0.95, seed=99)
    assert 0 < limit < 0.1 and (other <= limit).mean() > 0.98 and other[-1] <= 0.1 + 1e-6
    assert (planted_values(index, x, 0.99, seed=99) <= limit).all()
