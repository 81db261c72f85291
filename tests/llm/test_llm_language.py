"""Languages: held-out accuracy, the network against a plain version, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import language_id as L

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def network(spark):
    return L.fit_languages(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark, network):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = L.identify_languages(docs, network).where(L.held_out())
    rows = found.groupBy("lang").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")).alias("a"), F.min("score").alias("s")).collect()
    assert len(rows) == 4 and min(r["a"] for r in rows) > 0.97 and min(r["s"] for r in rows) >= 0


def test_split_is_crc32(spark):
    got = spark.range(50).select(F.col("id").alias("doc_id")).withColumn("h", L.held_out()).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_held_out_rows_teach_nothing(spark):
    """Labels of held-out rows may say anything."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lied = docs.withColumn("lang", F.when(L.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = L.fit_languages(docs), L.fit_languages(lied)
    assert a.languages == b.languages and all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables, strict=True))


def plain(net, text):
    """Probabilities by loops over windows, filters and places."""
    data, sums, total = text.encode(), 0, 0
    for row in L.windows(data):
        n = int(np.flatnonzero(row).max(initial=-1)) + 1
        tops = []
        for table, w in zip(net.tables, L.WIDTHS, strict=True):
            places = range(max(n - w, 0) + 1)
            tops.append(np.max([sum(table[k][row[p + k]] for k in range(w)) for p in places], 0))
        logits = np.concatenate(tops) @ net.weights + net.bias
        p = np.exp(logits - logits.max())
        letters = sum(65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in row) + 1e-9
        sums, total = sums + p / p.sum() * letters, total + letters
    return sums / total


def test_scores_equal_plain_version(network):
    texts = ["a", "Der", "été", "the cat " * 31, "x" * 253, "x" * 254, "x" * 255, "y" * 256, "z" * 257, "le chat é " * 200]
    got = network.probabilities([t.encode() for t in texts])
    assert np.allclose(got, [plain(network, t) for t in texts], atol=1e-4)
    assert np.allclose(got.sum(1), 1)


def test_windows_cover_every_stretch():
    for n in (0, 1, 253, 254, 255, 256, 257, 508, 509, 510, 5000):
        data = bytes(1 + i % 255 for i in range(n))
        cut = [bytes(w) for w in L.windows(data)]
        stretch = max(L.WIDTHS)
        assert all(any(data[i : i + stretch] in w for w in cut) for i in range(max(n - stretch + 1, 0)))


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = L.LanguageNetwork(["a", "b", "c"])
    net.weights += rng.normal(0, 0.3, net.weights.shape).astype(np.float32)
    rows = np.stack([L.windows(bytes(rng.integers(1, 255, n).astype(np.uint8)))[0] for n in (3, 90, 256)])
    labels, weight = np.array([0, 1, 2]), np.ones(3, np.float32)

    def loss():
        net._pairs = None
        return -np.log(net.window_probabilities(rows)[np.arange(3), labels]).mean()

    slopes = net._slopes(rows, labels, weight)
    for p, g in zip([*net.tables, net.weights, net.bias], slopes, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = p[at]
        p[at] = kept + 1e-3
        up = loss()
        p[at] = kept - 1e-3
        down = loss()
        p[at] = kept
        assert (up - down) / 2e-3 == pytest.approx(g[at], rel=0.1, abs=2e-3)


def test_odd_rows(spark, network):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 34 !?", None), (4, "the " * 300_000, "en"), (None, "le chat est là", "fr"), (5, "日本", "en"), (5, "日本", "fr")]
    docs = spark.createDataFrame([(*r, "old", 9) for r in rows], "doc_id long, text string, lang string, lang_pred string, score int")
    got = L.identify_languages(docs, network).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
    assert [(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (1, 2, 3)] == [("und", 0.0)] * 3
    assert {r["lang_pred"] for r in got if r["doc_id"] not in (1, 2, 3)} <= {"de", "en", "es", "fr"}
    assert L.identify_languages(docs.limit(0), network).count() == 0
    nothing = L.fit_languages(docs.where("lang IS NULL"))
    assert {r["lang_pred"] for r in L.identify_languages(docs, nothing).collect()} == {"und"}
    one = L.fit_languages(docs.where("doc_id = 4"))
    assert one.languages == ["en"] and {r["score"] for r in L.identify_languages(docs, one).where("doc_id = 4").collect()} == {1.0}


def test_bounds_on_learning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    doubled = docs.unionByName(docs)
    a, b = L.fit_languages(docs, train_windows=50), L.fit_languages(doubled, train_windows=50)
    assert all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables, strict=True))
