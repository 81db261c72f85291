import zlib

import pytest
from pyspark.sql import functions as F

from shelfspark.llm.quality import Network, _chunks, fit_quality, held_out, quality_scores

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    network = fit_quality(docs, labels, rows=1200)
    known = quality_scores(docs.join(labels.where("quality IS NOT NULL"), "doc_id"), network).where(held_out())
    got = known.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("a")).collect()
    assert min(r["a"] for r in got) > 0.93


def test_split_is_crc32(spark):
    got = spark.range(50).select(F.col("id").alias("doc_id")).withColumn("h", held_out()).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)


def test_learning_and_scoring_pool_alike():
    import numpy as np

    network = Network()
    for n in (1, 255, 256, 257, 511, 512, 513, 2000):
        data = bytes((7 * i) % 250 + 1 for i in range(n))
        pooled, _ = network._pool(_chunks(data))
        blocks = network._blocks(data, -(-n // 256))
        chunks = np.maximum(blocks[:-1], blocks[1:]) if len(blocks) > 1 else blocks
        assert np.allclose(pooled, chunks, atol=1e-5)


def test_edge_cases(spark):
    rows = [(1, "good text " * 9, 5.0), (2, None, None), (3, "", None), (None, "x", None), (1, "good text " * 9, 5.0), (4, "é" * 70000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (9, 1), (None, 0)], "doc_id long, quality int")
    network = fit_quality(docs, labels)
    got = quality_scores(docs, network).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert quality_scores(docs.limit(0), network).count() == 0
    none = fit_quality(docs, labels.limit(0))
    assert {r["score"] for r in quality_scores(docs, none).collect()} == {0.5}
    assert Network().fit([b"a", b"b"], [1, 1]).scores([b"c", b""]) == pytest.approx([0.88, 0.88], abs=0.01)
