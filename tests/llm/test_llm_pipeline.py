"""The stages against brute force, and the registered queries."""

import re

import duckdb
import numpy as np
import pytest
from compare import normal
from test_llm_decontaminate import brute as brute_contamination
from test_llm_groups import brute_groups
from test_llm_tokens import WORD, ids_of

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from shelfspark.llm import pii
from shelfspark.llm.common import stored
from shelfspark.llm.quality import fit_quality
from shelfspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    network = fit_quality(docs, labels)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    score = network.scores([t.encode() for _, t in rows])
    rows = [r for r, s in zip(rows, score, strict=True) if s >= 0.5]
    rows = [r for r in rows if r[0] in {i for i, _, c in brute_groups(rows) if i == c}]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = brute_contamination(rows, items)
    rows = [r for r in rows if not hit[r[0]][4]]
    want = {}
    for i, t in rows:
        out, at = [], 0
        for a, b, kind, canonical in pii.detect(t):
            out += [t[at:a], pii.replacement(t[a:b], kind, canonical, pii.KEY)]
            at = b
        want[i] = ids_of("".join(out) + t[at:], WORD, 2)
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got.setdefault(r["doc_id"], {})[r["start"]] = np.frombuffer(r["ids"], "<u2").tolist()
    assert {i: sum((p[k] for k in sorted(p)), []) for i, p in got.items()} == want


def test_stages_keep_columns_and_odd_rows(spark):
    rows = [(1, None, "en", None, None), (2, "", None, "s", 0), (None, "A text without an id.", "en", "s", 1),
            (3, "A text without an id.", "en", "s", 1), (3, "A text without an id.", "en", "s", 1), (4, "w " * 200_000, "en", "s", 5)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], COLUMNS + ", score int")
    for n in (len(rows), 0):
        now = docs.limit(n)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, SF)
            if name != "packing":
                assert out.columns == docs.columns
            now = stored(spark, out, "stage")
        assert (now.count() > 0) == (n > 0)


def test_similar_stage(spark):
    rows = [(3, "a b c d e f g h"), (3, "a b c d e f g h"), (5, "A B C D E F G H"), (None, "a b c d e f g h"), (6, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], COLUMNS)
    kept = corpus_pipeline.keep_one_of_similar(spark, docs, SF).collect()
    assert sorted((str(r["doc_id"]) for r in kept)) == ["3", "6", "None"]


def test_names_and_stages():
    numbers = sorted(int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in queries()
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(spark, name):
    got = queries()[name](spark, SF)
    if name not in oracle_sql():
        assert got.count() > 0
        return
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = normal(got.toPandas()), normal(con.execute(oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want)
    for c in got.columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c
