import hashlib
import re

from pyspark.sql import functions as F

from shelfspark.llm import decontaminate
from shelfspark.llm.decontaminate import clean_documents, contaminated_spans, contamination_report

DOCS = "doc_id long, text string, block string, pattern string"
W = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = {}
    for i, t in docs:
        ws, hit, held = words(t), set(), set()
        for item, text in items:
            iw = words(text)
            n = min(10, len(iw))
            windows = {tuple(iw[k : k + n]) for k in range(len(iw) - n + 1)} if n else set()
            for k in range(len(ws)):
                if tuple(ws[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    held.add(str(item))
        digest = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        out[i] = (len(ws), len(hit), len(held), digest, bool(hit))
    return out


ROWS = [
    (1, "Xy " + " ".join(W) + " é, ALPHA"),
    (2, None),
    (3, ""),
    (4, "Só  TWO—words! and two... words"),
    (5, " ".join(W[:9])),
    (6, "Ünï " + ", ".join(W[1:11]).upper() + ". " + " ".join(W * 30)),
    (6, "a second row of one id: two words"),
]
ITEMS = [(7, " ".join(W)), (10, "two words"), (11, None), (12, "--- !"), (7, " ".join(W)), (13, "Two; WORDS"), (None, "and two")]


def frames(spark):
    return (
        spark.createDataFrame([(i, t, "x", "y") for i, t in ROWS], DOCS),
        spark.createDataFrame([(i, t, "z") for i, t in ITEMS], "item_id long, text string, doc_id string"),
    )


def test_report_equals_brute_force(spark):
    docs, items = frames(spark)
    want = brute([r for r in ROWS if r[0] != 6] + [ROWS[5]], [i for i in ITEMS if i[0] is not None])
    got = [r for r in contamination_report(docs, items).collect()]
    assert len(got) == len(ROWS)
    for r in got:
        if r["doc_id"] != 6:
            assert tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == want[r["doc_id"]]
    assert want[6] in {tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in got if r["doc_id"] == 6}


def test_many_blocks_equal_one(spark):
    docs, items = frames(spark)
    key = lambda df: sorted(
        (r["doc_id"], r["n_words"], sorted((s["first_word"], s["n_words"], s["start"], s["end"], *s["items"]) for s in r["spans"]))
        for r in df.collect()
    )
    assert key(contaminated_spans(docs, items)) == key(contaminated_spans(docs, items, block_bytes=60))
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert ids(clean_documents(docs, items)) == ids(clean_documents(docs, items, block_bytes=60)) == [2, 3, 5]


def test_repeated_rows_stay_with_many_blocks(spark):
    rows = [*ROWS, ROWS[0], ROWS[0], (None, "two words"), (None, "two words"), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS)
    items = frames(spark)[1]
    report = lambda n: sorted(
        str(tuple(r)) for r in contamination_report(docs, items, block_bytes=n).drop("spans").collect()
    )
    assert len(report(60)) == len(rows) and report(60) == report(2_000_000)
    assert clean_documents(docs, items, block_bytes=60).count() == clean_documents(docs, items).count() == 5


def test_one_benchmark_in_two_orders(spark, monkeypatch):
    # The worker keeps the automaton of the first call; the second one collects the same windows in another order.
    texts = [f"w{k} " * (k % 9 + 1) for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(texts)], "item_id string, text string")
    whole = decontaminate.window_table
    monkeypatch.setattr(decontaminate, "window_table", lambda *a: whole(*a).orderBy("pattern"))
    assert clean_documents(docs, items).count() == 0
    monkeypatch.setattr(decontaminate, "window_table", lambda *a: whole(*a).orderBy(F.desc("pattern")))
    spans = {r["doc_id"]: r["spans"] for r in contaminated_spans(docs, items).collect()}
    assert all([(s["items"], s["first_word"], s["n_words"]) for s in spans[k]] == [([f"i{k}"], 0, k % 9 + 1)] for k in range(400))


def test_spans_point_into_the_original(spark):
    docs, items = frames(spark)
    spans = {r["doc_id"]: r["spans"] for r in contaminated_spans(docs, items).where("doc_id <> 6").collect()}
    s = spans[4][0]
    assert dict(ROWS[:5])[4][s["start"] : s["end"]] == "two... words"  # the dash is a word character


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert contamination_report(docs.limit(0), items).count() == 0
    assert contamination_report(docs, items.limit(0)).where("contaminated").count() == 0
    kept = clean_documents(docs, items.limit(0))
    assert kept.count() == len(ROWS) and kept.columns == docs.columns


def test_a_window_of_very_many_items_is_kept_once_a_row(spark):
    ids = [f"item-{i:05d}" for i in range(20_000)]
    items = spark.createDataFrame([(i, "one two three") for i in ids], "item_id string, text string")
    docs = spark.createDataFrame([(1, "one two three " * 300), (2, "one two"), (3, "One, two; three!")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in contamination_report(docs, items).collect()}
    digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert [(got[k]["n_hit"], got[k]["n_items"]) for k in (1, 2, 3)] == [(900, 20_000), (0, 0), (3, 20_000)]
    assert got[1]["items_sha256"] == got[3]["items_sha256"] == digest
    assert got[1]["contaminated"] and not got[2]["contaminated"]


def test_a_very_long_text(spark):
    text = "word " * 500_000 + "alpha beta gamma"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([("x", "alpha beta gamma")], "item_id string, text string")
    row = contamination_report(docs, items).first()
    assert (row["n_words"], row["n_hit"], row["n_items"]) == (500_003, 3, 1)
    assert contaminated_spans(docs, items).first()["spans"][0]["end"] == len(text)
