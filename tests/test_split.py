"""Time-ordered split against a per-series loop."""

import itertools

import numpy as np
import pytest
from frames import day
from pyspark.sql import functions as F

from shelfspark.operators import split


def looped(rows, min_rows, short="drop"):
    """Label per (series, date, tie1, tie2) by rank in the series."""
    out = {}
    for _, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        group = list(group)
        n = len(group)
        n_tv = int(np.floor(n * 0.9))
        n_tr = int(np.floor(n_tv * 0.9))
        for r in group:
            rank = 1 + sum(g < r for g in group)
            label = "train" if rank <= n_tr else "validation" if rank <= n_tv else "test"
            if n < min_rows:
                label = "train" if short == "train" else None
            if label:
                out[r] = label
    return out


def frame(spark, rows):
    return spark.createDataFrame([(s, day(d), a, b) for s, d, a, b in rows], "s string, date date, a int, b int")


@pytest.mark.usefixtures("many_range_partitions")
@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("ties", [["a", "b"], ["a"], []])
def test_against_loop(spark, seed, ties):
    rng = np.random.default_rng(seed)
    # Series x holds most rows, on few dates; exact copies occur.
    rows = [("x", int(rng.integers(0, 3 + seed * 5)), int(rng.integers(0, 4)), int(rng.integers(0, 4))) for _ in range(90)]
    rows += [(s, int(rng.integers(0, 30)), int(rng.integers(0, 3)), 0) for s in "yz" for _ in range(25)]
    rows += [("w", i, 0, 0) for i in range(5)]
    depth = 2 + len(ties)
    for short in ("drop", "train"):
        got = split.time_split(frame(spark, rows), ["s"], "date", ties, min_rows=10, short=short).collect()
        want = looped([r[:depth] for r in rows], 10, short)
        assert len(got) == sum(r[:depth] in want for r in rows)
        for r in got:
            key = (r.s, (r.date - day(0)).days, r.a, r.b)[:depth]
            assert r.data_split == want[key], key


@pytest.mark.parametrize("most", [250_000, 40, 1])
@pytest.mark.parametrize("ties", [["a", "b"], []])
def test_gathered_against_loop(spark, monkeypatch, most, ties):
    """All series put in order, all but the longest, none."""
    monkeypatch.setattr(split, "PART_ROWS", most)
    rng = np.random.default_rng(most)
    rows = [("x", int(rng.integers(0, 8)), int(rng.integers(0, 4)), int(rng.integers(0, 4))) for _ in range(90)]
    rows += [(s, int(rng.integers(0, 30)), int(rng.integers(0, 3)), 0) for s in "yz" for _ in range(25)]
    rows += [("w", i, 0, 0) for i in range(5)]
    depth = 2 + len(ties)
    for short in ("drop", "train"):
        got = split.time_split(frame(spark, rows), ["s"], "date", ties, min_rows=10, short=short, gather=True)
        assert got.columns == ["s", "date", "a", "b", "data_split"]
        want = looped([r[:depth] for r in rows], 10, short)
        got = got.collect()
        assert len(got) == sum(r[:depth] in want for r in rows)
        for r in got:
            key = (r.s, (r.date - day(0)).days, r.a, r.b)[:depth]
            assert r.data_split == want[key], key


@pytest.mark.parametrize("most", [250_000, 9])
def test_gathered_nulls_copies_and_no_rows(spark, monkeypatch, most):
    """Null keys are a series, null dates and ties come first, copies share a label; as by cuts."""
    monkeypatch.setattr(split, "PART_ROWS", most)
    cell = F.col("id") % 50
    df = spark.range(150).select(
        F.when(cell % 3 > 0, cell % 3).alias("s"), F.when(cell % 4 > 0, (cell % 2).cast("string")).alias("s2"),
        F.when(cell % 5 > 0, F.date_add(F.lit(day(0)), (cell % 9).cast("int"))).alias("date"),
        F.when(cell % 7 > 0, cell % 11).alias("tie"), F.when(F.col("id") != 7, 1).alias("t"),
    )

    def labels(rows, **how):
        return sorted(map(repr, split.time_split(rows, ["s", "s2"], ties=["tie"], targets=["t"], min_rows=10, **how).collect()))

    assert labels(df, gather=True) == labels(df) != []
    assert labels(df.limit(0), gather=True) == []


def test_hot_series(spark):
    """One series holds a third of all rows."""
    rows = [("hot", i % 40, i, 0) for i in range(1000)] + [(f"s{i % 50}", i // 50, 0, 0) for i in range(2000)]
    got = split.time_split(frame(spark, rows), ["s"], "date", ["a"], min_rows=10)
    counts = {(r.s == "hot", r.data_split): r["count"] for r in got.groupBy("s", "data_split").count().collect() if r.s == "hot"}
    assert counts == {(True, "train"): 810, (True, "validation"): 90, (True, "test"): 100}


@pytest.mark.usefixtures("many_range_partitions")
def test_hot_date(spark):
    """One series has nearly all its rows on one date, so both cuts fall between the tie values of that date."""
    rows = [("hot", 5, (i * 7) % 1000, 0) for i in range(1000)] + [("cold", i, 0, 0) for i in range(30)]
    got = split.time_split(frame(spark, rows), ["s"], "date", ["a"], min_rows=10).where("s = 'hot'")
    span = {r.data_split: (r.lo, r.hi, r.n) for r in got.groupBy("data_split").agg(
        F.min("a").alias("lo"), F.max("a").alias("hi"), F.count("*").alias("n")).collect()}
    assert span == {"train": (0, 809, 810), "validation": (810, 899, 90), "test": (900, 999, 100)}


def test_missing_targets_are_left_out_first(spark):
    rows = [("x", i, i % 2, 0) for i in range(20)]
    df = frame(spark, rows).withColumn("t", F.when(F.col("a") == 0, 1))
    got = split.time_split(df, ["s"], "date", targets=["t"], min_rows=10)
    assert got.count() == 10 and got.where("data_split = 'test'").count() == 1
    assert split.time_split(df, ["s"], "date", targets=["t"], min_rows=11).count() == 0


def test_labels_never_go_back_in_time(spark):
    rng = np.random.default_rng(9)
    rows = [("x", int(rng.integers(0, 50)), i, 0) for i in range(200)]
    got = split.time_split(frame(spark, rows), ["s"], "date", ["a"], min_rows=10)
    span = {r.data_split: (r.lo, r.hi) for r in got.groupBy("data_split").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()}
    assert span["train"][1] <= span["validation"][0] and span["validation"][1] <= span["test"][0]


def test_as_of_date_comes_after_the_split(spark):
    rows = [("x", i, 0, 0) for i in range(100)]
    labelled = split.time_split(frame(spark, rows), ["s"], "date", min_rows=10)
    kept = split.filter_as_of_date(labelled, str(day(80)))
    assert {r.data_split: r["count"] for r in kept.groupBy("data_split").count().collect()} == {"train": 81}


def test_eligibility(spark):
    df = spark.createDataFrame(
        [("a", day(0), 1, 1, 1), ("b", day(0), 1, 0, 1), ("c", day(9), 1, 1, 1)],
        "s string, date date, neg_cc_flag long, sales_flag long, transfer_flag long",
    )
    ok = split.series_eligibility(df, str(day(5)), series=["s"])
    assert [r.s for r in ok.collect()] == ["a"]
    assert [r.s for r in split.join_eligible_series(df, ok, ["s"]).collect()] == ["a"]


def test_nulls_come_first(spark):
    """Ten rows of one day, one without a tie value; a series without a key; a row without a date."""
    rows = [("s", 1, c) for c in "bcdefghij"] + [("s", 1, None)] + [(None, 1, c) for c in "abcdefghij"]
    rows += [("d", None, "a")] + [("d", d, "a") for d in range(9)]
    df = spark.createDataFrame([(s, None if d is None else day(d), t) for s, d, t in rows], "s string, date date, t string")
    got = split.time_split(df, ["s"], "date", ["t"], min_rows=10).collect()
    assert len(got) == 30
    label = {(r.s, r.date, r.t): r.data_split for r in got}
    assert label["s", day(1), None] == "train"
    assert [label["s", day(1), c] for c in "bcdefghij"] == ["train"] * 7 + ["validation", "test"]
    assert [label[None, day(1), c] for c in "abcdefghij"] == ["train"] * 8 + ["validation", "test"]
    assert label["d", None, "a"] == "train" and label["d", day(8), "a"] == "test"


def test_plan_does_not_grow_with_ties(spark):
    df = frame(spark, [("s", i, i, 0) for i in range(20)])
    def scans(ties):
        return split.time_split(df, ["s"], "date", ties, min_rows=10)._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")
    assert scans(["a", "b"]) == scans(["a"])
