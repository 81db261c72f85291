"""What a query moves, stores and holds does not grow faster than its input."""

import re

import pytest
from frames import day, scored
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F
from test_cascade import some_scores
from test_plans import plan
from test_trees import random_trees, values

from shelfspark import names as N
from shelfspark.operators import cascade, scorers, split, trees, tuning
from shelfspark.plans import catalog, jobs
from shelfspark.plans import panel as panels
from shelfspark.sources import readers, writers


@pytest.fixture
def lines(spark, tmp_path):
    """Forty lines of thirty cells, one of them without a part."""
    cell = F.col("id") % 30
    spark.range(40).select(
        F.when(cell > 0, cell % 7).alias("l_partkey"), (cell % 5).alias("l_suppkey"),
        F.date_add(F.lit(day(0)), cell.cast("int")).cast("timestamp").alias("l_shipdate"),
        (F.col("id") + 0.0).alias("l_quantity"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_small_models_are_compiled_and_give_the_sums_of_a_fold(spark, monkeypatch):
    model = scorers.TreeTableScorer(random_trees(6, 8), 0.5, True)
    _, df = values(spark)
    odd = F.col("f") > 1

    def sums():
        return [r.s for active in (None, odd) for r in scorers.score_model(df, model, "s", active).collect()]

    assert model.splits <= trees.COMPILED_SPLITS
    out = scorers.score_model(df, model, "s")
    assert f"aggregate(array({trees.SUM}" in plan(out) and out.columns == [*df.columns, "s"]
    compiled = sums()
    monkeypatch.setattr(trees, "COMPILED_SPLITS", 0)
    assert trees.SUM not in plan(scorers.score_model(df, model, "s"))
    assert sums() == compiled


def test_a_task_gets_a_bounded_number_of_lines(spark, lines, monkeypatch):
    expected = sorted((r.sku or "", r.location, r.total_retail) for r in panels.panel(spark, lines).collect())
    assert len(expected) == 30 and sum(r[2] for r in expected) == sum(range(40))
    monkeypatch.setattr(panels, "TASK_LINES", 4)
    monkeypatch.setattr(panels, "LEAST_LINES", 4)
    rows = panels.panel(spark, lines)
    assert plan(rows).count("Exchange hash") == 1 and rows.rdd.getNumPartitions() == 10
    assert sorted((r.sku or "", r.location, r.total_retail) for r in rows.collect()) == expected


def test_ml_rows_are_derived_once(spark, lines, monkeypatch):
    derived = []
    monkeypatch.setattr(catalog, "panel", lambda *a: derived.append(a) or panels.panel(*a))
    monkeypatch.setattr(catalog.split, "filter_train_rows", lambda labelled: labelled.limit(0))
    with pytest.raises(Exception):  # nothing to fit on
        catalog.score_ml_model(spark, lines)
    assert len(derived) == 1


@pytest.mark.parametrize("new_models", [True, False])
def test_jobs_parse_the_columns_they_use(spark, tmp_path, monkeypatch, new_models):
    rows = scored(spark, some_scores(30))
    for step, frame in cascade.independent_steps(rows).items():
        writers.write_step_csv(frame, str(tmp_path), step, N.STEP_COLUMNS[step])
    writers.write_step_csv(cascade.cascade_predict(rows), str(tmp_path), "final_prediction", N.FINAL_COLUMNS)
    seen = {}
    scan = readers.scan_step_predictions
    monkeypatch.setattr(readers, "scan_step_predictions", lambda *a: seen.setdefault(a[2], scan(*a)))
    monkeypatch.setattr(readers, "scan_final_prediction_csv", lambda *a, **b: cascade.cascade_predict(rows))
    jobs.score_job(spark, str(tmp_path), f"{tmp_path}/out", 0.4, 0.4, new_models)
    keys = N.KEYS if new_models else []
    assert {s: f.columns for s, f in seen.items()} == {s: [*keys, *c, N.LOCATION_GROUP] for s, c in jobs.RATED.items()}


def test_scored_rows_are_stored_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(writers, "balanced", lambda *a: pytest.fail("moved"))
    predicted = cascade.cascade_predict(scored(spark, some_scores(30)))
    table, path = jobs._scored_table(spark, predicted, N.FINAL_COLUMNS)
    want = predicted.select(*N.FINAL_COLUMNS, N.LOCATION_GROUP, N.BRANCH)
    assert sorted(map(repr, table.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_search_moves_rows_once_into_tasks_of_a_bounded_size(spark, tmp_path, monkeypatch):
    frames = []
    rows = scored(spark, some_scores(40))
    for step, frame in cascade.independent_steps(rows.unionAll(rows.limit(5))).items():
        frame.select(*N.STEP_COLUMNS[step]).write.parquet(f"{tmp_path}/{step}")
        frames.append(spark.read.parquet(f"{tmp_path}/{step}"))
    expected = sorted(map(tuple, tuning.grid_counts(*frames, "0.3,0.5", "0.2,0.6").collect()))
    monkeypatch.setattr(tuning, "TASK_ROWS", 18)
    monkeypatch.setattr(tuning, "LEAST_ROWS", 18)
    grid = tuning.grid_counts(*frames, "0.3,0.5", "0.2,0.6")
    moved = re.findall(r"Exchange hashpartitioning\(sku#\S+ location#\S+ date#\S+ (\d+)\), REPARTITION_BY_NUM", plan(grid))
    assert moved == ["10"] * 3 and not re.search(r"hashpartitioning\(sku.*ENSURE_REQUIREMENTS", plan(grid))
    assert sorted(map(tuple, grid.collect())) == expected


def test_equal_rows_are_fitted_once_with_their_number(spark):
    rows = [(float(i % 4), i % 3, int(i % 5 > 1)) for i in range(120)] + [(None, 1, 1)]
    df = spark.createDataFrame(rows, "a double, b int, label int")
    stored = []

    class Fit(LogisticRegression):
        def fit(self, data):
            stored.append(data.count())
            return super().fit(data)

    once = scorers.fit_ml_model(df, Fit(weightCol="n", tol=1e-12), ["a", "b"], weight="n")
    every = scorers.fit_ml_model(df, Fit(tol=1e-12), ["a", "b"])
    assert stored == [24, 120]
    assert [*once.coefficients, once.intercept] == pytest.approx([*every.coefficients, every.intercept], abs=1e-6)


def test_split_sorts_plain_columns_and_reads_divided_dates_once(spark, monkeypatch):
    df = spark.range(60).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("s"), F.when(F.col("id") > 5, F.lit(day(0))).alias("date"), "id"
    )
    plans = {}
    keep = split._stored
    monkeypatch.setattr(split, "_stored", lambda rows, name: plans.setdefault(name, plan(rows)) and keep(rows, name))
    labels = split.time_split(df, series=["s"], ties=["id"], min_rows=5).collect()
    assert "struct<" not in plans["first-cuts"] and "Sort [_s0#" in plans["first-cuts"] and "inside" in plans
    assert sorted((r.s or 0, r.data_split) for r in labels) == sorted(
        (s, x) for s in range(3) for x in ["train"] * 16 + ["validation"] * 2 + ["test"] * 2
    )


def test_gathered_rows_are_moved_once_into_tasks_of_a_bounded_size(spark, monkeypatch):
    df = spark.range(400).select(
        F.when(F.col("id") < 90, 0).otherwise(F.col("id") % 31 + 1).alias("s"),
        F.date_add(F.lit(day(0)), (F.col("id") % 13).cast("int")).alias("date"), "id",
    )
    monkeypatch.setattr(split, "TASK_ROWS", 40)
    monkeypatch.setattr(split, "LEAST_ROWS", 40)
    stored = []
    keep = split._stored
    monkeypatch.setattr(split, "_stored", lambda rows, name: stored.append(name) or keep(rows, name))
    labels = split.time_split(df, ["s"], ties=["id"], min_rows=5, gather=True)
    assert stored == ["sizes"] and "Join" not in plan(labels)
    assert re.findall(r"Exchange hashpartitioning\(\S+ (\d+)\), (\w+)", plan(labels)) == [("10", "REPARTITION_BY_NUM")]
    expected = sorted(map(tuple, labels.collect()))
    assert len(expected) == 400
    monkeypatch.setattr(split, "PART_ROWS", 50)
    labels = split.time_split(df, ["s"], ties=["id"], min_rows=5, gather=True)
    assert "first-cuts" in stored and re.findall(r", (\d+)\), REPARTITION_BY_NUM", plan(labels)) == ["8"]
    assert sorted(map(tuple, labels.collect())) == expected


def test_rows_to_fit_on_are_not_sorted_for_each_step_of_the_split(spark, lines, monkeypatch):
    plans = []
    monkeypatch.setattr(catalog.split, "filter_train_rows", lambda labelled: plans.append(plan(labelled)) or labelled.limit(0))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with more series than are broadcast
    try:
        with pytest.raises(Exception):  # nothing to fit on
            catalog.score_ml_model(spark, lines)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plans[0] and plans[0].count("Exchange") == 1
