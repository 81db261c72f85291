"""Tree ensembles as expressions: against a walk in plain Python, cut into pieces of any size, skipped where inactive."""

import math
import random

import pandas as pd
import pytest
from frames import scored
from pyspark.sql import functions as F
from test_cascade import some_scores
from test_plans import plan

from shelfspark import names as N
from shelfspark.operators import cascade, scorers, trees
from shelfspark.plans import models
from shelfspark.plans.catalog import tree_model
from shelfspark.sources import schemas


def walk(nodes, row):
    by = {(n["tree"], n["node"]): n for n in nodes}
    total = 0.0
    for tree in sorted({n["tree"] for n in nodes}):
        at = by[tree, 0]
        while at["leaf"] is None:
            v = row[at["feature"]]
            default = at["default_left"] is None or at["default_left"]
            left = default if v is None or math.isnan(v) else v < at["threshold"]
            at = by[tree, at["left"] if left else at["right"]]
        total += at["leaf"]
    return total


def random_trees(count, splits, seed=0):
    """Trees of any shape, chains among them."""
    rnd = random.Random(seed)
    nodes = []
    for tree in range(count):
        leaves, used = [0], 1
        kids = {}
        for _ in range(splits):
            at = leaves.pop(rnd.randrange(len(leaves)) if tree % 2 else -1)
            kids[at] = (used, used + 1)
            leaves += kids[at]
            used += 2
        for node in range(used):
            row = dict.fromkeys(trees.NODE_COLUMNS) | {"tree": tree, "node": node}
            if node in kids:
                row |= {"feature": rnd.choice("fg"), "threshold": rnd.randrange(20) / 4, "left": kids[node][0],
                        "right": kids[node][1], "default_left": rnd.choice([True, False, None])}
            else:
                row["leaf"] = rnd.randrange(-64, 64) / 64
            nodes.append(row)
    return nodes


def values(spark):
    rows = [(a / 4, b / 4) for a in range(-1, 21, 3) for b in range(0, 21, 3)]
    rows += [(None, 1.0), (float("nan"), 2.5), (3.0, None), (None, float("nan"))]
    return rows, spark.createDataFrame(rows, "f double, g double")


@pytest.mark.parametrize("most", [1, 3, 31])
def test_pieces_add_up_to_the_walk(spark, monkeypatch, most):
    nodes = random_trees(6, 40)
    monkeypatch.setattr(trees.tree_pieces, "__defaults__", (most,))
    model = scorers.TreeTableScorer(nodes, 0.5)
    assert len(model.pieces) >= 6 * 40 // most
    rows, df = values(spark)
    got = [r.s for r in scorers.score_model(df, model, "s").collect()]
    assert got == [0.5 + walk(nodes, dict(zip("fg", r, strict=True))) for r in rows]


def test_small_model(spark):
    rows = [(25, 9, 30), (10, 4, 10), (10, 5, 25), (None, None, None)]
    df = spark.createDataFrame(rows, f"{N.CURDAY_QTY} long, {N.IP_QTY} long, {N.TOTAL_RETAIL} long")
    got = [r.s for r in scorers.score_model(df, tree_model(), "s").collect()]
    assert got == [0.5 - 0.5 - 0.25 + 0.0625, 0.5 + 0.75 + 0.25 + 0.0625, 0.5 + 0.125 - 0.25 + 0.0625,
                   0.5 + 0.75 - 0.25 + 0.0625]
    off = scorers.score_model(df, tree_model(), "s", F.col(N.IP_QTY) > 4).collect()
    assert [r.s is None for r in off] == [False, True, False, True]


def test_model_from_table_and_from_pandas(spark):
    nodes = random_trees(3, 5, seed=4)
    table = spark.createDataFrame(nodes, schemas.NODES).repartition(4)
    frame = pd.DataFrame(nodes).sample(frac=1, random_state=1)
    a, b = scorers.TreeTableScorer.from_table(table, 0.25, True), scorers.TreeTableScorer(frame, 0.25, True)
    assert a.pieces == b.pieces == scorers.TreeTableScorer(nodes).pieces and a.features == ["f", "g"]
    rows, df = values(spark)
    for got, row in zip(scorers.score_model(df, a, "s").collect(), rows, strict=True):
        assert got.s == pytest.approx(1 / (1 + math.exp(-0.25 - walk(nodes, dict(zip("fg", row, strict=True))))))


def test_missing_child_and_lone_leaf(spark):
    lone = [dict.fromkeys(trees.NODE_COLUMNS) | {"tree": 0, "node": 0, "leaf": 2.5}]
    assert spark.range(1).select(trees.ensemble(scorers.TreeTableScorer(lone).pieces, 1.0, False).alias("s")).first().s == 3.5
    assert spark.range(1).select(trees.ensemble([], 1.0, False).alias("s")).first().s == 1.0
    broken = [dict.fromkeys(trees.NODE_COLUMNS) | {"tree": 0, "node": 0, "feature": "f", "threshold": 1.0, "left": 1, "right": 2}]
    with pytest.raises(KeyError):
        scorers.TreeTableScorer(broken)


def test_cascade_runs_in_the_jvm_and_skips_rows(spark):
    df = scored(spark, some_scores(50)).drop("binary_pred", "hl_orig_pred", "ls_ratio", "hs_pred")
    df = df.withColumn(N.CURDAY_QTY, F.col("sku").cast("long") % 40).withColumn(N.IP_QTY, F.col("sku").cast("long") % 9)
    df = df.withColumn("shelf_count", F.col("sku").cast("long") % 7)
    rows = scorers.score_cascade(df, models.tree_models(), 0.4, 0.4)
    text = plan(cascade.cascade_predict(rows))
    assert "Python" not in text and "Exchange" not in text
    got = rows.collect()
    for r in got:
        rest = r.binary_pred <= 0.4
        assert (r.hl_orig_pred is not None) == rest
        assert (r.ls_ratio is not None) == (rest and r.hl_orig_pred > 0.4)
        assert (r.hs_pred is not None) == (rest and r.hl_orig_pred <= 0.4)
    assert len({r.binary_pred <= 0.4 for r in got}) == 2


def test_a_skipped_model_is_not_evaluated(spark):
    """A model whose evaluation fails does no harm on rows of other branches."""
    class Failing(scorers.Scorer):
        features: list[str] = []

        def add(self, df, out, active=None):
            fail = F.raise_error(F.lit("evaluated")).cast("double")
            return df.withColumn(out, fail if active is None else F.when(active, fail))

    out = scorers.LinearScorer({}, 0.9)
    df = spark.range(5).withColumn("x", F.lit(1.0))
    models_ = {"step_1": out, "step_2": Failing(), "step_3": Failing(), "step_4": Failing()}
    assert {r[N.BINARY_PRED] for r in scorers.score_cascade(df, models_).collect()} == {0.9}
    with pytest.raises(Exception, match="evaluated"):
        scorers.score_cascade(df, models_ | {"step_1": scorers.LinearScorer({}, 0.1)}).collect()


def test_a_filter_does_not_repeat_a_model(spark):
    """One evaluation of each model in the plan, and features that are derived once: a filter on the scores stays above."""
    df = scored(spark, some_scores(50)).drop("binary_pred", "hl_orig_pred", "ls_ratio", "hs_pred")
    derived = df.withColumn(N.IP_QTY, F.length("sku") * 5 % 9).withColumn("shelf_count", F.length("location") * 3 % 7)
    out = cascade.cascade_predict(scorers.score_cascade(derived, models.tree_models(), 0.4, 0.4))
    text = plan(out)
    assert text.count("aggregate(array(") == 4 and text.count("length(sku") == 1
    assert out.columns == cascade.cascade_predict(derived.withColumns({c: F.lit(0.5) for c in (N.BINARY_PRED, N.HL_ORIG_PRED, N.LS_RATIO, N.HS_PRED)})).columns
