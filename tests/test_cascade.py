"""Routing, edge inputs and the agreement of the two ways to build a final prediction."""

import warnings

import pytest
from frames import scored
from pyspark.sql import functions as F

from shelfspark import names as N
from shelfspark.functions.scalar import without_nan
from shelfspark.operators import cascade, confidence, scorers, tuning
from shelfspark.operators.metrics import confusion_stock
from shelfspark.plans.catalog import LINEAR

NAN = float("nan")
SCORES = [
    (0.9, 0.1, 0.5, 4.0),    # out of stock
    (0.4, 0.4, 0.5, 4.0),    # both on the cut-off: higher stock
    (0.1, 0.41, 0.5, 4.0),   # lower stock: 0.5 * 10
    (0.1, 0.2, 0.5, 40.0),   # higher stock
    (NAN, 0.2, 0.5, 4.0),    # no score: leaves the cascade
    (None, 0.2, 0.5, 4.0),
    (0.1, NAN, 0.5, 4.0),
    (0.9, NAN, NAN, NAN),    # out of stock needs no other score
    (0.1, 0.2, 0.5, NAN),    # routed, but without a quantity
]


def test_routes(spark):
    got = {r.sku: r for r in cascade.cascade_predict(scored(spark, SCORES)).collect()}
    assert {k: r.branch for k, r in got.items()} == {
        "0000": "oos", "0001": "hs", "0002": "ls", "0003": "hs", "0007": "oos", "0008": "hs",
    }
    assert (got["0000"].orig_pred, got["0000"].orig_pred_temp, got["0000"].hl_orig_pred) == (0.0, None, None)
    assert (got["0002"].orig_pred, got["0002"].orig_pred_low, got["0002"].orig_pred_high) == (5.0, 4.0, 6.0)
    assert (got["0008"].orig_pred, got["0008"].orig_pred_low, got["0008"].oos) == (None, None, 0)
    assert got["0000"].oos == 1 and got["0002"].oos == 0


def test_steps_partition_the_rows(spark):
    frames = cascade.step_frames(cascade.cascade_predict(scored(spark, SCORES)))
    n = {k: f.count() for k, f in frames.items()}
    assert n["step_1"] + n["step_2"] == 6 and n["step_3"] + n["step_4"] == n["step_2"]


def stored(df):
    frames = cascade.independent_steps(df)
    return [frames[s].select(*N.STEP_COLUMNS[s]) for s in N.STEPS]


def some_scores(n=200):
    return [(i * 37 % 101 / 100, i * 53 % 97 / 96, i % 9 / 4, float(i % 23)) for i in range(n)]


def test_rebuilt_equals_direct(spark):
    df = scored(spark, some_scores(), rev=[i % 5 - 2 for i in range(200)])
    direct = cascade.cascade_predict(df, 0.5, 0.3).select(*N.BEST_COLUMNS)
    rebuilt = cascade.cascade_from_predictions(*stored(df), 0.5, 0.3).select(*N.BEST_COLUMNS)
    assert direct.exceptAll(rebuilt).count() == 0 and rebuilt.exceptAll(direct).count() == 0


GRID = ("0.5,0.1,0.9,0.5", "0.3,0.8,0.0")


@pytest.mark.parametrize("copies", [False, True])
def test_grid_equals_loop(spark, copies):
    df = scored(spark, some_scores(60) + SCORES, rev=[i % 5 - 2 for i in range(60 + len(SCORES))])
    s1, s2, s3, s4 = stored(df)
    if copies:
        # A third of all rows are copies of one key, in every stored step, with different scores.
        hot = s1.where("sku = '0003'")
        s1 = s1.unionByName(hot.crossJoin(spark.range(8)).withColumn("binary_pred", F.col("id") / 8).drop("id"))
        s2 = s2.unionByName(s2.where("sku = '0003'").crossJoin(spark.range(6)).withColumn("hl_orig_pred", F.col("id") / 6).drop("id"))
        s3 = s3.unionByName(s3.where("sku = '0003'").crossJoin(spark.range(4)).drop("id"))
    unique = [False] if copies else [False, True]
    for flag in unique:
        got = tuning.grid_counts(s1, s2, s3, s4, *GRID, unique_keys=flag).orderBy("pos").collect()
        pairs = [(a, b) for a in tuning.parse_thresholds(GRID[0]) for b in tuning.parse_thresholds(GRID[1])]
        assert [(r.oos_threshold, r.hl_threshold) for r in got] == pairs
        clean = [x.transform(lambda d: d.replace(float("nan"), None)) for x in (s1, s2, s3, s4)]
        for r, (a, b) in list(zip(got, pairs))[::2]:
            from shelfspark.operators.metrics import confusion_stock

            want = confusion_stock(cascade.cascade_from_predictions(*clean, a, b)).first()
            assert (r.tp, r.fn, r.tn, r.fp) == (want.tp, want.fn, want.tn, want.fp), (a, b)


def test_grid_ties_and_no_winner(spark):
    df = scored(spark, some_scores(20))
    steps = stored(df)
    flat = [{"metric_name": "TP Count", "metric_weight": 0.0}]
    with pytest.raises(ValueError, match="Nonsense"):
        tuning.threshold_search(*steps, *GRID, [{"metric_name": "Nonsense", "metric_weight": 1.0}])
    best = tuning.threshold_search(*steps, *GRID, flat)
    assert tuple(best.first()) == (0.0, 0.0, 0.0)
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        assert tuning.best_prediction(*steps, best).count() == 0
        assert any("above zero" in str(w.message) for w in caught)
    tied = spark.createDataFrame([(1, 0.1, 0.1, 5.0), (0, 0.2, 0.2, 5.0), (2, 0.3, 0.3, 4.0)],
                                 "pos long, oos_threshold double, hl_threshold double, score double")
    assert tuple(tuning.best_of_grid(tied).first()) == (0.2, 0.2, 5.0)


def test_junk_feature(spark):
    df = spark.createDataFrame([("1",), ("x",)], "f string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        cascade.cast_object_features(df, ["f"]).collect()
    assert [r.f for r in cascade.cast_object_features(df, ["f"], strict=False).collect()] == [1, None]


def test_linear_cascade_skips_unrouted_rows(spark):
    df = scored(spark, some_scores(50)).drop("binary_pred", "hl_orig_pred", "ls_ratio", "hs_pred")
    rows = scorers.score_cascade(df, LINEAR, 0.4, 0.4).collect()
    for r in rows:
        assert (r.hl_orig_pred is None) == (r.binary_pred > 0.4)


def test_ml_model(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df = spark.createDataFrame([(float(i), float(i % 2), float(i > 5), 2.0 * i) for i in range(12)],
                               "a double, b double, label double, qty double")
    train = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    tree = DecisionTreeClassifier(labelCol="label").fit(train)
    assert [r.p for r in scorers.score_ml_model(df, tree, ["a", "b"], "p").collect()] == [0.0] * 6 + [1.0] * 6
    line = LinearRegression(labelCol="qty").fit(train)
    got = scorers.score_ml_model(df, line, ["a", "b"], "p").collect()
    assert [round(r.p, 6) for r in got] == [2.0 * i for i in range(12)]


def test_confidence_levels(spark):
    df = cascade.cascade_predict(scored(spark, some_scores(), rev=[i % 5 - 2 for i in range(200)]))
    row = confidence.confidence_metrics(df, 0.4, 0.4)
    got = confidence.with_confidence(df, row, 0.4, 0.4)
    assert {r[0] for r in got.select(N.CONFIDENCE_LEVEL).distinct().collect()} <= {"HIGH", "MEDIUM", "LOW"}
    plugged = confidence.with_confidence(df, row, 0.4, 0.4, rule=lambda *models: F.lit(len(models)).cast("string"))
    assert plugged.first()[N.CONFIDENCE_LEVEL] == "4"


def test_confidence_edges(spark):
    rows = cascade.cascade_predict(scored(spark, [(1.0, 0.1, 0.0, 0.0), (0.4, 0.1, 0.0, 0.0)], rev=[0, 0]))
    row = confidence.confidence_metrics(rows, 0.4, 0.4).first()
    # 0.4 counts as called out of stock here; exactly 1.0 lies in no bin.
    assert row.oos_tp_percent == 100.0 and row.oos_tp_bins["0.4"] == 50.0 and row.oos_tp_bins["0.9"] == 0.0
    closed = confidence.confidence_metrics(rows, 0.4, 0.4, close_last=True).first()
    assert closed.oos_tp_bins["0.9"] == 50.0
    empty = confidence.confidence_metrics(rows.where(F.lit(False)), 1.0, 0.0).first()
    assert empty.oos_tp_percent == 0.0 and empty.oos_tp_bins == {} and empty.hl_tn_bins == {}
