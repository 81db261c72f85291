"""The jobs end to end on stored data, including both directory layouts."""

import json
from pathlib import Path

import pytest
from frames import scored
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_cascade import some_scores

from shelfspark import names as N
from shelfspark.operators import cascade, confidence, metrics, scorers, tuning
from shelfspark.plans import jobs
from shelfspark.sources import readers, writers

MODELS = {
    "step_1": scorers.LinearScorer({"f1": 1.0}),
    "step_2": scorers.LinearScorer({"f2": 1.0}),
    "step_3": scorers.LinearScorer({"f3": 1.0}),
    "step_4": scorers.LinearScorer({"f4": 1.0}),
}
DAY = "2020-08-01"


def featured(spark, n=120):
    df = scored(spark, some_scores(n), rev=[i % 5 - 2 for i in range(n)])
    named = dict(zip((N.BINARY_PRED, N.HL_ORIG_PRED, N.LS_RATIO, N.HS_PRED), ("f1", "f2", "f3", "f4")))
    return df.withColumnsRenamed(named).withColumn("location_group", F.format_string("%02d", (F.col("sku") % 3).cast("int")))


def document(path) -> dict:
    (part,) = Path(path).glob("part-*.json")
    return json.loads(part.read_text())


def test_life_of_the_models(spark, tmp_path):
    base = str(tmp_path)
    df = featured(spark)
    targets = [N.REV_QTY, N.TOTAL_RETAIL, N.TARGET_OOS, N.TARGET_HL, N.TARGET_LS, N.TARGET_HS]
    by = ["location_group", "load_date"]
    loaded = df.withColumn("load_date", F.lit("2020-07-01"))
    loaded.drop(*targets).write.partitionBy(*by).parquet(f"{base}/features")
    loaded.select(*N.KEYS, *targets, *by).write.partitionBy(*by).parquet(f"{base}/targets")

    jobs.split_job(spark, f"{base}/features", f"{base}/targets", f"{base}/split", current_date=DAY,
                   train_start="2020-01-01", series=[N.LOCATION], ties=[N.SKU])
    test = readers.scan_test_split(spark, f"{base}/split")
    assert test.count() == 12 and set(test.columns) >= {"f1", N.TARGET_OOS, "location_group"}
    assert list(Path(f"{base}/split/location_group=00/load_date={DAY}/data_split=test").glob("*.gz.parquet"))

    jobs.evaluate_new_job(spark, f"{base}/split", f"{base}/new", MODELS)
    steps = {s: readers.scan_step_predictions(spark, f"{base}/new", s) for s in N.STEPS}
    assert {s: f.count() for s, f in steps.items()} == dict.fromkeys(N.STEPS, 12)

    (tmp_path / "weights.json").write_text(json.dumps({"metrics_list": [{"metric_name": "Accuracy", "metric_weight": 1}]}))
    best = jobs.tune_job(spark, f"{base}/new", f"{base}/tuned", "0.2,0.5", "0.2,0.5", f"{base}/weights.json").first()
    assert document(f"{base}/tuned/best_thresholds") == {"oos_threshold": best.oos_threshold, "hl_threshold": best.hl_threshold}

    t1, t2 = best.oos_threshold, best.hl_threshold
    jobs.score_job(spark, f"{base}/new", f"{base}/score", t1, t2, new_models=True)
    overall = document(f"{base}/score/overall_metrics_new")
    assert list(overall) == list(N.OVERALL_DOCUMENT) and overall["Accuracy %"] == pytest.approx(best.score)
    technical = document(f"{base}/score/individual_tech_metrics_new")
    assert "step_1_roc_auc" in technical and "step_4_median_absolute_error" in technical

    jobs.evaluate_production_job(spark, f"{base}/split", f"{base}/prod", MODELS, t1, t2)
    jobs.score_job(spark, f"{base}/prod", f"{base}/score", t1, t2, new_models=False)
    assert document(f"{base}/score/overall_metrics_prod") == overall

    audit = df.withColumn("load_date", F.lit(DAY))
    audit.write.partitionBy("load_date").parquet(f"{base}/audit-features")
    jobs.predict_audit_job(spark, f"{base}/audit-features", f"{base}/audit-out", DAY, MODELS, 0.4, 0.4)
    jobs.confidence_job(spark, f"{base}/audit-out", f"{base}/confidence", DAY, 0.4, 0.4)
    stored = readers.scan_confidence_document(spark, f"{base}/confidence/LOAD_DATE={DAY}").first()
    direct = cascade.cascade_predict(scorers.score_cascade(df, MODELS))
    assert stored.asDict() == confidence.confidence_metrics(direct).first().asDict()

    audit.write.partitionBy("location_group", "load_date").parquet(f"{base}/day")
    jobs.infer_job(spark, f"{base}/day", f"{base}/infer", DAY, MODELS, f"{base}/confidence/LOAD_DATE={DAY}", 0.4, 0.4)
    assert len(list(Path(f"{base}/infer/prediction").glob("location_group=*/*.csv"))) == 3

    flags = df.withColumn(N.ACTUAL_OOS, F.col(N.TARGET_OOS)).where("sku % 2 = 0")
    flags.select(*[f.name for f in readers.schemas.AUDIT.fields]).write.option("header", True).csv(f"{base}/actuals")
    jobs.audit_job(spark, f"{base}/actuals", f"{base}/infer", f"{base}/report", f"{base}/all")
    want = metrics.to_document(
        metrics.audit_metrics(metrics.join_audit_prediction(
            flags.select(*N.KEYS, N.ACTUAL_OOS, N.REV_QTY, N.CURDAY_QTY, N.IP_QTY, N.TOTAL_RETAIL), direct)),
        N.AUDIT_DOCUMENT,
    ).first().asDict()
    assert document(f"{base}/report/output_metrics") == want
    assert len(list(Path(f"{base}/all").glob("*.csv"))) == 1


def test_switch(spark, tmp_path):
    for name, score in (("a", "71.5"), ("b", "71.5"), ("c", "72.0")):
        (tmp_path / f"{name}.csv").write_text(f"RUN,OVERALL_SCORE\nx,{score}\ny,99\n")
    runs = {"champion": "old", "challenger": "new"}

    def decide(champion, challenger, compare=True):
        paths = {"champion": str(tmp_path / champion), "challenger": str(tmp_path / challenger)}
        return jobs.switch_job(spark, paths, runs, compare).first()

    assert decide("a.csv", "c.csv").production_run == "new"
    assert decide("a.csv", "b.csv").production_run == "old"
    assert decide("c.csv", "a.csv").promote == 0
    assert decide("c.csv", "a.csv", compare=False).promote == 1
    (tmp_path / "none.csv").write_text("RUN,OVERALL_SCORE\n")
    with pytest.raises(Exception, match="no score of a champion"):
        decide("none.csv", "a.csv")


def test_group_first_layout(spark, tmp_path):
    """Groups above steps, upper-case headers, an index column, whole numbers with a point, a padded SKU."""
    for group, sku in (("01", "007"), ("02", "8")):
        for step, header, line in (
            ("step_1", ",SKU,LOCATION,DATE,binary_pred,BINARY_TARGET_CLASSIFICATION,IP_QTY_EOP_SOH,"
             "CURDAY_IP_QTY_EOP_SOH,REV_IP_QTY_EOP_SOH,TOTAL_RETAIL", f"0,{sku},5,2020-01-01,0.25,1.0,3,4,-1,9"),
            ("final_prediction", "SKU,LOCATION,DATE,IP_QTY_EOP_SOH,CURDAY_IP_QTY_EOP_SOH,REV_IP_QTY_EOP_SOH,"
             "TOTAL_RETAIL,OOS,binary_pred,hl_orig_pred,orig_pred,orig_pred_low,orig_pred_high,"
             "BINARY_TARGET_CLASSIFICATION", f"{sku},5,2020-01-01 00:00:00,3,4,-1,9,1,0.5,,0,0,0,1"),
        ):
            at = tmp_path / f"LOCATION_GROUP={group}" / step
            at.mkdir(parents=True)
            (at / "part-0.csv").write_text(f"{header}\n{line}\n")
    rows = readers.scan_step_predictions(spark, str(tmp_path), "step_1", by_group=True).orderBy("sku").collect()
    assert [(r.sku, r.LOCATION_GROUP, r.binary_pred, r.binary_target_classification) for r in rows] == [
        ("007", "01", 0.25, 1), ("8", "02", 0.25, 1)
    ]
    final = readers.scan_final_prediction_csv(spark, str(tmp_path), "group").orderBy("sku").first()
    assert final.hl_orig_pred is None and final.oos == 1 and str(final.date) == "2020-01-01"


def test_nan_becomes_null_at_the_source(spark, tmp_path):
    spark.createDataFrame([(float("nan"), "a")], "x double, load_date string").write.parquet(str(tmp_path / "t"))
    assert readers.read_parquet(spark, str(tmp_path / "t")).first().x is None


def test_weights_round_trip(spark, tmp_path):
    (tmp_path / "w.json").write_text('{\n "metrics_list": [{"metric_name": "F1 Score", "metric_weight": 2}]\n}')
    assert jobs.load_weights(spark, str(tmp_path / "w.json")) == [{"metric_name": "F1 Score", "metric_weight": 2.0}]
    counts = spark.createDataFrame([(2, 2, 3, 1)], "tp long, fn long, tn long, fp long")
    weights = jobs.load_weights(spark, str(tmp_path / "w.json"))
    assert tuning.weighted_metric_score(counts, weights).first().score == 2 * 57.14


def test_weights_of_one_metric_are_added(spark, tmp_path):
    entries = [{"metric_name": ("Accuracy", "F1 Score")[i % 2], "metric_weight": 0.5} for i in range(5000)]
    (tmp_path / "many.json").write_text(json.dumps({"metrics_list": entries}))
    want = [{"metric_name": "Accuracy", "metric_weight": 1250.0}, {"metric_name": "F1 Score", "metric_weight": 1250.0}]
    assert jobs.load_weights(spark, str(tmp_path / "many.json")) == want
    (tmp_path / "odd.json").write_text(json.dumps({"metrics_list": [{"metric_name": "Luck", "metric_weight": 1}]}))
    with pytest.raises(ValueError, match="Luck"):
        jobs.load_weights(spark, str(tmp_path / "odd.json"))


def test_swapped_header_is_an_error(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.csv").write_text("sku,x\na,1\n")
    (tmp_path / "p" / "b.csv").write_text("x,sku\n2,b\n")
    schema = T.StructType([T.StructField("sku", T.StringType()), T.StructField("x", T.DoubleType())])
    with pytest.raises(Exception, match="header|FAILED_READ_FILE"):
        readers.read_csv(spark, str(tmp_path / "p"), schema).collect()


def test_first_score_of_many_parts(spark, tmp_path):
    """The first row of the first file by name that has rows, whatever the number of tasks."""
    for name, lines in (("part-2", ["30"]), ("part-0", []), ("part-1", ["", "12", "13"])):
        (tmp_path / f"{name}.csv").write_text("\n".join(["overall_score,run", *(f"{x},a" for x in lines), ""]))
    paths = {"champion": str(tmp_path)}
    assert readers.scan_model_scores(spark, paths, {"champion": "r"}).first().overall_score is None
    (tmp_path / "part-1.csv").write_text("run,overall_score\n" + "\n".join(f"a,{i}.5" for i in range(7, 5000)) + "\n")
    for name in ("part-2", "part-0"):
        (tmp_path / f"{name}.csv").write_text("run,overall_score\n" + ("a,1\n" if name == "part-2" else ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert readers.scan_model_scores(spark, paths, {"champion": "r"}).first().overall_score == 7.5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
