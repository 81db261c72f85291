"""Headline queries on ``$BENCH_SF_DIR``; prints one JSON line with seconds per query.

The stored tables the components read (scored panel, step predictions, audits) are written once beforehand,
so a query's time is that of the operator and not of deriving its input. ``*_e2e`` queries start from the
given tables instead.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from shelfspark import names as N
from shelfspark.operators import cascade, confidence, metrics, ranking, scorers, split, tuning
from shelfspark.plans import catalog
from shelfspark.plans.panel import audit_actuals, feature_store, panel, target_store
from shelfspark.sources.scratch import scratch_path, set_local_scratch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    tables = {"panel": keep("panel", panel(spark, SF_DIR))}
    p = tables["panel"]
    for step, frame in cascade.independent_steps(p).items():
        tables[step] = keep(step, frame.select(*N.STEP_COLUMNS[step]))
    tables["final"] = keep("final", cascade.cascade_predict(p).select(*N.FINAL_COLUMNS))
    tables["audit"] = keep("audit", audit_actuals(p))
    tables["features"] = keep("features", feature_store(p))
    tables["targets"] = keep("targets", target_store(p))
    return tables


def cases(spark: SparkSession, t: dict[str, DataFrame]) -> dict:
    p, final = t["panel"], t["final"]
    steps = [t[s] for s in N.STEPS]
    values = [round(0.05 + 0.09 * i, 2) for i in range(10)]

    def search(n: int, unique: bool = False):
        return lambda: tuning.threshold_search(*steps, values[:n], values[:n], catalog.WEIGHTS, unique_keys=unique)

    predicted = final.select(*N.KEYS, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH, N.OOS)
    return {
        "cascade_predict": lambda: cascade.cascade_predict(p),
        "score_model_trees": lambda: scorers.score_model(p, catalog.tree_model(), "score"),
        "score_cascade_linear": lambda: cascade.cascade_predict(scorers.score_cascade(p, catalog.LINEAR)),
        "audit_metrics": lambda: metrics.audit_metrics(metrics.join_audit_prediction(t["audit"], predicted)),
        "overall_metrics": lambda: metrics.overall_metrics(final),
        "confidence_metrics": lambda: confidence.confidence_metrics(final, 0.4, 0.4),
        "tn_probability_bins": lambda: confidence.tn_probability_bins(final, 0.4, 0.4),
        "confidence_level": lambda: confidence.with_confidence(
            cascade.cascade_predict(p), confidence.confidence_metrics(final, 0.4, 0.4)
        ),
        "threshold_search_1": search(1),
        "threshold_search_25": search(5),
        "threshold_search_100": search(10),
        "threshold_search_100_unique_keys": search(10, True),
        "cascade_from_predictions": lambda: cascade.cascade_from_predictions(*steps),
        "join_target_feature": lambda: split.join_target_feature(
            t["targets"].drop("location_group", "load_date"), t["features"]
        ),
        "time_split": lambda: split.time_split(p, series=[N.LOCATION], ties=[N.SKU]),
        "roc_auc": lambda: ranking.roc_auc(p, N.TARGET_OOS, N.BINARY_PRED),
        "regression_errors": lambda: ranking.regression_errors(p, N.TARGET_HS, N.HS_PRED),
        "audit_metrics_e2e": lambda: catalog.QUERIES["audit_metrics"](spark, SF_DIR),
        "cascade_predict_e2e": lambda: catalog.QUERIES["cascade_predict"](spark, SF_DIR),
        "daily_inference_e2e": lambda: catalog.QUERIES["daily_inference"](spark, SF_DIR),
    }


def main() -> None:
    spark = session()
    set_local_scratch(spark)
    base = scratch_path(spark, "bench")
    tables = stored(spark, base)
    seconds = {}
    for name, build in cases(spark, tables).items():
        took = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(min(took), 3)
        print(f"{name:28s} {took}", file=sys.stderr)
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cores": int(CPUS),
        "panel_rows": tables["panel"].count(),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
