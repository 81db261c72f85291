"""Named queries: every operator applied to the panel derived from the given tables.

Each takes ``(spark, sf_dir)`` and runs over the whole tables. Source and sink queries write the derived
tables below the shared scratch folder first and read them back.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark import names as N
from shelfspark.functions import binarize, oos_exact, oos_nonpositive, parse_iso_date, round_n
from shelfspark.functions.scalar import band_columns
from shelfspark.operators import cascade, confidence, metrics, ranking, scorers, selection, split, tuning
from shelfspark.plans import jobs, models
from shelfspark.plans.panel import FEATURES, TARGETS, audit_actuals, feature_store, panel, target_store
from shelfspark.sources import readers, writers
from shelfspark.sources.scratch import delete_path, drops_shuffles, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

T1 = T2 = 0.4
DAY = "2001-12-31"
TRAIN_START = "1996-03-01"
LAST_TRAIN = "1997-06-01"
AS_OF = "2001-06-30"
COUNTS_FROM = "1995-06-01"
ELIGIBLE_START = "1995-03-01"
GROUPS = ["0", "1", "2", "3"]
OOS_GRID, HL_GRID = "0.3,0.4,0.5,0.6", "0.5,0.2,0.4,0.35"
WEIGHTS = [
    {"metric_name": "F1 Score", "metric_weight": 0.5},
    {"metric_name": "Recall Percent", "metric_weight": 0.25},
    {"metric_name": "Accuracy", "metric_weight": 0.25},
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _predicted(spark: SparkSession, sf: str, t1: float = T1, t2: float = T2) -> DataFrame:
    return cascade.cascade_predict(panel(spark, sf), t1, t2)


def _steps(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Step tables as the evaluation of new models stores them."""
    frames = cascade.independent_steps(panel(spark, sf))
    return {s: cascade.project_required_columns(f, N.STEP_COLUMNS[s]) for s, f in frames.items()}


def _audited(spark: SparkSession, sf: str) -> DataFrame:
    predicted = _predicted(spark, sf).select(*N.KEYS, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH, N.OOS)
    return metrics.join_audit_prediction(audit_actuals(panel(spark, sf)), predicted)


def _stored_panel(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """What the step tables are cut from, derived once, and where it lies."""
    path = scratch_path(spark, "panel")
    scores = (N.BINARY_PRED, N.HL_ORIG_PRED, N.LS_RATIO, N.HS_PRED)
    rows = panel(spark, sf)
    held = {*N.KEYS, *scores, N.CURDAY_QTY, N.LOCATION_GROUP, *(c for cols in N.STEP_COLUMNS.values() for c in cols)}
    rows.select(*[c for c in rows.columns if c in held]).write.options(**writers.SCRATCH).parquet(path)
    return spark.read.parquet(path), path


def _ordered_steps(spark: SparkSession, sf: str) -> list[DataFrame]:
    frames = cascade.independent_steps(_stored_panel(spark, sf)[0])
    return [cascade.project_required_columns(frames[s], N.STEP_COLUMNS[s]) for s in N.STEPS]


# --- sources ------------------------------------------------------------------------------------------------


def _stored_features(spark: SparkSession, sf: str, load_date: str | None = None) -> str:
    path = scratch_path(spark, "features")
    rows = feature_store(panel(spark, sf))
    rows = rows if load_date is None else rows.withColumn(N.LOAD_DATE, F.lit(load_date))
    writers.balanced(rows, [N.LOCATION_GROUP]).write.partitionBy(N.LOCATION_GROUP, N.LOAD_DATE).parquet(path)
    return path


@query
def scan_feature_store(spark, sf):
    return readers.scan_feature_store(spark, _stored_features(spark, sf), GROUPS)


@query
def scan_controlled_features(spark, sf):
    """Features of the groups and months that a stored control table switches on."""
    path = scratch_path(spark, "control")
    months = panel(spark, sf).select(N.LOCATION_GROUP, N.LOAD_DATE).distinct()
    group, month = F.col(N.LOCATION_GROUP).cast("int"), F.month(F.to_date(N.LOAD_DATE))
    months.withColumn("state", F.when((group + month) % 3 == 0, "on").otherwise("off")).write.parquet(path)
    control = spark.read.parquet(path).where("state = 'on'")  # Catalyst prunes by conditions it thinks selective
    store = readers.read_parquet(spark, _stored_features(spark, sf))
    return readers.scan_by_control(store, control).select(*N.KEYS, *FEATURES, N.LOCATION_GROUP, N.LOAD_DATE)


@query
def scan_target_store(spark, sf):
    path = scratch_path(spark, "targets")
    writers.balanced(target_store(panel(spark, sf)), [N.LOCATION_GROUP]).write.partitionBy(N.LOCATION_GROUP).parquet(path)
    return readers.scan_target_store(spark, path, GROUPS)


@query
def scan_inference_features(spark, sf):
    return readers.scan_inference_features(spark, _stored_features(spark, sf, DAY), DAY, GROUPS)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return split.time_split(panel(spark, sf), series=[N.LOCATION], ties=[N.SKU])


@query
def scan_test_split(spark, sf):
    path = scratch_path(spark, "split")
    writers.write_split_parquet(_labelled(spark, sf), path)
    return readers.scan_test_split(spark, path, GROUPS).select(*N.KEYS, *FEATURES, *TARGETS[:3])


@query
def scan_audit_features(spark, sf):
    path = scratch_path(spark, "audit-features")
    rows = panel(spark, sf).select(*N.KEYS, *FEATURES, F.lit(DAY).alias(N.LOAD_DATE))
    rows.write.partitionBy(N.LOAD_DATE).parquet(path)
    return readers.scan_audit_features(spark, path, DAY)


@drops_shuffles
def _stored_steps(spark: SparkSession, sf: str) -> str:
    """The step sets as the evaluation of new models publishes them."""
    base = scratch_path(spark, "steps")
    rows, path = _stored_panel(spark, sf)
    for step, frame in cascade.independent_steps(rows).items():
        writers.write_step_csv(frame, base, step, N.STEP_COLUMNS[step], packed=True)
    delete_path(spark, path)
    return base


def _whole_as_double(df: DataFrame) -> DataFrame:
    """Whole numbers that some branches lack, in a type that has one form with and without gaps."""
    whole = [f.name for f in df.schema.fields if f.dataType.typeName() == "long"]
    return df.withColumns({c: F.col(c).cast("double") for c in whole})


@query
def scan_step_predictions(spark, sf):
    base = _stored_steps(spark, sf)
    stacked = cascade.concat_branches(
        *[readers.scan_step_predictions(spark, base, s).withColumn("step", F.lit(s)) for s in N.STEPS]
    )
    return _whole_as_double(stacked)


@query
def scan_final_prediction_csv(spark, sf):
    base = scratch_path(spark, "final")
    writers.write_step_csv(_predicted(spark, sf), base, "final_prediction", N.FINAL_COLUMNS)
    return readers.scan_final_prediction_csv(spark, base)


@query
def scan_final_prediction_parquet(spark, sf):
    base = scratch_path(spark, "final-parquet")
    writers.write_final_parquet(_predicted(spark, sf), base, DAY, N.FINAL_COLUMNS)
    return readers.scan_final_prediction_parquet(spark, base, DAY)


def _stored_audit(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "audit")
    audit_actuals(panel(spark, sf)).write.option("header", True).csv(path)
    return path


@query
def scan_audit_actuals(spark, sf):
    return readers.scan_audit_actuals(spark, _stored_audit(spark, sf))


def _confident(spark: SparkSession, sf: str) -> DataFrame:
    predicted = _predicted(spark, sf)
    return confidence.with_confidence(predicted, confidence.confidence_metrics(predicted, T1, T2), T1, T2)


def _stored_concatenated(spark: SparkSession, sf: str) -> str:
    base = scratch_path(spark, "daily")
    writers.write_step_csv(_confident(spark, sf), f"{base}/temp", "concatenated", N.CONCATENATED_COLUMNS)
    return base


@query
def scan_concatenated_predictions(spark, sf):
    return readers.scan_concatenated_predictions(spark, _stored_concatenated(spark, sf))


def _confidence_long(row: DataFrame) -> DataFrame:
    """Scalars and bins of a flat confidence row as ``(metric, value)``."""
    scalars = [c for c in row.columns if not c.endswith("_bins")]
    bins = [
        row.select(F.explode(c).alias("start", "value")).select(
            F.concat(F.lit(c + "_"), F.col("start")).alias("metric"), "value"
        )
        for c in row.columns if c.endswith("_bins")
    ]
    return cascade.concat_branches(metrics.to_long(row.select(*scalars)), *bins)


@query
def scan_confidence_document(spark, sf):
    path = scratch_path(spark, "confidence")
    row = confidence.confidence_metrics(_predicted(spark, sf), T1, T2)
    writers.write_metric_json(confidence.confidence_document(row), path)
    return _confidence_long(readers.scan_confidence_document(spark, path))


def _stored_weights(spark: SparkSession) -> str:
    path = scratch_path(spark, "weights")
    spark.range(1).select(F.lit(json.dumps({"metrics_list": WEIGHTS})).alias("value")).coalesce(1).write.text(path)
    return path


@query
def scan_metric_weights(spark, sf):
    """The stored weights next to the value each one weighs."""
    weights = readers.scan_metric_weights(spark, _stored_weights(spark))
    rated = metrics.binary_rates(metrics.confusion_stock(_predicted(spark, sf)))
    named = rated.select(*[F.col(c).cast("double").alias(name) for name, c in N.WEIGHTED_METRICS.items()])
    values = metrics.to_long(named).withColumnRenamed("metric", "metric_name")
    return weights.join(values, "metric_name").select("metric_name", "metric_weight", "value")


def _run_scores(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Overall scores of two cut-off choices on the panel."""
    pairs = {selection.CHAMPION: (0.4, 0.4), selection.CHALLENGER: (0.5, 0.3)}
    return {
        role: tuning.weighted_metric_score(
            metrics.confusion_stock(_predicted(spark, sf, *pair)), WEIGHTS, "overall_score"
        ).select("overall_score")
        for role, pair in pairs.items()
    }


def _stored_scores(spark: SparkSession, sf: str) -> DataFrame:
    paths = {}
    for role, row in _run_scores(spark, sf).items():
        paths[role] = scratch_path(spark, f"score-{role}")
        row.coalesce(1).write.option("header", True).csv(paths[role])
    return readers.scan_model_scores(spark, paths, {r: f"run-{r}" for r in paths})


@query
def scan_model_scores(spark, sf):
    return _stored_scores(spark, sf)


# --- sinks --------------------------------------------------------------------------------------------------


@query
def sink_split_parquet(spark, sf):
    path = scratch_path(spark, "split")
    writers.write_split_parquet(_labelled(spark, sf).drop(N.LOAD_DATE), path, DAY)
    return readers.read_parquet(spark, path).select(*N.KEYS, N.TOTAL_RETAIL, N.LOCATION_GROUP, N.LOAD_DATE, N.DATA_SPLIT)


@query
def sink_step_csv(spark, sf):
    base = scratch_path(spark, "step")
    writers.write_step_csv(panel(spark, sf), base, "step_1", N.STEP_COLUMNS["step_1"])
    return readers.scan_step_predictions(spark, base, "step_1")


@query
def sink_step_csv_by_group(spark, sf):
    """Groups written in two runs, one of them written again, another by a run that has no rows of it any more."""
    base, rows = scratch_path(spark, "step-groups"), panel(spark, sf)
    for groups in (GROUPS[:2], GROUPS[2:], GROUPS[1:2]):
        writers.write_step_csv(readers.in_groups(rows, groups), base, "step_1", N.STEP_COLUMNS["step_1"], groups)
    emptied = readers.in_groups(rows, GROUPS[2:]).where(F.col(N.LOCATION_GROUP) != GROUPS[3])
    writers.write_step_csv(emptied, base, "step_1", N.STEP_COLUMNS["step_1"], GROUPS[2:])
    return readers.scan_step_predictions(spark, base, "step_1")


@query
def sink_split_rerun(spark, sf):
    """A load date written twice, the second time without validation rows and without one group; another stays. The rows
    are labelled and laid out once, and all three runs write from that table."""
    path, once, by = scratch_path(spark, "split-rerun"), scratch_path(spark, "labelled"), [N.LOCATION_GROUP, N.DATA_SPLIT]
    writers.balanced(_labelled(spark, sf).drop(N.LOAD_DATE), by).write.partitionBy(*by).parquet(once)
    rows = readers.read_parquet(spark, once)
    fewer = rows.where((F.col(N.DATA_SPLIT) != "validation") & (F.col(N.LOCATION_GROUP) != GROUPS[0]))
    writers.write_split_parquet(rows, path, AS_OF, GROUPS, balance=False)
    writers.write_split_parquet(rows, path, DAY, GROUPS, balance=False)
    writers.write_split_parquet(fewer, path, DAY, GROUPS, balance=False)
    return readers.read_parquet(spark, path).select(*N.KEYS, N.LOCATION_GROUP, N.LOAD_DATE, N.DATA_SPLIT)


@query
def sink_single_csv(spark, sf):
    """The daily prediction after writing one CSV per group."""
    path = scratch_path(spark, "single")
    writers.write_group_csv(_confident(spark, sf), path, N.DAILY_COLUMNS, GROUPS)
    return readers.read_csv(spark, path, readers.schemas.DAILY, path)


@query
def sink_performance_report(spark, sf):
    path = scratch_path(spark, "report")
    writers.write_performance_report(_audited(spark, sf), path)
    columns = N.KEYS + [N.ACTUAL_OOS, N.REV_QTY, N.CURDAY_QTY, N.IP_QTY, N.TOTAL_RETAIL, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH, N.OOS]
    return readers.read_csv(spark, path, readers.schemas.table(columns))


@query
def sink_all_predictions(spark, sf):
    path = scratch_path(spark, "all")
    columns = N.KEYS + [N.BINARY_PRED, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH, N.ORIG_PRED, N.HL_ORIG_PRED, N.ORIG_PRED_TEMP, N.OOS]
    writers.write_all_predictions(_predicted(spark, sf).select(*columns), path)
    return readers.read_csv(spark, path, readers.schemas.table(columns))


@query
def sink_final_parquet(spark, sf):
    base = scratch_path(spark, "final-parquet")
    writers.write_final_parquet(_predicted(spark, sf), base, DAY, N.FINAL_COLUMNS)
    return spark.read.parquet(f"{base}/LOAD_DATE={DAY}/final_prediction")


def _best_rows(spark: SparkSession, sf: str) -> DataFrame:
    steps = _ordered_steps(spark, sf)
    return tuning.best_prediction(*steps, tuning.threshold_search(*steps, OOS_GRID, HL_GRID, WEIGHTS))


@query
def sink_best_prediction(spark, sf):
    base = scratch_path(spark, "best")
    writers.write_best_prediction(_best_rows(spark, sf), base)
    return readers.scan_final_prediction_csv(spark, base, "flat", best=True)


@query
def sink_metric_json(spark, sf):
    path = scratch_path(spark, "metrics")
    row = metrics.to_document(metrics.overall_metrics(_predicted(spark, sf)), N.OVERALL_DOCUMENT)
    writers.write_metric_json(row, path)
    kinds = {f.name: f.dataType for f in row.schema.fields}
    back = spark.read.schema(", ".join(f"`{k}` {t.simpleString()}" for k, t in kinds.items())).json(path)
    return back.select(*[F.col(f"`{k}`").alias(c) for k, c in N.OVERALL_DOCUMENT.items()])


# --- projections and filters --------------------------------------------------------------------------------


@query
def drop_partition_columns(spark, sf):
    return split.drop_partition_columns(feature_store(panel(spark, sf)))


@query
def filter_train_start(spark, sf):
    return split.filter_train_start(panel(spark, sf), TRAIN_START).select(*N.KEYS, N.BINARY_PRED)


@query
def filter_incremental_load(spark, sf):
    return split.filter_incremental_load(panel(spark, sf), LAST_TRAIN).select(*N.KEYS, N.LOAD_DATE)


@query
def filter_as_of_date(spark, sf):
    return split.filter_as_of_date(_labelled(spark, sf), AS_OF).select(*N.KEYS, N.DATA_SPLIT)


@query
def optional_audit_filter(spark, sf):
    flagged = panel(spark, sf).withColumn("audit_day_flag", F.when(F.col("dn") % 3 == 0, 1).otherwise(0))
    return split.optional_audit_filter(flagged).select(*N.KEYS, N.TOTAL_RETAIL)


@query
def cast_object_features(spark, sf):
    coded = panel(spark, sf).withColumn(N.CURDAY_QTY, F.col(N.CURDAY_QTY).cast("string"))
    return cascade.cast_object_features(coded, [N.CURDAY_QTY, N.IP_QTY]).select(*N.KEYS, N.CURDAY_QTY, N.IP_QTY)


@query
def route_oos(spark, sf):
    return panel(spark, sf).where(cascade.is_oos(T1)).select(*N.KEYS, N.BINARY_PRED)


@query
def route_rest(spark, sf):
    return panel(spark, sf).where(cascade.is_rest(T1)).select(*N.KEYS, N.BINARY_PRED)


@query
def route_lower_stock(spark, sf):
    return panel(spark, sf).where(cascade.is_lower_stock(T1, T2)).select(*N.KEYS, N.BINARY_PRED, N.HL_ORIG_PRED)


@query
def route_higher_stock(spark, sf):
    return panel(spark, sf).where(cascade.is_higher_stock(T1, T2)).select(*N.KEYS, N.BINARY_PRED, N.HL_ORIG_PRED)


@query
def fill_oos_constants(spark, sf):
    rows = cascade.fill_oos_constants(panel(spark, sf).where(cascade.is_oos(T1)))
    return rows.select(*N.KEYS, N.ORIG_PRED, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH)


@query
def scale_ratio_by_book(spark, sf):
    return panel(spark, sf).select(*N.KEYS, cascade.scale_by_book(N.LS_RATIO).alias(N.ORIG_PRED))


@query
def prediction_band(spark, sf):
    rows = panel(spark, sf).select(*N.KEYS, F.col(N.HS_PRED).alias(N.ORIG_PRED))
    return band_columns(rows)


@query
def oos_flag_exact(spark, sf):
    return band_columns(panel(spark, sf).select(*N.KEYS, F.col(N.HS_PRED).alias(N.ORIG_PRED))).select(
        *N.KEYS, oos_exact().alias(N.OOS)
    )


@query
def oos_flag_nonpositive(spark, sf):
    return panel(spark, sf).select(*N.KEYS, oos_nonpositive(N.IP_QTY).alias(N.OOS))


@query
def conditional_mask_outputs(spark, sf):
    return cascade.mask_outputs(_predicted(spark, sf), T1, T2).select(*N.KEYS, N.GT_OUT, N.LT_OUT)


@query
def project_required_columns(spark, sf):
    return cascade.project_required_columns(_predicted(spark, sf), N.FINAL_COLUMNS)


@query
def binarize_score(spark, sf):
    return panel(spark, sf).select(*N.KEYS, binarize(N.BINARY_PRED, T1).alias("predicted"))


@query
def parse_audit_date(spark, sf):
    text = panel(spark, sf).select("sku", "location", F.col("date").cast("string").alias("text"))
    return text.select("sku", "location", parse_iso_date("text").alias("date"))


@query
def rescale_target(spark, sf):
    return panel(spark, sf).select(*N.KEYS, ranking.rescale_target(N.TARGET_LS).alias("quantity"))


# --- aggregations -------------------------------------------------------------------------------------------


@query
def confusion_flags(spark, sf):
    return metrics.confusion_flags(_audited(spark, sf))


@query
def confusion_stock(spark, sf):
    return metrics.confusion_stock(_predicted(spark, sf))


@query
def confusion_scores(spark, sf):
    return metrics.confusion_scores(panel(spark, sf), N.TARGET_OOS, N.BINARY_PRED, T1)


@query
def binary_rates(spark, sf):
    return metrics.binary_rates(metrics.confusion_stock(_predicted(spark, sf)))


@query
def class_ratio(spark, sf):
    return metrics.class_ratio(metrics.confusion_stock(_predicted(spark, sf)))


@query
def roc_auc(spark, sf):
    return ranking.roc_auc(panel(spark, sf), N.TARGET_OOS, N.BINARY_PRED)


@query
def roc_auc_labels(spark, sf):
    """The same over the labelled documents: does their length tell their quality?"""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars")
    return ranking.roc_auc(labels.join(documents, "doc_id"), "quality", "n_chars")


@query
def regression_errors(spark, sf):
    return ranking.regression_errors(panel(spark, sf), N.TARGET_HS, N.HS_PRED)


@query
def score_distribution(spark, sf):
    row = ranking.score_distribution(panel(spark, sf), N.TARGET_HS, N.HS_PRED)
    return row.select(*[round_n(c, 6).alias(c) for c in row.columns])


@query
def understock_performance(spark, sf):
    return metrics.understock_performance(_predicted(spark, sf))


@query
def overstock_performance(spark, sf):
    return metrics.overstock_performance(_predicted(spark, sf))


@query
def book_vs_prediction(spark, sf):
    return metrics.book_vs_prediction(_predicted(spark, sf))


@query
def revenue_impact(spark, sf):
    return metrics.revenue_impact(_predicted(spark, sf))


@query
def overall_metrics(spark, sf):
    return metrics.overall_metrics(_predicted(spark, sf))


@query
def audit_metrics(spark, sf):
    return metrics.audit_metrics(_audited(spark, sf))


@query
def technical_metrics_binary(spark, sf):
    return ranking.technical_metrics_binary(panel(spark, sf), N.TARGET_OOS, N.BINARY_PRED, T1)


@query
def technical_metrics_regression(spark, sf):
    banded = cascade.independent_steps(panel(spark, sf))["step_3"]
    return ranking.technical_metrics_regression(banded, N.TARGET_LS, N.ORIG_PRED, scale_col=N.CURDAY_QTY)


@query
def technical_metrics_new(spark, sf):
    """All four new models, each on the rows the cascade routes to it."""
    frames = jobs.new_model_frames(spark, _steps(spark, sf), T1, T2, scratch_path(spark, "model-rows"))
    return jobs.technical_metrics(frames, T1, T2)


@query
def confidence_oos(spark, sf):
    return confidence.confidence_oos(_predicted(spark, sf), T1)


@query
def confidence_hl(spark, sf):
    return confidence.confidence_hl(_predicted(spark, sf), T1, T2)


@query
def confidence_lt(spark, sf):
    return confidence.confidence_lt(_predicted(spark, sf), T1, T2)


@query
def confidence_hs(spark, sf):
    return confidence.confidence_hs(_predicted(spark, sf), T1, T2)


@query
def tp_probability_bins(spark, sf):
    return confidence.tp_probability_bins(_predicted(spark, sf), T1, T2)


@query
def tn_probability_bins(spark, sf):
    return confidence.tn_probability_bins(_predicted(spark, sf), T1, T2)


@query
def probability_bins_irregular(spark, sf):
    """Bins of cut-offs off the 0.1 grid."""
    predicted = _predicted(spark, sf)
    sides = {"tp": confidence.tp_probability_bins, "tn": confidence.tn_probability_bins}
    return cascade.concat_branches(
        *[fn(predicted, 0.45, 0.35).withColumn("side", F.lit(side)) for side, fn in sides.items()]
    )


@query
def weighted_metric_score(spark, sf):
    counts = metrics.confusion_stock(_predicted(spark, sf))
    every = [{"metric_name": m, "metric_weight": (i + 1) / 8} for i, m in enumerate(N.WEIGHTED_METRICS)]
    return tuning.weighted_metric_score(counts, every).select(*metrics.CONFUSION, round_n("score", 6).alias("score"))


@query
def threshold_grid(spark, sf):
    """Every pair of cut-offs with the confusion counts it leads to."""
    return tuning.grid_counts(*_ordered_steps(spark, sf), OOS_GRID, HL_GRID)


@query
def threshold_scores(spark, sf):
    """Every pair of cut-offs with its weighted score."""
    scored = tuning.score_grid(*_ordered_steps(spark, sf), OOS_GRID, HL_GRID, WEIGHTS)
    return scored.select("pos", "oos_threshold", "hl_threshold", round_n("score", 6).alias("score"))


@query
def threshold_search(spark, sf):
    best = tuning.threshold_search(*_ordered_steps(spark, sf), OOS_GRID, HL_GRID, WEIGHTS)
    return best.withColumn("score", round_n("score", 6))


@query
def threshold_search_unique_keys(spark, sf):
    steps = _ordered_steps(spark, sf)
    best = tuning.threshold_search(*steps, OOS_GRID, HL_GRID, WEIGHTS, unique_keys=True)
    return best.withColumn("score", round_n("score", 6))


@query
def champion_challenger(spark, sf):
    decision = selection.champion_challenger(_stored_scores(spark, sf))
    rounded = {c: round_n(c, 6) for c in ("champion_score", "challenger_score")}
    return decision.withColumns(rounded)


@query
def series_eligibility(spark, sf):
    return split.series_eligibility(panel(spark, sf), ELIGIBLE_START, series=[N.SKU])


# --- models and cascade -------------------------------------------------------------------------------------


@query
def time_split(spark, sf):
    rows = split.time_split(panel(spark, sf), series=[N.LOCATION], ties=[N.SKU], gather=True)
    return rows.select(*N.KEYS, N.DATA_SPLIT)


@query
def time_split_by_sku(spark, sf):
    """Short series: the minimum of an incremental run, short series kept as training rows."""
    rows = split.time_split(
        panel(spark, sf), series=[N.SKU], ties=[N.LOCATION], min_rows=split.MIN_ROWS_INCREMENTAL, short="train",
        gather=True,
    )
    return rows.select(*N.KEYS, N.DATA_SPLIT)


@query
def time_split_two_ties(spark, sf):
    """Series of whole location groups; every seventh location is unknown and comes first."""
    rows = panel(spark, sf).withColumn("place", F.when(F.col("dn") % 7 > 0, F.col(N.LOCATION)))
    labelled = split.time_split(rows, series=[N.LOCATION_GROUP], ties=["place", N.SKU])
    return labelled.select(*N.KEYS, "place", N.DATA_SPLIT)


def tree_model() -> scorers.TreeTableScorer:
    """Three small trees over the stock quantities."""
    split_at = dict(leaf=None)
    rows = [
        dict(tree=0, node=0, feature=N.CURDAY_QTY, threshold=20.0, left=1, right=2, default_left=True, **split_at),
        dict(tree=0, node=1, feature=N.IP_QTY, threshold=5.0, left=3, right=4, default_left=True, **split_at),
        dict(tree=0, node=2, leaf=-0.5),
        dict(tree=0, node=3, leaf=0.75),
        dict(tree=0, node=4, leaf=0.125),
        dict(tree=1, node=0, feature=N.TOTAL_RETAIL, threshold=25.0, left=1, right=2, default_left=False, **split_at),
        dict(tree=1, node=1, leaf=0.25),
        dict(tree=1, node=2, leaf=-0.25),
        dict(tree=2, node=0, leaf=0.0625),
    ]
    columns = ["tree", "node", "feature", "threshold", "left", "right", "leaf", "default_left"]
    return scorers.TreeTableScorer(pd.DataFrame(rows).reindex(columns=columns), base=0.5)


@query
def score_model(spark, sf):
    return scorers.score_model(panel(spark, sf), tree_model(), "score").select(*N.KEYS, "score")


LINEAR = {
    "step_1": scorers.LinearScorer({N.CURDAY_QTY: -0.125, N.IP_QTY: -0.0625}, 1.0, sigmoid=True),
    "step_2": scorers.LinearScorer({N.CURDAY_QTY: 0.0625, N.TOTAL_RETAIL: -0.03125}, 0.0, sigmoid=True),
    "step_3": scorers.LinearScorer({N.IP_QTY: 0.03125}, 0.5),
    "step_4": scorers.LinearScorer({N.CURDAY_QTY: 1.25, N.IP_QTY: 0.25}, 2.0),
}


@query
def score_model_independent(spark, sf):
    rows = scorers.score_independent(panel(spark, sf), LINEAR)
    scores = (N.BINARY_PRED, N.HL_ORIG_PRED, N.LS_RATIO, N.HS_PRED)
    return rows.select(*N.KEYS, *[round_n(c, 6).alias(c) for c in scores])


@query
def score_cascade(spark, sf):
    """Linear models, each evaluated on the rows routed to it, through to the final prediction."""
    rows = cascade.cascade_predict(scorers.score_cascade(panel(spark, sf), LINEAR, T1, T2), T1, T2)
    return rows.select(*N.KEYS, N.BRANCH, N.ORIG_PRED, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH, N.OOS)


def _counted(p: DataFrame) -> DataFrame:
    """The panel with a quantity that is unknown on every fifth day."""
    return p.withColumn("shelf_count", F.when(F.col("dn") % 5 > 0, F.col(N.TOTAL_RETAIL)))


@query
def score_cascade_trees(spark, sf):
    """Four tree ensembles out of stored node tables, each evaluated on the rows routed to it."""
    fitted = {}
    for step, (base, _, sigmoid) in models.SHAPES.items():
        path = scratch_path(spark, f"trees-{step}")
        spark.createDataFrame(list(models.tree_nodes(step)), readers.schemas.NODES).write.parquet(path)
        fitted[step] = scorers.TreeTableScorer.from_table(spark.read.parquet(path), base, sigmoid)
    rows = cascade.cascade_predict(scorers.score_cascade(_counted(panel(spark, sf)), fitted, T1, T2), T1, T2)
    return rows.select(
        *N.KEYS, N.BRANCH, round_n(N.BINARY_PRED, 6).alias(N.BINARY_PRED), round_n(N.HL_ORIG_PRED, 6).alias(N.HL_ORIG_PRED),
        N.ORIG_PRED, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH, N.OOS,
    )


ML_FEATURES = [N.CURDAY_QTY, N.IP_QTY]


@query
def score_ml_model(spark, sf):
    """A logistic model fitted on the train split, stored, and loaded again to score all rows."""
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel

    path, once = scratch_path(spark, "ml-model"), scratch_path(spark, "ml-rows")
    # The split reads its rows twice, and all of them are scored
    panel(spark, sf).select(*N.KEYS, N.TARGET_HL, *ML_FEATURES).write.parquet(once)
    rows = spark.read.parquet(once)
    train = split.filter_train_rows(split.time_split(rows, series=[N.LOCATION], ties=[N.SKU], gather=True))
    fit = LogisticRegression(labelCol=N.TARGET_HL, maxIter=200, tol=1e-14, standardization=False, weightCol="alike")
    scorers.fit_ml_model(train, fit, ML_FEATURES, weight="alike").write().overwrite().save(path)
    scored = scorers.score_ml_model(rows, LogisticRegressionModel.load(path), ML_FEATURES, "score")
    return scored.select(*N.KEYS, round_n("score", 3).alias("score"))


@query
def cascade_predict(spark, sf):
    return _predicted(spark, sf).select(
        *N.KEYS, N.BRANCH, N.BINARY_PRED, N.HL_ORIG_PRED, N.ORIG_PRED, N.ORIG_PRED_TEMP, N.ORIG_PRED_LOW,
        N.ORIG_PRED_HIGH, N.OOS,
    )


@query
def cascade_from_predictions(spark, sf):
    return cascade.cascade_from_predictions(*_ordered_steps(spark, sf), T1, T2).select(*N.BEST_COLUMNS)


@query
def confidence_level(spark, sf):
    return _confident(spark, sf).select(*N.DAILY_COLUMNS)


# --- joins and set operations -------------------------------------------------------------------------------


@query
def join_target_feature(spark, sf):
    p = panel(spark, sf)
    target = split.filter_train_start(split.drop_partition_columns(target_store(p), split.TARGET_BOOKKEEPING), TRAIN_START)
    feature = split.drop_partition_columns(feature_store(p))
    return split.join_target_feature(target, feature)


@query
def join_step1_step2(spark, sf):
    s = _steps(spark, sf)
    return cascade.join_step1_step2(s["step_1"], s["step_2"], T1)


@query
def join_lower_stock(spark, sf):
    s = _steps(spark, sf)
    return cascade.join_lower_stock(cascade.join_step1_step2(s["step_1"], s["step_2"], T1), s["step_3"], T2)


@query
def join_higher_stock(spark, sf):
    s = _steps(spark, sf)
    return cascade.join_higher_stock(cascade.join_step1_step2(s["step_1"], s["step_2"], T1), s["step_4"], T2)


@query
def join_audit_prediction(spark, sf):
    return _audited(spark, sf)


@query
def join_eligible_series(spark, sf):
    p = panel(spark, sf)
    eligible = split.series_eligibility(p, ELIGIBLE_START, series=[N.SKU])
    return split.join_eligible_series(p, eligible, [N.SKU]).select(*N.KEYS, N.TOTAL_RETAIL)


@query
def concat_branches(spark, sf):
    """The three branches cut apart and stacked again; columns a branch lacks become NULL."""
    rows = _predicted(spark, sf)
    branch = F.col(N.BRANCH)
    out = rows.where(branch == "oos").select(*N.KEYS, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH)
    stocked = [
        rows.where(branch == b).select(*N.KEYS, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH, N.HL_ORIG_PRED, N.ORIG_PRED_TEMP)
        for b in ("ls", "hs")
    ]
    return cascade.concat_branches(out, *stocked)


@query
def concat_location_groups(spark, sf):
    base = scratch_path(spark, "groups")
    writers.write_step_csv(panel(spark, sf), base, "step_2", N.STEP_COLUMNS["step_2"])
    return readers.scan_step_predictions(spark, base, "step_2")


# --- whole jobs ---------------------------------------------------------------------------------------------


@drops_shuffles
def _daily_run(spark: SparkSession, sf: str) -> str:
    """Stored features and confidence document in, the folder of all daily outputs out."""
    features, out, doc = _stored_day(spark, sf), scratch_path(spark, "inference"), scratch_path(spark, "document")
    rows = readers.scan_inference_features(spark, features, DAY)
    predicted = cascade.cascade_predict(scorers.score_cascade(rows, LINEAR, T1, T2), T1, T2)
    row = confidence.confidence_metrics(predicted.withColumn(N.TARGET_OOS, oos_nonpositive(N.REV_QTY)), T1, T2)
    writers.write_metric_json(confidence.confidence_document(row), doc)
    jobs.infer_job(spark, features, out, DAY, LINEAR, doc, T1, T2, GROUPS)
    return out


@query
def daily_inference(spark, sf):
    """Daily inference end to end: the published predictions."""
    out = _daily_run(spark, sf)
    return readers.read_csv(spark, f"{out}/prediction", readers.schemas.DAILY, f"{out}/prediction")


def _rounded(df: DataFrame) -> DataFrame:
    """Scores that went through an exponential, to six places."""
    return df.withColumns({c: round_n(c, 6) for c in (N.BINARY_PRED, N.HL_ORIG_PRED) if c in df.columns})


@query
def daily_inference_outputs(spark, sf):
    """The other outputs of the daily job, stacked: full rows and steps."""
    out = _daily_run(spark, sf)
    named = {"concatenated": N.CONCATENATED_COLUMNS, **N.DAILY_STEP_COLUMNS}
    frames = [
        readers.scan_step_predictions(spark, f"{out}/temp", name, schema=readers.schemas.table(columns)).withColumn(
            "output", F.lit(name)
        )
        for name, columns in named.items()
    ]
    return _whole_as_double(_rounded(cascade.concat_branches(*frames)))


@query
def split_run(spark, sf):
    """Split job end to end: stored features and targets in, the published split out."""
    targets, out = scratch_path(spark, "targets"), scratch_path(spark, "split-out")
    writers.balanced(target_store(panel(spark, sf)), [N.LOCATION_GROUP]).write.partitionBy(N.LOCATION_GROUP).parquet(targets)
    jobs.split_job(
        spark, _stored_features(spark, sf), targets, out, GROUPS, DAY, TRAIN_START, series=[N.LOCATION], ties=[N.SKU],
        incremental=False,
    )
    return readers.read_parquet(spark, out).select(
        *N.KEYS, *FEATURES, N.TARGET_OOS, N.LOCATION_GROUP, N.LOAD_DATE, N.DATA_SPLIT
    )


def _stored_split(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "split-in")
    scores = (N.BINARY_PRED, N.HL_ORIG_PRED, N.LS_RATIO, N.HS_PRED)
    writers.write_split_parquet(_labelled(spark, sf).drop(*scores), path)
    return path


@query
def evaluate_new_run(spark, sf):
    """Evaluation of new models end to end: stored test rows in, four published steps out."""
    out = scratch_path(spark, "new-models")
    jobs.evaluate_new_job(spark, _stored_split(spark, sf), out, LINEAR, GROUPS)
    frames = [readers.scan_step_predictions(spark, out, s).withColumn("step", F.lit(s)) for s in N.STEPS]
    return _whole_as_double(_rounded(cascade.concat_branches(*frames)))


def _production_run(spark: SparkSession, sf: str) -> str:
    out = scratch_path(spark, "production-models")
    jobs.evaluate_production_job(spark, _stored_split(spark, sf), out, LINEAR, T1, T2, GROUPS)
    return out


@query
def evaluate_production_run(spark, sf):
    """Evaluation of production models end to end: stored test rows in, the published final prediction out."""
    return _rounded(readers.scan_final_prediction_csv(spark, _production_run(spark, sf)))


def _document(spark: SparkSession, path: str, names: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    back = spark.read.schema(", ".join(f"`{k}` {kinds[c]}" for k, c in names.items())).json(path)
    return back.select(*[F.col(f"`{k}`").alias(c) for k, c in names.items()])


@query
def score_production_run(spark, sf):
    """Scoring job on production models: published steps and final prediction in, the overall document out."""
    base, out = _production_run(spark, sf), scratch_path(spark, "production-scores")
    jobs.score_job(spark, base, out, T1, T2, new_models=False)
    kinds = dict(metrics.overall_metrics(_predicted(spark, sf)).dtypes)
    return _document(spark, f"{out}/overall_metrics_prod", N.OVERALL_DOCUMENT, kinds)


@query
def score_new_run(spark, sf):
    """Tuning and scoring of new models: published steps in, the overall document of the winning rows out."""
    base, out = _stored_steps(spark, sf), scratch_path(spark, "new-scores")
    jobs.tune_job(spark, base, scratch_path(spark, "tuned"), OOS_GRID, HL_GRID, _stored_weights(spark))
    jobs.score_job(spark, base, out, T1, T2, new_models=True)
    kinds = dict(metrics.overall_metrics(_predicted(spark, sf)).dtypes)
    return _document(spark, f"{out}/overall_metrics_new", N.OVERALL_DOCUMENT, kinds)


def _audit_predictions(spark: SparkSession, sf: str) -> str:
    features, out = scratch_path(spark, "audit-rows"), scratch_path(spark, "audit-predictions")
    scores = (N.BINARY_PRED, N.HL_ORIG_PRED, N.LS_RATIO, N.HS_PRED)
    rows = panel(spark, sf).drop(*scores).withColumn(N.LOAD_DATE, F.lit(DAY))
    rows.write.partitionBy(N.LOAD_DATE).parquet(features)
    jobs.predict_audit_job(spark, features, out, DAY, LINEAR, T1, T2)
    return out


@query
def predict_audit_run(spark, sf):
    """Prediction of one audit day end to end."""
    return _rounded(readers.scan_final_prediction_parquet(spark, _audit_predictions(spark, sf), DAY))


@query
def confidence_run(spark, sf):
    """Confidence job end to end: stored predictions of a day in, the document out."""
    out = scratch_path(spark, "confidence-out")
    jobs.confidence_job(spark, _audit_predictions(spark, sf), out, DAY, T1, T2)
    return _confidence_long(readers.scan_confidence_document(spark, f"{out}/LOAD_DATE={DAY}"))


@query
def switch_run(spark, sf):
    """Switch job end to end: score files of several parts and rows in, the decision out. The first row counts."""
    paths = {}
    for role, row in _run_scores(spark, sf).items():
        paths[role] = scratch_path(spark, f"scores-{role}")
        later = row.withColumn("overall_score", F.col("overall_score") + 100)
        # Part files are named in the order of partitions: the first row of the first part is the run's own
        rows = row.coalesce(1).unionByName(later.coalesce(1)).unionByName(later.coalesce(1))
        rows.write.option("header", True).csv(paths[role])
    decision = jobs.switch_job(spark, paths, {role: f"run-{role}" for role in paths})
    return decision.withColumns({c: round_n(c, 6) for c in ("champion_score", "challenger_score")})


def _stored_day(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "day")
    quantities = (N.IP_QTY, N.CURDAY_QTY, N.REV_QTY, N.TOTAL_RETAIL)
    rows = panel(spark, sf).select(*N.KEYS, *quantities, N.LOCATION_GROUP, F.lit(DAY).alias(N.LOAD_DATE))
    with writers.open_files(spark):
        rows.write.partitionBy(N.LOCATION_GROUP, N.LOAD_DATE).parquet(path)
    return path


@query
def audit_report(spark, sf):
    """Audit job end to end: stored audits and predictions in, the published document out."""
    base, out = _stored_concatenated(spark, sf), scratch_path(spark, "audit-out")
    jobs.audit_job(spark, _stored_audit(spark, sf), base, out)
    fields = ", ".join(
        f"`{k}` {'double' if '%' in k or k == 'F1 Score' else 'bigint'}" for k in N.AUDIT_DOCUMENT
    )
    back = spark.read.schema(fields).json(f"{out}/output_metrics")
    return back.select(*[F.col(f"`{k}`").alias(c) for k, c in N.AUDIT_DOCUMENT.items()])


@query
def tuning_run(spark, sf):
    """Tuning job end to end: stored step predictions and weights in, winning pair out."""
    best = jobs.tune_job(
        spark, _stored_steps(spark, sf), scratch_path(spark, "tuned"), OOS_GRID, HL_GRID, _stored_weights(spark)
    )
    return best.withColumn("score", round_n("score", 6))


# --- documents from stored counts -----------------------------------------------------------------------------


def _stored_counts(spark: SparkSession, counts: DataFrame, name: str) -> str:
    """Counts of the earlier and of the later load dates, each by a run of its own, the later one twice. They are taken
    once: the list of dates and the runs read the stored table."""
    base, once = scratch_path(spark, name), scratch_path(spark, f"{name}-once")
    counts.write.parquet(once)
    counts = spark.read.parquet(once)
    days = sorted(r[0] for r in counts.select(N.LOAD_DATE).distinct().collect())  # one for each load
    early, late = [d for d in days if d < COUNTS_FROM], [d for d in days if d >= COUNTS_FROM]
    for run in (early, late, late):
        if run:
            writers.write_counts(counts.where(F.col(N.LOAD_DATE).between(run[0], run[-1])), base, run)
    return base


@query
def overall_metrics_loads(spark, sf):
    """The document of all load dates from stored counts."""
    counts = metrics.overall_counts(_predicted(spark, sf), (N.LOAD_DATE, N.LOCATION_GROUP))
    return metrics.overall_metrics_of(readers.scan_counts(spark, _stored_counts(spark, counts, "overall-counts")))


@query
def overall_metrics_recent(spark, sf):
    """The same from one load date on: earlier counts are not read."""
    counts = metrics.overall_counts(_predicted(spark, sf), (N.LOAD_DATE, N.LOCATION_GROUP))
    base = _stored_counts(spark, counts, "recent-counts")
    return metrics.overall_metrics_of(readers.scan_counts(spark, base, first=COUNTS_FROM))


@query
def audit_metrics_loads(spark, sf):
    rows = _audited(spark, sf).withColumn(N.LOAD_DATE, F.date_format(F.trunc(N.DATE, "month"), "yyyy-MM-dd"))
    base = _stored_counts(spark, metrics.audit_counts(rows), "audit-counts")
    return metrics.audit_metrics_of(readers.scan_counts(spark, base))


@query
def confidence_metrics_recent(spark, sf):
    counts = confidence.confidence_counts(_predicted(spark, sf), (N.LOAD_DATE, N.LOCATION_GROUP), T1, T2)
    base = _stored_counts(spark, counts, "confidence-counts")
    return _confidence_long(confidence.confidence_metrics_of(readers.scan_counts(spark, base, first=COUNTS_FROM), T1, T2))
