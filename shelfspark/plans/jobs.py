"""The user-level jobs: read stores, run one component over all location groups, write its outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark import names as N
from shelfspark.operators import cascade, confidence, metrics, ranking, selection, split, tuning
from shelfspark.operators.scorers import Scorer, score_cascade, score_independent
from shelfspark.sources import readers, writers
from shelfspark.sources.publish import Publication
from shelfspark.sources.scratch import delete_path, drops_shuffles, scratch_path


def split_job(
    spark: SparkSession,
    features: str,
    targets: str,
    out: str,
    groups: Sequence[str] | None = None,
    current_date: str | None = None,
    train_start: str | None = None,
    last_train_date: str | None = None,
    series: Sequence[str] = N.SERIES,
    ties: Sequence[str] = (),
    target_columns: Sequence[str] = (),
    incremental: bool = True,
    eligible_flags: Sequence[str] | None = None,
) -> None:
    """Join features with targets, label every series in time order, write by group, load date and split."""
    with_group = readers.in_groups(readers.read_parquet(spark, features), groups)
    feature = split.filter_train_start(split.drop_partition_columns(with_group, [N.LOAD_DATE]), train_start)
    if eligible_flags and train_start:
        feature = split.join_eligible_series(
            feature, split.series_eligibility(feature, train_start, eligible_flags)
        )
    target = split.filter_train_start(readers.scan_target_store(spark, targets, groups, last_train_date), train_start)
    # The split reads its rows several times: for the dates of a series, for the ties on a cut, and for the labels.
    scratch = scratch_path(spark, "joined")
    split.join_target_feature(target, feature).write.parquet(scratch)
    labelled = split.time_split(
        spark.read.parquet(scratch),
        series=series,
        ties=ties,
        targets=target_columns,
        min_rows=split.MIN_ROWS_INCREMENTAL if incremental else split.MIN_ROWS_HISTORICAL,
    )
    writers.write_split_parquet(split.filter_as_of_date(labelled, current_date), out, current_date, groups)
    delete_path(spark, scratch)


def evaluate_new_job(
    spark: SparkSession, test_base: str, out: str, models: Mapping[str, Scorer], groups: Sequence[str] | None = None
) -> None:
    """Every model on every held-out row; one CSV set per step, published together, packed for the jobs that read them."""
    rows = readers.scan_test_split(spark, test_base, groups)
    with Publication(spark, out, groups) as run:
        for step, frame in cascade.independent_steps(score_independent(rows, models)).items():
            writers.stage_step_csv(run, frame, step, N.STEP_COLUMNS[step], packed=True)


def evaluate_production_job(
    spark: SparkSession,
    test_base: str,
    out: str,
    models: Mapping[str, Scorer],
    t1: float,
    t2: float,
    groups: Sequence[str] | None = None,
) -> None:
    """The cascade on held-out rows; the four step outputs and the final prediction as CSV.

    The rows are scored once, into one table the five outputs are cut from.
    """
    rows = readers.scan_test_split(spark, test_base, groups)
    predicted = cascade.cascade_predict(score_cascade(rows, models, t1, t2), t1, t2)
    stored = list(dict.fromkeys(c for cols in (N.FINAL_COLUMNS, *N.STEP_COLUMNS.values()) for c in cols))
    predicted, path = _scored_table(spark, predicted, stored)
    with Publication(spark, out, groups) as run:
        for step, frame in cascade.step_frames(predicted).items():
            writers.stage_step_csv(run, frame, step, N.STEP_COLUMNS[step])
        writers.stage_step_csv(run, predicted, "final_prediction", N.FINAL_COLUMNS)
    delete_path(spark, path)


def predict_audit_job(
    spark: SparkSession, audit_base: str, out: str, load_date: str, models: Mapping[str, Scorer], t1: float, t2: float
) -> None:
    """The cascade on one day's audit features, as parquet."""
    rows = readers.scan_audit_features(spark, audit_base, load_date)
    predicted = cascade.cascade_predict(score_cascade(rows, models, t1, t2), t1, t2)
    writers.write_final_parquet(predicted, out, load_date, N.FINAL_COLUMNS)


@drops_shuffles
def tune_job(
    spark: SparkSession, predictions: str, out: str, oos: str, hl: str, weights_path: str, by_group: bool = False
) -> DataFrame:
    """Search the cut-offs over stored step predictions; write the winning rows and the winning pair."""
    scratch = scratch_path(spark, "steps")
    steps = list(_parsed_steps(spark, predictions, by_group, scratch, TUNED).values())
    best = tuning.threshold_search(*steps, oos, hl, load_weights(spark, weights_path))
    # The pair is read once; everything after it works with the two numbers.
    best = spark.createDataFrame([best.first()], best.schema)
    writers.write_best_prediction(tuning.best_prediction(*steps, best), predictions)
    writers.write_metric_json(best.select("oos_threshold", "hl_threshold"), f"{out}/best_thresholds")
    delete_path(spark, scratch)
    return best


#: What the search and the winning rows take from each step: the quantities of a row come from the first.
TUNED = {
    "step_1": [c for c in N.STEP_COLUMNS["step_1"] if c in (*N.BEST_COLUMNS, N.BINARY_PRED)],
    "step_2": [*N.KEYS, N.HL_ORIG_PRED],
    "step_3": [*N.KEYS, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH],
    "step_4": [*N.KEYS, N.ORIG_PRED_LOW, N.ORIG_PRED_HIGH],
}
#: What a model's technical metrics compare.
RATED = {
    "step_1": [N.BINARY_PRED, N.TARGET_OOS],
    "step_2": [N.HL_ORIG_PRED, N.TARGET_HL],
    "step_3": [N.ORIG_PRED, N.TARGET_LS],
    "step_4": [N.ORIG_PRED, N.TARGET_HS],
}


def _parsed_steps(
    spark: SparkSession,
    predictions: str,
    by_group: bool,
    scratch: str,
    columns: Mapping[str, Sequence[str]],
    several: Sequence[str] = tuple(N.STEPS),
) -> dict[str, DataFrame]:
    """Columns of the stored step predictions in their types. Those in ``several``, which more than one pass reads, are
    parsed once and stored; the others are read where they are used."""
    steps = {}
    for s in N.STEPS:
        schema = readers.schemas.table(list(columns[s]))
        read = readers.scan_step_predictions(spark, predictions, s, by_group, schema).drop(N.LOCATION_GROUP)
        if s in several:
            read.write.options(**writers.SCRATCH).parquet(f"{scratch}/{s}")
            read = spark.read.parquet(f"{scratch}/{s}")
        steps[s] = read
    return steps


def load_weights(spark: SparkSession, path: str) -> list[dict]:
    """The weight of each configured metric. The score is linear, so weights of one metric are added; names outside
    the closed set of metrics are an error, which leaves at most one row for each of them."""
    weights = readers.scan_metric_weights(spark, path)
    unknown = weights.where(~F.col("metric_name").isin(list(N.WEIGHTED_METRICS)) | F.col("metric_name").isNull())
    if (bad := unknown.first()) is not None:
        raise ValueError(f"unknown metric name: {bad['metric_name']}")
    rows = (
        weights.groupBy("metric_name")
        .agg(F.sum("metric_weight").alias("metric_weight"), F.min("pos").alias("pos"))
        .orderBy("pos")
        .collect()
    )
    return [{"metric_name": r["metric_name"], "metric_weight": r["metric_weight"]} for r in rows]


def technical_metrics(frames: Mapping[str, DataFrame], t1: float, t2: float) -> DataFrame:
    """Technical metrics of the four models as one row, keys prefixed by step."""
    rows = [
        ranking.technical_metrics_binary(frames["step_1"], N.TARGET_OOS, N.BINARY_PRED, t1, "step_1"),
        ranking.technical_metrics_binary(frames["step_2"], N.TARGET_HL, N.HL_ORIG_PRED, t2, "step_2"),
        ranking.technical_metrics_regression(frames["step_3"], N.TARGET_LS, N.ORIG_PRED, "step_3"),
        ranking.technical_metrics_regression(frames["step_4"], N.TARGET_HS, N.ORIG_PRED, "step_4"),
    ]
    columns = [c for r in rows for c in r.columns]
    stacked = cascade.concat_branches(*rows)
    return stacked.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in columns])


def new_model_frames(
    spark: SparkSession, steps: Mapping[str, DataFrame], t1: float, t2: float, scratch: str
) -> dict[str, DataFrame]:
    """What each new model is scored on: the rows the cascade would have routed to it.

    Several passes run over each of these joins, so their target and prediction columns are stored first.
    """
    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").options(**writers.SCRATCH).parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    narrow = steps["step_1"].select(*N.KEYS, N.BINARY_PRED)
    rest = stored("step_2", cascade.join_step1_step2(narrow, steps["step_2"], t1).drop(N.BINARY_PRED))
    lower = cascade.join_lower_stock(rest, steps["step_3"].select(*N.KEYS, N.ORIG_PRED, N.TARGET_LS), t2)
    higher = cascade.join_higher_stock(rest, steps["step_4"].select(*N.KEYS, N.ORIG_PRED, N.TARGET_HS), t2)
    return {
        "step_1": steps["step_1"].where(cascade.is_oos(t1)),
        "step_2": rest,
        "step_3": stored("step_3", lower.select(N.ORIG_PRED, N.TARGET_LS)),
        "step_4": stored("step_4", higher.select(N.ORIG_PRED, N.TARGET_HS)),
    }


@drops_shuffles
def score_job(
    spark: SparkSession,
    predictions: str,
    out: str,
    t1: float,
    t2: float,
    new_models: bool,
    by_group: bool = False,
) -> None:
    """Technical metrics per model and overall business metrics, for new or production models."""
    scratch = scratch_path(spark, "model-rows")
    # Only the rows of new models are routed here, by joins on the key
    columns = {s: [*N.KEYS, *cols] for s, cols in RATED.items()} if new_models else RATED
    # and each of the later steps by a single join, whose rows are stored.
    several = N.STEPS[:1] if new_models else N.STEPS
    steps = _parsed_steps(spark, predictions, by_group, f"{scratch}/parsed", columns, several)
    if new_models:
        steps = new_model_frames(spark, steps, t1, t2, scratch)
        final = readers.scan_final_prediction_csv(spark, predictions, "flat", best=True)
    else:
        final = readers.scan_final_prediction_csv(spark, predictions, "group" if by_group else "step")
    tag = "new" if new_models else "prod"
    writers.write_metric_json(technical_metrics(steps, t1, t2), f"{out}/individual_tech_metrics_{tag}")
    overall = metrics.to_document(metrics.overall_metrics(final), N.OVERALL_DOCUMENT)
    writers.write_metric_json(overall, f"{out}/overall_metrics_{tag}")
    delete_path(spark, scratch)


def confidence_job(spark: SparkSession, predictions: str, out: str, load_date: str, t1: float, t2: float) -> None:
    """Confidence document of one load date."""
    rows = readers.scan_final_prediction_parquet(spark, predictions, load_date)
    document = confidence.confidence_document(confidence.confidence_metrics(rows, t1, t2))
    writers.write_metric_json(document, f"{out}/LOAD_DATE={load_date}")


@drops_shuffles
def infer_job(
    spark: SparkSession,
    features: str,
    out: str,
    load_date: str,
    models: Mapping[str, Scorer],
    confidence_path: str,
    t1: float,
    t2: float,
    groups: Sequence[str] | None = None,
) -> None:
    """Daily inference of all location groups: predictions, full rows and step outputs as CSV. The sets below ``temp``, which
    other jobs read, are packed; the predictions are plain text."""
    rows = readers.scan_inference_features(spark, features, load_date, groups)
    stats = readers.scan_confidence_document(spark, confidence_path)
    predicted = cascade.cascade_predict(score_cascade(rows, models, t1, t2), t1, t2)
    table, path = _scored_table(spark, confidence.with_confidence(predicted, stats, t1, t2), N.CONCATENATED_COLUMNS)
    frames = cascade.step_frames(table)
    with Publication(spark, out, groups) as run:
        writers.stage_step_csv(run, table, "temp/OOS", N.DAILY_COLUMNS, packed=True)
        writers.stage_step_csv(run, table, "temp/concatenated", N.CONCATENATED_COLUMNS, packed=True)
        for step, columns in N.DAILY_STEP_COLUMNS.items():
            writers.stage_step_csv(run, frames[step], f"temp/{step}", columns, packed=True)
        writers.stage_step_csv(run, table, "prediction", N.DAILY_COLUMNS, balance=True)
    delete_path(spark, path)


def _scored_table(spark: SparkSession, predicted: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, str]:
    """Store scored rows in the scratch folder and read them back: several sinks then share one scoring run.

    Only the columns some output needs are kept. A stored table also survives lost executors, which a cache
    would not. Every task writes its own file for each group and branch: the table is read a few times and dropped, so
    moving all its rows for fewer files would cost more than it saves.
    """
    path = scratch_path(spark, "scored")
    by = [N.LOCATION_GROUP, N.BRANCH]
    with writers.open_files(spark):
        predicted.select(*columns, *by).write.partitionBy(*by).parquet(path)
    return readers.read_parquet(spark, path), path


def audit_job(
    spark: SparkSession,
    actuals: str,
    inference_out: str,
    out: str,
    single_prediction_out: str | None = None,
    by_group: bool = False,
) -> None:
    """Audit metrics and performance report; on request also all predictions in one place."""
    predictions = readers.scan_concatenated_predictions(spark, inference_out, by_group)
    scratch = scratch_path(spark, "audited")
    metrics.join_audit_prediction(readers.scan_audit_actuals(spark, actuals), predictions).write.parquet(scratch)
    joined = spark.read.parquet(scratch)
    document = metrics.to_document(metrics.audit_metrics(joined), N.AUDIT_DOCUMENT)
    writers.write_metric_json(document, f"{out}/output_metrics")
    writers.write_performance_report(joined, f"{out}/model-performance-report")
    if single_prediction_out:
        writers.write_all_predictions(predictions, single_prediction_out)
    delete_path(spark, scratch)


def switch_job(
    spark: SparkSession, score_paths: dict[str, str], runs: dict[str, str], compare: bool = True
) -> DataFrame:
    """Which run should be in production."""
    return selection.champion_challenger(readers.scan_model_scores(spark, score_paths, runs), compare)
