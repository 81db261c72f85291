"""Readers of the feature, target, prediction and metric stores.

One scan covers every location group; a group, load date or split is a partition predicate on it, so only
the matching directories are listed and read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions import parse_iso_date
from shelfspark.functions.scalar import without_nan
from shelfspark.names import DATA_SPLIT, LOAD_DATE, LOCATION_GROUP
from shelfspark.operators.confidence import document_schema, flatten_document
from shelfspark.operators.split import (
    FEATURE_BOOKKEEPING,
    TARGET_BOOKKEEPING,
    drop_partition_columns,
    filter_incremental_load,
)
from shelfspark.sources import schemas
from shelfspark.sources.publish import Files

_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


@contextmanager
def text_partitions(spark: SparkSession) -> Iterator[None]:
    """Partition values stay text while the relation is resolved: group ``01`` must not become 1."""
    before = spark.conf.get(_INFERENCE)
    spark.conf.set(_INFERENCE, "false")
    try:
        yield
    finally:
        spark.conf.set(_INFERENCE, before)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    with text_partitions(spark):
        return without_nan(spark.read.parquet(path))


def in_groups(df: DataFrame, groups: Sequence[str] | None) -> DataFrame:
    return df if groups is None else df.where(F.col(LOCATION_GROUP).isin(list(groups)))


def scan_by_control(store: DataFrame, control: DataFrame) -> DataFrame:
    """Rows of a store whose partition (location group and load date, as far as ``control`` names them) is listed in
    ``control``. A filtered control table prunes partitions at run time: only the listed directories are read, and the
    list never passes the driver's code."""
    by = [c for c in (LOCATION_GROUP, LOAD_DATE) if c in control.columns]
    if not by:
        raise ValueError(f"a control table needs {LOCATION_GROUP} or {LOAD_DATE}")
    return store.join(control.select(*by), by, "left_semi")


def scan_feature_store(spark: SparkSession, base: str, groups: Sequence[str] | None = None) -> DataFrame:
    return drop_partition_columns(in_groups(read_parquet(spark, base), groups), FEATURE_BOOKKEEPING)


def scan_target_store(
    spark: SparkSession, base: str, groups: Sequence[str] | None = None, last_train_date: str | None = None
) -> DataFrame:
    loads = filter_incremental_load(in_groups(read_parquet(spark, base), groups), last_train_date)
    return drop_partition_columns(loads, TARGET_BOOKKEEPING)


def scan_inference_features(
    spark: SparkSession, base: str, load_date: str, groups: Sequence[str] | None = None
) -> DataFrame:
    """Features of one day; keeps the group, by which the outputs are laid out."""
    return in_groups(read_parquet(spark, base), groups).where(F.col(LOAD_DATE) == load_date)


def scan_counts(spark: SparkSession, base: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored counts of the load dates from ``first`` to ``last``; rows of other dates are not read."""
    counts = read_parquet(spark, base)
    counts = counts if first is None else counts.where(F.col(LOAD_DATE) >= first)
    return counts if last is None else counts.where(F.col(LOAD_DATE) <= last)


def scan_test_split(spark: SparkSession, base: str, groups: Sequence[str] | None = None) -> DataFrame:
    """Held-out rows over all load dates."""
    return in_groups(read_parquet(spark, base), groups).where(F.col(DATA_SPLIT) == "test").drop(DATA_SPLIT)


def scan_audit_features(spark: SparkSession, base: str, load_date: str) -> DataFrame:
    return read_parquet(spark, base).where(F.col(LOAD_DATE) == load_date).drop(LOAD_DATE)


def _typed(name: str, kind: T.DataType) -> Column:
    """A CSV text column in its stored type. Whole numbers may have been written with a decimal point."""
    c = F.col(name)
    if isinstance(kind, T.LongType):
        return F.coalesce(c.try_cast("long"), c.cast("double").cast("long")).alias(name)
    if isinstance(kind, T.DateType):
        return parse_iso_date(F.substring(c, 1, 10)).alias(name)
    return c.cast(kind).alias(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, base: str | None = None) -> DataFrame:
    """CSV with a header, columns bound by name (extra columns are ignored and never parsed).

    All files must have the columns in one order: a file whose header differs is an error, never bound by position.
    With ``base`` the partition directories below it become columns. A path ``folder/*`` of an empty folder is a table
    without rows; where there is no such folder, it is an error.
    """
    if path.endswith("/*") and Files(spark, path).is_empty(path[:-2]):
        return spark.createDataFrame([], schema if not base else T.StructType([*schema.fields, T.StructField(LOCATION_GROUP, T.StringType())]))
    reader = spark.read.option("header", True).option("enforceSchema", False)
    with text_partitions(spark):
        raw = (reader.option("basePath", base) if base else reader).csv(path)
    group = [F.col(c) for c in raw.columns if c.lower() == LOCATION_GROUP] if base else []
    return without_nan(raw.select(*[_typed(f.name, f.dataType) for f in schema.fields], *group))


def _layout(base: str, name: str, by_group: bool) -> str:
    """``base/<name>/location_group=g`` as written here, or ``base/<any group>/<name>``."""
    return f"{base}/*/{name}" if by_group else f"{base}/{name}/*"


def scan_step_predictions(
    spark: SparkSession, base: str, step: str, by_group: bool = False, schema: T.StructType | None = None
) -> DataFrame:
    """Stored predictions of one model over all location groups."""
    return read_csv(spark, _layout(base, step, by_group), schema or schemas.STEPS[step], base)


def scan_final_prediction_csv(
    spark: SparkSession, base: str, layout: str = "step", best: bool = False
) -> DataFrame:
    """Final predictions: of the cascade, or with ``best=True`` those of the winning cut-offs.

    ``layout`` is ``step`` or ``group`` (which directory level comes first) or ``flat`` (no group level).
    """
    schema = schemas.BEST if best else schemas.FINAL
    if layout == "flat":
        return read_csv(spark, f"{base}/final_prediction", schema)
    return read_csv(spark, _layout(base, "final_prediction", layout == "group"), schema, base)


def scan_final_prediction_parquet(spark: SparkSession, base: str, load_date: str) -> DataFrame:
    return read_parquet(spark, f"{base}/LOAD_DATE={load_date}/final_prediction")


def scan_audit_actuals(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.AUDIT)


def scan_concatenated_predictions(spark: SparkSession, base: str, by_group: bool = False) -> DataFrame:
    """The day's full prediction rows over all location groups."""
    return read_csv(spark, _layout(f"{base}/temp", "concatenated", by_group), schemas.CONCATENATED).drop(LOCATION_GROUP)


def scan_confidence_document(spark: SparkSession, path: str) -> DataFrame:
    """The stored document as the flat confidence row; bin starts are text keys."""
    return flatten_document(spark.read.schema(document_schema()).json(path, multiLine=True))


def scan_metric_weights(spark: SparkSession, path: str) -> DataFrame:
    """One ``(metric_name, metric_weight)`` row per configured metric, in the order of the file."""
    raw = spark.read.schema(schemas.WEIGHTS).json(path, multiLine=True)
    return raw.select(F.posexplode("metrics_list").alias("pos", "m")).select("pos", "m.metric_name", "m.metric_weight")


def scan_model_scores(spark: SparkSession, paths: dict[str, str], runs: dict[str, str]) -> DataFrame:
    """The first ``overall_score`` of each role's score file, as ``(role, run_id, overall_score)``.

    First is the first row of the first file by name that has rows: by the place of a row in its file, whatever the
    number of files and tasks. One aggregation finds it, with a row for each task.
    """
    score = T.StructType([T.StructField("overall_score", T.DoubleType())])
    reader = spark.read.option("header", True).option("enforceSchema", False)
    frames = []
    for role, path in paths.items():
        raw = reader.csv(path).select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
        typed = raw.select(*[_typed(f.name, f.dataType) for f in score.fields], "_file", "_block", "_row")
        # Within a block of a file the numbers of rows rise
        first = F.min_by("overall_score", F.struct("_file", "_block", "_row"))
        some = without_nan(typed).agg(first.alias("overall_score"), F.count("*").alias("rows")).where("rows > 0")
        frames.append(some.select(F.lit(role).alias("role"), F.lit(runs[role]).alias("run_id"), "overall_score"))
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first
