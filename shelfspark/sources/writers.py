"""Sinks. Location groups are written together by one job, as partition directories.

Before a partitioned write the rows are rebalanced on the partition columns: a small partition ends up in
one file, a partition that outgrows the advisory size is split over several tasks and files.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.names import DATA_SPLIT, LOAD_DATE, LOCATION_GROUP
from shelfspark.sources.publish import Publication

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: CSV files a task keeps open; rows of further partitions are sorted.
OPEN_FILES = 32
#: Tables of a job's own, read a few times and dropped: a tenth to a quarter smaller than with Spark's default.
SCRATCH = {"compression": "zstd"}
#: CSV sets that later jobs read back: ``part-*.csv.gz``, less than half the bytes. Least effort takes up to a
#: third more time than plain text; gzip's default nearly twice as long, for a fifth less.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in by]) if by else df.hint("rebalance")


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """A task keeps the files of several partitions open instead of sorting all its rows by partition first."""
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def _csv(df: DataFrame, path: str, by: Sequence[str], balance: bool, packed: bool = False) -> None:
    writer = (balanced(df, by) if balance else df).write.mode("overwrite").option("header", True)
    writer = writer.options(**PACKED) if packed else writer
    with open_files(df.sparkSession):
        (writer.partitionBy(*by) if by else writer).csv(path)


def write_split_parquet(
    df: DataFrame, base: str, load_date: str | None = None, groups: Sequence[str] | None = None, balance: bool = True
) -> None:
    """Split rows as gzip parquet by group, load date and split. The run replaces the whole load date (or, without one,
    everything) of its groups: a split, or a group, that has no rows any more is gone afterwards. Rows that already lie
    together by group and split (a table stored that way) need no ``balance``."""
    out = df if load_date is None else df.withColumn(LOAD_DATE, F.lit(load_date))
    by = [c for c in (LOCATION_GROUP, LOAD_DATE, DATA_SPLIT) if c in out.columns]
    inner = "" if load_date is None else f"{LOAD_DATE}={load_date}"
    with Publication(df.sparkSession, base, groups) as run:
        rows = (balanced(out, by) if balance else out).write.option("compression", "gzip").partitionBy(*by)
        rows.parquet(run.output("", LOCATION_GROUP, inner))


def stage_step_csv(
    run: Publication, df: DataFrame, step: str, columns: Sequence[str], balance: bool = False, packed: bool = False
) -> None:
    """Chosen columns of one model's rows, to be published as ``<step>/location_group=g/part-*.csv``, or ``.csv.gz``."""
    _csv(df.select(*columns, LOCATION_GROUP), run.output(step, LOCATION_GROUP), [LOCATION_GROUP], balance, packed)


def write_step_csv(
    df: DataFrame,
    base: str,
    step: str,
    columns: Sequence[str],
    groups: Sequence[str] | None = None,
    packed: bool = False,
) -> None:
    """Chosen columns of one model's rows as ``base/<step>/location_group=g/part-*.csv`` (``packed``: ``.csv.gz``). All
    folders of the run's groups are replaced, those without rows included; groups that the run does not stand for stay."""
    with Publication(df.sparkSession, base, groups) as run:
        stage_step_csv(run, df, step, columns, packed=packed)


def write_group_csv(df: DataFrame, base: str, columns: Sequence[str], groups: Sequence[str] | None = None) -> None:
    """One CSV file per location group (more only where a group exceeds the advisory partition size)."""
    with Publication(df.sparkSession, base, groups) as run:
        stage_step_csv(run, df, "", columns, balance=True)


def write_report_csv(df: DataFrame, path: str) -> None:
    """All rows as one balanced CSV directory: a single file while small, several in parallel beyond."""
    _csv(df, path, [], balance=True)


def write_performance_report(joined: DataFrame, path: str) -> None:
    write_report_csv(joined, path)


def write_all_predictions(predictions: DataFrame, path: str) -> None:
    write_report_csv(predictions, path)


def write_final_parquet(df: DataFrame, base: str, load_date: str, columns: Sequence[str]) -> None:
    df.select(*columns).write.mode("overwrite").parquet(f"{base}/LOAD_DATE={load_date}/final_prediction")


def write_counts(counts: DataFrame, base: str, load_dates: Sequence[str]) -> None:
    """Counts of whole load dates as ``base/load_date=d``. The run replaces the dates it stands for, those that have no
    rows any more included; the counts of other dates stay as they are."""
    with Publication(counts.sparkSession, base, load_dates) as run:
        balanced(counts, [LOAD_DATE]).write.partitionBy(LOAD_DATE).parquet(run.output("", LOAD_DATE))


def write_best_prediction(df: DataFrame, base: str) -> None:
    """Rows of the winning cut-offs, which the scoring job reads, as ``base/final_prediction/part-*.csv.gz``."""
    _csv(df, f"{base}/final_prediction", [], balance=False, packed=True)


def write_metric_json(row: DataFrame, path: str) -> None:
    """A one-row metric frame as a JSON object."""
    row.coalesce(1).write.mode("overwrite").json(path)
