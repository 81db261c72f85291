"""Metric documents from stored counts of load dates."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfspark import names as N
from shelfspark.operators import confidence, metrics
from shelfspark.operators.cascade import cascade_predict
from shelfspark.plans.panel import panel
from shelfspark.sources import readers, writers

DAYS = ["d1", "d2", "d3"]


@pytest.fixture(scope="module")
def rows(spark):
    day = F.concat(F.lit("d"), (F.col("dn") % 3 + 1).cast("string"))
    frame = cascade_predict(panel(spark, "/root/testdata/sf0.001").withColumn(N.LOAD_DATE, day), 0.4, 0.4)
    # Fractions that would be lost if each part were cut to whole units.
    return frame.withColumn(N.TOTAL_RETAIL, F.col(N.TOTAL_RETAIL) + 0.75).cache()


def kinds(rows):
    audited = rows.withColumn(N.ACTUAL_OOS, F.col(N.TARGET_OOS))
    return [
        (rows, metrics.overall_metrics, metrics.overall_counts, metrics.overall_metrics_of),
        (audited, metrics.audit_metrics, metrics.audit_counts, metrics.audit_metrics_of),
        (rows, confidence.confidence_metrics, confidence.confidence_counts, confidence.confidence_metrics_of),
    ]


@pytest.mark.parametrize("kind", range(3))
def test_counts_add_up(rows, kind):
    frame, whole, counted, merged = kinds(rows)[kind]
    for by in ((N.LOAD_DATE,), (N.LOAD_DATE, N.LOCATION_GROUP), (N.LOCATION,)):
        assert merged(counted(frame, by)).collect() == whole(frame).collect()
    empty = frame.limit(0)
    assert merged(counted(empty)).collect() == whole(empty).collect()


@pytest.mark.parametrize("kind", range(3))
def test_other_dates_are_neither_read_nor_changed(spark, rows, kind, tmp_path):
    frame, whole, counted, merged = kinds(rows)[kind]
    base = str(tmp_path / "counts")
    writers.write_counts(counted(frame), base, DAYS)
    (files,) = {tuple(sorted(p.name for p in Path(base, "load_date=d1").glob("*.parquet")))}
    for p in Path(base, "load_date=d1").glob("*.parquet"):
        whole_file = p.read_bytes()
        footer = 8 + int.from_bytes(whole_file[-8:-4], "little")
        p.write_bytes(b"PAR1" + bytes(len(whole_file) - footer - 4) + whole_file[-footer:])  # only the schema is left
        Path(p.parent, f".{p.name}.crc").unlink(missing_ok=True)
    # A day that has fewer rows now; the broken old day is not opened for it.
    fewer = frame.where(F.col(N.LOAD_DATE) == "d3").where(F.col("dn") % 2 == 0)
    writers.write_counts(counted(fewer), base, ["d3"])
    late = frame.where(F.col(N.LOAD_DATE) == "d2").unionByName(fewer)
    counts = readers.scan_counts(spark, base, first="d2")
    assert merged(counts).collect() == whole(late).collect()
    with pytest.raises(Exception):  # noqa: B017
        merged(readers.scan_counts(spark, base)).collect()
    assert tuple(sorted(p.name for p in Path(base, "load_date=d1").glob("*.parquet"))) == files


def test_a_date_without_rows_is_emptied(spark, rows, tmp_path):
    base = str(tmp_path / "counts")
    writers.write_counts(metrics.overall_counts(rows), base, DAYS)
    writers.write_counts(metrics.overall_counts(rows.where(F.col(N.LOAD_DATE) == "d2")), base, ["d2", "d3"])
    left = readers.scan_counts(spark, base)
    assert sorted(r[0] for r in left.select(N.LOAD_DATE).collect()) == ["d1", "d2"]
    assert readers.scan_counts(spark, base, last="d1").select(N.LOAD_DATE).distinct().count() == 1
