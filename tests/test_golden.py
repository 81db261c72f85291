"""Hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from shelfspark import names as N
from shelfspark.functions import lower_edges, round_n, upper_edges, upper_bins
from shelfspark.functions.scalar import band_columns
from shelfspark.operators import metrics

BAND = [
    (0.0, 0.00, 0, 1), (0.04, 0.04, 0, 1), (0.5, 0.50, 0, 2), (0.575, 0.57, 0, 2), (1.0, 1.00, 0, 2),
    (1.005, 1.00, 0, 2), (2.0, 2.00, 0, 2), (2.5, 2.50, 1, 3), (2.675, 2.68, 1, 3), (3.0, 3.00, 1, 3),
    (1.5, 1.50, 0, 2), (5.0, 5.00, 4, 6), (6.67, 6.67, 6, 8), (10.0, 10.00, 8, 12), (20.0, 20.00, 17, 23),
    (100.0, 100.00, 85, 115), (-0.5, -0.50, 0, -1), (-1.0, -1.00, 0, 0), (-10.0, -10.00, 0, -11),
    (3.33, 3.33, 2, 4), (4.0, 4.00, 3, 5), (None, None, None, None),
]


def test_band(spark):
    df = spark.createDataFrame([(i, b[0]) for i, b in enumerate(BAND)], "i int, orig_pred double")
    got = band_columns(df).orderBy("i").collect()
    for row, (pred, temp, low, high) in zip(got, BAND):
        assert (row.orig_pred_temp, row.orig_pred_low, row.orig_pred_high) == (temp, low, high), pred


def test_band_has_no_negative_zero(spark):
    row = band_columns(spark.createDataFrame([(-0.5,)], "orig_pred double")).first()
    assert math.copysign(1, row.orig_pred_low) == 1


def test_round_is_half_even_on_the_scaled_value(spark):
    values = [0.5, 1.5, 2.5, -0.5, -1.5]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(round_n("v", 0)).collect()]
    assert got == [0.0, 2.0, 2.0, 0.0, -2.0]


UPPER = {
    0.0: [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    0.3: [0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    0.35: [0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9],
    0.4: [0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    0.45: [0.45, 0.6, 0.7, 0.8, 0.8, 0.9],
    0.55: [0.55, 0.7, 0.8, 0.8, 0.9],
    1.0: [1.0],
}
LOWER = {
    0.0: [0.0],
    0.1: [0.0, 0.1],
    0.35: [0.0, 0.1, 0.2, 0.35],
    0.4: [0.0, 0.1, 0.2, 0.3, 0.4],
    0.45: [0.0, 0.1, 0.2, 0.3, 0.45],
    0.55: [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.55],
    1.0: [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
}


@pytest.mark.parametrize("t", UPPER)
def test_upper_edges(t):
    assert upper_edges(t) == UPPER[t]


@pytest.mark.parametrize("t", LOWER)
def test_lower_edges(t):
    assert lower_edges(t) == LOWER[t]


def test_edges_need_a_probability():
    for fn in (upper_edges, lower_edges):
        for t in (-0.1, 1.1):
            with pytest.raises(ValueError):
                fn(t)


def test_coinciding_edges_keep_the_later_bin():
    assert upper_bins(0.45) == [(0.45, 0.6, False), (0.6, 0.7, False), (0.7, 0.8, False), (0.8, 0.9, False)]


AUDIT = [
    (0, 5, 3, 10, 1, 0, 0, 1), (0, 5, 0, 20, 1, 0, 0, 1), (-1, 4, 2, 30, 1, 3, 5, 0), (0, 4, 0, 40, 1, 2, 4, 0),
    (6, 5, 5, 50, 0, 4, 6, 0), (3, 5, 5, 60, 0, 0, 2, 1), (9, 5, 5, 70, 0, 8, 12, 0), (4, 4, 4, 80, 0, 3, 5, 0),
]
AUDIT_SCHEMA = (
    "rev_ip_qty_eop_soh long, curday_ip_qty_eop_soh long, ip_qty_eop_soh long, total_retail long, "
    "actual_oos_flag long, orig_pred_low double, orig_pred_high double, oos long"
)


def audit_rows(spark, rows=AUDIT):
    return spark.createDataFrame([(*r[:5], float(r[5]), float(r[6]), r[7]) for r in rows], AUDIT_SCHEMA)


def test_eight_audit_rows(spark):
    row = metrics.audit_metrics(audit_rows(spark)).first().asDict()
    assert row == {
        "tp": 2, "fn": 2, "tn": 3, "fp": 1, "recall": 50.0, "precision": 66.67, "f1_score": 57.14, "accuracy": 62.5,
        "understock_accurate": 50.0, "understock_overall": 100.0, "overstock_accurate": 100.0,
        "overstock_overall": 100.0, "br_pr_percent": 12.5, "br_pw_percent": 12.5, "bw_pr_percent": 12.5,
        "br_pr_value": 20, "revenue_recovery": 10, "model_loss": 70, "book_recoverable_loss": 40,
    }


def test_document_keys(spark):
    document = metrics.to_document(metrics.audit_metrics(audit_rows(spark)), N.AUDIT_DOCUMENT)
    assert document.columns == list(N.AUDIT_DOCUMENT)
    assert len(N.AUDIT_DOCUMENT) == 19 and len(N.OVERALL_DOCUMENT) == 23


def test_empty_audit(spark):
    none = audit_rows(spark).where(F.lit(False))
    row = metrics.audit_metrics(none).first()
    assert (row.tp, row.understock_accurate, row.br_pr_percent, row.br_pr_value) == (0, 0.0, None, 0)
    overall = metrics.overall_metrics(none, actual_oos=N.ACTUAL_OOS).first()
    assert (overall.accuracy, overall.understock_accurate, overall.overstock_overall) == (0.0, 100.0, 100.0)
