"""Classification and business metrics.

Every document is one global aggregation (map-side combined to a single row per task) followed by
arithmetic on that one row, however many counts and sums it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import double, percent, ratio, round_n
from shelfspark.names import (
    ACTUAL_OOS,
    AUDIT_DOCUMENT,
    CURDAY_QTY,
    IP_QTY,
    KEYS,
    LOAD_DATE,
    OOS,
    ORIG_PRED_HIGH,
    ORIG_PRED_LOW,
    OVERALL_DOCUMENT,
    REV_QTY,
    TARGET_OOS,
    TOTAL_RETAIL,
)

CONFUSION = ["tp", "fn", "tn", "fp"]
RATES = ["tp_percent", "fn_percent", "tn_percent", "fp_percent", "precision", "recall", "f1_score", "accuracy"]


def _count_if(cond: str, name: str) -> Column:
    return F.expr(f"count_if({cond})").alias(name)


def _confusion(actual: str, not_actual: str, predicted: str, not_predicted: str) -> list[Column]:
    return [
        _count_if(f"{actual} AND {predicted}", "tp"),
        _count_if(f"{actual} AND {not_predicted}", "fn"),
        _count_if(f"{not_actual} AND {not_predicted}", "tn"),
        _count_if(f"{not_actual} AND {predicted}", "fp"),
    ]


def flag_confusion(actual: str = ACTUAL_OOS, predicted: str = OOS) -> list[Column]:
    return _confusion(f"{actual} = 1", f"{actual} = 0", f"{predicted} = 1", f"{predicted} = 0")


def stock_confusion(actual: str = REV_QTY, low: str = ORIG_PRED_LOW) -> list[Column]:
    return _confusion(f"{actual} <= 0", f"{actual} > 0", f"{low} <= 0", f"{low} > 0")


def score_confusion(target: str, score: str, threshold: float) -> list[Column]:
    above = f"coalesce({score} > {double(threshold)}, false)"
    return _confusion(f"{target} = 1", f"{target} = 0", above, f"NOT {above}")


def join_audit_prediction(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Audited rows with their prediction; the audit's own quantities win over those of the prediction."""
    held = {c.lower() for c in actual.columns} - set(KEYS)
    return actual.join(predicted.select(*[c for c in predicted.columns if c.lower() not in held]), KEYS, "inner")


def confusion_flags(df: DataFrame, actual: str = ACTUAL_OOS, predicted: str = OOS) -> DataFrame:
    """Counts from the audited flag and the predicted flag."""
    return df.agg(*flag_confusion(actual, predicted))


def confusion_stock(df: DataFrame, actual: str = REV_QTY, low: str = ORIG_PRED_LOW) -> DataFrame:
    """Counts from "no stock found" and "lower prediction bound at or below zero"."""
    return df.agg(*stock_confusion(actual, low))


def confusion_scores(df: DataFrame, target: str, score: str, threshold: float = 0.4) -> DataFrame:
    """Counts from a 0/1 target and a score cut at the threshold; other target values are ignored."""
    return df.agg(*score_confusion(target, score, threshold))


def rate_columns() -> dict[str, Column]:
    """Rates over a frame that has the columns tp, fn, tn, fp. F1 uses the *rounded* precision and recall."""
    tp, fn, tn, fp = (F.col(c) for c in CONFUSION)
    precision, recall = percent(tp, tp + fp), percent(tp, tp + fn)
    harmonic = F.lit(2.0) * (precision * recall / (precision + recall))
    return {
        "tp_percent": percent(tp, tp + fn),
        "fn_percent": percent(fn, tp + fn),
        "tn_percent": percent(tn, tn + fp),
        "fp_percent": percent(fp, tn + fp),
        "precision": precision,
        "recall": recall,
        "f1_score": F.when(precision + recall > 0, round_n(harmonic, 2)).otherwise(F.lit(0.0)),
        "accuracy": percent(tp + tn, tp + tn + fp + fn),
    }


def binary_rates(counts: DataFrame) -> DataFrame:
    """Append the eight rates to a frame of confusion counts."""
    return counts.withColumns(rate_columns())


def class_ratio(counts: DataFrame) -> DataFrame:
    """Negatives, positives and negatives per positive (three decimals, 0 without positives)."""
    zeros, ones = F.col("tn") + F.col("fp"), F.col("tp") + F.col("fn")
    return counts.select(
        zeros.alias("zeros"), ones.alias("ones"), round_n(ratio(zeros, ones), 3).alias("zero_to_one_ratio")
    )


def _business_counts(actual_oos: str, whole: bool = True) -> list[Column]:
    """Counts and retail sums; the sums in whole units, or as they are so that they can be added up."""
    under, over = f"{REV_QTY} <= {CURDAY_QTY}", f"{REV_QTY} > {CURDAY_QTY}"
    inside = f"{ORIG_PRED_LOW} <= {REV_QTY} AND {ORIG_PRED_HIGH} >= {REV_QTY}"
    missing = f"{actual_oos} = 1"
    pred_out, pred_in = f"{ORIG_PRED_LOW} <= 0", f"{ORIG_PRED_LOW} > 0"
    book_out, book_in = f"{IP_QTY} <= 0", f"{IP_QTY} > 0"

    def retail(name: str, *conds: str) -> Column:
        total = f"coalesce(sum({TOTAL_RETAIL}) FILTER (WHERE {' AND '.join(conds)}), 0)"
        return F.expr(f"CAST({total} AS BIGINT)" if whole else total).alias(name)

    return [
        F.expr("count(*)").alias("_rows"),
        _count_if(under, "_under"),
        _count_if(f"{under} AND {inside}", "_under_in"),
        _count_if(f"{under} AND {ORIG_PRED_LOW} <= {CURDAY_QTY}", "_under_ok"),
        _count_if(over, "_over"),
        _count_if(f"{over} AND {inside}", "_over_in"),
        _count_if(f"{over} AND {ORIG_PRED_HIGH} > {CURDAY_QTY}", "_over_ok"),
        _count_if(f"{missing} AND {pred_out} AND {book_out}", "_br_pr"),
        _count_if(f"{missing} AND {pred_in} AND {book_out}", "_br_pw"),
        _count_if(f"{missing} AND {pred_out} AND {book_in}", "_bw_pr"),
        retail("br_pr_value", missing, pred_out, book_out),
        retail("revenue_recovery", missing, pred_out, book_in),
        retail("model_loss", missing, pred_in),
        retail("book_recoverable_loss", missing, pred_in, book_out),
    ]


def _understock(empty: float) -> list[Column]:
    return [
        percent(F.col("_under_in"), F.col("_under"), empty).alias("understock_accurate"),
        percent(F.col("_under_ok"), F.col("_under"), empty).alias("understock_overall"),
    ]


def _overstock(empty: float) -> list[Column]:
    return [
        percent(F.col("_over_in"), F.col("_over"), empty).alias("overstock_accurate"),
        percent(F.col("_over_ok"), F.col("_over"), empty).alias("overstock_overall"),
    ]


def _book() -> list[Column]:
    """NULL on an empty frame: there is no share of nothing."""
    rows = F.col("_rows")
    return [
        percent(F.col("_br_pr"), rows, None).alias("br_pr_percent"),
        percent(F.col("_br_pw"), rows, None).alias("br_pw_percent"),
        percent(F.col("_bw_pr"), rows, None).alias("bw_pr_percent"),
    ]


_REVENUE = ["br_pr_value", "revenue_recovery", "model_loss", "book_recoverable_loss"]


def understock_performance(df: DataFrame, empty_default: float = 0.0) -> DataFrame:
    """Rows where the found stock is at most the book: band hit rate and "band at or below book" rate."""
    return df.agg(*_business_counts(TARGET_OOS)).select(F.col("_under").alias("rows"), *_understock(empty_default))


def overstock_performance(df: DataFrame, empty_default: float = 0.0) -> DataFrame:
    """Rows where the found stock exceeds the book: band hit rate and "band above book" rate."""
    return df.agg(*_business_counts(TARGET_OOS)).select(F.col("_over").alias("rows"), *_overstock(empty_default))


def book_vs_prediction(df: DataFrame, actual_oos: str = TARGET_OOS) -> DataFrame:
    """Shares of truly empty shelves by whether book and prediction called them empty."""
    return df.agg(*_business_counts(actual_oos)).select(*_book())


def revenue_impact(df: DataFrame, actual_oos: str = TARGET_OOS) -> DataFrame:
    """Retail value of the same cases, truncated to whole units."""
    return df.agg(*_business_counts(actual_oos)).select(*_REVENUE)


def audit_metrics(df: DataFrame, actual_oos: str = ACTUAL_OOS, empty_default: float = 0.0) -> DataFrame:
    """Audited flags against predicted flags plus the business metrics, as one row."""
    counted = df.agg(*flag_confusion(actual_oos, OOS), *_business_counts(actual_oos)).withColumns(rate_columns())
    return _document_order(counted, AUDIT_DOCUMENT, empty_default)


def overall_metrics(df: DataFrame, actual_oos: str = TARGET_OOS, empty_default: float = 100.0) -> DataFrame:
    """Found stock against the lower prediction bound plus the business metrics, as one row."""
    counted = df.agg(*stock_confusion(), *_business_counts(actual_oos)).withColumns(rate_columns())
    return _document_order(counted, OVERALL_DOCUMENT, empty_default)


def audit_counts(df: DataFrame, by: Sequence[str] = (LOAD_DATE,), actual_oos: str = ACTUAL_OOS) -> DataFrame:
    """What ``audit_metrics`` needs of every part of the rows (load date, group): counts and sums that add up."""
    return df.groupBy(*by).agg(*flag_confusion(actual_oos, OOS), *_business_counts(actual_oos, whole=False))


def overall_counts(df: DataFrame, by: Sequence[str] = (LOAD_DATE,), actual_oos: str = TARGET_OOS) -> DataFrame:
    """What ``overall_metrics`` needs of every part of the rows."""
    return df.groupBy(*by).agg(*stock_confusion(), *_business_counts(actual_oos, whole=False))


def _added(counts: DataFrame) -> DataFrame:
    names = [*CONFUSION, *[c for c in counts.columns if c.startswith("_")]]
    return counts.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in _REVENUE],
    ).withColumns(rate_columns())


def audit_metrics_of(counts: DataFrame, empty_default: float = 0.0) -> DataFrame:
    """The document of ``audit_metrics`` from the counts of any parts."""
    return _document_order(_added(counts), AUDIT_DOCUMENT, empty_default)


def overall_metrics_of(counts: DataFrame, empty_default: float = 100.0) -> DataFrame:
    """The document of ``overall_metrics`` from the counts of any parts."""
    return _document_order(_added(counts), OVERALL_DOCUMENT, empty_default)


def _document_order(counted: DataFrame, document: dict[str, str], empty: float) -> DataFrame:
    full = counted.select("*", *_understock(empty), *_overstock(empty), *_book())
    return full.select(*document.values())


def to_document(metrics: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rename the columns of a one-row metric frame to the published document keys."""
    return metrics.select(*[F.col(column).alias(key) for key, column in keys.items()])


def to_long(metrics: DataFrame) -> DataFrame:
    """One ``(metric, value)`` row per column."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metrics.columns]
    return metrics.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.metric", "_pair.value")
