"""Stock panel derived from the ``lineitem`` table: one row per (sku, location, date), with scores and targets.

Scores are exact thousandths and all quantities integers, so results do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.names import ACTUAL_OOS, CURDAY_QTY, IP_QTY, KEYS, LOAD_DATE, REV_QTY, TARGET_OOS, TOTAL_RETAIL


#: Lines that one task aggregates, and the fewest that are worth a task.
TASK_LINES, LEAST_LINES = 500_000, 50_000


def _by_cell(lines: DataFrame) -> DataFrame:
    """Lines dealt out by cell, at most some ``TASK_LINES`` to a task whatever the size of the table. Nearly every line
    is a cell of its own, so nothing is gained by adding them up before they are moved."""
    rows = lines.count()  # from the footers of the files
    cores = lines.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-rows // TASK_LINES), min(cores, -(-rows // LEAST_LINES)), 1)
    day = F.col("l_shipdate").cast("date").alias("date")
    return lines.select("l_partkey", "l_suppkey", day, F.col("l_quantity").cast("long").alias("quantity")).repartition(
        tasks, "l_partkey", "l_suppkey", "date"
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supp, day = F.col("l_partkey"), F.col("l_suppkey"), F.col("date")
    lines = _by_cell(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    cells = lines.groupBy("l_partkey", "l_suppkey", "date").agg(F.sum("quantity").alias(TOTAL_RETAIL))

    def mixed(a: int, b: int, c: int) -> Column:
        return (part * a + supp * b + F.col("dn") * c) % 1000

    h1, h2, h3 = F.col("h1"), F.col("h2"), F.col("h3")
    mixed_cells = (
        cells.withColumn("dn", (F.year(day) * 372 + F.month(day) * 31 + F.dayofmonth(day)).cast("long"))
        .withColumns({"h1": mixed(7919, 104729, 31), "h2": mixed(6151, 15485, 17), "h3": mixed(3571, 2741, 13)})
        .withColumn(REV_QTY, (h3 * 11 + h2) % 40 - 8)
        .withColumn(CURDAY_QTY, (h2 * 3 + h1) % 40)
    )
    rev, book = F.col(REV_QTY), F.col(CURDAY_QTY)
    return mixed_cells.select(
        part.cast("string").alias("sku"),
        supp.cast("string").alias("location"),
        "date",
        (supp % 4).cast("string").alias("location_group"),
        F.date_format(F.trunc("date", "month"), "yyyy-MM-dd").alias(LOAD_DATE),
        "dn",
        TOTAL_RETAIL,
        (h1 / F.lit(1000.0)).alias("binary_pred"),
        (h2 / F.lit(1000.0)).alias("hl_orig_pred"),
        (h3 * 2 / F.lit(1000.0)).alias("ls_ratio"),
        (h3 * 60 / F.lit(1000.0)).alias("hs_pred"),
        ((h1 * 7 + h2) % 40 - 3).alias(IP_QTY),
        CURDAY_QTY,
        REV_QTY,
        F.when(rev <= 0, 1).otherwise(0).cast("long").alias(TARGET_OOS),
        F.when(rev < book, 1).otherwise(0).cast("long").alias("binary_hl_target_classification"),
        F.when(book > 0, rev.cast("double") / book.cast("double")).otherwise(F.lit(0.0)).alias("target_regression"),
        rev.cast("double").alias("h_rev_target_ratio"),
        (h1 % 2).alias("neg_cc_flag"),
        (h2 % 2).alias("sales_flag"),
        (h3 % 2).alias("transfer_flag"),
    )


FEATURES = [
    IP_QTY, CURDAY_QTY, "neg_cc_flag", "sales_flag", "transfer_flag", "binary_pred", "hl_orig_pred", "ls_ratio",
    "hs_pred",
]
TARGETS = [
    REV_QTY, TOTAL_RETAIL, TARGET_OOS, "binary_hl_target_classification", "target_regression", "h_rev_target_ratio",
]


def feature_store(p: DataFrame) -> DataFrame:
    return p.select(*KEYS, *FEATURES, "location_group", LOAD_DATE)


def target_store(p: DataFrame) -> DataFrame:
    return p.select(*KEYS, *TARGETS, F.lit(0).cast("long").alias("year_audit_day_flag"), "location_group", LOAD_DATE)


def audit_actuals(p: DataFrame) -> DataFrame:
    """All rows of the panel as audits. Two of three are of a day without predictions, so the join drops them."""
    audited = p.withColumn("date", F.when(F.col("dn") % 3 == 0, F.col("date")).otherwise(F.date_add("date", 40000)))
    return audited.select(
        *KEYS, F.col(TARGET_OOS).alias(ACTUAL_OOS), REV_QTY, CURDAY_QTY, IP_QTY, TOTAL_RETAIL
    )
