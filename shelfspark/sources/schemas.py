"""Types of the stored tables. Keys are strings (a numeric-looking SKU keeps its leading zeros)."""

from __future__ import annotations

from pyspark.sql import types as T

from shelfspark import names as N

_LONGS = {N.IP_QTY, N.CURDAY_QTY, N.REV_QTY, N.TOTAL_RETAIL, N.OOS, N.TARGET_OOS, N.TARGET_HL, N.ACTUAL_OOS}
_STRINGS = {N.SKU, N.LOCATION, N.LOCATION_GROUP, N.LOAD_DATE, N.DATA_SPLIT, N.CONFIDENCE_LEVEL}


def column_type(name: str) -> T.DataType:
    if name in _LONGS:
        return T.LongType()
    if name in _STRINGS:
        return T.StringType()
    return T.DateType() if name == N.DATE else T.DoubleType()


def table(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, column_type(c)) for c in columns])


STEPS = {step: table(columns) for step, columns in N.STEP_COLUMNS.items()}
FINAL = table(N.FINAL_COLUMNS)
BEST = table(N.BEST_COLUMNS)
DAILY = table(N.DAILY_COLUMNS)
CONCATENATED = table(N.CONCATENATED_COLUMNS)
AUDIT = table(N.KEYS + [N.ACTUAL_OOS, N.REV_QTY, N.CURDAY_QTY, N.IP_QTY, N.TOTAL_RETAIL])
WEIGHTS = T.StructType(
    [T.StructField("metrics_list", T.ArrayType(T.StructType(
        [T.StructField("metric_name", T.StringType()), T.StructField("metric_weight", T.DoubleType())]
    )))]
)
NODES = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("tree", "node")]
    + [T.StructField("feature", T.StringType()), T.StructField("threshold", T.DoubleType())]
    + [T.StructField(c, T.LongType()) for c in ("left", "right")]
    + [T.StructField("leaf", T.DoubleType()), T.StructField("default_left", T.BooleanType())]
)
