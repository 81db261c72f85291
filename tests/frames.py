"""Small frames for the tests."""

from __future__ import annotations

import datetime as dt

DAY0 = dt.date(2020, 1, 1)


def day(i: int) -> dt.date:
    return DAY0 + dt.timedelta(days=i)


SCORED = (
    "sku string, location string, date date, location_group string, ip_qty_eop_soh long, curday_ip_qty_eop_soh long, "
    "rev_ip_qty_eop_soh long, total_retail long, binary_target_classification long, "
    "binary_hl_target_classification long, target_regression double, h_rev_target_ratio double, "
    "binary_pred double, hl_orig_pred double, ls_ratio double, hs_pred double"
)


def scored(spark, scores, rev=None):
    """One row per ``(binary_pred, hl_orig_pred, ls_ratio, hs_pred)``."""
    rows = [
        (f"{i:04d}", "7", day(i), "01", 3, 10, (rev[i] if rev else i % 3), 5, int((rev[i] if rev else i % 3) <= 0), 1,
         0.5, 2.0, *s)
        for i, s in enumerate(scores)
    ]
    return spark.createDataFrame(rows, SCORED)
