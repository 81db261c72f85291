"""Column names and fixed values shared by every operator.

Spark resolves names case-insensitively, so frames with upper-case columns bind as well.
"""

SKU = "sku"
LOCATION = "location"
DATE = "date"
KEYS = [SKU, LOCATION, DATE]
SERIES = [SKU, LOCATION]

LOCATION_GROUP = "location_group"
LOAD_DATE = "load_date"
DATA_SPLIT = "data_split"

BINARY_PRED = "binary_pred"
HL_ORIG_PRED = "hl_orig_pred"
ORIG_PRED = "orig_pred"
ORIG_PRED_TEMP = "orig_pred_temp"
ORIG_PRED_LOW = "orig_pred_low"
ORIG_PRED_HIGH = "orig_pred_high"
OOS = "oos"
CONFIDENCE_LEVEL = "confidence_level"
GT_OUT = "gt_out"
LT_OUT = "lt_out"

IP_QTY = "ip_qty_eop_soh"
CURDAY_QTY = "curday_ip_qty_eop_soh"
REV_QTY = "rev_ip_qty_eop_soh"
TOTAL_RETAIL = "total_retail"
ACTUAL_OOS = "actual_oos_flag"

TARGET_OOS = "binary_target_classification"
TARGET_HL = "binary_hl_target_classification"
TARGET_LS = "target_regression"
TARGET_HS = "h_rev_target_ratio"

# Working columns of the cascade: which of the four branches a row took, and the raw scores of the
# two quantity models before they are turned into a quantity.
BRANCH = "branch"
LS_RATIO = "ls_ratio"
HS_PRED = "hs_pred"

STEPS = ["step_1", "step_2", "step_3", "step_4"]

# The columns each stored table carries.
STEP_COLUMNS = {
    "step_1": KEYS + [BINARY_PRED, TARGET_OOS, IP_QTY, CURDAY_QTY, REV_QTY, TOTAL_RETAIL],
    "step_2": KEYS + [HL_ORIG_PRED, TARGET_HL],
    "step_3": KEYS + [ORIG_PRED, ORIG_PRED_LOW, ORIG_PRED_HIGH, TARGET_LS],
    "step_4": KEYS + [ORIG_PRED, ORIG_PRED_LOW, ORIG_PRED_HIGH, TARGET_HS],
}
FINAL_COLUMNS = KEYS + [
    IP_QTY, CURDAY_QTY, REV_QTY, TOTAL_RETAIL, OOS, BINARY_PRED, HL_ORIG_PRED, ORIG_PRED,
    ORIG_PRED_LOW, ORIG_PRED_HIGH, TARGET_OOS,
]
DAILY_COLUMNS = KEYS + [OOS, CONFIDENCE_LEVEL]
CONCATENATED_COLUMNS = KEYS + [
    BINARY_PRED, ORIG_PRED_LOW, ORIG_PRED_HIGH, ORIG_PRED, HL_ORIG_PRED, ORIG_PRED_TEMP, OOS,
    CONFIDENCE_LEVEL,
]
DAILY_STEP_COLUMNS = {
    "step_2": KEYS + [BINARY_PRED, HL_ORIG_PRED],
    "step_3": KEYS + [BINARY_PRED, ORIG_PRED_LOW, ORIG_PRED_HIGH, ORIG_PRED, HL_ORIG_PRED, ORIG_PRED_TEMP],
    "step_4": KEYS + [BINARY_PRED, ORIG_PRED_LOW, ORIG_PRED_HIGH, ORIG_PRED, HL_ORIG_PRED, ORIG_PRED_TEMP],
}
BEST_COLUMNS = KEYS + [
    TARGET_OOS, IP_QTY, CURDAY_QTY, REV_QTY, TOTAL_RETAIL, ORIG_PRED_LOW, ORIG_PRED_HIGH, OOS,
]

# Metric names a weight configuration may use, and the metric column each one reads.
WEIGHTED_METRICS = {
    "TP Count": "tp",
    "FN Count": "fn",
    "TN Count": "tn",
    "FP Count": "fp",
    "TP Percent": "tp_percent",
    "FN Percent": "fn_percent",
    "TN Percent": "tn_percent",
    "FP Percent": "fp_percent",
    "Precision Percent": "precision",
    "Recall Percent": "recall",
    "F1 Score": "f1_score",
    "Accuracy": "accuracy",
}

# Keys of the published audit document, in order, and the metric column of each.
AUDIT_DOCUMENT = {
    "True Positive Count": "tp",
    "False Negative Count": "fn",
    "True Negative Count": "tn",
    "False Positive Count": "fp",
    "Recall %": "recall",
    "Precision %": "precision",
    "F1 Score": "f1_score",
    "Accuracy %": "accuracy",
    "Actual Less Than Book Accurate Performance %": "understock_accurate",
    "Actual Less Than Book Overall  Performance %": "understock_overall",
    "Actual Greater Than Book Accurate  Performance %": "overstock_accurate",
    "Actual Greater Than Book Overall  Performance %": "overstock_overall",
    "BR_PR %": "br_pr_percent",
    "BR_PW %": "br_pw_percent",
    "BW_PR %": "bw_pr_percent",
    "BR_PR $ Value": "br_pr_value",
    "Revenue Recovery Due to Model": "revenue_recovery",
    "Loss Due to Model": "model_loss",
    "Part of Loss Due to Model that Book Can Recover": "book_recoverable_loss",
}

# Keys of the published overall document, in order, and the metric column of each.
OVERALL_DOCUMENT = {
    "TP Count": "tp",
    "TN Count": "tn",
    "FP Count": "fp",
    "FN Count": "fn",
    "TP %": "tp_percent",
    "TN %": "tn_percent",
    "FP %": "fp_percent",
    "FN %": "fn_percent",
    "Precision %": "precision",
    "Recall %": "recall",
    "F1 Score": "f1_score",
    "Accuracy %": "accuracy",
    "Actual Less Than Book Accurate Performance %": "understock_accurate",
    "Actual Less Than Book Overall  Performance %": "understock_overall",
    "Actual Greater Than Book Accurate  Performance %": "overstock_accurate",
    "Actual Greater Than Book Overall  Performance %": "overstock_overall",
    "BR_PR %": "br_pr_percent",
    "BR_PW %": "br_pw_percent",
    "BW_PR %": "bw_pr_percent",
    "BR_PR $ Value": "br_pr_value",
    "Revenue Recovery Due to Model": "revenue_recovery",
    "Loss Due to Model": "model_loss",
    "Part of Loss Due to Model that Book Can Recover": "book_recoverable_loss",
}

# Sections and fields of the published confidence document.
CONFIDENCE_DOCUMENT = {
    "OOS_BINARY": {
        "OOS_BINARY_TP_PERCENTAGE": "oos_tp_percent",
        "OOS_BINARY_OUT_OF_STOCK_MEAN_PROBABILITY": "oos_tp_mean",
        "OOS_BINARY_TN_PERCENTAGE": "oos_tn_percent",
        "OOS_BINARY_IN_STOCK_MEAN_PROBABILITY": "oos_tn_mean",
        "OOS_BINARY_OUT_OF_STOCK_BINS_PERCENTAGE": "oos_tp_bins",
        "OOS_BINARY_IN_STOCK_BINS_PERCENTAGE": "oos_tn_bins",
    },
    "HL_BINARY": {
        "HL_BINARY_TP_PERCENTAGE": "hl_tp_percent",
        "HL_BINARY_OUT_OF_STOCK_MEAN_PROBABILITY": "hl_tp_mean",
        "HL_BINARY_TN_PERCENTAGE": "hl_tn_percent",
        "HL_BINARY_IN_STOCK_MEAN_PROBABILITY": "hl_tn_mean",
        "HL_BINARY_OUT_OF_STOCK_BINS_PERCENTAGE": "hl_tp_bins",
        "HL_BINARY_IN_STOCK_BINS_PERCENTAGE": "hl_tn_bins",
    },
    "LT": {
        "LT_TP_PERCENTAGE": "lt_tp_percent",
        "LT_TN_PERCENTAGE": "lt_tn_percent",
    },
    "HS": {
        "HS_TP_PERCENTAGE": "hs_tp_percent",
        "HS_TN_PERCENTAGE": "hs_tn_percent",
    },
}

# Suffixes of the technical metric keys, prefixed by the step name when published.
BINARY_TECHNICAL = {
    "tp_%": "tp_percent",
    "fn_%": "fn_percent",
    "tn_%": "tn_percent",
    "fp_%": "fp_percent",
    "accuracy": "accuracy",
    "roc_auc": "roc_auc",
    "precision": "precision",
    "recall": "recall",
    "f1_score": "f1_score",
}
REGRESSION_TECHNICAL = {
    "r2": "r2",
    "mean_squared_error": "mean_squared_error",
    "mean_absolute_error": "mean_absolute_error",
    "median_absolute_error": "median_absolute_error",
}
