"""Column expressions. All are built-in Catalyst expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.names import ORIG_PRED, ORIG_PRED_HIGH, ORIG_PRED_LOW, ORIG_PRED_TEMP


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_n(c: Column | str, n: int) -> Column:
    """Scale, round half to even, scale back. ``F.round`` rounds half up on the decimal text instead."""
    scale = float(10**n)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def nan_to_null(c: Column | str) -> Column:
    """Spark orders NaN above every number, so a NaN score would pass ``score > t``. NULL does not."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def without_nan(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating-point column."""
    floating = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: nan_to_null(c) for c in floating}) if floating else df


def ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """``num / den`` with a default (or NULL) where the denominator is not positive."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(default).cast("double"))


def percent(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """Share in percent, two decimals, with a default (or NULL) where there is nothing to divide by."""
    share = num.cast("double") / den.cast("double") * F.lit(100.0)
    return F.when(den > 0, round_n(share, 2)).otherwise(F.lit(default).cast("double"))


def binarize(score: Column | str, threshold: float) -> Column:
    """1 above the threshold, otherwise 0; a missing score counts as 0."""
    return F.when(_col(score) > F.lit(float(threshold)), F.lit(1)).otherwise(F.lit(0)).cast("long")


def oos_exact(low: Column | str = ORIG_PRED_LOW) -> Column:
    return F.when(_col(low) == 0, F.lit(1)).otherwise(F.lit(0)).cast("long")


def oos_nonpositive(low: Column | str = ORIG_PRED_LOW) -> Column:
    return F.when(_col(low) <= 0, F.lit(1)).otherwise(F.lit(0)).cast("long")


def parse_iso_date(c: Column | str) -> Column:
    return F.to_date(_col(c), "yyyy-MM-dd")


def band_columns(df: DataFrame, pred: str = ORIG_PRED) -> DataFrame:
    """Add the rounded prediction and its +-15 % band as whole units.

    The band is widened downwards until it spans more than one unit (by 2 when both ends coincide, by 1
    when they are neighbours). A lower end below zero is clipped to zero and lifts the upper end by one.
    The steps are separate projections so that the generated code computes each of them once.
    """
    margin = F.col(ORIG_PRED_TEMP) * F.lit(0.15)
    width = F.col("_hi") - F.col("_lo")
    return (
        df.withColumn(ORIG_PRED_TEMP, round_n(pred, 2))
        .withColumns({"_lo": F.rint(F.col(ORIG_PRED_TEMP) - margin), "_hi": F.rint(F.col(ORIG_PRED_TEMP) + margin)})
        .withColumn(
            "_lo",
            F.col("_lo") - F.when(width == 0, F.lit(2.0)).when(width == 1, F.lit(1.0)).otherwise(F.lit(0.0)),
        )
        .withColumns(
            {
                ORIG_PRED_LOW: F.when(F.col("_lo") < 0, F.lit(0.0)).otherwise(F.col("_lo") + F.lit(0.0)),
                ORIG_PRED_HIGH: F.when(F.col("_lo") < 0, F.col("_hi") + 1).otherwise(F.col("_hi") + F.lit(0.0)),
            }
        )
        .drop("_lo", "_hi")
    )


def bucket_index(score: str, cuts: Sequence[float]) -> Column:
    """How many of the ascending cut-offs lie strictly below a score column (NULL for a missing score).

    Written as a balanced tree of comparisons: log2(len(cuts)) of them per row, all JVM-side.
    """
    def search(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"IF({score} > {double(cuts[mid])}, {search(mid + 1, hi)}, {search(lo, mid)})"

    return F.expr(f"IF({score} IS NULL OR isnan({score}), NULL, {search(0, len(cuts))})")


def double(value: float) -> str:
    """A double literal in SQL text, exact to the last bit."""
    return f"{float(value)!r}D" if "e" not in repr(float(value)) else f"CAST('{float(value)!r}' AS DOUBLE)"
