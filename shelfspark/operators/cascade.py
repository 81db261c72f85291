"""The four-model cascade: routing, prediction band, out-of-stock flag, and its rebuild from stored steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import band_columns, nan_to_null, oos_exact, oos_nonpositive
from shelfspark.names import (
    BINARY_PRED,
    BRANCH,
    CURDAY_QTY,
    GT_OUT,
    HL_ORIG_PRED,
    HS_PRED,
    KEYS,
    LS_RATIO,
    LT_OUT,
    OOS,
    ORIG_PRED,
    ORIG_PRED_HIGH,
    ORIG_PRED_LOW,
    ORIG_PRED_TEMP,
    TARGET_HL,
    TARGET_HS,
    TARGET_LS,
)


def is_oos(t1: float, score: str = BINARY_PRED) -> Column:
    return F.col(score) > F.lit(float(t1))


def is_rest(t1: float, score: str = BINARY_PRED) -> Column:
    return F.col(score) <= F.lit(float(t1))


def is_lower_stock(t1: float, t2: float) -> Column:
    return is_rest(t1) & (F.col(HL_ORIG_PRED) > F.lit(float(t2)))


def is_higher_stock(t1: float, t2: float) -> Column:
    return is_rest(t1) & (F.col(HL_ORIG_PRED) <= F.lit(float(t2)))


def route(t1: float, t2: float) -> Column:
    """Branch name, or NULL where a score is missing (such rows leave the cascade)."""
    return (
        F.when(is_oos(t1), F.lit("oos"))
        .when(is_lower_stock(t1, t2), F.lit("ls"))
        .when(is_higher_stock(t1, t2), F.lit("hs"))
    )


def scale_by_book(ratio: Column | str, book: str = CURDAY_QTY) -> Column:
    return (F.col(ratio) if isinstance(ratio, str) else ratio) * F.col(book)


def fill_oos_constants(df: DataFrame) -> DataFrame:
    """Rows called out of stock predict zero units."""
    return df.withColumns({c: F.lit(0.0) for c in (ORIG_PRED, ORIG_PRED_LOW, ORIG_PRED_HIGH)})


def cast_object_features(df: DataFrame, features: list[str], strict: bool = True) -> DataFrame:
    """Cast string-typed features to integers. ``strict=False`` turns junk into NULL instead of failing."""
    kinds = {f.name.lower(): f.dataType.typeName() for f in df.schema.fields}
    text = [c for c in features if kinds[c.lower()] in ("string", "varchar", "char")]
    convert = (lambda c: F.col(c).cast("long")) if strict else (lambda c: F.col(c).try_cast("long"))
    return df.withColumns({c: convert(c) for c in text}) if text else df


def cascade_predict(scored: DataFrame, t1: float = 0.4, t2: float = 0.4) -> DataFrame:
    """Final prediction for every row that has the scores it needs: one narrow projection, no shuffle.

    Expects the four raw model outputs (``binary_pred``, ``hl_orig_pred``, ``ls_ratio``, ``hs_pred``).
    Adds the branch, quantity, band and flag; the columns a branch never computes are NULL on it.
    """
    scores = (BINARY_PRED, HL_ORIG_PRED, LS_RATIO, HS_PRED)
    # Says the same as "the branch is not NULL" in terms of the scores: a filter is pushed down as text, and
    # this one stays small there.
    routable = F.col(BINARY_PRED).isNotNull() & (is_oos(t1) | F.col(HL_ORIG_PRED).isNotNull())
    routed = (
        scored.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in scores})
        .where(routable)
        .withColumn(BRANCH, route(t1, t2))
    )
    out = F.col(BRANCH) == "oos"
    quantity = F.when(F.col(BRANCH) == "ls", scale_by_book(LS_RATIO)).when(F.col(BRANCH) == "hs", F.col(HS_PRED))
    banded = band_columns(routed.withColumn(ORIG_PRED, quantity), ORIG_PRED)
    zero = F.lit(0.0)
    return (
        banded.withColumns(
            {
                HL_ORIG_PRED: F.when(~out, F.col(HL_ORIG_PRED)),
                ORIG_PRED: F.when(out, zero).otherwise(F.col(ORIG_PRED)),
                ORIG_PRED_LOW: F.when(out, zero).otherwise(F.col(ORIG_PRED_LOW)),
                ORIG_PRED_HIGH: F.when(out, zero).otherwise(F.col(ORIG_PRED_HIGH)),
            }
        )
        .withColumn(OOS, oos_exact())
        .drop(LS_RATIO, HS_PRED)
    )


def step_frames(predicted: DataFrame) -> dict[str, DataFrame]:
    """The rows each model was responsible for, out of one cascade result."""
    branch = F.col(BRANCH)
    return {
        "step_1": predicted.where(branch == "oos"),
        "step_2": predicted.where(branch != "oos"),
        "step_3": predicted.where(branch == "ls"),
        "step_4": predicted.where(branch == "hs"),
    }


def project_required_columns(df: DataFrame, columns: Sequence[str], *extra: str) -> DataFrame:
    """The fixed column list of a stored output (plus, say, the partition column it is written by)."""
    return df.select(*columns, *extra)


def independent_steps(scored: DataFrame) -> dict[str, DataFrame]:
    """Every model on every row, as used to compare models and to search cut-offs afterwards."""
    return {
        "step_1": scored,
        "step_2": scored,
        "step_3": band_columns(scored.withColumn(ORIG_PRED, scale_by_book(nan_to_null(LS_RATIO)))),
        "step_4": band_columns(scored.withColumn(ORIG_PRED, nan_to_null(HS_PRED))),
    }


def mask_outputs(predicted: DataFrame, t1: float = 0.4, t2: float = 0.4) -> DataFrame:
    """``gt_out``/``lt_out``: the predicted quantity where the higher/lower-stock model made it."""
    return predicted.withColumns(
        {
            GT_OUT: F.when(is_higher_stock(t1, t2), F.col(ORIG_PRED)),
            LT_OUT: F.when(is_lower_stock(t1, t2), F.col(ORIG_PRED)),
        }
    )


def join_step1_step2(step1: DataFrame, step2: DataFrame, t1: float) -> DataFrame:
    """Rows below the out-of-stock cut-off with their higher/lower score."""
    return step1.where(is_rest(t1)).join(step2, KEYS, "inner")


def join_lower_stock(rest: DataFrame, step3: DataFrame, t2: float) -> DataFrame:
    return rest.where(F.col(HL_ORIG_PRED) > F.lit(float(t2))).join(step3, KEYS, "inner")


def join_higher_stock(rest: DataFrame, step4: DataFrame, t2: float) -> DataFrame:
    return rest.where(F.col(HL_ORIG_PRED) <= F.lit(float(t2))).join(step4, KEYS, "inner")


def concat_branches(*branches: DataFrame) -> DataFrame:
    """Rows of all branches; a column a branch lacks is NULL there. Nothing is deduplicated."""
    first, *others = branches
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def cascade_from_predictions(
    step1: DataFrame, step2: DataFrame, step3: DataFrame, step4: DataFrame, t1: float = 0.4, t2: float = 0.4
) -> DataFrame:
    """Final prediction rebuilt from stored step predictions for a pair of cut-offs.

    Both quantity models are read as one tagged relation, so the three-way join is planned once: every
    stored step is shuffled once on the key. A row takes the quantity of the model its branch asks for.
    """
    quantity = [ORIG_PRED_LOW, ORIG_PRED_HIGH]
    models = step3.select(*KEYS, *quantity, F.lit("ls").alias(BRANCH)).unionByName(
        step4.select(*KEYS, *quantity, F.lit("hs").alias(BRANCH))
    )
    # Not an equality on purpose: the branch must not become a join key, or the rows already laid out by
    # KEYS would be shuffled again.
    lower = (F.col(BRANCH) == "ls") & (F.col(HL_ORIG_PRED) > F.lit(float(t2)))
    higher = (F.col(BRANCH) == "hs") & (F.col(HL_ORIG_PRED) <= F.lit(float(t2)))
    rest = join_step1_step2(step1, step2.select(*KEYS, HL_ORIG_PRED), t1)
    stocked = rest.join(models, KEYS, "inner").where(lower | higher)
    out = step1.where(is_oos(t1)).withColumns({c: F.lit(0.0) for c in quantity})
    dropped = [BINARY_PRED, HL_ORIG_PRED, BRANCH, TARGET_HL, TARGET_LS, TARGET_HS, ORIG_PRED, ORIG_PRED_TEMP]
    return concat_branches(out.drop(*dropped), stocked.drop(*dropped)).withColumn(OOS, oos_nonpositive())
