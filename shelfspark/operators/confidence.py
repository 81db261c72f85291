"""Confidence statistics of the two classifiers and the confidence level of a prediction."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions import double, lower_bins, upper_bins
from shelfspark.names import (
    BINARY_PRED,
    CONFIDENCE_DOCUMENT,
    CONFIDENCE_LEVEL,
    GT_OUT,
    HL_ORIG_PRED,
    LOAD_DATE,
    LT_OUT,
    OOS,
    ORIG_PRED_LOW,
    TARGET_OOS,
)
from shelfspark.operators.cascade import mask_outputs

Bins = list[tuple[float, float, bool]]


def _in_bin(score: str, start: float, end: float, closed: bool) -> str:
    return f"{score} >= {double(start)} AND {score} {'<=' if closed else '<'} {double(end)}"


def _sides(t1: float, t2: float, close_last: bool) -> dict[str, tuple[str, str, Bins]]:
    """Condition, probability column and bins of the four (classifier, side) pairs.

    Unlike the cascade, these cut-offs are inclusive from above: ``>= t`` and ``< t``.
    """
    called, rest = f"{BINARY_PRED} >= {double(t1)}", f"{BINARY_PRED} < {double(t1)}"
    true, false = f"{TARGET_OOS} = 1", f"{TARGET_OOS} = 0"
    out, stocked = f"{ORIG_PRED_LOW} = 0", f"{ORIG_PRED_LOW} > 0"
    return {
        "oos_tp": (f"{called} AND {true}", BINARY_PRED, upper_bins(t1, close_last)),
        "oos_tn": (f"{rest} AND {false}", BINARY_PRED, lower_bins(t1)),
        "hl_tp": (f"{rest} AND {out} AND {true}", HL_ORIG_PRED, upper_bins(t2, close_last)),
        "hl_tn": (f"{rest} AND {stocked} AND {false}", HL_ORIG_PRED, lower_bins(t2)),
    }


def confidence_metrics(df: DataFrame, t1: float = 0.4, t2: float = 0.4, close_last: bool = False) -> DataFrame:
    """Every confidence statistic as one row from one aggregation; bins are maps from bin start to percent.

    There are at most ten bins a side, so each is one more conditional count and no join is needed.
    """
    return _statistics(confidence_counts(df, (), t1, t2, close_last), t1, t2, close_last)


def confidence_metrics_of(
    counts: DataFrame, t1: float = 0.4, t2: float = 0.4, close_last: bool = False
) -> DataFrame:
    """The same row from the counts of any parts, taken with the same cut-offs."""
    names = [c for c in counts.columns if c.startswith(("n_", "sum_"))]
    row = counts.agg(*[(F.sum(c) if c.startswith("sum_") else F.coalesce(F.sum(c), F.lit(0))).alias(c) for c in names])
    return _statistics(row, t1, t2, close_last)


def confidence_counts(
    df: DataFrame, by: Sequence[str] = (LOAD_DATE,), t1: float = 0.4, t2: float = 0.4, close_last: bool = False
) -> DataFrame:
    """What ``confidence_metrics`` needs of every part of the rows (load date, group): counts and sums that add up."""
    sides = _sides(t1, t2, close_last)
    rest = f"{BINARY_PRED} < {double(t1)}"
    counts = {"n_oos": "count(*)", "n_hl": f"count_if({rest})"}
    for side, (cond, score, bins) in sides.items():
        counts[f"n_{side}"] = f"count_if({cond})"
        counts[f"sum_{side}"] = f"sum({score}) FILTER (WHERE {cond})"
        counts |= {f"n_{side}_{i}": f"count_if({cond} AND {_in_bin(score, *bin_)})" for i, bin_ in enumerate(bins)}
    for model, part in (("lt", f"{HL_ORIG_PRED} >= {double(t2)}"), ("hs", f"{HL_ORIG_PRED} < {double(t2)}")):
        counts[f"n_{model}"] = f"count_if({rest} AND {part})"
        for side in ("tp", "tn"):
            counts[f"n_{model}_{side}"] = f"count_if({part} AND {sides[f'hl_{side}'][0]})"
    return df.groupBy(*by).agg(*[F.expr(sql).alias(name) for name, sql in counts.items()])


def _statistics(row: DataFrame, t1: float, t2: float, close_last: bool) -> DataFrame:
    sides = _sides(t1, t2, close_last)

    def share(n: str, of: str) -> str:
        """Percent with two decimals, 0 when there is nothing to divide by."""
        return f"IF({of} > 0, rint({n} / {of} * 100D * 100D) / 100D, 0D)"

    out = []
    for side, (_, _, bins) in sides.items():
        model = side.split("_")[0]
        bars = ", ".join(f"'{start}', {share(f'n_{side}_{i}', f'n_{side}')}" for i, (start, _, _) in enumerate(bins))
        out += [
            f"{share(f'n_{side}', f'n_{model}')} AS {side}_percent",
            f"IF(n_{side} > 0, rint(coalesce(sum_{side}, 0D) / n_{side} * 100D) / 100D, 0D) AS {side}_mean",
            f"CAST(map({bars}) AS map<string, double>) AS {side}_bins",
        ]
    for side in ("lt_tp", "lt_tn", "hs_tp", "hs_tn"):
        out.append(f"{share(f'n_{side}', f'n_{side[:2]}')} AS {side}_percent")
    return row.selectExpr(*out)


def confidence_oos(df: DataFrame, t1: float = 0.4) -> DataFrame:
    """Out-of-stock classifier: share of all rows and mean probability of its true positives and negatives."""
    return confidence_metrics(df, t1, t1).select("oos_tp_percent", "oos_tp_mean", "oos_tn_percent", "oos_tn_mean")


def confidence_hl(df: DataFrame, t1: float = 0.4, t2: float = 0.4) -> DataFrame:
    """Higher/lower classifier, over the rows below the out-of-stock cut-off."""
    return confidence_metrics(df, t1, t2).select("hl_tp_percent", "hl_tp_mean", "hl_tn_percent", "hl_tn_mean")


def confidence_lt(df: DataFrame, t1: float = 0.4, t2: float = 0.4) -> DataFrame:
    """Of those, the rows called lower than the book."""
    return confidence_metrics(df, t1, t2).select("lt_tp_percent", "lt_tn_percent")


def confidence_hs(df: DataFrame, t1: float = 0.4, t2: float = 0.4) -> DataFrame:
    """Of those, the rows called higher than the book."""
    return confidence_metrics(df, t1, t2).select("hs_tp_percent", "hs_tn_percent")


def _bin_rows(row: DataFrame, side: str) -> DataFrame:
    frames = [
        row.select(F.lit(model).alias("model"), F.explode(f"{model}_{side}_bins").alias("bin_start", "percent"))
        for model in ("oos", "hl")
    ]
    return frames[0].unionByName(frames[1]).select("model", F.col("bin_start").cast("double").alias("bin_start"), "percent")


def tp_probability_bins(df: DataFrame, t1: float = 0.4, t2: float = 0.4, close_last: bool = False) -> DataFrame:
    """Share of the true positives in each probability bin from the cut-off up, as rows."""
    return _bin_rows(confidence_metrics(df, t1, t2, close_last), "tp")


def tn_probability_bins(df: DataFrame, t1: float = 0.4, t2: float = 0.4) -> DataFrame:
    """Share of the true negatives in each probability bin below the cut-off, as rows."""
    return _bin_rows(confidence_metrics(df, t1, t2), "tn")


def confidence_document(metrics: DataFrame) -> DataFrame:
    """Nest the flat confidence row into the published document: one struct per section."""
    return metrics.select(
        *[F.struct(*[F.col(c).alias(field) for field, c in fields.items()]).alias(section)
          for section, fields in CONFIDENCE_DOCUMENT.items()]
    )


def document_schema() -> T.StructType:
    def field(name: str, column: str) -> T.StructField:
        kind = T.MapType(T.StringType(), T.DoubleType()) if column.endswith("_bins") else T.DoubleType()
        return T.StructField(name, kind)

    return T.StructType(
        [T.StructField(section, T.StructType([field(n, c) for n, c in fields.items()]))
         for section, fields in CONFIDENCE_DOCUMENT.items()]
    )


def flatten_document(document: DataFrame) -> DataFrame:
    """The flat row behind a stored confidence document."""
    return document.select(
        *[F.col(f"{section}.{field}").alias(c)
          for section, fields in CONFIDENCE_DOCUMENT.items() for field, c in fields.items()]
    )


@dataclass(frozen=True)
class SideStats:
    """What is known of one side of a model's scores: share of right calls, their mean score, shares by bin."""

    share: float
    mean: float | None = None
    bins: Mapping[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class ModelStats:
    """Statistics of a model above and below its cut-off."""

    above: SideStats
    below: SideStats
    cut: float | None = None


def stats_of(row: Mapping, model: str, cut: float | None = None) -> ModelStats:
    """The statistics of one model in the flat confidence row."""
    def side(kind: str) -> SideStats:
        held = {"mean": row[f"{model}_{kind}_mean"], "bins": row[f"{model}_{kind}_bins"]} if cut is not None else {}
        return SideStats(row[f"{model}_{kind}_percent"], **held)

    return ModelStats(side("tp"), side("tn"), cut)


def confidence_rule(first: ModelStats, second: ModelStats, lower: ModelStats, higher: ModelStats) -> Column:
    """HIGH / MEDIUM / LOW from how extreme and how usual the deciding model's score is.

    The out-of-stock classifier decides above its cut-off, the higher/lower classifier below it. A score is
    extreme when it is at least as far out as the mean of its side, and usual when its bin holds at least an
    even share of that side. Both: HIGH, one: MEDIUM, none or no bin at all: LOW. Below the cut-off HIGH also
    needs the quantity model that answered to lean to the same side; otherwise it is MEDIUM.
    """
    out_side = F.col(OOS) == 1

    def share(score: Column, bins: Bins, shares: Mapping[str, float]) -> Column:
        """Share of the bin holding the score: one comparison per edge, from the top down."""
        ladder, above = [], None
        for start, end, _ in sorted(bins, reverse=True):
            if end != above:
                ladder.append((end, None))
            ladder.append((start, shares.get(str(start))))
            above = start
        value = F.lit(None).cast("double")
        for edge, held in reversed(ladder):
            value = F.when(score >= F.lit(edge), F.lit(held).cast("double")).otherwise(value)
        return value

    def level(score: Column, model: ModelStats, lean: Column) -> Column:
        """Every part appears once in the expression, which keeps the generated code small enough to compile.

        Points: 1 for extreme, 2 for usual, 4 for leaning the same way; negative when no bin holds the score.
        """
        above, below = model.above, model.below
        even = [100.0 / max(len(side.bins), 1) for side in (above, below)]
        usual = F.when(out_side, share(score, upper_bins(model.cut), above.bins) >= F.lit(even[0])).otherwise(
            share(score, lower_bins(model.cut), below.bins) >= F.lit(even[1])
        )
        extreme = F.when(out_side, score >= F.lit(float(above.mean))).otherwise(score <= F.lit(float(below.mean)))
        points = (
            F.coalesce(usual.cast("int") * 2, F.lit(-8)) + extreme.cast("int") + lean.cast("int") * 4
        )
        verdicts = ["LOW", "MEDIUM", "MEDIUM", "MEDIUM", "LOW", "MEDIUM", "MEDIUM", "HIGH"]
        return F.coalesce(F.get(F.array(*map(F.lit, verdicts)), points), F.lit("LOW"))

    def leaning(model: ModelStats) -> Column:
        return F.when(out_side, F.lit(model.above.share >= model.below.share)).otherwise(
            F.lit(model.above.share <= model.below.share)
        )

    lean = (
        F.when(F.col(LT_OUT).isNotNull(), leaning(lower))
        .when(F.col(GT_OUT).isNotNull(), leaning(higher))
        .otherwise(F.lit(False))
    )
    by_first, by_second = level(F.col(BINARY_PRED), first, F.lit(True)), level(F.col(HL_ORIG_PRED), second, lean)
    return F.when(F.col(BINARY_PRED) > F.lit(float(first.cut)), by_first).otherwise(by_second)


def with_confidence(
    predicted: DataFrame,
    metrics: DataFrame | Mapping,
    t1: float = 0.4,
    t2: float = 0.4,
    rule: Callable[..., Column] = confidence_rule,
) -> DataFrame:
    """Append ``confidence_level``. ``metrics`` is the flat confidence row (one row, read into literals)."""
    m = metrics.first().asDict() if isinstance(metrics, DataFrame) else dict(metrics)
    level = rule(stats_of(m, "oos", t1), stats_of(m, "hl", t2), stats_of(m, "lt"), stats_of(m, "hs"))
    return mask_outputs(predicted, t1, t2).withColumn(CONFIDENCE_LEVEL, level)
