"""Champion / challenger decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHAMPION, CHALLENGER = "champion", "challenger"


def champion_challenger(scores: DataFrame, compare: bool = True) -> DataFrame:
    """One decision row from ``(role, run_id, overall_score)``.

    The challenger is promoted when it scores strictly higher, or always when no comparison is asked for. A score that
    the decision needs and that is missing is an error: of both runs, or of the challenger alone without comparison.
    """
    def of(role: str, column: str):
        return F.max(F.when(F.col("role") == role, F.col(column)))

    row = scores.agg(
        of(CHAMPION, "overall_score").alias("champion_score"),
        of(CHALLENGER, "overall_score").alias("challenger_score"),
        of(CHAMPION, "run_id").alias("champion_run"),
        of(CHALLENGER, "run_id").alias("challenger_run"),
    )
    needed = [CHALLENGER, CHAMPION] if compare else [CHALLENGER]
    promote = F.col("challenger_score") > F.col("champion_score") if compare else F.lit(True)
    for role in needed:
        missing = F.col(f"{role}_score").isNull() | F.col(f"{role}_run").isNull()
        promote = F.when(missing, F.raise_error(F.lit(f"no score of a {role}")).cast("boolean")).otherwise(promote)
    return row.select(
        "champion_score",
        "challenger_score",
        promote.cast("int").cast("long").alias("promote"),
        F.when(promote, F.col("challenger_run")).otherwise(F.col("champion_run")).alias("production_run"),
    )
