"""Feature/target join and the time-ordered train / validation / test split."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.names import DATA_SPLIT, DATE, KEYS, LOAD_DATE, LOCATION_GROUP, SERIES
from shelfspark.sources.scratch import scratch_path

# Bookkeeping columns that are dropped before joining.
FEATURE_BOOKKEEPING = [LOCATION_GROUP, LOAD_DATE]
TARGET_BOOKKEEPING = [LOCATION_GROUP, LOAD_DATE, "year_audit_day_flag"]

# Split fractions and the shortest series of a historical and of an incremental run.
TRAIN_TEST_FRACTION = 0.9
TRAIN_VALIDATION_FRACTION = 0.9
MIN_ROWS_HISTORICAL = 270
MIN_ROWS_INCREMENTAL = 10

# Rows of one series that are joined with its cuts, or put in order, in one place.
PART_ROWS = 250_000
# Rows of gathered series that one task puts in order, and the fewest that are worth a task.
TASK_ROWS, LEAST_ROWS = 500_000, 50_000


def drop_partition_columns(df: DataFrame, columns: Sequence[str] = FEATURE_BOOKKEEPING) -> DataFrame:
    return df.drop(*columns)


def filter_train_start(df: DataFrame, start: str | None, date: str = DATE) -> DataFrame:
    return df if start is None else df.where(F.col(date) >= F.lit(start).cast("date"))


def filter_incremental_load(df: DataFrame, last_train_date: str | None) -> DataFrame:
    """Only loads after the last training run; a partition predicate, so older loads are not even listed."""
    return df if last_train_date is None else df.where(F.col(LOAD_DATE) > F.lit(last_train_date))


def filter_as_of_date(df: DataFrame, current: str | None, date: str = DATE) -> DataFrame:
    """Applied after the split, so later rows still shift the fractions."""
    return df if current is None else df.where(F.col(date) <= F.lit(current).cast("date"))


def optional_audit_filter(df: DataFrame, flag: str = "audit_day_flag") -> DataFrame:
    return df.where(F.col(flag) == 1)


def join_target_feature(target: DataFrame, feature: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return target.join(feature, list(keys), "inner")


def series_eligibility(
    df: DataFrame,
    start: str,
    flags: Sequence[str] = ("neg_cc_flag", "sales_flag", "transfer_flag"),
    series: Sequence[str] = SERIES,
    date: str = DATE,
) -> DataFrame:
    """Series that began by ``start`` and show every flag at least once, with the sums that decided it."""
    sums = {f: f"{f}_sum" for f in flags}
    grouped = df.groupBy(*series).agg(
        *[F.sum(f).cast("long").alias(name) for f, name in sums.items()], F.min(date).alias("min_date")
    )
    began = F.col("min_date") <= F.lit(start).cast("date")
    return grouped.where(reduce(lambda a, b: a & b, [F.col(name) > 0 for name in sums.values()], began))


def join_eligible_series(df: DataFrame, eligible: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    return df.join(eligible.select(*series), list(series), "left_semi")


def time_split(
    df: DataFrame,
    series: Sequence[str] = SERIES,
    date: str = DATE,
    ties: Sequence[str] = (),
    targets: Sequence[str] = (),
    train_test_frac: float = TRAIN_TEST_FRACTION,
    train_validation_frac: float = TRAIN_VALIDATION_FRACTION,
    min_rows: int = MIN_ROWS_HISTORICAL,
    short: str = "drop",
    gather: bool = False,
) -> DataFrame:
    """Label the rows of every series train / validation / test in ``(date, *ties)`` order.

    Of n rows the first ``floor(floor(n * train_test_frac) * train_validation_frac)`` are train, the rest of
    the first ``floor(n * train_test_frac)`` validation, the others test. Rows equal in the whole order take
    the label of their first position. NULLs come first in every part of the order, and rows whose series key holds a
    NULL are a series like others. Rows without a target are left out; series shorter than ``min_rows`` are dropped,
    or all train with ``short="train"``.

    Unless gathered, no series is ever sorted as a whole. A series needs only the two order values at which its label
    changes. Those come from row counts per (series, date), then, where a cut falls inside one date, from row
    counts per tie value of just that date. The cuts, one row per series, are stored below the scratch folder and joined
    back: Spark then knows their size beforehand, so a small table of cuts is broadcast and no row is moved. Where it is
    too large for that, rows of a series of more than ``PART_ROWS`` are spread over as many parts, with the cuts repeated
    for each, so no task reads a whole hot series; the list of such series is broadcast, with at most one row for every
    ``PART_ROWS`` rows.

    That pays where series are few and long. Of many short ones the cuts are nearly as many as the dates, and rows are moved
    and sorted for each step. With ``gather`` the series of at most ``PART_ROWS`` rows are moved together once, some
    ``TASK_ROWS`` rows to a task, and put in order there; only longer ones are labelled by their cuts.
    """
    if short not in ("drop", "train"):
        raise ValueError("short must be 'drop' or 'train'")
    series, ties = list(series), list(ties)
    rows = df.dropna(subset=list(targets)) if targets else df
    if gather:
        order, fracs = [date, *ties], (train_test_frac, train_validation_frac)
        return _gathered(rows, series, order, fracs, min_rows, short, lambda hot: time_split(
            hot, series, date, ties, (), *fracs, min_rows, short
        ))

    # Structs compare field by field with nulls first and equal, which plain columns would not; and all ties are one
    # level, so the plan does not grow with their number.
    packed = {"_s": F.struct(*series), "_o0": F.struct(date)} | ({"_o1": F.struct(*ties)} if ties else {})
    rows = rows.withColumns(packed)
    key, order = ["_s"], [c for c in packed if c != "_s"]
    cuts = _stored(_first_cuts(rows, series, date, train_test_frac, train_validation_frac), "first-cuts")
    cuts = cuts.where(F.col("_n") >= min_rows) if short == "drop" else cuts
    if ties:
        cuts = _refine(rows, cuts, key, order[:1], order[1])
    levels = range(len(order))
    wide = cuts.groupBy(*key).agg(
        F.max("_n").alias("_n"),
        *[F.max(F.when(F.col("_mark") == m, F.col(f"_cut_{i}"))).alias(f"_{m}_{i}") for m in _MARKS for i in levels],
    )
    parts = F.greatest(F.ceil(F.col("_n") / F.lit(PART_ROWS)), F.lit(1).cast("long"))
    wide = _stored(wide.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))), "cuts")

    def upto_cut(mark: str) -> Column:
        """(date, *ties) <= cut; a level at which the cut is NULL was not split and is taken whole."""
        cond = F.lit(True)
        for level in reversed(levels):
            value, cut = F.col(order[level]), F.col(f"_{mark}_{level}")
            here = (value < cut) | ((value == cut) & cond)
            cond = here if level == 0 else F.when(cut.isNull(), F.lit(True)).otherwise(here)
        return F.coalesce(cond, F.lit(False))

    label = F.when(upto_cut("tr"), "train").when(upto_cut("tv"), "validation").otherwise("test")
    if short == "train":
        label = F.when(F.col("_n") < min_rows, "train").otherwise(label)
    helper = [c for c in wide.columns if c.startswith("_")]
    hot = wide.where(F.col("_n") > PART_ROWS).groupBy(*key).agg(F.count(F.lit(1)).alias("_of"))
    place = F.pmod(F.xxhash64(*order), F.coalesce(F.col("_of"), F.lit(1).cast("long")))
    placed = rows.join(F.broadcast(hot), key, "left").withColumn("_part", place)
    return placed.join(wide, [*key, "_part"], "inner").withColumn(DATA_SPLIT, label).drop(*helper, *packed, "_of")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _gathered(
    rows: DataFrame,
    series: list[str],
    order: list[str],
    fracs: tuple[float, float],
    min_rows: int,
    short: str,
    by_cuts: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Rows of series of at most ``PART_ROWS`` labelled by their rank, the others ``by_cuts``."""
    keys = [f"_s{i}" for i in range(len(series))]
    sizes = rows.groupBy(*[F.col(c).alias(k) for c, k in zip(series, keys, strict=True)]).agg(F.count(F.lit(1)).alias("_n"))
    sizes = _stored(sizes, "sizes")
    hot = F.col("_n") > PART_ROWS
    cold_rows, n_hot = sizes.agg(F.sum(F.when(~hot, F.col("_n")).otherwise(0)), F.count_if(hot)).first()
    long = F.broadcast(sizes.where(hot).select(*keys))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(series, keys, strict=True)])
    cold = rows.join(long, same, "left_anti") if n_hot else rows

    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-(cold_rows or 0) // TASK_ROWS), min(cores, -(-(cold_rows or 0) // LEAST_ROWS)), 1)
    ordered = Window.partitionBy(*series).orderBy(*order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = cold.repartition(tasks, *series).withColumns(
        {"_at": F.rank().over(ordered), "_n": F.count(F.lit(1)).over(whole)}
    )
    tv = F.floor(F.col("_n") * F.lit(fracs[0]))
    label = F.when(F.col("_at") <= F.floor(tv * F.lit(fracs[1])), "train").when(F.col("_at") <= tv, "validation").otherwise("test")
    if short == "train":
        label = F.when(F.col("_n") < min_rows, "train").otherwise(label)
    else:
        placed = placed.where(F.col("_n") >= min_rows)
    labelled = placed.withColumn(DATA_SPLIT, label).drop("_at", "_n")
    return labelled.unionByName(by_cuts(rows.join(long, same, "left_semi"))) if n_hot else labelled


_MARKS = ("tr", "tv")


def _counted_off(counted: DataFrame, group: list[str], order: str) -> DataFrame:
    """Add how many rows of the group lie up to and before each order value (``_c`` rows share a value)."""
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("_end", F.sum("_c").over(upto)).withColumn("_start", F.col("_end") - F.col("_c"))


def _holds(position: str) -> Column:
    return (F.col("_start") < F.col(position)) & (F.col(position) <= F.col("_end"))


def _first_cuts(rows: DataFrame, series: list[str], date: str, tv_frac: float, tr_frac: float) -> DataFrame:
    """Per series and mark: the date its last row falls on, how far into that date, and the rows on that date.

    Groups and windows take NULLs as equal and put them first in plain columns too, which are sorted faster than structs.
    """
    flat = [f"_s{i}" for i in range(len(series))]
    named = [F.col(c).alias(name) for c, name in zip([*series, date], [*flat, "_d"], strict=True)]
    per_date = rows.select(*named).groupBy(*flat, "_d").agg(F.count(F.lit(1)).alias("_c"))
    placed = (
        _counted_off(per_date, flat, "_d")
        .withColumn("_n", F.sum("_c").over(Window.partitionBy(*flat)))
        .withColumn("_tv", F.floor(F.col("_n") * F.lit(tv_frac)))
        .withColumn("_tr", F.floor(F.col("_tv") * F.lit(tr_frac)))
    )
    cell = F.struct(F.struct(F.col("_d").alias(date)).alias("cut"), F.col("_start").alias("before"), F.col("_c").alias("size"))
    # The cells a cut falls on, and each series' first one, without which a series too short for a cut would be lost.
    telling = placed.where(_holds("_tv") | _holds("_tr") | (F.col("_start") == 0))
    per_series = telling.groupBy(*flat).agg(
        F.max("_n").alias("_n"),
        *[F.struct(F.max(f"_{m}").alias("position"), F.max(F.when(_holds(f"_{m}"), cell)).alias("cell")).alias(m)
          for m in _MARKS],
    )
    marks = F.explode(F.array(*[F.struct(F.lit(m).alias("mark"), F.col(m).alias("at")) for m in _MARKS]))
    packed = F.struct(*[F.col(name).alias(c) for c, name in zip(series, flat, strict=True)])
    return per_series.select(packed.alias("_s"), "_n", marks.alias("_m")).select(
        "_s",
        "_n",
        F.col("_m.mark").alias("_mark"),
        F.col("_m.at.cell.cut").alias("_cut_0"),
        (F.col("_m.at.position") - F.col("_m.at.cell.before")).alias("_left"),
        F.col("_m.at.cell.size").alias("_size"),
    )


def _near_cut(counted: DataFrame, group: list[str], order: str) -> DataFrame:
    """Of each group's counted values, those in the range partition that holds ``_left``, and the rows before.

    A group with very many values spans several range partitions; only one row per partition is put in order
    to find the right one. It is named by its value range, so a recomputed sample cannot mislead.
    """
    parts = (
        counted.repartitionByRange(*group, order)
        .groupBy(F.spark_partition_id().alias("_part"), *group, "_left")
        .agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"), F.sum("_c").alias("_c"))
    )
    holding = _counted_off(parts, group, "_lo").where(_holds("_left")).select(
        *group, "_lo", "_hi", F.col("_start").alias("_before")
    )
    return counted.join(holding, group, "inner").where(F.col(order).between(F.col("_lo"), F.col("_hi")))


def _refine(rows: DataFrame, cuts: DataFrame, series: list[str], fixed: list[str], tie: str) -> DataFrame:
    """Locate the cuts inside the cells they fell into: the tie value at the remaining position.

    Only cells a cut really divides are read again, counted per tie value before they are put in order; the counts are read
    several times and therefore stored.
    """
    depth = len(fixed)
    cell = [f"_cut_{level}" for level in range(depth)]
    group = [*series, "_mark"]
    divided = cuts.where(F.col("_left") < F.col("_size")).select(*group, *cell, "_left")
    inside = (
        rows.select(*series, *fixed, tie)
        .withColumnsRenamed(dict(zip(fixed, cell)))
        .join(divided, [*series, *cell], "inner")
        .groupBy(*group, "_left", tie)
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    inside = _stored(inside, "inside")
    found = (
        _counted_off(_near_cut(inside, group, tie), group, tie)
        .withColumns({"_end": F.col("_end") + F.col("_before"), "_start": F.col("_start") + F.col("_before")})
        .where(_holds("_left"))
        .select(
            *group,
            F.col(tie).alias(f"_cut_{depth}"),
            (F.col("_left") - F.col("_start")).alias("_next_left"),
            F.col("_c").alias("_next_size"),
        )
    )
    # A cell that was not divided ends at its last row: nothing is left to locate inside it.
    return cuts.drop("_left", "_size").join(found, group, "left").withColumnsRenamed(
        {"_next_left": "_left", "_next_size": "_size"}
    )


def filter_train_rows(labelled: DataFrame) -> DataFrame:
    """What models are fitted on."""
    return labelled.where(F.col(DATA_SPLIT) == "train").drop(DATA_SPLIT)
