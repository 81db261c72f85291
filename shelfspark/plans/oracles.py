"""The same queries as SQL text, written from the definitions and not from the Spark plans.

Rounding is scale, round half to even, scale back. Literals are doubles (``0.4E0``) in both engines.
"""

from __future__ import annotations

from shelfspark import names as N
from shelfspark.plans.catalog import (
    AS_OF,
    COUNTS_FROM,
    DAY,
    ELIGIBLE_START,
    HL_GRID,
    LAST_TRAIN,
    OOS_GRID,
    TRAIN_START,
)
from shelfspark.plans.models import SHAPES, tree_nodes
from shelfspark.plans.panel import FEATURES, TARGETS

KEYS = "sku, location, date"
LONGS = [N.TARGET_OOS, N.IP_QTY, N.CURDAY_QTY, N.REV_QTY, N.TOTAL_RETAIL, N.TARGET_HL]


def rnd(x: str, n: int = 2) -> str:
    scale = f"{10**n}.0::DOUBLE"
    return f"(round_even(({x})*{scale}, 0)/{scale})"


def pct(num: str, den: str, default: str = "0.0::DOUBLE") -> str:
    share = rnd(f"({num})::DOUBLE/({den})::DOUBLE*100.0::DOUBLE")
    return f"CASE WHEN ({den}) > 0 THEN {share} ELSE {default} END"


PANEL = """
k AS (
  SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS d,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
  FROM lineitem GROUP BY l_partkey, l_suppkey, CAST(l_shipdate AS DATE)),
h AS (SELECT *, CAST(year(d)*372 + month(d)*31 + day(d) AS BIGINT) AS dn FROM k),
g AS (SELECT *, (l_partkey*7919 + l_suppkey*104729 + dn*31) % 1000 AS h1,
                (l_partkey*6151 + l_suppkey*15485  + dn*17) % 1000 AS h2,
                (l_partkey*3571 + l_suppkey*2741   + dn*13) % 1000 AS h3 FROM h),
q AS (SELECT *, (h2*3 + h1) % 40 AS curday, (h3*11 + h2) % 40 - 8 AS rev FROM g),
panel AS (
  SELECT CAST(l_partkey AS VARCHAR) AS sku, CAST(l_suppkey AS VARCHAR) AS location, d AS date,
         CAST(l_suppkey % 4 AS VARCHAR) AS location_group,
         strftime(date_trunc('month', d), '%Y-%m-%d') AS load_date, dn, qty AS total_retail,
         h1/1000.0E0 AS binary_pred, h2/1000.0E0 AS hl_orig_pred,
         h3*2/1000.0E0 AS ls_ratio, h3*60/1000.0E0 AS hs_pred,
         (h1*7 + h2) % 40 - 3 AS ip_qty_eop_soh, curday AS curday_ip_qty_eop_soh, rev AS rev_ip_qty_eop_soh,
         CAST(CASE WHEN rev <= 0 THEN 1 ELSE 0 END AS BIGINT) AS binary_target_classification,
         CAST(CASE WHEN rev < curday THEN 1 ELSE 0 END AS BIGINT) AS binary_hl_target_classification,
         CASE WHEN curday > 0 THEN rev::DOUBLE/curday::DOUBLE ELSE 0.0::DOUBLE END AS target_regression,
         rev::DOUBLE AS h_rev_target_ratio,
         h1 % 2 AS neg_cc_flag, h2 % 2 AS sales_flag, h3 % 2 AS transfer_flag
  FROM q)"""


def band(source: str, name: str) -> str:
    """CTEs that end in ``name``: the source plus orig_pred_temp/low/high, rule after rule."""
    return f"""
{name}_t AS (SELECT *, {rnd('orig_pred')} AS orig_pred_temp FROM {source}),
{name}_0 AS (SELECT *, round_even(orig_pred_temp - orig_pred_temp*0.15E0, 0) AS lo0,
                       round_even(orig_pred_temp + orig_pred_temp*0.15E0, 0) AS hi0 FROM {name}_t),
{name}_1 AS (SELECT *, CASE WHEN lo0 = hi0 THEN lo0 - 2 ELSE lo0 END AS lo1 FROM {name}_0),
{name}_2 AS (SELECT *, CASE WHEN hi0 - lo1 = 1 THEN lo1 - 1 ELSE lo1 END AS lo2 FROM {name}_1),
{name} AS (SELECT *, CASE WHEN lo2 < 0 THEN 0.0E0 ELSE lo2 + 0.0E0 END AS orig_pred_low,
                     CASE WHEN lo2 < 0 THEN hi0 + 1 ELSE hi0 + 0.0E0 END AS orig_pred_high FROM {name}_2)"""


def predicted(source: str = "panel", name: str = "pred", t1: str = "0.4E0", t2: str = "0.4E0") -> str:
    """CTEs of the cascade: one SELECT per branch, stacked."""
    keep = ("* EXCLUDE (ls_ratio, hs_pred, hl_orig_pred)")
    return f"""
{name}_q AS (
  SELECT {keep}, hl_orig_pred, 'ls' AS branch, ls_ratio*curday_ip_qty_eop_soh AS orig_pred FROM {source}
  WHERE binary_pred <= {t1} AND hl_orig_pred > {t2}
  UNION ALL
  SELECT {keep}, hl_orig_pred, 'hs' AS branch, hs_pred AS orig_pred FROM {source}
  WHERE binary_pred <= {t1} AND hl_orig_pred <= {t2}),
{band(f'{name}_q', f'{name}_b')},
{name}_all AS (
  SELECT * EXCLUDE (lo0, hi0, lo1, lo2) FROM {name}_b
  UNION ALL BY NAME
  SELECT {keep}, 'oos' AS branch, 0.0E0 AS orig_pred, 0.0E0 AS orig_pred_low, 0.0E0 AS orig_pred_high
  FROM {source} WHERE binary_pred > {t1}),
{name} AS (SELECT *, CAST(CASE WHEN orig_pred_low = 0 THEN 1 ELSE 0 END AS BIGINT) AS oos FROM {name}_all)"""


STEPS = f""",
s3_q AS (SELECT *, ls_ratio*curday_ip_qty_eop_soh AS orig_pred FROM panel),
{band('s3_q', 's3_b')},
s4_q AS (SELECT *, hs_pred AS orig_pred FROM panel),
{band('s4_q', 's4_b')},
step_1 AS (SELECT {', '.join(N.STEP_COLUMNS['step_1'])} FROM panel),
step_2 AS (SELECT {', '.join(N.STEP_COLUMNS['step_2'])} FROM panel),
step_3 AS (SELECT {', '.join(N.STEP_COLUMNS['step_3'])} FROM s3_b),
step_4 AS (SELECT {', '.join(N.STEP_COLUMNS['step_4'])} FROM s4_b)"""

AUDIT = """,
audit AS (SELECT sku, location, CASE WHEN dn % 3 = 0 THEN date ELSE date + 40000 END AS date, binary_target_classification AS actual_oos_flag, rev_ip_qty_eop_soh,
                 curday_ip_qty_eop_soh, ip_qty_eop_soh, total_retail FROM panel),
audited AS (SELECT a.*, p.orig_pred_low, p.orig_pred_high, p.oos FROM audit a JOIN pred p
            ON a.sku = p.sku AND a.location = p.location AND a.date = p.date)"""


def from_panel(body: str) -> str:
    return f"WITH {PANEL} {body}"


def from_pred(body: str, t1: str = "0.4E0", t2: str = "0.4E0") -> str:
    return f"WITH {PANEL}, {predicted(t1=t1, t2=t2)} {body}"


def count_if(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


def stock_counts(source: str) -> str:
    rev, low = "rev_ip_qty_eop_soh", "orig_pred_low"
    return f"""SELECT {count_if(f'{rev} <= 0 AND {low} <= 0')} AS tp, {count_if(f'{rev} <= 0 AND {low} > 0')} AS fn,
       {count_if(f'{rev} > 0 AND {low} > 0')} AS tn, {count_if(f'{rev} > 0 AND {low} <= 0')} AS fp FROM {source}"""


def flag_counts(source: str, actual: str, predicted_flag: str) -> str:
    a, p = actual, predicted_flag
    return f"""SELECT {count_if(f'{a} = 1 AND {p} = 1')} AS tp, {count_if(f'{a} = 1 AND {p} = 0')} AS fn,
       {count_if(f'{a} = 0 AND {p} = 0')} AS tn, {count_if(f'{a} = 0 AND {p} = 1')} AS fp FROM {source}"""


def rates(source: str, extra: str = "*", out: str = "rated") -> str:
    """CTEs that end in ``out``: eight rates next to the counts of ``source``."""
    f1 = rnd("2.0::DOUBLE*(\"precision\"*recall/(\"precision\"+recall))")
    return f"""
{out}_0 AS (SELECT {extra}, {pct('tp', 'tp+fn')} AS tp_percent, {pct('fn', 'tp+fn')} AS fn_percent,
  {pct('tn', 'tn+fp')} AS tn_percent, {pct('fp', 'tn+fp')} AS fp_percent, {pct('tp', 'tp+fp')} AS "precision",
  {pct('tp', 'tp+fn')} AS recall, {pct('tp+tn', 'tp+tn+fp+fn')} AS accuracy FROM {source}),
{out} AS (SELECT *, CASE WHEN "precision"+recall > 0 THEN {f1} ELSE 0.0::DOUBLE END AS f1_score FROM {out}_0)"""


RATES = 'tp_percent, fn_percent, tn_percent, fp_percent, "precision", recall, f1_score, accuracy'


def business(source: str, actual: str, empty: str) -> str:
    """One SELECT list over ``source``: under/over stock, book comparison, revenue."""
    rev, book, low, high = "rev_ip_qty_eop_soh", "curday_ip_qty_eop_soh", "orig_pred_low", "orig_pred_high"
    inside = f"{low} <= {rev} AND {high} >= {rev}"
    ip = "ip_qty_eop_soh"

    def retail(cond: str) -> str:
        return f"CAST(coalesce(sum(total_retail) FILTER (WHERE {cond}), 0) AS BIGINT)"

    under, over = count_if(f"{rev} <= {book}"), count_if(f"{rev} > {book}")
    miss = f"{actual} = 1"
    return f"""{pct(count_if(f'{rev} <= {book} AND {inside}'), under, empty)} AS understock_accurate,
  {pct(count_if(f'{rev} <= {book} AND {low} <= {book}'), under, empty)} AS understock_overall,
  {pct(count_if(f'{rev} > {book} AND {inside}'), over, empty)} AS overstock_accurate,
  {pct(count_if(f'{rev} > {book} AND {high} > {book}'), over, empty)} AS overstock_overall,
  {pct(count_if(f'{miss} AND {low} <= 0 AND {ip} <= 0'), 'count(*)', 'NULL')} AS br_pr_percent,
  {pct(count_if(f'{miss} AND {low} > 0 AND {ip} <= 0'), 'count(*)', 'NULL')} AS br_pw_percent,
  {pct(count_if(f'{miss} AND {low} <= 0 AND {ip} > 0'), 'count(*)', 'NULL')} AS bw_pr_percent,
  {retail(f'{miss} AND {low} <= 0 AND {ip} <= 0')} AS br_pr_value,
  {retail(f'{miss} AND {low} <= 0 AND {ip} > 0')} AS revenue_recovery,
  {retail(f'{miss} AND {low} > 0')} AS model_loss,
  {retail(f'{miss} AND {low} > 0 AND {ip} <= 0')} AS book_recoverable_loss,
  {under} AS under_rows, {over} AS over_rows"""


def business_only(source: str, columns: str, actual: str = "binary_target_classification", empty: str = "0.0::DOUBLE") -> str:
    return f", biz AS (SELECT {business(source, actual, empty)} FROM {source}) SELECT {columns} FROM biz"


def auc(source: str, target: str, score: str, where: str = "true") -> str:
    """Expression query for the AUC over tied scores."""
    return f"""(SELECT {rnd('sum(pos*(below + neg/2.0::DOUBLE))/(sum(pos)::DOUBLE*sum(neg)::DOUBLE)', 3)} FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below
  FROM (SELECT {score} AS s, sum({target})::DOUBLE AS pos, sum(1-{target})::DOUBLE AS neg FROM {source} WHERE {where} GROUP BY 1)))"""


def errors(source: str, target: str, score: str, prefix: str = "") -> str:
    e = f"({target} - {score})"
    r2 = f"1 - sum({e}*{e})/(var_pop({target})*count(*))"
    return f"""{rnd(r2, 3)} AS "{prefix}r2", {rnd(f'avg({e}*{e})', 3)} AS "{prefix}mean_squared_error",
  {rnd(f'avg(abs({e}))', 3)} AS "{prefix}mean_absolute_error", {rnd(f'median(abs({e}))', 3)} AS "{prefix}median_absolute_error"
  FROM {source}"""


# Bin edges around the cut-offs used below.
UPPER_04 = [0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
LOWER_04 = [0.0, 0.1, 0.2, 0.3]
BINS = {
    ("tp", 0.4): list(zip(UPPER_04, UPPER_04[1:])),
    ("tn", 0.4): [(0.0, 0.1), (0.1, 0.2), (0.2, 0.3), (0.3, 0.4)],
    ("tp", 0.45): [(0.45, 0.6), (0.6, 0.7), (0.7, 0.8), (0.8, 0.9)],
    ("tn", 0.45): [(0.0, 0.1), (0.1, 0.2), (0.2, 0.3), (0.3, 0.4)],
    ("tp", 0.35): [(0.35, 0.4), (0.4, 0.5), (0.5, 0.6), (0.6, 0.7), (0.7, 0.8), (0.8, 0.9)],
    ("tn", 0.35): [(0.0, 0.1), (0.1, 0.2), (0.2, 0.3)],
}


def side_conditions(t1: float) -> dict[str, str]:
    t = f"{t1}E0"
    return {
        "oos_tp": f"binary_pred >= {t} AND binary_target_classification = 1",
        "oos_tn": f"binary_pred < {t} AND binary_target_classification = 0",
        "hl_tp": f"binary_pred < {t} AND orig_pred_low = 0 AND binary_target_classification = 1",
        "hl_tn": f"binary_pred < {t} AND orig_pred_low > 0 AND binary_target_classification = 0",
    }


def bin_rows(side: str, t1: float, t2: float) -> str:
    parts = []
    for model, score, t in (("oos", "binary_pred", t1), ("hl", "hl_orig_pred", t2)):
        cond = side_conditions(t1)[f"{model}_{side}"]
        for lo, hi in BINS[side, t]:
            inside = count_if(f"{cond} AND {score} >= {lo}E0 AND {score} < {hi}E0")
            parts.append(f"SELECT '{model}' AS model, {lo}::DOUBLE AS bin_start, {pct(inside, count_if(cond))} AS percent FROM pred")
    return "\nUNION ALL ".join(parts)


def confidence_cte(t1: float = 0.4, t2: float = 0.4) -> str:
    sides = side_conditions(t1)
    cols = []
    for side, cond in sides.items():
        model = side[: side.index("_")]
        score = "binary_pred" if model == "oos" else "hl_orig_pred"
        of = "count(*)" if model == "oos" else count_if(f"binary_pred < {t1}E0")
        n = count_if(cond)
        cols.append(f"{pct(n, of)} AS {side}_percent")
        mean = rnd(f"coalesce(sum({score}) FILTER (WHERE {cond}), 0)/({n})::DOUBLE")
        cols.append(f"CASE WHEN {n} > 0 THEN {mean} ELSE 0.0::DOUBLE END AS {side}_mean")
    for model, cmp in (("lt", ">="), ("hs", "<")):
        part = f"binary_pred < {t1}E0 AND hl_orig_pred {cmp} {t2}E0"
        for side, low, y in (("tp", "= 0", 1), ("tn", "> 0", 0)):
            hit = count_if(f"{part} AND orig_pred_low {low} AND binary_target_classification = {y}")
            cols.append(f"{pct(hit, count_if(part))} AS {model}_{side}_percent")
    return "conf AS (SELECT " + ",\n  ".join(cols) + " FROM pred)"


def confident() -> str:
    """CTEs that end in ``confident``: the prediction with its confidence level."""
    def table(side: str) -> str:
        return f"bins_{side} AS ({bin_rows(side, 0.4, 0.4)})"

    def share(model: str, side: str, score: str) -> str:
        whens = " ".join(
            f"WHEN {score} >= {lo}E0 AND {score} < {hi}E0 THEN "
            f"(SELECT percent FROM bins_{side} WHERE model = '{model}' AND bin_start = {lo}::DOUBLE)"
            for lo, hi in BINS[side, 0.4]
        )
        return f"CASE {whens} END"

    return f"""{confidence_cte()}, {table('tp')}, {table('tn')},
judged AS (
  SELECT p.*, c.lt_tp_percent, c.lt_tn_percent, c.hs_tp_percent, c.hs_tn_percent,
    CASE WHEN binary_pred > 0.4E0
         THEN CASE WHEN oos = 1 THEN {share('oos', 'tp', 'binary_pred')} ELSE {share('oos', 'tn', 'binary_pred')} END
         ELSE CASE WHEN oos = 1 THEN {share('hl', 'tp', 'hl_orig_pred')} ELSE {share('hl', 'tn', 'hl_orig_pred')} END
    END AS share,
    CASE WHEN oos = 1 THEN 100.0E0/6.0E0 ELSE 100.0E0/4.0E0 END AS even,
    CASE WHEN binary_pred > 0.4E0
         THEN CASE WHEN oos = 1 THEN binary_pred >= c.oos_tp_mean ELSE binary_pred <= c.oos_tn_mean END
         ELSE CASE WHEN oos = 1 THEN hl_orig_pred >= c.hl_tp_mean ELSE hl_orig_pred <= c.hl_tn_mean END
    END AS extreme,
    CASE WHEN binary_pred > 0.4E0 THEN true
         WHEN branch = 'ls' THEN CASE WHEN oos = 1 THEN c.lt_tp_percent >= c.lt_tn_percent ELSE c.lt_tp_percent <= c.lt_tn_percent END
         ELSE CASE WHEN oos = 1 THEN c.hs_tp_percent >= c.hs_tn_percent ELSE c.hs_tp_percent <= c.hs_tn_percent END
    END AS leaning
  FROM pred p CROSS JOIN conf c),
confident AS (
  SELECT *, CASE WHEN share IS NULL THEN 'LOW' WHEN extreme AND share >= even AND leaning THEN 'HIGH'
                 WHEN extreme OR share >= even THEN 'MEDIUM' ELSE 'LOW' END AS confidence_level FROM judged)"""


def split_rows(series: str, ties: str, min_rows: int, short: str = "drop", source: str = "panel") -> str:
    """CTE ``labelled``: rank of every row in its series."""
    keep = f"WHERE n >= {min_rows}" if short == "drop" else ""
    early = "" if short == "drop" else f"WHEN n < {min_rows} THEN 'train' "
    return f"""
ranked AS (SELECT *, count(*) OVER (PARTITION BY {series}) AS n,
                     rank() OVER (PARTITION BY {series} ORDER BY date, {ties}) AS rn FROM {source}),
sized AS (SELECT *, floor(n*0.9E0) AS n_tv FROM ranked {keep}),
labelled AS (SELECT *, CASE {early}WHEN rn <= floor(n_tv*0.9E0) THEN 'train' WHEN rn <= n_tv THEN 'validation'
                       ELSE 'test' END AS data_split FROM sized)"""


LABELLED = f", {split_rows('location', 'sku', 270)}"


def grid_counts(t1: str, t2: str) -> str:
    """CTEs that end in ``grid``: counts per pair of cut-offs, by trying every row with every pair."""
    pairs = ", ".join(
        f"({i * len(t2.split(',')) + j}, {a}E0, {b}E0)"
        for i, a in enumerate(t1.split(",")) for j, b in enumerate(t2.split(","))
    )
    return f""",
pairs(pos, oos_threshold, hl_threshold) AS (VALUES {pairs}),
outcome AS (
  SELECT pos, oos_threshold, hl_threshold, a.rev_ip_qty_eop_soh AS rev,
         CASE WHEN a.binary_pred > oos_threshold THEN 0.0E0 WHEN b.hl_orig_pred > hl_threshold THEN c.orig_pred_low
              ELSE d.orig_pred_low END AS low
  FROM step_1 a JOIN step_2 b USING (sku, location, date) JOIN step_3 c USING (sku, location, date)
       JOIN step_4 d USING (sku, location, date) CROSS JOIN pairs),
grid AS (SELECT CAST(pos AS BIGINT) AS pos, oos_threshold::DOUBLE AS oos_threshold, hl_threshold::DOUBLE AS hl_threshold,
  {count_if('rev <= 0 AND low <= 0')} AS tp, {count_if('rev <= 0 AND low > 0')} AS fn,
  {count_if('rev > 0 AND low > 0')} AS tn, {count_if('rev > 0 AND low <= 0')} AS fp FROM outcome GROUP BY ALL)"""


SCORE = "0.5::DOUBLE*f1_score + 0.25::DOUBLE*recall + 0.25::DOUBLE*accuracy"
GRID = f"WITH {PANEL} {STEPS} {grid_counts(OOS_GRID, HL_GRID)}, {rates('grid')}, scored AS (SELECT *, {SCORE} AS score FROM rated)"
BEST_PAIR = "best AS (SELECT * FROM scored WHERE score > 0 ORDER BY score DESC, pos LIMIT 1)"
BEST_ROWS = f"""{GRID}, {BEST_PAIR}
SELECT {', '.join('a.' + c for c in N.BEST_COLUMNS[:8])}, 0.0E0 AS orig_pred_low, 0.0E0 AS orig_pred_high, CAST(1 AS BIGINT) AS oos
FROM step_1 a, best WHERE a.binary_pred > best.oos_threshold
UNION ALL
SELECT {', '.join('a.' + c for c in N.BEST_COLUMNS[:8])}, m.orig_pred_low, m.orig_pred_high,
       CAST(CASE WHEN m.orig_pred_low <= 0 THEN 1 ELSE 0 END AS BIGINT) AS oos
FROM step_1 a JOIN step_2 b USING (sku, location, date) CROSS JOIN best
JOIN (SELECT 'ls' AS m, sku, location, date, orig_pred_low, orig_pred_high FROM step_3 UNION ALL
      SELECT 'hs', sku, location, date, orig_pred_low, orig_pred_high FROM step_4) m USING (sku, location, date)
WHERE a.binary_pred <= best.oos_threshold AND (m.m = 'ls') = (b.hl_orig_pred > best.hl_threshold)"""


def cols(names) -> str:
    return ", ".join(names)


def run_scores() -> str:
    """CTE ``runs``: weighted scores of the two cut-off choices."""
    return f"""WITH {PANEL}, {predicted(name='pa')}, {predicted(name='pb', t1='0.5E0', t2='0.3E0')},
ca AS ({stock_counts('pa')}), cb AS ({stock_counts('pb')}), {rates('ca', out='ra')}, {rates('cb', out='rb')},
runs AS (SELECT 'champion' AS role, 'run-champion' AS run_id, {SCORE} AS overall_score FROM ra
         UNION ALL SELECT 'challenger', 'run-challenger', {SCORE} FROM rb)"""


def weighted_all() -> str:
    order = list(N.WEIGHTED_METRICS.values())
    terms = " + ".join(f'{(i + 1) / 8}::DOUBLE*"{c}"' for i, c in enumerate(order))
    return from_pred(f", counts AS ({stock_counts('pred')}), {rates('counts')} SELECT tp, fn, tn, fp, {rnd(terms, 6)} AS score FROM rated")


def linear_scores() -> str:
    """CTE ``scored`` with the raw outputs of the four linear models."""
    c, i, r = N.CURDAY_QTY, N.IP_QTY, N.TOTAL_RETAIL
    return f"""scored AS (SELECT * EXCLUDE (binary_pred, hl_orig_pred, ls_ratio, hs_pred),
  1.0E0/(1.0E0+exp(-(1.0E0 + -0.125E0*{c} + -0.0625E0*{i}))) AS binary_pred,
  1.0E0/(1.0E0+exp(-(0.0E0 + 0.0625E0*{c} + -0.03125E0*{r}))) AS hl_orig_pred,
  0.5E0 + 0.03125E0*{i} AS ls_ratio, 2.0E0 + 1.25E0*{c} + 0.25E0*{i} AS hs_pred FROM panel)"""


def tree_scores() -> str:
    """CTEs that end in ``scored``: every row walks down every tree of the node tables, one split a round."""
    def cell(v) -> str:
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    nodes = ", ".join(
        "(" + ", ".join([f"'{step}'", *map(cell, n.values())]) + ")" for step in SHAPES for n in tree_nodes(step)
    )
    value = " ".join(f"WHEN '{f}' THEN {f}" for f in ("ip_qty_eop_soh", "curday_ip_qty_eop_soh", "shelf_count"))

    def score(step: str) -> str:
        base, _, sigmoid = SHAPES[step]
        total = f"({base}::DOUBLE + sum(leaf) FILTER (WHERE step = '{step}'))"
        return f"1.0E0/(1.0E0+exp(-{total}))" if sigmoid else total

    return f"""nodes(step, tree, node, feature, threshold, l, r, leaf, default_left) AS (VALUES {nodes}),
counted AS (SELECT row_number() OVER () AS id, *, CASE WHEN dn % 5 > 0 THEN total_retail END AS shelf_count FROM panel),
walk AS (
  SELECT id, step, tree, 0 AS node FROM counted CROSS JOIN (SELECT DISTINCT step, tree FROM nodes)
  UNION ALL
  SELECT w.id, w.step, w.tree, CASE WHEN coalesce((CASE feature {value} END) < threshold, default_left) THEN l ELSE r END
  FROM walk w JOIN nodes n USING (step, tree, node) JOIN counted c ON c.id = w.id WHERE n.leaf IS NULL),
totals AS (SELECT id, {score('step_1')} AS binary_pred, {score('step_2')} AS hl_orig_pred, {score('step_3')} AS ls_ratio,
  {score('step_4')} AS hs_pred FROM walk JOIN nodes USING (step, tree, node) WHERE leaf IS NOT NULL GROUP BY id),
scored AS (SELECT c.* EXCLUDE (id, binary_pred, hl_orig_pred, ls_ratio, hs_pred), t.* EXCLUDE (id)
           FROM counted c JOIN totals t USING (id))"""


def newton(rounds: int = 9) -> str:
    """CTEs that end in ``w{rounds}``: intercept and two weights of a logistic model, by Newton steps from zero. The
    three equations of a step are solved by determinants."""
    parts = ["w0 AS (SELECT 0.0E0 AS b, 0.0E0 AS c, 0.0E0 AS d)"]
    for k in range(rounds):
        parts.append(f"""g{k} AS (SELECT sum(y-p) AS g0, sum((y-p)*x1) AS g1, sum((y-p)*x2) AS g2, sum(p*(1-p)) AS h00,
  sum(p*(1-p)*x1) AS h01, sum(p*(1-p)*x2) AS h02, sum(p*(1-p)*x1*x1) AS h11, sum(p*(1-p)*x1*x2) AS h12,
  sum(p*(1-p)*x2*x2) AS h22 FROM (SELECT x1, x2, y, 1.0E0/(1.0E0+exp(-(w.b + w.c*x1 + w.d*x2))) AS p FROM points CROSS JOIN w{k} w)),
w{k + 1} AS (SELECT w.b + (g0*(h11*h22-h12*h12) - h01*(g1*h22-h12*g2) + h02*(g1*h12-h11*g2))/det AS b,
  w.c + (h00*(g1*h22-h12*g2) - g0*(h01*h22-h12*h02) + h02*(h01*g2-g1*h02))/det AS c,
  w.d + (h00*(h11*g2-g1*h12) - h01*(h01*g2-g1*h02) + g0*(h01*h12-h11*h02))/det AS d
  FROM w{k} w CROSS JOIN (SELECT *, h00*(h11*h22-h12*h12) - h01*(h01*h22-h12*h02) + h02*(h01*h12-h11*h02) AS det FROM g{k}))""")
    return ",\n".join(parts)


def new_frames(t: str = "0.4E0") -> str:
    k = "USING (sku, location, date)"
    return f""", n1 AS (SELECT * FROM step_1 WHERE binary_pred > {t}),
n2 AS (SELECT * FROM step_1 JOIN step_2 {k} WHERE binary_pred <= {t}),
n3 AS (SELECT n2.*, s.orig_pred, s.orig_pred_low, s.orig_pred_high, s.target_regression FROM n2 JOIN step_3 s {k} WHERE hl_orig_pred > {t}),
n4 AS (SELECT n2.*, s.orig_pred, s.orig_pred_low, s.orig_pred_high, s.h_rev_target_ratio FROM n2 JOIN step_4 s {k} WHERE hl_orig_pred <= {t})"""


def technical(source: str, target: str, score: str, prefix: str = "", out: str = "tech") -> str:
    """CTEs that end in ``out``: the nine numbers of a classifier."""
    flag = f"(SELECT {target} AS y, CASE WHEN {score} > 0.4E0 THEN 1 ELSE 0 END AS p FROM {source})"
    names = {"tp_%": "tp_percent", "fn_%": "fn_percent", "tn_%": "tn_percent", "fp_%": "fp_percent",
             "accuracy": "accuracy", "precision": '"precision"', "recall": "recall", "f1_score": "f1_score"}
    renamed = ", ".join(f'{c} AS "{prefix}{k if prefix else c.strip(chr(34))}"' for k, c in names.items())
    return f"""{out}_c AS ({flag_counts(flag, 'y', 'p')}), {rates(f'{out}_c', out=f'{out}_r')},
{out} AS (SELECT {renamed}, {auc(source, target, score)} AS "{prefix}roc_auc" FROM {out}_r)"""


def confidence_body() -> str:
    scalars = [f"{s}_{m}" for s in ("oos_tp", "oos_tn", "hl_tp", "hl_tn") for m in ("percent", "mean")]
    scalars += [f"{m}_{s}_percent" for m in ("lt", "hs") for s in ("tp", "tn")]
    parts = [f"SELECT '{c}' AS metric, {c} AS value FROM conf" for c in scalars]
    for side in ("tp", "tn"):
        for model in ("oos", "hl"):
            parts.append(f"SELECT '{model}_{side}_bins_' || bin_start::VARCHAR, percent FROM ({bin_rows(side, 0.4, 0.4)}) WHERE model = '{model}'")
    return f", {confidence_cte()} " + "\nUNION ALL ".join(parts)


def confidence_long() -> str:
    return from_pred(confidence_body())


def overall(ctes: str, source: str) -> str:
    """The overall document of the rows of ``source``."""
    return f"""{ctes}, counts AS ({stock_counts(source)}), {rates('counts')},
        biz AS (SELECT {business(source, 'binary_target_classification', '100.0::DOUBLE')} FROM {source})
        SELECT rated.* , biz.* EXCLUDE (under_rows, over_rows) FROM rated CROSS JOIN biz"""


LINEAR_CONFIDENT = f"WITH {PANEL}, {linear_scores()}, {predicted('scored')}, {confident()}"
TESTED = f"{LABELLED[2:]}, {linear_scores()}, tested AS (SELECT s.* FROM scored s JOIN labelled l USING (sku, location, date) WHERE data_split = 'test')"
ROUNDED = f"* REPLACE ({rnd('binary_pred', 6)} AS binary_pred, {rnd('hl_orig_pred', 6)} AS hl_orig_pred)"

PRED_KEYED = "SELECT " + cols(N.FINAL_COLUMNS) + " FROM pred"

ORACLES: dict[str, str] = {
    # sources
    "scan_feature_store": from_panel(f"SELECT {KEYS}, {cols(FEATURES)} FROM panel"),
    "scan_controlled_features": from_panel(f"""SELECT {KEYS}, {cols(FEATURES)}, location_group, load_date FROM panel
        WHERE (CAST(location_group AS INTEGER) + month(CAST(load_date AS DATE))) % 3 = 0"""),
    "scan_target_store": from_panel(f"SELECT {KEYS}, {cols(TARGETS)} FROM panel"),
    "scan_inference_features": from_panel(f"SELECT {KEYS}, {cols(FEATURES)}, location_group, '{DAY}' AS load_date FROM panel"),
    "scan_test_split": from_panel(f"{LABELLED} SELECT {KEYS}, {cols(FEATURES)}, {cols(TARGETS[:3])} FROM labelled WHERE data_split = 'test'"),
    "scan_audit_features": from_panel(f"SELECT {KEYS}, {cols(FEATURES)} FROM panel"),
    "scan_step_predictions": from_panel(f"""{STEPS}, wide AS (
        SELECT *, 'step_1' AS step FROM step_1 UNION ALL BY NAME SELECT *, 'step_2' AS step FROM step_2
        UNION ALL BY NAME SELECT *, 'step_3' AS step FROM step_3 UNION ALL BY NAME SELECT *, 'step_4' AS step FROM step_4)
        SELECT w.* REPLACE ({', '.join(f'{c}::DOUBLE AS {c}' for c in LONGS)}),
               CAST(CAST(location AS BIGINT) % 4 AS VARCHAR) AS location_group FROM wide w"""),
    "scan_final_prediction_csv": from_pred(f"SELECT {cols(N.FINAL_COLUMNS)}, location_group FROM pred"),
    "scan_final_prediction_parquet": from_pred(PRED_KEYED),
    "scan_audit_actuals": from_pred(f"{AUDIT} SELECT * FROM audit"),
    "scan_concatenated_predictions": from_pred(f", {confident()} SELECT {cols(N.CONCATENATED_COLUMNS)} FROM confident"),
    "scan_confidence_document": confidence_long(),
    "scan_metric_weights": from_pred(f""", counts AS ({stock_counts('pred')}), {rates('counts')}
        SELECT 'F1 Score' AS metric_name, 0.5E0 AS metric_weight, f1_score AS value FROM rated
        UNION ALL SELECT 'Recall Percent', 0.25E0, recall FROM rated UNION ALL SELECT 'Accuracy', 0.25E0, accuracy FROM rated"""),
    "scan_model_scores": f"{run_scores()} SELECT role, run_id, overall_score FROM runs",
    # sinks
    "sink_split_parquet": from_panel(f"{LABELLED} SELECT {KEYS}, total_retail, location_group, '{DAY}' AS load_date, data_split FROM labelled"),
    "sink_step_csv": from_panel(f"SELECT {cols(N.STEP_COLUMNS['step_1'])}, location_group FROM panel"),
    "sink_single_csv": from_pred(f", {confident()} SELECT {cols(N.DAILY_COLUMNS)}, location_group FROM confident"),
    "sink_step_csv_by_group": from_panel(f"SELECT {cols(N.STEP_COLUMNS['step_1'])}, location_group FROM panel WHERE location_group <> '3'"),
    "sink_split_rerun": from_panel(f"""{LABELLED} SELECT {KEYS}, location_group, '{AS_OF}' AS load_date, data_split FROM labelled
        UNION ALL SELECT {KEYS}, location_group, '{DAY}', data_split FROM labelled
        WHERE data_split <> 'validation' AND location_group <> '0'"""),
    "sink_performance_report": from_pred(f"{AUDIT} SELECT * FROM audited"),
    "sink_all_predictions": from_pred(f"SELECT {KEYS}, binary_pred, orig_pred_low, orig_pred_high, orig_pred, hl_orig_pred, orig_pred_temp, oos FROM pred"),
    "sink_final_parquet": from_pred(PRED_KEYED),
    "sink_best_prediction": BEST_ROWS,
    "sink_metric_json": overall(f"WITH {PANEL}, {predicted()}", "pred"),
    # projections and filters
    "drop_partition_columns": from_panel(f"SELECT {KEYS}, {cols(FEATURES)} FROM panel"),
    "filter_train_start": from_panel(f"SELECT {KEYS}, binary_pred FROM panel WHERE date >= DATE '{TRAIN_START}'"),
    "filter_incremental_load": from_panel(f"SELECT {KEYS}, load_date FROM panel WHERE load_date > '{LAST_TRAIN}'"),
    "filter_as_of_date": from_panel(f"{LABELLED} SELECT {KEYS}, data_split FROM labelled WHERE date <= DATE '{AS_OF}'"),
    "optional_audit_filter": from_panel(f"SELECT {KEYS}, total_retail FROM panel WHERE dn % 3 = 0"),
    "cast_object_features": from_panel(f"SELECT {KEYS}, {N.CURDAY_QTY}, {N.IP_QTY} FROM panel"),
    "route_oos": from_panel(f"SELECT {KEYS}, binary_pred FROM panel WHERE binary_pred > 0.4E0"),
    "route_rest": from_panel(f"SELECT {KEYS}, binary_pred FROM panel WHERE binary_pred <= 0.4E0"),
    "route_lower_stock": from_panel(f"SELECT {KEYS}, binary_pred, hl_orig_pred FROM panel WHERE binary_pred <= 0.4E0 AND hl_orig_pred > 0.4E0"),
    "route_higher_stock": from_panel(f"SELECT {KEYS}, binary_pred, hl_orig_pred FROM panel WHERE binary_pred <= 0.4E0 AND hl_orig_pred <= 0.4E0"),
    "fill_oos_constants": from_panel(f"SELECT {KEYS}, 0.0E0 AS orig_pred, 0.0E0 AS orig_pred_low, 0.0E0 AS orig_pred_high FROM panel WHERE binary_pred > 0.4E0"),
    "scale_ratio_by_book": from_panel(f"SELECT {KEYS}, ls_ratio*{N.CURDAY_QTY} AS orig_pred FROM panel"),
    "prediction_band": from_panel(f", src AS (SELECT {KEYS}, hs_pred AS orig_pred FROM panel), {band('src', 'b')} SELECT {KEYS}, orig_pred, orig_pred_temp, orig_pred_low, orig_pred_high FROM b"),
    "oos_flag_exact": from_panel(f", src AS (SELECT {KEYS}, hs_pred AS orig_pred FROM panel), {band('src', 'b')} SELECT {KEYS}, CAST(orig_pred_low = 0 AS BIGINT) AS oos FROM b"),
    "oos_flag_nonpositive": from_panel(f"SELECT {KEYS}, CAST({N.IP_QTY} <= 0 AS BIGINT) AS oos FROM panel"),
    "conditional_mask_outputs": from_pred(f"""SELECT {KEYS}, CASE WHEN branch = 'hs' THEN orig_pred END AS gt_out,
        CASE WHEN branch = 'ls' THEN orig_pred END AS lt_out FROM pred"""),
    "project_required_columns": from_pred(PRED_KEYED),
    "binarize_score": from_panel(f"SELECT {KEYS}, CAST(binary_pred > 0.4E0 AS BIGINT) AS predicted FROM panel"),
    "parse_audit_date": from_panel(f"SELECT sku, location, date FROM panel"),
    "rescale_target": from_panel(f"SELECT {KEYS}, target_regression*{N.CURDAY_QTY} AS quantity FROM panel"),
    # aggregations
    "confusion_flags": from_pred(f"{AUDIT} {flag_counts('audited', 'actual_oos_flag', 'oos')}"),
    "confusion_stock": from_pred(stock_counts("pred")),
    "confusion_scores": from_panel(flag_counts("(SELECT binary_target_classification AS y, CASE WHEN binary_pred > 0.4E0 THEN 1 ELSE 0 END AS p FROM panel)", "y", "p")),
    "binary_rates": from_pred(f", counts AS ({stock_counts('pred')}), {rates('counts')} SELECT tp, fn, tn, fp, {RATES} FROM rated"),
    "class_ratio": from_pred(f", counts AS ({stock_counts('pred')}) SELECT tn+fp AS zeros, tp+fn AS ones, {rnd('(tn+fp)::DOUBLE/(tp+fn)::DOUBLE', 3)} AS zero_to_one_ratio FROM counts"),
    "roc_auc": from_panel(f"SELECT {auc('panel', 'binary_target_classification', 'binary_pred')} AS roc_auc"),
    "roc_auc_labels": f"WITH j AS (SELECT quality, n_chars FROM labels JOIN documents USING (doc_id)) SELECT {auc('j', 'quality', 'n_chars')} AS roc_auc",
    "regression_errors": from_panel("SELECT " + errors("panel", "h_rev_target_ratio", "hs_pred")),
    "score_distribution": from_panel("SELECT " + ", ".join(
        f"{rnd(f'{fn}({c})', 6)} AS {side}_{name}" for side, c in (("target", "h_rev_target_ratio"), ("prediction", "hs_pred"))
        for name, fn in (("min", "min"), ("mean", "avg"), ("max", "max"), ("std", "stddev_samp"))) + " FROM panel"),
    "understock_performance": from_pred(business_only("pred", "under_rows AS rows, understock_accurate, understock_overall")),
    "overstock_performance": from_pred(business_only("pred", "over_rows AS rows, overstock_accurate, overstock_overall")),
    "book_vs_prediction": from_pred(business_only("pred", "br_pr_percent, br_pw_percent, bw_pr_percent")),
    "revenue_impact": from_pred(business_only("pred", "br_pr_value, revenue_recovery, model_loss, book_recoverable_loss")),
    "audit_metrics": from_pred(f"""{AUDIT}, counts AS ({flag_counts('audited', 'actual_oos_flag', 'oos')}), {rates('counts')},
        biz AS (SELECT {business('audited', 'actual_oos_flag', '0.0::DOUBLE')} FROM audited)
        SELECT tp, fn, tn, fp, recall, "precision", f1_score, accuracy, biz.* EXCLUDE (under_rows, over_rows) FROM rated CROSS JOIN biz"""),
    "technical_metrics_binary": from_panel(f", {technical('panel', 'binary_target_classification', 'binary_pred')} SELECT * FROM tech"),
    "technical_metrics_regression": from_panel(f", e AS (SELECT target_regression*{N.CURDAY_QTY} AS y, ls_ratio*{N.CURDAY_QTY} AS p FROM panel) SELECT {errors('e', 'y', 'p')}"),
    "technical_metrics_new": from_panel(f"""{STEPS} {new_frames()}, {technical('n1', 'binary_target_classification', 'binary_pred', 'step_1_', 't1')},
        {technical('n2', 'binary_hl_target_classification', 'hl_orig_pred', 'step_2_', 't2')},
        t3 AS (SELECT {errors('n3', 'target_regression', 'orig_pred', 'step_3_')}), t4 AS (SELECT {errors('n4', 'h_rev_target_ratio', 'orig_pred', 'step_4_')})
        SELECT * FROM t1 CROSS JOIN t2 CROSS JOIN t3 CROSS JOIN t4"""),
    "confidence_oos": from_pred(f", {confidence_cte()} SELECT oos_tp_percent, oos_tp_mean, oos_tn_percent, oos_tn_mean FROM conf"),
    "confidence_hl": from_pred(f", {confidence_cte()} SELECT hl_tp_percent, hl_tp_mean, hl_tn_percent, hl_tn_mean FROM conf"),
    "confidence_lt": from_pred(f", {confidence_cte()} SELECT lt_tp_percent, lt_tn_percent FROM conf"),
    "confidence_hs": from_pred(f", {confidence_cte()} SELECT hs_tp_percent, hs_tn_percent FROM conf"),
    "tp_probability_bins": from_pred(bin_rows("tp", 0.4, 0.4)),
    "tn_probability_bins": from_pred(bin_rows("tn", 0.4, 0.4)),
    "probability_bins_irregular": from_pred(f"SELECT *, 'tp' AS side FROM ({bin_rows('tp', 0.45, 0.35)}) UNION ALL SELECT *, 'tn' AS side FROM ({bin_rows('tn', 0.45, 0.35)})"),
    "weighted_metric_score": weighted_all(),
    "threshold_grid": f"{GRID} SELECT pos, oos_threshold, hl_threshold, tp, fn, tn, fp FROM grid",
    "threshold_scores": f"{GRID} SELECT pos, oos_threshold, hl_threshold, {rnd('score', 6)} AS score FROM scored",
    "threshold_search": f"{GRID}, {BEST_PAIR} SELECT oos_threshold, hl_threshold, {rnd('score', 6)} AS score FROM best",
    "champion_challenger": f"""{run_scores()}, d AS (SELECT max(overall_score) FILTER (WHERE role = 'champion') AS a,
        max(overall_score) FILTER (WHERE role = 'challenger') AS b FROM runs)
        SELECT {rnd('a', 6)} AS champion_score, {rnd('b', 6)} AS challenger_score, CAST(b > a AS BIGINT) AS promote,
        CASE WHEN b > a THEN 'run-challenger' ELSE 'run-champion' END AS production_run FROM d""",
    "series_eligibility": from_panel(f"""SELECT sku, CAST(sum(neg_cc_flag) AS BIGINT) AS neg_cc_flag_sum, CAST(sum(sales_flag) AS BIGINT) AS sales_flag_sum,
        CAST(sum(transfer_flag) AS BIGINT) AS transfer_flag_sum, min(date) AS min_date FROM panel GROUP BY sku
        HAVING min(date) <= DATE '{ELIGIBLE_START}' AND sum(neg_cc_flag) > 0 AND sum(sales_flag) > 0 AND sum(transfer_flag) > 0"""),
    # models and cascade
    "time_split": from_panel(f"{LABELLED} SELECT {KEYS}, data_split FROM labelled"),
    "time_split_by_sku": from_panel(f", {split_rows('sku', 'location', 10, 'train')} SELECT {KEYS}, data_split FROM labelled"),
    "time_split_two_ties": from_panel(f""", known AS (SELECT *, CASE WHEN dn % 7 > 0 THEN location END AS place FROM panel),
        {split_rows('location_group', 'place NULLS FIRST, sku', 270, source='known')}
        SELECT {KEYS}, place, data_split FROM labelled"""),
    "score_model": from_panel(f"""SELECT {KEYS}, 0.5E0
        + CASE WHEN {N.CURDAY_QTY} < 20 THEN CASE WHEN {N.IP_QTY} < 5 THEN 0.75E0 ELSE 0.125E0 END ELSE -0.5E0 END
        + CASE WHEN total_retail < 25 THEN 0.25E0 ELSE -0.25E0 END + 0.0625E0 AS score FROM panel"""),
    "score_model_independent": from_panel(f", {linear_scores()} SELECT {KEYS}, {', '.join(f'{rnd(c, 6)} AS {c}' for c in ('binary_pred', 'hl_orig_pred', 'ls_ratio', 'hs_pred'))} FROM scored"),
    "score_cascade": f"WITH {PANEL}, {linear_scores()}, {predicted('scored')} SELECT {KEYS}, branch, orig_pred, orig_pred_low, orig_pred_high, oos FROM pred",
    "score_cascade_trees": f"""WITH RECURSIVE {PANEL}, {tree_scores()}, {predicted('scored')}
        SELECT {KEYS}, branch, {rnd('binary_pred', 6)} AS binary_pred, {rnd('hl_orig_pred', 6)} AS hl_orig_pred,
        orig_pred, orig_pred_low, orig_pred_high, oos FROM pred""",
    "score_ml_model": from_panel(f"""{LABELLED}, points AS (SELECT {N.CURDAY_QTY}::DOUBLE AS x1, {N.IP_QTY}::DOUBLE AS x2,
        {N.TARGET_HL}::DOUBLE AS y FROM labelled WHERE data_split = 'train'), {newton()}
        SELECT {KEYS}, {rnd(f'1.0E0/(1.0E0+exp(-(b + c*{N.CURDAY_QTY} + d*{N.IP_QTY})))', 3)} AS score FROM panel CROSS JOIN w9"""),
    "cascade_predict": from_pred(f"SELECT {KEYS}, branch, binary_pred, hl_orig_pred, orig_pred, orig_pred_temp, orig_pred_low, orig_pred_high, oos FROM pred"),
    "cascade_from_predictions": from_pred(f"SELECT {cols(N.BEST_COLUMNS)} FROM pred"),
    "confidence_level": from_pred(f", {confident()} SELECT {cols(N.DAILY_COLUMNS)} FROM confident"),
    # joins and set operations
    "join_target_feature": from_panel(f"SELECT {KEYS}, {cols(TARGETS)}, {cols(FEATURES)} FROM panel WHERE date >= DATE '{TRAIN_START}'"),
    "join_step1_step2": from_panel(f"{STEPS} {new_frames()} SELECT * FROM n2"),
    "join_lower_stock": from_panel(f"{STEPS} {new_frames()} SELECT * FROM n3"),
    "join_higher_stock": from_panel(f"{STEPS} {new_frames()} SELECT * FROM n4"),
    "join_audit_prediction": from_pred(f"{AUDIT} SELECT * FROM audited"),
    "join_eligible_series": from_panel(f""", ok AS (SELECT sku FROM panel GROUP BY sku HAVING min(date) <= DATE '{ELIGIBLE_START}'
        AND sum(neg_cc_flag) > 0 AND sum(sales_flag) > 0 AND sum(transfer_flag) > 0)
        SELECT {KEYS}, total_retail FROM panel WHERE sku IN (SELECT sku FROM ok)"""),
    "concat_branches": from_pred(f"SELECT {KEYS}, orig_pred_low, orig_pred_high, hl_orig_pred, orig_pred_temp FROM pred"),
    "concat_location_groups": from_panel(f"SELECT {cols(N.STEP_COLUMNS['step_2'])}, location_group FROM panel"),
    # whole jobs
    "daily_inference": f"{LINEAR_CONFIDENT} SELECT {cols(N.DAILY_COLUMNS)}, location_group FROM confident",
    "daily_inference_outputs": f"""{LINEAR_CONFIDENT}, outputs AS (
        SELECT 'concatenated' AS output, {cols(N.CONCATENATED_COLUMNS)}, location_group FROM confident
        UNION ALL BY NAME SELECT 'step_2' AS output, {cols(N.DAILY_STEP_COLUMNS['step_2'])}, location_group FROM pred WHERE branch <> 'oos'
        UNION ALL BY NAME SELECT 'step_3' AS output, {cols(N.DAILY_STEP_COLUMNS['step_3'])}, location_group FROM pred WHERE branch = 'ls'
        UNION ALL BY NAME SELECT 'step_4' AS output, {cols(N.DAILY_STEP_COLUMNS['step_4'])}, location_group FROM pred WHERE branch = 'hs')
        SELECT {ROUNDED[:-1]}, oos::DOUBLE AS oos) FROM outputs""",
    "split_run": from_panel(f""", begun AS (SELECT * FROM panel WHERE date >= DATE '{TRAIN_START}'),
        {split_rows('location', 'sku', 270, source='begun')}
        SELECT {KEYS}, {cols(FEATURES)}, {N.TARGET_OOS}, location_group, '{DAY}' AS load_date, data_split FROM labelled
        WHERE date <= DATE '{DAY}'"""),
    "evaluate_new_run": f"""WITH {PANEL}, {TESTED},
        s3_q AS (SELECT *, ls_ratio*curday_ip_qty_eop_soh AS orig_pred FROM tested), {band('s3_q', 's3_b')},
        s4_q AS (SELECT *, hs_pred AS orig_pred FROM tested), {band('s4_q', 's4_b')},
        outputs AS (SELECT {cols(N.STEP_COLUMNS['step_1'])}, location_group, 'step_1' AS step FROM tested
        UNION ALL BY NAME SELECT {cols(N.STEP_COLUMNS['step_2'])}, location_group, 'step_2' AS step FROM tested
        UNION ALL BY NAME SELECT {cols(N.STEP_COLUMNS['step_3'])}, location_group, 'step_3' AS step FROM s3_b
        UNION ALL BY NAME SELECT {cols(N.STEP_COLUMNS['step_4'])}, location_group, 'step_4' AS step FROM s4_b)
        SELECT * REPLACE ({rnd('binary_pred', 6)} AS binary_pred, {rnd('hl_orig_pred', 6)} AS hl_orig_pred,
        {', '.join(f'{c}::DOUBLE AS {c}' for c in LONGS)}) FROM outputs""",
    "evaluate_production_run": f"""WITH {PANEL}, {TESTED}, {predicted('tested')},
        outputs AS (SELECT {cols(N.FINAL_COLUMNS)}, location_group FROM pred) SELECT {ROUNDED} FROM outputs""",
    "score_production_run": overall(f"WITH {PANEL}, {TESTED}, {predicted('tested')}", "pred"),
    "score_new_run": overall(f"WITH won AS ({BEST_ROWS})", "won"),
    "predict_audit_run": f"""WITH {PANEL}, {linear_scores()}, {predicted('scored')},
        outputs AS (SELECT {cols(N.FINAL_COLUMNS)} FROM pred) SELECT {ROUNDED} FROM outputs""",
    "confidence_run": f"WITH {PANEL}, {linear_scores()}, {predicted('scored')}{confidence_body()}",
}
ORACLES["overall_metrics"] = ORACLES["sink_metric_json"]
ORACLES["audit_report"] = ORACLES["audit_metrics"]
ORACLES["threshold_search_unique_keys"] = ORACLES["threshold_search"]
ORACLES["switch_run"] = ORACLES["champion_challenger"]
ORACLES["tuning_run"] = ORACLES["threshold_search"]
RECENT = f"WITH {PANEL}, recent AS (SELECT * FROM panel WHERE load_date >= '{COUNTS_FROM}'), {predicted('recent')}"
ORACLES["overall_metrics_loads"] = ORACLES["overall_metrics"]
ORACLES["overall_metrics_recent"] = overall(RECENT, "pred")
ORACLES["audit_metrics_loads"] = ORACLES["audit_metrics"]
ORACLES["confidence_metrics_recent"] = f"{RECENT} {confidence_body()}"
