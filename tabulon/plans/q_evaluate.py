"""J-family queries on the deterministic score view."""

from __future__ import annotations

from tabulon.operators import evaluate as J
from tabulon.plans.base import Query
from tabulon.sources import fixtures as fx

BOOT_B = 1000      # replicates drawn on cells
BOOT_ROW_B = 20    # replicates drawn row by row, the check on the cell form
EPS = J.EPS


def _sc(spark, d):
    return fx.scored_survey(spark, d)


def uniform(key: str) -> str:
    return f"((cast(('0x' || substr(md5({key}), 1, 13)) as bigint) + 0.5) / {float(1 << 52)!r}::double)"


CONF_SQL = ("select cell, actual, predicted, count from (select 'tn' as cell, 0 as actual, 0 as predicted, "
            "count(*) filter (where y = 0 and p < 0.5) as count from scored_survey union all "
            "select 'fp', 0, 1, count(*) filter (where y = 0 and p >= 0.5) from scored_survey union all "
            "select 'fn', 1, 0, count(*) filter (where y = 1 and p < 0.5) from scored_survey union all "
            "select 'tp', 1, 1, count(*) filter (where y = 1 and p >= 0.5) from scored_survey)")
CNT_CTE = ("cnt as (select cast(count(*) filter (where y = 1 and p >= 0.5) as double) as tp, "
           "cast(count(*) filter (where y = 0 and p < 0.5) as double) as tn, "
           "cast(count(*) filter (where y = 0 and p >= 0.5) as double) as fp, "
           "cast(count(*) filter (where y = 1 and p < 0.5) as double) as fn from scored_survey)")
THR_SQL = ("select 'accuracy' as metric, coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0.0) as value from cnt "
           "union all select 'balanced_accuracy', (coalesce(tp / nullif(tp + fn, 0), 0.0) + "
           "coalesce(tn / nullif(tn + fp, 0), 0.0)) / 2 from cnt "
           "union all select 'precision', coalesce(tp / nullif(tp + fp, 0), 0.0) from cnt "
           "union all select 'recall', coalesce(tp / nullif(tp + fn, 0), 0.0) from cnt "
           "union all select 'f1', coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) from cnt")
SC_CTE = ("scnt as (select p as s, sum(case when y = 1 then 1.0 else 0.0 end) as pos, "
          "sum(case when y = 0 then 1.0 else 0.0 end) as neg from scored_survey group by p)")
AUC_SQL = ("select sum(pos * (neg_le - neg / 2.0)) / (sum(pos) * sum(neg)) as roc_auc from "
           "(select *, sum(neg) over (order by s rows between unbounded preceding and current row) as neg_le from scnt)")
ROC_SQL = ("select s as threshold, cast(tp as bigint) as true_positives, cast(fp as bigint) as false_positives, "
           "fp / sum(neg) over () as fpr, tp / sum(pos) over () as tpr from "
           "(select *, sum(pos) over (order by s desc rows between unbounded preceding and current row) as tp, "
           "sum(neg) over (order by s desc rows between unbounded preceding and current row) as fp from scnt)")
LOSS_SQL = (f"select avg(power(p - y, 2)) as brier_score, avg(-(y * ln(least(greatest(p, {EPS!r}), 1 - {EPS!r})) "
            f"+ (1 - y) * ln(1 - least(greatest(p, {EPS!r}), 1 - {EPS!r})))) as log_loss from scored_survey")
CAL_CTE = (
    "edges as (select list_sort(list_distinct(quantile_cont(p, ["
    + ", ".join(repr(i / 8) for i in range(9)) + "]))) as e from scored_survey), "
    "binned as (select s.*, greatest(1, len(list_filter(e, lambda x: x < s.p))) as bin "
    "from scored_survey s cross join edges), "
    "cal0 as (select cast(bin as integer) as bin, count(*) as n, avg(p) as mean_predicted_probability, "
    "avg(cast(y as double)) as observed_positive_rate, min(p) as minimum_probability, max(p) as maximum_probability "
    "from binned group by bin), "
    "cal as (select *, abs(mean_predicted_probability - observed_positive_rate) as absolute_calibration_error, "
    "abs(mean_predicted_probability - observed_positive_rate) * n / sum(n) over () as weighted_error from cal0)")
CAL_DOUBLES = ("mean_predicted_probability", "observed_positive_rate", "minimum_probability", "maximum_probability",
               "absolute_calibration_error", "weighted_error")

_POIS = "case " + " ".join(f"when u < {c!r}::double then {k}" for k, c in enumerate(J.poisson_cdf())) + " else 18 end"
ROW_CTE = (
    f"bs0 as (select y, p, case when p >= 0.5 then 1 else 0 end as pr, respondent_id, b "
    f"from scored_survey cross join range(0, {BOOT_ROW_B}) t(b)), "
    "bs1 as (select *, " + uniform("concat('boot|', cast(respondent_id as varchar), '|', cast(b as varchar))") + " as u from bs0), "
    f"bs as (select b, y, pr, p as s, 1 as c, {_POIS} as w from bs1), ")


def cell_cte(salt: str) -> str:
    """The draws on cells: the same uniforms, the distribution function from its closed form with the log-gamma function."""
    return (
        "cc as (select y, case when p >= 0.5 then 1 else 0 end as pr, p as s, count(*) as c from scored_survey group by all), "
        "ck as (select c, unnest(range(greatest(0, c - reach), c + reach + 1)) as k from "
        "(select distinct c, cast(ceil(9 * sqrt(c)) as bigint) + 16 as reach from cc)), "
        "cp as (select c, k, sum(exp(k * ln(c) - c - lgamma(k + 1))) over (partition by c order by k "
        "rows between unbounded preceding and current row) as cdf from ck), "
        "cd as (select c, min(k) as k0, list(cdf order by k) as cdf from cp group by c), "
        f"bs0 as (select cc.*, b, k0, cdf from cc join cd using (c) cross join range(0, {BOOT_B}) t(b)), "
        "bs1 as (select *, " + uniform(f"concat_ws('|', '{salt}', cast(y as varchar), cast(pr as varchar), cast(s as varchar), cast(b as varchar))")
        + " as u from bs0), "
        "bs as (select b, y, pr, s, c, k0 + len(list_filter(cdf, lambda x: x < u)) as w from bs1), ")


METRICS_CTE = (
    "per0 as (select b, sum(case when y = 1 and pr = 1 then w else 0 end) as tp_, "
    "sum(case when y = 0 and pr = 0 then w else 0 end) as tn_, sum(case when y = 0 and pr = 1 then w else 0 end) as fp_, "
    "sum(case when y = 1 and pr = 0 then w else 0 end) as fn_, sum(c) filter (where y = 1) as n1, "
    "sum(c) filter (where y = 0) as n0, sum(case when y = 1 then w * power(s - 1.0, 2) end) as b1, "
    "sum(case when y = 0 then w * power(s, 2) end) as b0 from bs group by b), "
    "per1 as (select *, n1 / (tp_ + fn_) as s1, n0 / (tn_ + fp_) as s0, n1 + n0 as nn from per0), "
    "per2 as (select b, tp_ * s1 as tp, fn_ * s1 as fn, tn_ * s0 as tn, fp_ * s0 as fp, nn, b1 * s1 + b0 * s0 as bb from per1), "
    "per as (select b, coalesce((tp + tn) / nullif(nn, 0), 0.0) as accuracy, "
    "coalesce(tp / nullif(tp + fp, 0), 0.0) as precision, coalesce(tp / nullif(tp + fn, 0), 0.0) as recall, "
    "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) as f1, bb / nullif(nn, 0) as brier_score from per2), "
    "bsc as (select b, s, cast(sum(case when y = 1 then w else 0 end) as double) as pos, "
    "cast(sum(case when y = 0 then w else 0 end) as double) as neg from bs group by b, s), "
    "bauc as (select b, sum(pos * (neg_le - neg / 2.0)) / (sum(pos) * sum(neg)) as roc_auc from "
    "(select *, sum(neg) over (partition by b order by s rows between unbounded preceding and current row) "
    "as neg_le from bsc) group by b), "
    "blong as (select metric, v from (select p.*, a.roc_auc from per p join bauc a using (b)) "
    "unpivot (v for metric in (accuracy, precision, recall, f1, roc_auc, brier_score)))")


def boot_sql(replicates: int, method: str) -> str:
    return (f"select metric, quantile_cont(v, 0.025) as lower_95, quantile_cont(v, 0.5) as median, "
            f"quantile_cont(v, 0.975) as upper_95, {replicates} as iterations, '{method}' as method from blong group by metric")


BOOT_DOUBLES = ("lower_95", "median", "upper_95")
CELL_SQL = boot_sql(BOOT_B, "class-renormalised Poisson bootstrap (cell draws)")
ROW_SQL = boot_sql(BOOT_ROW_B, "class-renormalised Poisson bootstrap")

QUERIES = [
    Query("confusion", "J1,J2", lambda s, d: J.confusion(_sc(s, d), "y", "p"), CONF_SQL),
    Query("threshold_metrics", "J3", lambda s, d: J.threshold_metrics(_sc(s, d), "y", "p"), THR_SQL,
          ("value",), ctes=CNT_CTE),
    Query("roc_auc", "J4", lambda s, d: J.roc_auc(_sc(s, d), "y", "p"), AUC_SQL, ("roc_auc",), ctes=SC_CTE),
    Query("roc_points", "J6", lambda s, d: J.roc_points(_sc(s, d), "y", "p"), ROC_SQL,
          ("threshold", "fpr", "tpr"), ctes=SC_CTE),
    Query("prob_losses", "J5", lambda s, d: J.prob_losses(_sc(s, d), "y", "p"), LOSS_SQL,
          ("brier_score", "log_loss")),
    Query("calibration", "J7", lambda s, d: J.calibration(_sc(s, d), "y", "p"), "select * from cal",
          CAL_DOUBLES, ctes=CAL_CTE),
    Query("ece", "J8", lambda s, d: J.expected_calibration_error(J.calibration(_sc(s, d), "y", "p")),
          "select sum(n * absolute_calibration_error) / sum(n) as expected_calibration_error from cal",
          ("expected_calibration_error",), ctes=CAL_CTE),
    Query("bootstrap_intervals", "J9", lambda s, d: J.bootstrap_cells(_sc(s, d), "y", "p", replicates=BOOT_B, salt="boot"),
          CELL_SQL, BOOT_DOUBLES, ctes=cell_cte("boot") + METRICS_CTE),
    Query("bootstrap_rows", "J9",
          lambda s, d: J.bootstrap_intervals(_sc(s, d), "respondent_id", "y", "p", replicates=BOOT_ROW_B),
          ROW_SQL, BOOT_DOUBLES, ctes=ROW_CTE + METRICS_CTE),
    Query("bootstrap_cells", "J9", lambda s, d: J.bootstrap_cells(_sc(s, d), "y", "p", replicates=BOOT_B),
          CELL_SQL, BOOT_DOUBLES, ctes=cell_cte("bootc") + METRICS_CTE),
]
