"""F-family queries: contingency, χ², Cramér's V, extremes, Mann–Whitney, BH."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions.tails import chi2_sf_sql, normal_two_sided_sql
from tabulon.operators import stats as S
from tabulon.plans.base import Query
from tabulon.session import materialize
from tabulon.sources import fixtures as fx

W, SCALE = "wgt", 2
TEST_DIMS = fx.DIMENSIONS  # every declared dimension is tested against every target
EXCL = ", ".join(f"'{c}'" for c in S.NON_SUBSTANTIVE)


def _cells(spark, d):
    return S.contingency(fx.clean_survey(spark, d), fx.TARGETS, TEST_DIMS, W, scale=SCALE)


def _tests(spark, d):
    return S.chi_square_tests(_cells(spark, d))


def _mw(spark, d):
    return S.mann_whitney(fx.clean_survey(spark, d), fx.TARGETS, "age", "Respondent age")


def q_contingency(spark, d):
    return _cells(spark, d).drop("n_included", "n_excluded_nonresponse")


def q_chi(spark, d):
    return _tests(spark, d).select("test_id", "target", "dimension", "n_included", "n_excluded_nonresponse",
                                   "category_count", "chi_square", "degrees_freedom", "minimum_expected_count",
                                   "expected_cells_below_5", "expected_cells_total", "assumption_passed")


def q_v(spark, d):
    return _tests(spark, d).select("test_id", "target", "dimension", "effect_size", "effect_magnitude")


def q_ext(spark, d):
    return _tests(spark, d).select("test_id", "lowest_weighted_rate_category", "lowest_weighted_rate",
                                   "highest_weighted_rate_category", "highest_weighted_rate",
                                   "weighted_rate_gap_pp")


def q_p_values(spark, d):
    cat = S.with_chi_p(_tests(spark, d)).select("test_id", "target", F.col("chi_square").alias("statistic"),
                                                "degrees_freedom", "p_value")
    num = S.with_normal_p(_mw(spark, d)).select("test_id", "target", F.col("z_statistic").alias("statistic"),
                                                F.lit(None).cast("int").alias("degrees_freedom"), "p_value")
    return cat.unionByName(num)


def _tested(spark, d):
    """Both test tables with p-values, written once (one row per test; read by several branches)."""
    return (materialize(S.with_chi_p(_tests(spark, d))), materialize(S.with_normal_p(_mw(spark, d))))


def _assoc(spark, d, by_abs=True):
    cat, num = _tested(spark, d)
    return S.association_results(cat, num, by_abs=by_abs)


def q_rollup(spark, d):
    cat, num = _tested(spark, d)
    return S.test_rollup(S.association_results(cat, num), cat)


def q_bh(spark, d):
    return S.bh_adjust(fx.scored_survey(spark, d), ["y"], "p")


# ----------------------------------------------------------------- oracle text
def _dim_label_case() -> str:
    return "case " + " ".join(f"when dimension = '{k}' then '{lab}'" for k, _c, lab, _o in TEST_DIMS) + " end"


CT_CTE = (
    "ct_long as (" + " union all ".join(
        f"select '{k}' as dimension, {c} as category, wgt, {', '.join(fx.TARGETS)} from clean_survey"
        for k, c, _l, _o in TEST_DIMS) + "), "
    "ct_cells as (select dimension, category, count(*) as category_n, "
    "cast(sum(cast(wgt as decimal(18,2))) as double) as category_weight_sum, "
    + ", ".join(f"sum({t}) as pos_{t}, cast(sum({t} * cast(wgt as decimal(18,2))) as double) as wpos_{t}"
                for t in fx.TARGETS)
    + " from ct_long group by dimension, category), "
    "ct_t as (" + " union all ".join(
        f"select '{t}' as target, '{lab}' as outcome, dimension, {_dim_label_case()} as dimension_label, category, "
        f"category_n, category_weight_sum, pos_{t} as pos, wpos_{t} as wpos from ct_cells"
        for t, lab in fx.TARGETS.items()) + "), "
    "ct_tot as (select target, dimension, sum(category_n) as total_rows from ct_t group by target, dimension), "
    "ct_inc as (select *, sum(category_n) over (partition by target, dimension) as n_inc, "
    f"sum(pos) over (partition by target, dimension) as pos_total from ct_t where category not in ({EXCL})), "
    "contingency as (select i.target, i.outcome, i.dimension, i.dimension_label, i.category, "
    "cast(o.ov as integer) as outcome_value, "
    "cast(case when o.ov = 1 then i.pos else i.category_n - i.pos end as bigint) as observed_count, "
    "cast(i.category_n * (case when o.ov = 1 then i.pos_total else i.n_inc - i.pos_total end) as double) / i.n_inc "
    "as expected_count, i.category_n, i.category_weight_sum, i.wpos / i.category_weight_sum "
    "as category_weighted_positive_rate, cast(i.n_inc as bigint) as n_included, "
    "cast(t.total_rows - i.n_inc as bigint) as n_excluded_nonresponse "
    "from ct_inc i cross join (select unnest([0, 1]) as ov) o "
    "join ct_tot t on t.target = i.target and t.dimension = i.dimension), "
    "tests as (select target || ':' || dimension as test_id, target, dimension, min(n_included) as n_included, "
    "min(n_excluded_nonresponse) as n_excluded_nonresponse, cast(count(distinct category) as bigint) as category_count, "
    "case when count(*) filter (where expected_count <= 0) = 0 then "
    "sum((observed_count - expected_count) * (observed_count - expected_count) / expected_count) end as chi_square, "
    "cast(count(distinct category) - 1 as integer) as degrees_freedom, min(expected_count) as minimum_expected_count, "
    "count(*) filter (where expected_count < 5) as expected_cells_below_5, count(*) as expected_cells_total, "
    "bool_and(expected_count >= 5) as assumption_passed, "
    "first(category order by category_weighted_positive_rate, category) as lowest_weighted_rate_category, "
    "min(category_weighted_positive_rate) as lowest_weighted_rate, "
    "first(category order by category_weighted_positive_rate desc, category) as highest_weighted_rate_category, "
    "max(category_weighted_positive_rate) as highest_weighted_rate "
    "from contingency group by target, dimension), "
    "tests_v as (select *, cast(n_included as double) as nn, cast(category_count as double) as rr, "
    "chi_square / n_included as phi2 from tests), "
    "tests_e as (select *, case when nn <= 1 or rr < 2 then 0.0 "
    "when least(rr - (rr - 1) * (rr - 1) / (nn - 1) - 1, 2 - 1.0 / (nn - 1) - 1) > 0 then "
    "sqrt(greatest(0.0, phi2 - (rr - 1) / (nn - 1)) / least(rr - (rr - 1) * (rr - 1) / (nn - 1) - 1, "
    "2 - 1.0 / (nn - 1) - 1)) else 0.0 end as effect_size from tests_v)")

CT_SQL = ("select target, outcome, dimension, dimension_label, category, outcome_value, observed_count, "
          "expected_count, category_n, category_weight_sum, category_weighted_positive_rate from contingency")
CHI_SQL = ("select test_id, target, dimension, n_included, n_excluded_nonresponse, category_count, chi_square, "
           "degrees_freedom, minimum_expected_count, expected_cells_below_5, expected_cells_total, assumption_passed "
           "from tests")
V_SQL = ("select test_id, target, dimension, effect_size, case when abs(effect_size) < 0.10 then 'negligible' "
         "when abs(effect_size) < 0.30 then 'small' when abs(effect_size) < 0.50 then 'moderate' else 'large' end "
         "as effect_magnitude from tests_e")
EXT_SQL = ("select test_id, lowest_weighted_rate_category, lowest_weighted_rate, highest_weighted_rate_category, "
           "highest_weighted_rate, (highest_weighted_rate - lowest_weighted_rate) * 100 as weighted_rate_gap_pp "
           "from tests")

MW_CTE = (
    "mw_long as (" + " union all ".join(
        f"select '{t}' as target, '{lab}' as outcome, {t} as y, cast(age as double) as v from clean_survey"
        for t, lab in fx.TARGETS.items()) + "), "
    "mw_c as (select target, outcome, v, cast(count(*) filter (where y = 1) as double) as pos, "
    "cast(count(*) filter (where y = 0) as double) as neg from mw_long group by target, outcome, v), "
    "mw_cum as (select *, sum(neg) over (partition by target order by v rows between unbounded preceding "
    "and current row) as neg_le from mw_c), "
    "mw_s as (select target, outcome, sum(pos * (neg_le - neg / 2.0)) as u, sum(pos) as n1, sum(neg) as n0, "
    "sum(power(pos + neg, 3) - (pos + neg)) as tie from mw_cum group by target, outcome), "
    "mw_q as (select target, quantile_cont(v, 0.5) filter (where y = 0) as m0, "
    "quantile_cont(v, 0.5) filter (where y = 1) as m1, avg(v) filter (where y = 0) as a0, "
    "avg(v) filter (where y = 1) as a1 from mw_long group by target), "
    "mw as (select s.*, q.*, n1 + n0 as nn, sqrt(n1 * n0 / 12.0 * ((n1 + n0 + 1) - tie / ((n1 + n0) * (n1 + n0 - 1)))) "
    "as sigma, 2 * u / (n1 * n0) - 1 as rb from mw_s s join mw_q q using (target))")
MW_SQL = (
    "select target || ':age' as test_id, target, outcome, 'age' as variable, 'Respondent age' as variable_label, "
    "'Two-sided Mann-Whitney U' as test, cast(nn as bigint) as n_total, cast(n0 as bigint) as n_target_0, "
    "cast(n1 as bigint) as n_target_1, u as u_statistic, sigma as u_sigma, "
    "(greatest(u, n1 * n0 - u) - n1 * n0 / 2.0 - 0.5) / sigma as z_statistic, "
    "'rank-biserial correlation' as effect_metric, rb as effect_size, "
    "case when abs(rb) < 0.10 then 'negligible' when abs(rb) < 0.30 then 'small' when abs(rb) < 0.50 then 'moderate' "
    "else 'large' end as effect_magnitude, m0 as median_target_0, m1 as median_target_1, a0 as mean_target_0, "
    "a1 as mean_target_1, m1 - m0 as median_difference, "
    "case when rb > 0 then 'positive class older' else 'positive class younger' end as direction from mw")
DIST_SQL = (
    "select target, outcome, cast(y as integer) as outcome_value, count(*) as n, min(v) as minimum, "
    "quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median, avg(v) as mean, quantile_cont(v, 0.75) as q3, "
    "max(v) as maximum from mw_long group by target, outcome, y")
BH_CTE = (
    "bh_d as (select y, p, count(*) as c from scored_survey group by y, p), "
    "bh_r as (select y, p, sum(c) over (partition by y order by p rows between unbounded preceding and current row) "
    "as rnk, sum(c) over (partition by y) as m from bh_d), "
    "bh_q as (select y, p, least(1.0, greatest(0.0, min(p * m / rnk) over (partition by y order by p desc "
    "rows between unbounded preceding and current row))) as q from bh_r)")
BH_SQL = ("select s.respondent_id, s.y, s.p, q.q as adjusted_p_value from scored_survey s "
          "join bh_q q on q.y = s.y and q.p = s.p")

_P_CTE = (CT_CTE + ", " + MW_CTE + ", "
          "cat_p as (select test_id, target, outcome, dimension_label, chi_square, degrees_freedom, effect_size, "
          "assumption_passed, expected_cells_below_5, " + chi2_sf_sql("chi_square", "degrees_freedom") + " as p_value "
          "from tests_e join (select distinct target, dimension, outcome, dimension_label from contingency) using (target, dimension)), "
          "num_z as (" + MW_SQL + "), "
          "num_p as (select *, " + normal_two_sided_sql("z_statistic") + " as p_value from num_z)")
P_SQL = ("select test_id, target, chi_square as statistic, degrees_freedom, p_value from cat_p "
         "union all select test_id, target, z_statistic, cast(null as integer), p_value from num_p")
_MAG = ("case when abs(effect_size) < 0.10 then 'negligible' when abs(effect_size) < 0.30 then 'small' "
        "when abs(effect_size) < 0.50 then 'moderate' else 'large' end")
ASSOC_CTE = (
    _P_CTE + ", assoc0 as (select test_id, target, outcome, dimension_label as variable_label, "
    "'Pearson chi-square test of independence' as test, p_value, 'bias-corrected Cramer''s V' as effect_metric, effect_size, "
    + _MAG + " as effect_magnitude from cat_p union all "
    "select test_id, target, outcome, variable_label, test, p_value, effect_metric, effect_size, effect_magnitude from num_p), "
    "assoc1 as (select *, least(1.0, p_value * count(*) over (partition by target) / "
    "count(*) over (partition by target order by p_value range between unbounded preceding and current row)) as raw from assoc0), "
    "assoc2 as (select *, min(raw) over (partition by target order by p_value desc range between unbounded preceding "
    "and current row) as adjusted_p_value from assoc1), "
    "assoc as (select test_id, target, outcome, variable_label, test, p_value, effect_metric, effect_size, effect_magnitude, "
    "adjusted_p_value, adjusted_p_value < 0.05 as significant_fdr_0_05, "
    "cast(row_number() over (partition by target order by abs(effect_size) desc, test_id) as integer) as effect_rank from assoc2)")
ROLL_SQL = (
    "select a.target, count(*) as tests, count(*) filter (where significant_fdr_0_05) as significant, "
    "min(c.ok) as assumption_passed_tests, min(c.low) as expected_cells_below_5 from assoc a "
    "left join (select target, count(*) filter (where assumption_passed) as ok, cast(sum(expected_cells_below_5) as bigint) as low "
    "from cat_p group by target) c using (target) group by a.target")

QUERIES = [
    Query("contingency", "F1", q_contingency, CT_SQL,
          ("expected_count", "category_weight_sum", "category_weighted_positive_rate"), ctes=CT_CTE),
    Query("chi_square", "F2,F5", q_chi, CHI_SQL, ("chi_square", "minimum_expected_count"), ctes=CT_CTE),
    Query("cramers_v", "F3,F4", q_v, V_SQL, ("effect_size",), ctes=CT_CTE),
    Query("extreme_categories", "F6", q_ext, EXT_SQL,
          ("lowest_weighted_rate", "highest_weighted_rate", "weighted_rate_gap_pp"), ctes=CT_CTE),
    Query("mann_whitney", "F7,F8", _mw, MW_SQL,
          ("u_statistic", "u_sigma", "z_statistic", "effect_size", "median_target_0", "median_target_1",
           "mean_target_0", "mean_target_1", "median_difference"), ctes=MW_CTE),
    Query("class_distribution", "F9",
          lambda s, d: S.class_distribution(fx.clean_survey(s, d), fx.TARGETS, "age"), DIST_SQL,
          ("minimum", "q1", "median", "mean", "q3", "maximum"), ctes=MW_CTE),
    Query("bh_adjust", "F10", q_bh, BH_SQL, ("p", "adjusted_p_value"), ctes=BH_CTE),
    Query("p_values", "F2,F7", q_p_values, P_SQL, ("statistic", "p_value"), ctes=_P_CTE),
    Query("association_results", "F10,F11", _assoc, "select * from assoc", ("p_value", "effect_size", "adjusted_p_value"), ctes=ASSOC_CTE),
    Query("association_signed", "F11", lambda s, d: _assoc(s, d, by_abs=False), "select * replace (cast(row_number() over (partition by target order by effect_size desc, "
          "test_id) as integer) as effect_rank) from assoc", ("p_value", "effect_size", "adjusted_p_value"), ctes=ASSOC_CTE),
    Query("test_rollup", "F12", q_rollup, ROLL_SQL, ctes=ASSOC_CTE),
]
