"""E-family queries over clean_survey."""

from __future__ import annotations

from tabulon.operators import survey as E
from tabulon.plans.base import Query, values_sql
from tabulon.sources import fixtures as fx

W = "wgt"
SCALE = 2  # the fixture weight carries two decimals → exact integer sums
GAP_PAIRS = (
    ("y_a", "education", "Primary education or less", "Tertiary education or more"),
    ("y_a", "income_quintile", "Income quintile 1", "Income quintile 5"),
    ("y_b", "internet_use", fx.COMBINED_NO, "Yes"),
    ("y_b", "phone_ownership", "No", "Yes"),
)


def _rates(spark, d):
    return E.subgroup_rates(fx.clean_survey(spark, d), fx.TARGETS, fx.DIMENSIONS, W, scale=SCALE)


def q_overall(spark, d):
    return E.overall_rates(fx.clean_survey(spark, d), fx.TARGETS, W, scale=SCALE)


def q_weight_checks(spark, d):
    return E.weight_stats(fx.raw_survey(spark, d), W, scale=SCALE)


def q_unexpected(spark, d):
    # the declared order deliberately omits one region so the gate has something to report
    dims = [dim if dim[0] != "region" else (dim[0], dim[1], dim[2], dim[3][:-1]) for dim in fx.DIMENSIONS]
    return E.unexpected_categories(fx.clean_survey(spark, d), dims)


def q_panel(spark, d):
    return E.category_panel(_rates(spark, d), "income_quintile", list(fx.TARGETS))


def q_gaps(spark, d):
    pairs = spark.createDataFrame(list(GAP_PAIRS), "target string, dimension string, "
                                                   "category_a string, category_b string")
    return E.rate_gaps(_rates(spark, d), pairs)


# ----------------------------------------------------------------- oracle text
def _dims_values():
    rows = [(k, label, i + 1, cat) for k, _c, label, order in fx.DIMENSIONS for i, cat in enumerate(order)]
    return values_sql(rows, ["dimension", "dimension_label", "category_order", "category"])


def subgroup_cte() -> str:
    longs = " union all ".join(
        f"select '{k}' as dimension, {c} as category, wgt, {', '.join(fx.TARGETS)} from clean_survey"
        for k, c, _l, _o in fx.DIMENSIONS)
    tsums = ", ".join(f"sum({t}) as pos_{t}, sum({t} * cast(wgt as decimal(18,2))) as wpos_{t}"
                      for t in fx.TARGETS)
    per_target = " union all ".join(
        f"select '{t}' as target, '{label}' as outcome, a.dimension, d.dimension_label, d.category_order, "
        f"a.category, a.n, cast(pos_{t} as bigint) as positive_count, cast(ws as double) as weight_sum, "
        f"cast(wpos_{t} as double) as weighted_positive, "
        f"cast(wpos_{t} as double) / cast(ws as double) as weighted_rate, "
        f"cast(pos_{t} as double) / a.n as unweighted_rate, "
        f"(a.n >= 10 and a.category not in ('Nonresponse', 'Missing or nonresponse')) as chart_eligible "
        f"from sg_agg a join {_dims_values()} d on a.dimension = d.dimension and a.category = d.category"
        for t, label in fx.TARGETS.items())
    return (f"sg_long as ({longs}), "
            f"sg_agg as (select dimension, category, count(*) as n, sum(cast(wgt as decimal(18,2))) as ws, {tsums} "
            f"from sg_long group by dimension, category), "
            f"subgroup_rates as ({per_target})")


RATE_DOUBLES = ("weight_sum", "weighted_positive", "weighted_rate", "unweighted_rate")

OVERALL_SQL = " union all ".join(
    f"select '{t}' as target, '{label}' as outcome, count(*) as n, cast(sum({t}) as bigint) as positive_count, "
    f"cast(sum(cast(wgt as decimal(18,2))) as double) as weight_sum, "
    f"cast(sum({t} * cast(wgt as decimal(18,2))) as double) / cast(sum(cast(wgt as decimal(18,2))) as double) as weighted_rate, "
    f"cast(sum({t}) as double) / count(*) as unweighted_rate, "
    f"(cast(sum({t} * cast(wgt as decimal(18,2))) as double) / cast(sum(cast(wgt as decimal(18,2))) as double) "
    f"- cast(sum({t}) as double) / count(*)) * 100 as weighted_minus_unweighted_pp from clean_survey"
    for t, label in fx.TARGETS.items())

_UNEXP_DIMS = values_sql([(k, cat) for k, _c, _l, order in fx.DIMENSIONS
                          for cat in (order if k != "region" else order[:-1])], ["dimension", "category"])
UNEXPECTED_SQL = (
    "select l.dimension, l.category, count(*) as n from sg_long l "
    f"where not exists (select 1 from {_UNEXP_DIMS} d where d.dimension = l.dimension and d.category = l.category) "
    "group by l.dimension, l.category")

PANEL_SQL = (
    "select dimension, category_order, category, "
    + ", ".join(f"max(case when target = '{t}' then weighted_rate end) as {t}" for t in fx.TARGETS)
    + " from subgroup_rates where dimension = 'income_quintile' and chart_eligible "
      "group by dimension, category_order, category")

GAPS_SQL = (
    "select p.target, p.dimension, p.category_a, p.category_b, a.weighted_rate as rate_a, "
    "b.weighted_rate as rate_b, (b.weighted_rate - a.weighted_rate) * 100 as gap_pp "
    f"from {values_sql(GAP_PAIRS, ['target', 'dimension', 'category_a', 'category_b'])} p "
    "join subgroup_rates a on a.target = p.target and a.dimension = p.dimension and a.category = p.category_a "
    "join subgroup_rates b on b.target = p.target and b.dimension = p.dimension and b.category = p.category_b")

QUERIES = [
    Query("overall_rates", "E2,E4", q_overall, OVERALL_SQL,
          ("weight_sum", "weighted_rate", "unweighted_rate", "weighted_minus_unweighted_pp")),
    Query("subgroup_rates", "E3,E5,E6,E7", _rates, "select * from subgroup_rates", RATE_DOUBLES,
          ctes=subgroup_cte()),
    Query("weight_checks", "E1", q_weight_checks,
          "select count(wgt) as weight_count, count(*) filter (where wgt is null) as weight_missing, "
          "count(*) filter (where isnan(wgt) or isinf(wgt)) as weight_nonfinite, "
          "count(*) filter (where wgt <= 0) as weight_nonpositive, min(wgt) as weight_min, max(wgt) as weight_max, "
          "cast(sum(cast(wgt as decimal(18,2))) as double) as weight_sum from raw_survey",
          ("weight_min", "weight_max", "weight_sum")),
    Query("unexpected_categories", "E6", q_unexpected, UNEXPECTED_SQL, (), ctes=subgroup_cte()),
    Query("category_panel", "E8", q_panel, PANEL_SQL, tuple(fx.TARGETS), ctes=subgroup_cte()),
    Query("rate_gaps", "E9", q_gaps, GAPS_SQL, ("rate_a", "rate_b", "gap_pp"), ctes=subgroup_cte()),
]
