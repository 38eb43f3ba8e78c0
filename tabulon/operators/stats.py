"""F — inferential statistics: contingency, χ², Cramér's V, Mann–Whitney, BH.

The contingency cells for every (target, dimension) come from the same single
GROUPING SETS aggregate used by the subgroup rates; everything after that works
on the aggregated cells (size bounded by the declared categories).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.tails import chi2_sf, normal_two_sided
from tabulon.operators.ordered import quantiles, running
from tabulon.operators.survey import grouped_by_dimension, wsum

NON_SUBSTANTIVE = ("Nonresponse", "Missing or nonresponse")


def contingency(df: DataFrame, targets: Mapping[str, str], dimensions: Sequence[tuple], weight: str,
                exclude: Sequence[str] = NON_SUBSTANTIVE, scale: int | None = None) -> DataFrame:
    """observed count per (target, dimension, category, outcome 0/1) + expected count, n, Σw, rate.

    Excluded (non-substantive) categories leave the test but are counted in
    ``n_excluded`` (total rows − included rows of that dimension).
    """
    aggs: dict[str, Column] = {"category_n": F.count(F.lit(1)).cast("bigint"),
                               "category_weight_sum": wsum(weight, scale)}
    for i, t in enumerate(targets):
        aggs[f"__pos_{i}"] = F.sum(F.col(t).cast("bigint"))
        aggs[f"__wpos_{i}"] = wsum(F.col(t) * F.col(weight), scale)
    cells = grouped_by_dimension(df, dimensions, aggs)
    labels = {k: label for k, _c, label, _o in dimensions}
    dim_label = None
    for k, label in labels.items():
        cond = F.col("dimension") == k
        dim_label = F.when(cond, F.lit(label)) if dim_label is None else dim_label.when(cond, F.lit(label))
    parts = [F.struct(F.lit(t).alias("target"), F.lit(lab).alias("outcome"),
                      F.col(f"__pos_{i}").alias("pos"), F.col(f"__wpos_{i}").alias("wpos"))
             for i, (t, lab) in enumerate(targets.items())]
    long = cells.select("dimension", dim_label.alias("dimension_label"), "category", "category_n",
                        "category_weight_sum", F.explode(F.array(*parts)).alias("t")) \
        .select("t.target", "t.outcome", "dimension", "dimension_label", "category", "category_n",
                "category_weight_sum", "t.pos", "t.wpos")
    wtest = Window.partitionBy("target", "dimension")
    long = long.withColumn("__total_rows", F.sum("category_n").over(wtest))
    inc = long.filter(~F.col("category").isin(*exclude))
    inc = inc.withColumn("__n", F.sum("category_n").over(wtest)) \
        .withColumn("__pos_total", F.sum("pos").over(wtest))
    rate = (F.col("wpos") / F.col("category_weight_sum")).alias("category_weighted_positive_rate")
    outcome = F.explode(F.array(F.lit(0), F.lit(1))).alias("outcome_value")
    cells = inc.select("*", rate, outcome)
    observed = F.when(F.col("outcome_value") == 1, F.col("pos")).otherwise(F.col("category_n") - F.col("pos"))
    col_total = F.when(F.col("outcome_value") == 1, F.col("__pos_total")).otherwise(F.col("__n") - F.col("__pos_total"))
    return cells.select(
        "target", "outcome", "dimension", "dimension_label", "category",
        F.col("outcome_value").cast("int").alias("outcome_value"),
        observed.cast("bigint").alias("observed_count"),
        (F.col("category_n") * col_total / F.col("__n")).cast("double").alias("expected_count"),
        "category_n", "category_weight_sum", "category_weighted_positive_rate",
        F.col("__n").cast("bigint").alias("n_included"),
        (F.col("__total_rows") - F.col("__n")).cast("bigint").alias("n_excluded_nonresponse"),
    )


def bias_corrected_v(chi2: Column, n: Column, r: Column, c: Column) -> Column:
    """bias-corrected Cramér's V; 0 when n ≤ 1, r < 2, c < 2 or the denominator ≤ 0."""
    phi2 = chi2 / n
    phi_c = F.greatest(F.lit(0.0), phi2 - (c - 1) * (r - 1) / (n - 1))
    r_c = r - (r - 1) * (r - 1) / (n - 1)
    c_c = c - (c - 1) * (c - 1) / (n - 1)
    den = F.least(r_c - 1, c_c - 1)
    return (F.when((n <= 1) | (r < 2) | (c < 2), F.lit(0.0))
            .when(den > 0, F.sqrt(phi_c / den)).otherwise(F.lit(0.0)))


def effect_magnitude(e: Column) -> Column:
    """|e| < .10 negligible, < .30 small, < .50 moderate, else large."""
    a = F.abs(e)
    return (F.when(a < 0.10, "negligible").when(a < 0.30, "small").when(a < 0.50, "moderate")
            .otherwise("large"))


def chi_square_tests(cells: DataFrame) -> DataFrame:
    """F2 + F3 + F5 + F6: one row per test from the contingency cells (no continuity correction).

    A zero outcome margin makes the statistic undefined → NULL statistic.
    """
    e = F.col("expected_count")
    o = F.col("observed_count")
    per_test = cells.groupBy("target", "outcome", "dimension", "dimension_label").agg(
        F.first("n_included").alias("n_included"),
        F.first("n_excluded_nonresponse").alias("n_excluded_nonresponse"),
        F.count_distinct("category").cast("bigint").alias("category_count"),
        F.sum(F.when(e > 0, (o - e) * (o - e) / e)).alias("__chi"),
        F.count_if(e <= 0).alias("__zero_cells"),
        F.min(e).alias("minimum_expected_count"),
        F.count_if(e < 5).cast("bigint").alias("expected_cells_below_5"),
        F.count(F.lit(1)).cast("bigint").alias("expected_cells_total"),
        F.bool_and(e >= 5).alias("assumption_passed"),
        # extremes over the per-category rates; ties → first category in sorted order
        F.min_by("category", F.struct("category_weighted_positive_rate", "category"))
        .alias("lowest_weighted_rate_category"),
        F.min("category_weighted_positive_rate").alias("lowest_weighted_rate"),
        F.min_by("category", F.struct((-F.col("category_weighted_positive_rate")).alias("r"), "category"))
        .alias("highest_weighted_rate_category"),
        F.max("category_weighted_positive_rate").alias("highest_weighted_rate"),
    )
    chi = F.when(F.col("__zero_cells") == 0, F.col("__chi"))
    r = F.col("category_count").cast("double")
    n = F.col("n_included").cast("double")
    v = bias_corrected_v(chi, n, r, F.lit(2.0))
    return per_test.select(
        F.concat_ws(":", "target", "dimension").alias("test_id"), "target", "outcome", "dimension",
        "dimension_label", F.lit("Pearson chi-square test of independence").alias("test"),
        "n_included", "n_excluded_nonresponse", "category_count",
        chi.alias("chi_square"), ((F.col("category_count") - 1) * 1).cast("int").alias("degrees_freedom"),
        F.lit("bias-corrected Cramer's V").alias("effect_metric"),
        v.alias("effect_size"), effect_magnitude(v).alias("effect_magnitude"),
        "minimum_expected_count", "expected_cells_below_5", "expected_cells_total", "assumption_passed",
        "lowest_weighted_rate_category", "lowest_weighted_rate", "highest_weighted_rate_category",
        "highest_weighted_rate",
        ((F.col("highest_weighted_rate") - F.col("lowest_weighted_rate")) * 100).alias("weighted_rate_gap_pp"),
    )


def with_chi_p(tests: DataFrame) -> DataFrame:
    """F2 tail: p from the χ² survival function."""
    return tests.withColumn("p_value", chi2_sf(F.col("chi_square"), F.col("degrees_freedom")))


def mann_whitney(df: DataFrame, targets: Mapping[str, str], value: str,
                 variable_label: str | None = None) -> DataFrame:
    """F7 + F8: two-sided asymptotic Mann–Whitney U (tie-corrected σ, 0.5 continuity correction).

    Rows collapse to (target, value) class counts first; the ordered part runs
    on distinct values through the range-partitioned running sum.
    """
    parts = [F.struct(F.lit(t).alias("target"), F.lit(lab).alias("outcome"), F.col(t).cast("int").alias("y"))
             for t, lab in targets.items()]
    long = df.select(F.col(value).cast("double").alias("v"), F.explode(F.array(*parts)).alias("t")) \
        .select("t.target", "t.outcome", "t.y", "v")
    counts = long.groupBy("target", "outcome", "v").agg(
        F.count_if(F.col("y") == 1).cast("double").alias("pos"),
        F.count_if(F.col("y") == 0).cast("double").alias("neg"))
    cum = running(counts, ["target"], "v", {"neg_le": ("neg", "sum")})
    per = cum.groupBy("target", "outcome").agg(
        F.sum(F.col("pos") * (F.col("neg_le") - F.col("neg") / 2.0)).alias("u_statistic"),
        F.sum("pos").alias("n1"), F.sum("neg").alias("n0"),
        F.sum(F.pow(F.col("pos") + F.col("neg"), 3) - (F.col("pos") + F.col("neg"))).alias("tie_term"))
    stats = per.withColumn("__n", F.col("n1") + F.col("n0")).withColumn("__mu", F.col("n1") * F.col("n0") / 2.0)
    sigma = F.sqrt(F.col("n1") * F.col("n0") / 12.0
                   * ((F.col("__n") + 1) - F.col("tie_term") / (F.col("__n") * (F.col("__n") - 1))))
    big_u = F.greatest(F.col("u_statistic"), F.col("n1") * F.col("n0") - F.col("u_statistic"))
    z = (big_u - F.col("__mu") - 0.5) / sigma
    rb = 2 * F.col("u_statistic") / (F.col("n1") * F.col("n0")) - 1
    # F8/F9 class summaries: exact linear-interpolated medians and means per class
    dist = class_distribution(df, targets, value).select(
        "target", "outcome_value", "median", "mean")
    med = dist.groupBy("target").agg(
        F.max(F.when(F.col("outcome_value") == 0, F.col("median"))).alias("median_target_0"),
        F.max(F.when(F.col("outcome_value") == 1, F.col("median"))).alias("median_target_1"),
        F.max(F.when(F.col("outcome_value") == 0, F.col("mean"))).alias("mean_target_0"),
        F.max(F.when(F.col("outcome_value") == 1, F.col("mean"))).alias("mean_target_1"))
    out = stats.select(
        F.concat_ws(":", "target", F.lit(value)).alias("test_id"), "target", "outcome",
        F.lit(value).alias("variable"), F.lit(variable_label or value).alias("variable_label"),
        F.lit("Two-sided Mann-Whitney U").alias("test"),
        F.col("__n").cast("bigint").alias("n_total"), F.col("n0").cast("bigint").alias("n_target_0"),
        F.col("n1").cast("bigint").alias("n_target_1"), "u_statistic", sigma.alias("u_sigma"),
        z.alias("z_statistic"), F.lit("rank-biserial correlation").alias("effect_metric"),
        rb.alias("effect_size"), effect_magnitude(rb).alias("effect_magnitude"))
    out = out.join(med, "target", "left")
    return out.withColumn("median_difference", F.col("median_target_1") - F.col("median_target_0")) \
        .withColumn("direction", F.when(F.col("effect_size") > 0, "positive class older")
                    .otherwise("positive class younger"))


def with_normal_p(tests: DataFrame) -> DataFrame:
    return tests.withColumn("p_value", normal_two_sided(F.col("z_statistic")))


def class_distribution(df: DataFrame, targets: Mapping[str, str], value: str) -> DataFrame:
    """n, min, q1, median, mean, q3, max per (target, class); exact linear-interpolated quantiles.

    Rows collapse to counts per value; the quantiles are read from running counts.
    """
    parts = [F.struct(F.lit(t).alias("target"), F.lit(lab).alias("outcome"), F.col(t).cast("int").alias("y"))
             for t, lab in targets.items()]
    long = df.select(F.col(value).cast("double").alias("v"), F.explode(F.array(*parts)).alias("t")) \
        .select("t.target", "t.outcome", F.col("t.y").alias("outcome_value"), "v")
    by = ["target", "outcome", "outcome_value"]
    counts = long.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("c"))
    held = counts.filter(F.col("v").isNotNull() & F.col("outcome_value").isNotNull())
    q = quantiles(held, by, "v", "c", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    agg = counts.groupBy(*by).agg(
        F.sum("c").cast("bigint").alias("n"), F.min("v").alias("minimum"),
        (F.sum(F.col("v") * F.col("c")) / F.sum(F.when(F.col("v").isNotNull(), F.col("c")))).alias("mean"),
        F.max("v").alias("maximum"))
    return agg.join(q, by, "left").select("target", "outcome", F.col("outcome_value").cast("int").alias("outcome_value"), "n",
                                          "minimum", "q1", "median", "mean", "q3", "maximum")


def bh_adjust(df: DataFrame, family: Sequence[str], p: str = "p_value", out: str = "adjusted_p_value",
              strict: bool = True) -> DataFrame:
    """Benjamini–Hochberg q per family: min over p' ≥ p of p'·m/rank(p'), clipped to [0, 1].

    Ties share the value of the last tied rank (same as a stable argsort), so the
    work runs on distinct p per family via the range-partitioned running scans;
    rows get their q back through an equi-join on (family, p).
    """
    fam = list(family)
    pv = F.col(p).cast("double")
    base = df
    if strict:
        base = df.withColumn(p, F.when(pv.isNull() | F.isnan(pv), F.raise_error(F.lit("p-value is NULL/NaN")))
                             .otherwise(pv))
    distinct = base.groupBy(*fam, F.col(p).alias("__p")).agg(F.count(F.lit(1)).alias("__c"))
    m = distinct.groupBy(*fam).agg(F.sum("__c").alias("__m"))
    cum = running(distinct, fam, "__p", {"__rank": ("__c", "sum")})
    cum = cum.join(m, fam, "inner").withColumn("__raw", F.col("__p") * F.col("__m") / F.col("__rank"))
    suff = running(cum, fam, "__p", {"__q": ("__raw", "min")}, descending=True)
    qtab = suff.select(*[F.col(f).alias(f"__f_{f}") for f in fam], "__p",
                       F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("__q"))).alias(out))
    cond = [F.col(f) == F.col(f"__f_{f}") for f in fam] + [F.col(p) == F.col("__p")]
    return base.join(qtab, cond, "left").drop(*[f"__f_{f}" for f in fam], "__p")


def association_results(categorical: DataFrame, numeric: DataFrame, alpha: float = 0.05, by_abs: bool = False) -> DataFrame:
    """aligned union of test results, BH within target, significance flag, rank by effect size, with ``by_abs`` by its size without sign."""
    cols = ["test_id", "target", "outcome", "variable_label", "test", "p_value", "effect_metric",
            "effect_size", "effect_magnitude"]
    cat = categorical.withColumnRenamed("dimension_label", "variable_label").select(*cols)
    num = numeric.select(*cols)
    allr = cat.unionByName(num)
    adj = bh_adjust(allr, ["target"], "p_value")
    adj = adj.withColumn("significant_fdr_0_05", F.col("adjusted_p_value") < alpha)
    # one row per (target, test): as many as declared tests
    size = F.abs(F.col("effect_size")) if by_abs else F.col("effect_size")
    return adj.withColumn("effect_rank", F.row_number().over(
        Window.partitionBy("target").orderBy(size.desc(), "test_id")))


def test_rollup(results: DataFrame, categorical: DataFrame | None = None) -> DataFrame:
    """tests and significant tests per outcome (+ assumption totals when given)."""
    out = results.groupBy("target").agg(F.count(F.lit(1)).cast("bigint").alias("tests"),
                                        F.count_if("significant_fdr_0_05").cast("bigint").alias("significant"))
    if categorical is not None:
        a = categorical.groupBy("target").agg(
            F.count_if("assumption_passed").cast("bigint").alias("assumption_passed_tests"),
            F.sum("expected_cells_below_5").cast("bigint").alias("expected_cells_below_5"))
        out = out.join(a, "target", "left")
    return out
