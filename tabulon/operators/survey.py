"""E — survey-weighted description (weights, overall and subgroup rates, panels, gaps).

All subgroup statistics for every (dimension, target) come out of ONE
``GROUPING SETS`` aggregate: partial aggregation runs map-side, so the shuffle
carries one row per (task, dimension, category) regardless of the row count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.exprs import col_

NON_SUBSTANTIVE = ("Nonresponse", "Missing or nonresponse")


def wsum(c: str | Column, scale: int | None = None) -> Column:
    """Σ of a weight expression.

    With ``scale`` (number of decimals the weights carry) the sum is a decimal one:
    exact, wide enough for any table and independent of partitioning/summation order.
    """
    v = col_(c)
    if scale is None:
        return F.sum(v.cast("double"))
    return F.sum(v.cast(f"decimal({18 + scale},{scale})")).cast("double")


def weight_stats(df: DataFrame, weight: str, scale: int | None = None) -> DataFrame:
    """One-row validity/stat summary of the weight column."""
    w = F.col(weight).cast("double")
    return df.agg(
        F.count(w).cast("bigint").alias("weight_count"),
        F.count_if(w.isNull()).cast("bigint").alias("weight_missing"),
        F.count_if(F.isnan(w) | (F.abs(w) == float("inf"))).cast("bigint").alias("weight_nonfinite"),
        F.count_if(w <= 0).cast("bigint").alias("weight_nonpositive"),
        F.min(w).alias("weight_min"), F.max(w).alias("weight_max"), wsum(w, scale).alias("weight_sum"),
    )


def assert_valid_weights(df: DataFrame, weight: str) -> DataFrame:
    """E1 gate inline: a NULL, non-finite or non-positive weight raises when the row is read."""
    w = F.col(weight).cast("double")
    bad = w.isNull() | F.isnan(w) | (F.abs(w) == float("inf")) | (w <= 0)
    return df.withColumn(weight, F.when(bad, F.raise_error(F.lit(f"{weight} must be complete, finite and > 0")))
                         .otherwise(w))


def _targets_long(agg: DataFrame, keys: Sequence[str], targets: Mapping[str, str]) -> DataFrame:
    """Per-target aggregate columns → one row per target (stack after the aggregate, tiny)."""
    parts = [F.struct(F.lit(t).alias("target"), F.lit(label).alias("outcome"),
                      F.col(f"__pos_{i}").alias("positive_count"),
                      F.col(f"__wpos_{i}").alias("weighted_positive"))
             for i, (t, label) in enumerate(targets.items())]
    return agg.select(*keys, "n", "weight_sum", F.explode(F.array(*parts)).alias("t")) \
        .select(*keys, "t.target", "t.outcome", "n", "t.positive_count", "weight_sum", "t.weighted_positive")


def _target_aggs(targets: Mapping[str, str], weight: str, scale: int | None) -> dict[str, Column]:
    aggs = {"n": F.count(F.lit(1)).cast("bigint"), "weight_sum": wsum(weight, scale)}
    for i, t in enumerate(targets):
        aggs[f"__pos_{i}"] = F.sum(F.col(t).cast("bigint"))
        aggs[f"__wpos_{i}"] = wsum(F.col(t) * F.col(weight), scale)
    return aggs


def overall_rates(df: DataFrame, targets: Mapping[str, str], weight: str,
                  scale: int | None = None) -> DataFrame:
    """Per target n, positives, Σw, weighted and unweighted rate, difference in pp."""
    agg = df.agg(*[a.alias(n) for n, a in _target_aggs(targets, weight, scale).items()])
    long = _targets_long(agg, [], targets)
    return long.select(
        "target", "outcome", "n", "positive_count", "weight_sum",
        (F.col("weighted_positive") / F.col("weight_sum")).alias("weighted_rate"),
        (F.col("positive_count") / F.col("n")).alias("unweighted_rate"),
    ).withColumn("weighted_minus_unweighted_pp",
                 (F.col("weighted_rate") - F.col("unweighted_rate")) * 100)


def dimension_table(spark: SparkSession, dimensions: Sequence[tuple]) -> DataFrame:
    """(dimension, dimension_label, category_order, category) lookup from the declared orders."""
    rows = [(key, label, i + 1, cat) for key, _col, label, order in dimensions
            for i, cat in enumerate(order)]
    return spark.createDataFrame(rows, "dimension string, dimension_label string, "
                                       "category_order int, category string")


def grouped_by_dimension(df: DataFrame, dimensions: Sequence[tuple],
                         aggs: Mapping[str, Column]) -> DataFrame:
    """One GROUPING SETS pass over all dimension columns → (dimension, category, aggs...).

    ``grouping_id`` tells which set a row belongs to; it is mapped back to the
    dimension key, so the long result needs no second scan per dimension.
    """
    cols = [c for _k, c, _l, _o in dimensions]
    if len(set(cols)) != len(cols):
        raise ValueError("each dimension needs its own column")
    grouped = df.groupingSets([[c] for c in cols], *cols).agg(
        *[a.alias(n) for n, a in aggs.items()], F.grouping_id(*cols).alias("__gid"))
    nbits = len(cols)
    dim_expr = cat_expr = None
    for idx, (key, c, _label, _order) in enumerate(dimensions):
        # bit set ⇔ column NOT grouped (leftmost column = most significant bit)
        cond = F.col("__gid") == (((1 << nbits) - 1) ^ (1 << (nbits - 1 - idx)))
        dim_expr = F.when(cond, F.lit(key)) if dim_expr is None else dim_expr.when(cond, F.lit(key))
        cat = F.col(c).cast("string")
        cat_expr = F.when(cond, cat) if cat_expr is None else cat_expr.when(cond, cat)
    return grouped.select(dim_expr.alias("dimension"), cat_expr.alias("category"), *aggs.keys())


def subgroup_rates(df: DataFrame, targets: Mapping[str, str], dimensions: Sequence[tuple],
                   weight: str, min_n: int = 10, non_substantive: Sequence[str] = NON_SUBSTANTIVE,
                   scale: int | None = None, strict: bool = True) -> DataFrame:
    """E5 (+E6 gate, E7 flag): weighted and plain rates per (target, dimension, category).

    Categories outside the declared order raise (strict) — checked inline on the
    aggregated rows, so the gate costs no extra job. Empty groups never appear.
    """
    spark = df.sparkSession
    agg = grouped_by_dimension(df, dimensions, _target_aggs(targets, weight, scale))
    order = dimension_table(spark, dimensions)
    # the order table is bounded by the declared categories (a parameter): broadcast is safe
    joined = agg.join(F.broadcast(order), ["dimension", "category"], "left")
    if strict:
        joined = joined.withColumn(
            "category_order",
            F.when(F.col("category_order").isNull(),
                   F.raise_error(F.concat(F.lit("unexpected category for "), F.col("dimension"),
                                          F.lit(": "), F.coalesce(F.col("category"), F.lit("NULL")))))
            .otherwise(F.col("category_order")))
    long = _targets_long(joined, ["dimension", "dimension_label", "category_order", "category"], targets)
    return long.select(
        "target", "outcome", "dimension", "dimension_label", "category_order", "category",
        "n", "positive_count", "weight_sum", "weighted_positive",
        (F.col("weighted_positive") / F.col("weight_sum")).alias("weighted_rate"),
        (F.col("positive_count") / F.col("n")).alias("unweighted_rate"),
        ((F.col("n") >= min_n) & ~F.col("category").isin(*non_substantive)).alias("chart_eligible"),
    )


def unexpected_categories(df: DataFrame, dimensions: Sequence[tuple]) -> DataFrame:
    """E6 as data: observed (dimension, category, n) outside the declared order (left anti join)."""
    spark = df.sparkSession
    observed = grouped_by_dimension(df, dimensions, {"n": F.count(F.lit(1)).cast("bigint")})
    return observed.join(F.broadcast(dimension_table(spark, dimensions)), ["dimension", "category"], "left_anti")


def category_panel(rates: DataFrame, dimension: str, targets: Sequence[str],
                   value: str = "weighted_rate") -> DataFrame:
    """Eligible rows of one dimension pivoted to one column per target."""
    return (rates.filter((F.col("dimension") == dimension) & F.col("chart_eligible"))
            .groupBy("dimension", "category_order", "category")
            .pivot("target", list(targets)).agg(F.first(value)))


def rate_gaps(rates: DataFrame, pairs: DataFrame) -> DataFrame:
    """Named category pairs → (rate_a, rate_b, gap_pp); each side must match exactly one cell.

    ``pairs``: (target, dimension, category_a, category_b). Two equi-joins, no self cross product.
    """
    cells = rates.select("target", "dimension", "category", "weighted_rate")
    counted = cells.groupBy("target", "dimension", "category").agg(
        F.count(F.lit(1)).alias("__cells"), F.first("weighted_rate").alias("rate"))
    a = counted.withColumnsRenamed({"category": "category_a", "rate": "rate_a", "__cells": "__na"})
    b = counted.withColumnsRenamed({"category": "category_b", "rate": "rate_b", "__cells": "__nb"})
    out = (pairs.join(a, ["target", "dimension", "category_a"], "left")
           .join(b, ["target", "dimension", "category_b"], "left"))
    bad = F.coalesce(F.col("__na"), F.lit(0)) != 1
    bad_b = F.coalesce(F.col("__nb"), F.lit(0)) != 1
    return out.select(
        "target", "dimension", "category_a", "category_b",
        F.when(bad, F.raise_error(F.lit("rate cell a not unique"))).otherwise(F.col("rate_a")).alias("rate_a"),
        F.when(bad_b, F.raise_error(F.lit("rate cell b not unique"))).otherwise(F.col("rate_b")).alias("rate_b"),
    ).withColumn("gap_pp", (F.col("rate_b") - F.col("rate_a")) * 100)
