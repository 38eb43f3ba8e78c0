"""Running (cumulative) aggregates and exact quantiles along a global order, without a single-task window.

A window ``partitionBy(family).orderBy(x)`` puts a whole family in one task.
Here rows are range-partitioned on (family, x) and written with the number of
their range; equal keys always share a range, and the written table makes every
recomputation (retries, executor loss, several branches of one plan) agree. Then:

1. partial aggregates per (family, range)                  — tiny table
2. carry-in from all earlier ranges of the family          — window over the tiny table
3. running aggregate inside each (family, range)           — window bounded by one range
4. combine local value with the carry                      — equi-join on (family, range)

One path at every size. Callers first collapse rows to distinct order values
(counts per value), so a hot value is one row, never a skewed range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.session import materialize

_OPS = {"sum": F.sum, "min": F.min, "max": F.max}


def running(df: DataFrame, by: Sequence[str], order: str, specs: Mapping[str, tuple[str, str]],
            descending: bool = False, buckets: int | None = None) -> DataFrame:
    """Add inclusive running aggregates ``name = op(col)`` over rows ordered by ``order`` within ``by``.

    ``specs``: name → (source column, op) with op in sum/min/max. ``order`` must be numeric.
    ``buckets`` is the number of ranges, by default the shuffle partitions.
    """
    key = F.col(order).cast("double")
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = materialize(df.withColumn("__key", -key if descending else key)
                       .repartitionByRange(n, *by, "__key").withColumn("__bkt", F.spark_partition_id()))
    part = base.groupBy("__bkt", *by).agg(
        *[_OPS[op](F.col(src)).alias(f"__p_{name}") for name, (src, op) in specs.items()])
    wc = Window.partitionBy(*by).orderBy("__bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = part.select("__bkt", *by, *[_OPS[op](F.col(f"__p_{name}")).over(wc).alias(f"__c_{name}")
                                       for name, (_src, op) in specs.items()])
    wl = Window.partitionBy("__bkt", *by).orderBy("__key").rowsBetween(Window.unboundedPreceding, 0)
    local = base.select("*", *[_OPS[op](F.col(src)).over(wl).alias(f"__l_{name}")
                               for name, (src, op) in specs.items()])
    joined = local.join(carry, ["__bkt", *by], "left")
    out: dict[str, Column] = {}
    for name, (_src, op) in specs.items():
        loc, car = F.col(f"__l_{name}"), F.col(f"__c_{name}")
        if op == "sum":
            out[name] = loc + F.coalesce(car, F.lit(0))
        elif op == "min":
            out[name] = F.least(loc, F.coalesce(car, loc))
        else:
            out[name] = F.greatest(loc, F.coalesce(car, loc))
    drop = ["__bkt", "__key"] + [f"__l_{k}" for k in specs] + [f"__c_{k}" for k in specs]
    return joined.withColumns(out).drop(*drop)


def quantiles(counts: DataFrame, by: Sequence[str], value: str, n: str, probs: Mapping[str, float]) -> DataFrame:
    """Exact linear-interpolated quantiles per ``by`` from (by, value, count) rows.

    ``probs``: output column → probability. The two order statistics around a
    probability are read from the running counts, so no task holds a group's
    distinct values.
    """
    cum = running(counts, by, value, {"__le": (n, "sum")})
    total = counts.groupBy(*by).agg(F.sum(n).alias("__total"))
    j = cum.join(total, list(by))
    aggs = []
    for name, p in probs.items():
        at = (F.col("__total") - 1) * F.lit(p)
        for part, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            inside = (F.col("__le") - F.col(n) <= place) & (place < F.col("__le"))
            aggs.append(F.max(F.when(inside, F.col(value).cast("double"))).alias(f"__{part}_{name}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"__f_{name}"))
    return j.groupBy(*by).agg(*aggs).select(*by, *[
        (F.col(f"__lo_{k}") + (F.col(f"__hi_{k}") - F.col(f"__lo_{k}")) * F.col(f"__f_{k}")).alias(k) for k in probs])
