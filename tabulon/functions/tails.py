"""Distribution tails as column expressions (neither Spark nor DuckDB has erf).

erfc uses the all-positive series of erf below ``SPLIT`` and the continued
fraction above it, so small p keep their digits; χ² with integer degrees of
freedom is a finite sum. Both are written as Horner steps over a short sequence,
which the oracle text repeats with ``list_reduce``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT, SERIES, LEVELS = 2.5, 80, 80


def _horner(start: int, stop: Column, step) -> Column:
    """Fold ``step(acc, k)`` over k = stop, stop − 1, …, start, beginning with 1."""
    ks = F.when(stop >= start, F.sequence(stop, F.lit(start), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(ks, F.lit(1.0), step)


def erfc(x: Column) -> Column:
    """Complementary error function of x ≥ 0."""
    gauss = F.exp(-x * x)
    series = _horner(1, F.lit(SERIES), lambda s, j: 1 + 2 * x * x / (2 * j + 1) * s)
    erf = 2 / math.sqrt(math.pi) * gauss * x * series
    ks = F.sequence(F.lit(LEVELS), F.lit(1), F.lit(-1))
    fraction = F.aggregate(ks, F.lit(0.0), lambda t, k: k / 2.0 / (x + t))
    return F.when(x < SPLIT, 1 - erf).otherwise(gauss / math.sqrt(math.pi) / (x + fraction))


def normal_two_sided(z: Column) -> Column:
    """2·(1 − Φ(|z|)); NULL and NaN stay as they are."""
    return F.when(z.isNotNull(), F.least(F.lit(1.0), erfc(F.abs(z.cast("double")) / math.sqrt(2.0))))


def chi2_sf(x: Column, k: Column) -> Column:
    """Upper tail of χ²(k) for integer k ≥ 1; NULL where x or k is NULL or k < 1."""
    x, k = x.cast("double"), k.cast("int")
    h = x / 2.0
    even = F.exp(-h) * _horner(1, (k / 2).cast("int") - 1, lambda s, i: 1 + h / i * s)
    root = F.sqrt(x)
    terms = _horner(2, ((k - 1) / 2).cast("int"), lambda s, i: 1 + x / (2 * i - 1) * s)
    odd = erfc(root / math.sqrt(2.0)) + F.when(k > 1, 2 * F.exp(-h) / math.sqrt(2 * math.pi) * root * terms).otherwise(0.0)
    tail = F.least(F.lit(1.0), F.when(k % 2 == 0, even).otherwise(odd))
    return F.when((k >= 1) & x.isNotNull(), F.when(x <= 0, 1.0).otherwise(tail))


# ----------------------------------------------------------------- oracle text
def erfc_sql(x: str) -> str:
    series = f"list_reduce(list_prepend(1.0::double, list_transform(range({SERIES}, 0, -1), lambda j: cast(j as double))), lambda s, j: 1 + 2 * ({x}) * ({x}) / (2 * j + 1) * s)"
    fraction = f"list_reduce(list_prepend(0.0::double, list_transform(range({LEVELS}, 0, -1), lambda j: cast(j as double))), lambda t, j: j / 2.0::double / (({x}) + t))"
    return (f"case when ({x}) < {SPLIT} then 1 - 2 / sqrt(pi()) * exp(-({x}) * ({x})) * ({x}) * {series} "
            f"else exp(-({x}) * ({x})) / sqrt(pi()) / (({x}) + {fraction}) end")


def normal_two_sided_sql(z: str) -> str:
    return f"least(1.0, {erfc_sql(f'abs({z}) / sqrt(2.0::double)')})"


def chi2_sf_sql(x: str, k: str) -> str:
    def horner(stop: str, start: int, body: str) -> str:
        ks = f"list_transform(range({stop}, {start - 1}, -1), lambda j: cast(j as double))"
        return f"list_reduce(list_prepend(1.0::double, {ks}), lambda s, i: {body})"
    even = f"exp(-({x}) / 2) * " + horner(f"cast(floor(({k}) / 2) as bigint) - 1", 1, f"1 + ({x}) / 2 / i * s")
    terms = horner(f"cast(floor((({k}) - 1) / 2) as bigint)", 2, f"1 + ({x}) / (2 * i - 1) * s")
    odd = (f"{erfc_sql(f'sqrt({x}) / sqrt(2.0::double)')} + case when ({k}) > 1 then "
           f"2 * exp(-({x}) / 2) / sqrt(2 * pi()) * sqrt({x}) * {terms} else 0.0 end")
    return f"case when ({k}) >= 1 then case when ({x}) <= 0 then 1.0 else least(1.0, case when ({k}) % 2 = 0 then {even} else {odd} end) end end"
