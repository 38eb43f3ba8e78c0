"""C9 — the strict data dictionary: catalogue, labels, codebook, observed counts and ratings, all under one set of names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts of code labels that mark a special (non-substantive) code: fixed values.
SPECIAL_TERMS = ("don't know", "refused", "no/dk/ref")


def strict_parts(parts: dict[str, DataFrame], key: str = "variable") -> DataFrame:
    """All parts side by side on ``key``; a name that any of them lacks is an error when the row is evaluated.

    One full outer join a part, so both sides' unmatched names are seen in the pass that
    joins. Parts have a row per variable; their other columns must differ.
    """
    marked = [df.withColumn(f"__in_{name}", F.lit(True)) for name, df in parts.items()]
    joined = reduce(lambda a, b: a.join(b, key, "full_outer"), marked)
    lacking = F.array_compact(F.array(*[F.when(F.col(f"__in_{name}").isNull(), F.lit(name)) for name in parts]))
    checked = F.when(F.size(lacking) > 0, F.raise_error(F.concat(F.lit("dictionary: "), F.col(key), F.lit(" is missing from "), F.array_join(lacking, ", "))))
    return joined.withColumn(key, F.coalesce(checked.cast("string"), F.col(key))).drop(*[f"__in_{name}" for name in parts])


def observed_counts(vf: DataFrame) -> DataFrame:
    """``variable, observed_values, observed_digest``: how many values a variable shows, and a digest of the (value, count) pairs.

    The pairs themselves are the value-frequency table; a variable of any width has one row here.
    """
    pair = F.concat_ws("=", "value", F.col("n").cast("string"))
    h = F.conv(F.substring(F.md5(pair), 1, 8), 16, 10).cast("decimal(20,0)")
    return vf.groupBy(F.col("column").alias("variable")).agg(F.count("*").alias("observed_values"), F.sum(h).cast("string").alias("observed_digest"))


def special_codes(codes: Column) -> Column:
    """Values of the codes (value, label) whose label names a special answer, joined by ';'."""
    special = lambda c: reduce(lambda a, b: a | b, [F.lower(c["label"]).contains(t) for t in SPECIAL_TERMS])
    return F.array_join(F.transform(F.filter(codes, special), lambda c: c["value"]), ";")


def tags(outcomes: Sequence[str]) -> Column:
    """The tag list of a row with category, origin, missing_pct, unique_count and status_/risk_ of each outcome: fixed names."""
    status = [F.col(f"status_{o}") for o in outcomes]
    risk = reduce(lambda a, b: a | b, [F.col(f"risk_{o}").isin("DIRECT", "HIGH") for o in outcomes])
    excluded = reduce(lambda a, b: a & b, [s.startswith("EXCLUDE") for s in status])
    return F.array_join(F.array_distinct(F.array_compact(F.array(
        F.col("category"), F.when(F.col("origin") == "CONSTRUCTED", "CONSTRUCTED"), F.when(F.col("missing_pct") >= 50, "HIGH_MISSING"),
        F.when(F.col("missing_pct") == 100, "ALL_MISSING"), F.when(F.col("unique_count") <= 1, "LOW_VARIANCE"),
        *[F.when(s.startswith("CANDIDATE"), f"CANDIDATE_MODEL_{i}") for i, s in enumerate(status, 1)],
        F.when(risk, "POSSIBLE_LEAKAGE"), F.when(excluded, "EXCLUDED")))), ";")
