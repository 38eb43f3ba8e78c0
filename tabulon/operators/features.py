"""G — deterministic feature derivation (bands, routed states, assembly, distributions)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.exprs import col_, first_match


def band(c: str | Column, bands: Sequence[tuple[float, float, str]], strict: bool = True) -> Column:
    """G1: left-closed bands ``[lo, hi)`` → label.

    NULL, fractional or out-of-range values raise (strict) or map to NULL.
    The check is inline in the projection: no extra job, fails on the row.
    """
    v = col_(c)
    whole = (v.cast("double") % 1) == 0
    banded = first_match([(whole & (v >= lo) & (v < hi), label) for lo, hi, label in bands])
    if not strict:
        return banded
    # one CASE: the error branch is the ELSE of the band chain (no duplicated chain)
    return banded.otherwise(F.raise_error(F.concat(F.lit("value outside the declared bands: "),
                                                   F.coalesce(v.cast("string"), F.lit("NULL")))))


def route(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """Ordered routing rules → derived state (first match wins, else ``default``/NULL)."""
    return first_match(rules, default)


def unresolved_states(df: DataFrame, state_col: str, sources: Sequence[str]) -> DataFrame:
    """Source combinations not covered by the rules, with counts.

    Counted where the state stands: a filter on it would be pushed below the projections that
    derive it, and would repeat their nested expressions for every rule and source column.
    """
    return (df.groupBy(*sources).agg(F.count_if(F.col(state_col).isNull()).alias("n"))
            .filter(F.col("n") > 0))


def distribution(df: DataFrame, features: Sequence[str], group: str | None = None) -> DataFrame:
    """Count and proportion of every category per feature (one unpivot + one aggregate)."""
    ids = [group] if group else []
    long = df.select(*ids, *[F.col(f).cast("string").alias(f) for f in features]) \
        .unpivot(ids, list(features), "feature", "category")
    counts = long.groupBy(*ids, "feature", "category").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*ids, "feature")
    return counts.withColumn("proportion", F.col("n") / F.sum("n").over(w))


def derive_states(df: DataFrame, states: Mapping[str, tuple[Sequence[tuple[Column, object]], Sequence[str]]],
                  strict: bool = True) -> DataFrame:
    """Add routed states (name → (rules, source columns)); with ``strict`` an unresolved
    combination raises naming its source values (the G5 gate, inline: no extra job)."""
    out = df.withColumns({name: first_match(rules) for name, (rules, _src) in states.items()})
    if not strict:
        return out

    def check(name, sources):
        msg = F.concat(F.lit(f"unresolved combination for {name}: "),
                       F.concat_ws(" / ", *[F.coalesce(F.col(s).cast("string"), F.lit("NULL")) for s in sources]))
        return F.when(F.col(name).isNull(), F.raise_error(msg)).otherwise(F.col(name))
    return out.withColumns({name: check(name, src) for name, (_r, src) in states.items()})


def mapped_rules(gate: Column, col: str, mapping: Mapping[str, str]) -> list[tuple[Column, str]]:
    """Rules ``gate & col == source → label`` for every entry of ``mapping`` (ordered)."""
    return [(gate & (F.col(col) == F.lit(src)), label) for src, label in mapping.items()]
