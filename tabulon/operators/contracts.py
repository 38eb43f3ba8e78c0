"""A3 / A5 — keyed uniqueness and frozen-schema gates returning violation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A3: rows, distinct keys, duplicated keys and rows in duplicated keys (one aggregate pass)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"))
    return g.agg(F.sum("__c").cast("bigint").alias("rows"), F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
                 F.count_if(F.col("__c") > 1).cast("bigint").alias("duplicate_keys"),
                 F.coalesce(F.sum(F.when(F.col("__c") > 1, F.col("__c"))), F.lit(0)).cast("bigint")
                 .alias("rows_in_duplicate_keys"))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A3 strict form: the duplicated keys (empty when the contract holds)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def schema_gate(df: DataFrame, expected_columns: Sequence[str], target: str | None = None,
                prohibited: Sequence[str] = (), expected_rows: int | None = None) -> DataFrame:
    """A5: (check, violations, passed). Column checks are driver metadata (free); all row-level
    checks come from ONE aggregate job."""
    spark = df.sparkSession
    cols = df.columns
    meta = [("ordered_columns", 0 if list(cols) == list(expected_columns) else
             len(set(cols) ^ set(expected_columns)) or 1),
            ("prohibited_columns", len([c for c in prohibited if c in cols]))]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    null_any = [F.count_if(F.col(f"`{c}`").isNull()) for c in cols]
    aggs.append(sum(null_any[1:], null_any[0]).alias("__nulls") if null_any else F.lit(0).alias("__nulls"))
    if target:
        t = F.col(f"`{target}`")
        aggs.append(F.count_if(t.isNull() | ~t.cast("string").isin("0", "1")).alias("__nonbinary"))
    row = df.agg(*aggs)
    checks = [F.struct(F.lit(n).alias("check"), F.lit(v).cast("bigint").alias("violations")) for n, v in meta]
    checks.append(F.struct(F.lit("null_cells").alias("check"), F.col("__nulls").cast("bigint").alias("violations")))
    if target:
        checks.append(F.struct(F.lit("non_binary_target").alias("check"),
                               F.col("__nonbinary").cast("bigint").alias("violations")))
    if expected_rows is not None:
        checks.append(F.struct(F.lit("row_count").alias("check"),
                               F.abs(F.col("__rows") - expected_rows).cast("bigint").alias("violations")))
    return row.select(F.explode(F.array(*checks)).alias("c")).select(
        "c.check", "c.violations", (F.col("c.violations") == 0).alias("passed"))
