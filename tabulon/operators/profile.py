"""B — profiling and data-quality audit of all-string tables.

Every check reads the long value-frequency table (B0) built by ONE unpivot +
hash aggregate with map-side combine; per-column statistics are aggregates of
that table, so no check re-scans the raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.exprs import case_map, trim_ws

INTEGER_RE = r"^[+-]?[0-9]+$"
DECIMAL_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# ---------------------------------------------------------------------------
# Textual missing markers and candidate numeric special codes
# ---------------------------------------------------------------------------
SPECIAL_MISSING_TOKENS = ("NA", "N/A", "NULL", "NONE", "NAN", "MISSING", "DK", "DON'T KNOW",
                          "DONT KNOW", "REFUSED")
CANDIDATE_NUMERIC_CODES = ("8", "9", "97", "98", "99", "997", "998", "999", "-8", "-9", "-97",
                           "-98", "-99")


def positions(cols: Sequence[str]) -> Column:
    """1-based column position as a JVM literal lookup (no join)."""
    return case_map(F.col("column"), {c: i + 1 for i, c in enumerate(cols)})


def value_frequency(df: DataFrame, cols: Sequence[str] | None = None, trim: bool = True) -> DataFrame:
    """(position, column, value, n) for every distinct value of every column; blank = ''."""
    cols = list(cols or df.columns)
    proj = [(F.coalesce(trim_ws(F.col(c).cast("string")), F.lit("")) if trim
             else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in cols]
    long = df.select(*proj).unpivot([], cols, "column", "value")
    return (long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
            .select(positions(cols).alias("position"), "column", "value", "n"))


def route_columns(df: DataFrame, cols: Sequence[str] | None = None, near_unique_ratio: float = 0.5,
                  rsd: float = 0.02) -> DataFrame:
    """B0 guard: ONE aggregate pass with HyperLogLog sketches decides, per column, whether it joins the
    long value-frequency table (values combine map-side) or the scalar path (near-unique: ids, free
    text, timestamps — the (column, value) groups would not shrink). Returns
    (position, column, rows, non_missing, approx_distinct, path) — the report of which path was taken."""
    cols = list(cols or df.columns)
    vals = {c: F.coalesce(trim_ws(F.col(f"`{c}`").cast("string")), F.lit("")) for c in cols}
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        v = vals[c]
        aggs.append(F.count_if(v != "").alias(f"__nm{i}"))
        aggs.append(F.approx_count_distinct(F.when(v != "", v), rsd).alias(f"__d{i}"))
    row = df.agg(*aggs)
    parts = [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column"),
                      F.col(f"__nm{i}").cast("bigint").alias("non_missing"),
                      F.col(f"__d{i}").cast("bigint").alias("approx_distinct")) for i, c in enumerate(cols)]
    out = row.select(F.col("__rows").cast("bigint").alias("rows"), F.explode(F.array(*parts)).alias("p")) \
        .select("p.position", "p.column", "rows", "p.non_missing", "p.approx_distinct")
    ratio = F.try_divide(F.col("approx_distinct").cast("double"), F.col("non_missing"))
    return out.withColumn("path", F.when(F.coalesce(ratio, F.lit(0.0)) >= near_unique_ratio, "scalar")
                          .otherwise("value_frequency"))


def scalar_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scalar path of the B0 guard: counts, exact distinct count, numeric min/max per near-unique column,
    in one scan, without building (column, value) groups for top values or value sets."""
    aggs, parts = [F.count(F.lit(1)).cast("bigint").alias("__rows")], []
    for i, c in enumerate(cols):
        v = F.coalesce(trim_ws(F.col(f"`{c}`").cast("string")), F.lit(""))
        num = F.when(v.rlike(DECIMAL_RE), v.try_cast("double"))
        aggs += [F.count_if(v != "").cast("bigint").alias(f"__m{i}"), F.count_distinct(F.when(v != "", v)).cast("bigint").alias(f"__u{i}"),
                 F.min(num).alias(f"__lo{i}"), F.max(num).alias(f"__hi{i}")]
        parts.append(F.struct(F.lit(c).alias("column"), F.col("__rows").alias("rows"), F.col(f"__m{i}").alias("non_missing_count"),
                              F.col(f"__u{i}").alias("unique_count"), F.col(f"__lo{i}").alias("min"), F.col(f"__hi{i}").alias("max")))
    return df.agg(*aggs).select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def _numeric(value: Column) -> Column:
    """Finite decimal parse of a trimmed value (NULL if not a finite decimal literal)."""
    return F.when(value.rlike(DECIMAL_RE), value.try_cast("double"))


def column_profile(vf: DataFrame, row_count: Column | None = None, top_k: int = 8) -> DataFrame:
    """B1 + B2 + B3: per-column type, counts, percentages, flags, min/max/mean, top values."""
    nonblank = F.col("value") != ""
    num = _numeric(F.col("value"))
    per_col = vf.groupBy("position", "column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(nonblank, F.col("n")).otherwise(0)).alias("non_missing_count"),
        F.count_if(nonblank).alias("unique_count"),
        F.bool_and(~nonblank | F.col("value").rlike(INTEGER_RE)).alias("__all_int"),
        F.bool_and(~nonblank | num.isNotNull()).alias("__all_num"),
        F.min(F.when(nonblank, num)).alias("__min"),
        F.max(F.when(nonblank, num)).alias("__max"),
        F.sum(F.when(nonblank, num * F.col("n"))).alias("__sum"),
    )
    inferred = (F.when(F.col("non_missing_count") == 0, "empty")
                .when(F.col("__all_int"), "integer")
                .when(F.col("__all_num"), "float").otherwise("string"))
    is_num = inferred.isin("integer", "float")
    prof = per_col.select(
        "position", "column", inferred.alias("inferred_type"),
        F.col("non_missing_count").cast("bigint").alias("non_missing_count"),
        (F.col("rows") - F.col("non_missing_count")).cast("bigint").alias("missing_count"),
        F.round(F.coalesce(F.try_divide((F.col("rows") - F.col("non_missing_count")) * 100.0, F.col("rows")),
                           F.lit(0.0)), 4).alias("missing_pct"),
        F.col("unique_count").cast("bigint").alias("unique_count"),
        F.round(F.coalesce(F.try_divide(F.col("unique_count") * 100.0, F.col("non_missing_count")),
                           F.lit(0.0)), 4).alias("unique_pct_non_missing"),
        (F.col("non_missing_count") == 0).alias("is_all_missing"),
        (F.col("unique_count") <= 1).alias("is_constant_non_missing"),
        ((F.col("non_missing_count") > 0) & (F.col("unique_count") == F.col("non_missing_count")))
        .alias("is_unique_non_missing"),
        F.when(is_num, F.col("__min")).alias("min"),
        F.when(is_num, F.col("__max")).alias("max"),
        F.when(is_num, F.col("__sum") / F.col("non_missing_count")).alias("mean"),
    )
    if top_k:
        tops = top_values(vf, top_k).groupBy("column").agg(
            F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value", "n"))),
                                  lambda s: F.struct(s["value"].alias("value"), s["n"].alias("count"))))
            .alias("top_values"))
        prof = prof.join(tops, "column", "left").withColumn(
            "top_values", F.coalesce(F.col("top_values"), F.lit("[]")))
    return prof


def top_values(vf: DataFrame, k: int = 8) -> DataFrame:
    """The k most frequent non-blank values per column, order (count desc, value asc).

    ``row_number() <= k`` lets Spark place a partial window-group limit before the
    shuffle, so a near-unique column never sends all its values to one task.
    """
    w = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value").asc())
    return (vf.filter(F.col("value") != "").withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k).select("column", "rank", "value", "n"))


def target_summary(vf: DataFrame, targets: Sequence[str], all_columns: Sequence[str]) -> DataFrame:
    """Presence, position, blanks, observed values, distribution, 0/1 validity, plain positive rate."""
    spark = vf.sparkSession
    want = spark.createDataFrame([(t,) for t in targets], "column string")
    sub = vf.join(F.broadcast(want), "column", "inner")
    nonblank = F.col("value") != ""
    agg = sub.groupBy("column").agg(
        F.first("position").alias("position"),
        F.sum(F.when(~nonblank, F.col("n")).otherwise(0)).cast("bigint").alias("missing_count"),
        F.sum(F.when(F.col("value") == "1", F.col("n")).otherwise(0)).alias("__pos"),
        F.sum(F.when(nonblank, F.col("n")).otherwise(0)).alias("__nb"),
    )
    sets = value_lists(vf, targets)
    out = want.join(agg, "column", "left").join(sets, "column", "left")
    present = F.col("column").isin(*all_columns)
    return out.select(
        F.col("column").alias("target"),
        present.alias("present"),
        F.col("position").cast("int").alias("position"),
        F.col("missing_count"),
        F.array_join(F.col("vals"), "|").alias("observed_values"),
        F.to_json(F.map_from_entries(F.col("dist"))).alias("distribution"),
        (present & F.coalesce(F.array_join(F.col("vals"), "|") == "0|1", F.lit(False))
         & (F.col("missing_count") == 0)).alias("valid_binary_0_1"),
        F.try_divide(F.col("__pos").cast("double"), F.col("__nb")).alias("unweighted_positive_rate"),
    )


def duplicate_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate groups over ``cols`` (untrimmed raw values).

    Rows are grouped on a 256-bit content digest of the null-safe JSON encoding,
    so wide/long rows are hashed where they sit and only 32-byte keys shuffle.
    """
    cols = list(cols or df.columns)
    key = F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)
    groups = df.select(key.alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    return groups.agg(
        F.count(F.lit(1)).cast("bigint").alias("exact_duplicate_groups"),
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows_excluding_first"),
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("rows_in_duplicate_groups"),
    )


def duplicate_ignoring_id(df: DataFrame, id_col: str) -> DataFrame:
    """Duplicate (trimmed) id values, and duplicate profiles once the id is dropped."""
    rest = [c for c in df.columns if c != id_col]
    ids = df.agg((F.count(F.lit(1)) - F.count_distinct(F.coalesce(trim_ws(F.col(id_col).cast("string")),
                                                                 F.lit(""))))
                 .cast("bigint").alias("duplicate_identifier_values"))
    prof = duplicate_summary(df, rest).select(
        F.col("exact_duplicate_groups").alias("duplicate_profiles_excluding_identifier_groups"),
        F.col("duplicate_rows_excluding_first")
        .alias("duplicate_profiles_excluding_identifier_rows_excluding_first"))
    return ids.crossJoin(prof)  # 1 row × 1 row


def field_roles(profile: DataFrame, roles: DataFrame) -> DataFrame:
    """(column, preliminary_role, rationale) rules joined to the profile (rules table is a parameter)."""
    return profile.join(F.broadcast(roles), "column", "inner").select(
        "column", "preliminary_role", "rationale", "unique_count", "missing_pct")


def special_tokens(vf: DataFrame, tokens: Sequence[str] = SPECIAL_MISSING_TOKENS,
                   codes: Sequence[str] = CANDIDATE_NUMERIC_CODES) -> DataFrame:
    """Textual missing markers (case-insensitive) and numeric special-code candidates."""
    txt = vf.filter(F.upper("value").isin(*tokens)).select(
        "column", F.col("value").alias("token"), F.lit("textual_candidate").alias("kind"), "n")
    num = vf.filter(F.col("value").isin(*codes)).select(
        "column", F.col("value").alias("token"), F.lit("numeric_candidate").alias("kind"), "n")
    return txt.unionByName(num).withColumnRenamed("n", "count")


#: Distinct values up to which a column's values are written out as one list.
LISTED = 1000


def value_lists(vf: DataFrame, columns: Sequence[str], most: int = LISTED) -> DataFrame:
    """(column, vals, dist): every distinct non-blank value of the named columns, sorted.

    The number of values is known before a list is built; a column with more than ``most``
    has null lists here (its values are the rows of the value-frequency table).
    """
    nb = vf.filter((F.col("value") != "") & F.col("column").isin(*columns))
    many = nb.groupBy("column").agg(F.count(F.lit(1)).alias("__k"))
    short = nb.join(F.broadcast(many.where(F.col("__k") <= most)), "column").groupBy("column").agg(  # a row per column
        F.array_sort(F.collect_list("value")).alias("vals"), F.array_sort(F.collect_list(F.struct("value", "n"))).alias("dist"))
    return many.select("column").join(short, "column", "left")


def small_sets(vf: DataFrame, max_values: int = 12) -> DataFrame:
    """(position, column, k, vals) for columns with at most ``max_values`` distinct non-blank values.

    Distinct counts come first (one small aggregate); arrays are built only for
    columns that passed, so no task ever collects a near-unique column.
    """
    nb = vf.filter(F.col("value") != "")
    small = nb.groupBy("column").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") <= max_values)
    return (nb.join(F.broadcast(small), "column", "inner").groupBy("position", "column", "k")
            .agg(F.array_sort(F.collect_list("value")).alias("vals"),
                 F.array_sort(F.collect_list(F.struct("value", "n"))).alias("dist")))


def value_sets(vf: DataFrame, max_values: int = 12) -> DataFrame:
    """Columns sharing the same set of 1..max_values observed values.

    The set is only collected for columns whose distinct count is already known
    to be small, so a near-unique column never builds a big array.
    """
    sets = small_sets(vf, max_values)
    grouped = sets.groupBy("vals").agg(
        F.count(F.lit(1)).cast("bigint").alias("column_count"),
        F.transform(F.array_sort(F.collect_list(F.struct("position", "column"))), lambda s: s["column"])
        .alias("cols"))
    return grouped.select(F.to_json("vals").alias("observed_values"), "column_count",
                          F.to_json("cols").alias("columns"))


def range_checks(vf: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules (column, lo, hi, check) → count of parsed values outside [lo, hi].

    Blank / non-numeric values are skipped; a column with nothing parseable gets
    no row. The rules table is a parameter (bounded) and is broadcast.
    """
    num = _numeric(F.col("value"))
    j = vf.filter(F.col("value") != "").join(F.broadcast(rules), "column", "inner") \
        .withColumn("__v", num)
    agg = j.filter(F.col("__v").isNotNull()).groupBy("column", "check").agg(
        F.sum(F.when((F.col("__v") < F.col("lo")) | (F.col("__v") > F.col("hi")), F.col("n"))
              .otherwise(0)).cast("bigint").alias("flagged_count"))
    return agg.withColumn("status", F.when(F.col("flagged_count") == 0, "PASS").otherwise("REVIEW"))


def positive_checks(vf: DataFrame, cols: Sequence[str], check: str = "must be positive") -> DataFrame:
    """Count of parsed values ≤ 0 per column."""
    num = _numeric(F.col("value"))
    sub = vf.filter(F.col("column").isin(*cols) & (F.col("value") != "")).withColumn("__v", num) \
        .filter(F.col("__v").isNotNull())
    agg = sub.groupBy("column").agg(
        F.sum(F.when(F.col("__v") <= 0, F.col("n")).otherwise(0)).cast("bigint").alias("flagged_count"))
    return agg.select("column", F.lit(check).alias("check"), "flagged_count",
                      F.when(F.col("flagged_count") == 0, "PASS").otherwise("REVIEW").alias("status"))


def code_set_checks(vf: DataFrame, cols: Sequence[str],
                    accepted: Sequence[Sequence[str]] = (("0", "1"), ("1", "2"))) -> DataFrame:
    """Observed non-blank set must equal one accepted set; flagged = 0 or all rows.

    ``offending_count`` adds the rows whose value is in none of the accepted sets.
    """
    allowed = sorted({v for s in accepted for v in s})
    sub = vf.filter(F.col("column").isin(*cols))
    agg = sub.groupBy("column").agg(
        F.sum("n").cast("bigint").alias("rows"),
        F.sum(F.when((F.col("value") != "") & ~F.col("value").isin(*allowed), F.col("n")).otherwise(0))
        .cast("bigint").alias("offending_count"))
    sets = value_lists(vf, cols).select("column", F.array_join("vals", "|").alias("obs"))
    agg = agg.join(sets, "column", "left")
    ok = None
    for acc in accepted:
        cond = F.coalesce(F.col("obs") == "|".join(sorted(acc)), F.lit(False))
        ok = cond if ok is None else (ok | cond)
    return agg.select(
        "column", F.concat(F.lit("observed indicator codes "),
                           F.coalesce(F.col("obs"), F.lit(""))).alias("check"),
        F.when(ok, F.lit(0).cast("bigint")).otherwise(F.col("rows")).alias("flagged_count"),
        "offending_count",
        F.when(ok, "PASS").otherwise("REVIEW").alias("status"))


def missingness_band(pct: Column) -> Column:
    """=100, ≥75, ≥50, ≥25, >0, else NONE."""
    return (F.when(pct == 100, "ALL_MISSING").when(pct >= 75, "HIGH_75_PLUS").when(pct >= 50, "HIGH_50_TO_74")
            .when(pct >= 25, "MODERATE_25_TO_49").when(pct > 0, "LOW_UNDER_25").otherwise("NONE"))


def missingness_summary(profile: DataFrame, thresholds: Sequence[int] = (50, 75, 90)) -> DataFrame:
    """Blank-cell total, all-missing columns, columns at or above each threshold."""
    def cols_where(cond):
        return F.to_json(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("position", "column")))),
                                     lambda s: s["column"]))
    aggs = [F.sum("missing_count").cast("bigint").alias("blank_cells"),
            cols_where(F.col("is_all_missing")).alias("all_missing_columns")]
    aggs += [cols_where(F.col("missing_pct") >= t).alias(f"columns_ge_{t}pct_missing") for t in thresholds]
    return profile.agg(*aggs)


def type_rollup(profile: DataFrame) -> DataFrame:
    """Column count and column list per inferred type."""
    return profile.groupBy("inferred_type").agg(
        F.count(F.lit(1)).cast("bigint").alias("column_count"),
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("position", "column"))),
                              lambda s: s["column"])).alias("columns"))


def cardinality_rollup(profile: DataFrame, vf: DataFrame) -> DataFrame:
    """Constant, unique and exact-0/1 column lists (one row per kind)."""
    binary = vf.filter(F.col("value") != "").groupBy("column").agg(
        F.count(F.lit(1)).alias("k"), F.count_if(F.col("value").isin("0", "1")).alias("k01")) \
        .filter((F.col("k") == 2) & (F.col("k01") == 2)).select("column", F.lit(True).alias("__b"))
    p = profile.join(binary, "column", "left")
    kinds = [("constant", F.col("is_constant_non_missing")), ("unique", F.col("is_unique_non_missing")),
             ("binary_0_1", F.coalesce(F.col("__b"), F.lit(False)))]
    parts = [F.struct(F.lit(k).alias("kind"),
                      F.array_sort(F.collect_list(F.when(c, F.struct("position", "column")))).alias("cs"))
             for k, c in kinds]
    return p.agg(F.array(*parts).alias("a")).select(F.explode("a").alias("r")).select(
        "r.kind", F.size("r.cs").cast("bigint").alias("column_count"),
        F.to_json(F.transform("r.cs", lambda s: s["column"])).alias("columns"))
