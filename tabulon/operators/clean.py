"""D — cleaning and recoding (code maps, routed blanks, validation gates)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.exprs import blank_to_empty
from tabulon.operators.profile import LISTED

NOT_APPLICABLE = "Not applicable / skipped"
CORE_MISSING = "Missing or nonresponse"


def _map_literal(mapping: Mapping[str, str]) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def recode_column(c: str, mapping: Mapping[str, str], blank_label: str | None) -> Column:
    """D3 for one (already trimmed, blank = '') column: map codes to labels, blank → ``blank_label``.

    An unknown non-blank code yields NULL here; :func:`recode_categoricals`
    raises on it (strict) or leaves it NULL (quarantine: the caller splits on NULL).
    """
    v = F.col(c)
    label = F.try_element_at(_map_literal(mapping), v) if mapping else F.lit(None).cast("string")
    blank = F.lit(blank_label) if blank_label is not None else F.lit(None).cast("string")
    return F.when(v == "", blank).otherwise(label)


def recode_categoricals(df: DataFrame, code_maps: Mapping[str, Mapping[str, str]],
                        core: Sequence[str] = (), routed: Sequence[str] = (),
                        strict: bool = True, core_label: str = CORE_MISSING,
                        routed_label: str = NOT_APPLICABLE) -> DataFrame:
    """D3: wide projections over all coded columns (no unpivot/pivot round trip).

    Three narrow steps — trim, look up, check — so each input expression is
    evaluated once per row and generated code stays small.
    """
    cols = list(code_maps)
    trimmed = df.withColumns({f"__raw_{c}": blank_to_empty(c) for c in cols})
    labelled = trimmed.withColumns({
        c: recode_column(f"__raw_{c}", m, routed_label if c in routed else core_label if c in core else None)
        for c, m in code_maps.items()})
    if strict:
        labelled = labelled.withColumns({
            c: F.when(F.col(c).isNull(), F.raise_error(
                F.concat(F.lit(f"unknown code in {c}: '"), F.col(f"__raw_{c}"), F.lit("'"))))
            .otherwise(F.col(c)) for c in cols})
    return labelled.drop(*[f"__raw_{c}" for c in cols])


def validate_binary(df: DataFrame, cols: Sequence[str], cast: str = "tinyint") -> DataFrame:
    """Target must be complete and in {0,1}; stored as ``cast``."""
    parsed = df.withColumns({c: F.expr(f"try_cast(trim(cast(`{c}` as string)) as int)") for c in cols})
    return parsed.withColumns({
        c: F.when(F.col(c).isNull() | ~F.col(c).isin(0, 1),
                  F.raise_error(F.lit(f"binary target {c} incomplete or not 0/1"))).otherwise(F.col(c)).cast(cast)
        for c in cols})


def validate_whole_number(df: DataFrame, c: str, lo: int, hi: int, cast: str = "smallint") -> DataFrame:
    """Complete, integral, inside [lo, hi]; stored as ``cast``."""
    parsed = df.withColumn(c, F.expr(f"try_cast(trim(cast(`{c}` as string)) as double)"))
    v = F.col(c)
    bad = v.isNull() | (v % 1 != 0) | (v < lo) | (v > hi)
    return parsed.withColumn(c, F.when(bad, F.raise_error(F.lit(f"{c} incomplete, fractional or outside [{lo}, {hi}]")))
                             .otherwise(v).cast(cast))


# ---------------------------------------------------------------------------
# Code maps from documented codes (nested JSON) with fallbacks
# ---------------------------------------------------------------------------
COMBINED_NO = "No / don't know / refused"
NONRESPONSE = "Nonresponse"
# Label fragments that mean an explicit non-response
NONRESPONSE_TERMS = ("don't know", "dont know", "refused")
CODES_SCHEMA = "array<struct<value:string,label:string>>"


def documented_code_map(codes: DataFrame, variable: str = "variable", codes_col: str = "codes_json") -> DataFrame:
    """(variable, JSON list of {value, label}) → (variable, raw_value, source_label, cleaned_label, mapping_basis).

    Blank and ``sysmiss`` values are skipped; the combined no/don't-know label maps
    to one state, don't-know/refused labels to ``Nonresponse``; an empty label
    becomes ``Code <value>``.
    """
    parsed = codes.select(F.col(variable).alias("variable"),
                          F.explode(F.from_json(F.col(codes_col), CODES_SCHEMA)).alias("c"))
    raw = F.trim(F.coalesce(F.col("c.value"), F.lit("")))
    label = F.trim(F.coalesce(F.col("c.label"), F.lit("")))
    low = F.lower(label)
    nonresp = None
    for term in NONRESPONSE_TERMS:
        cond = low.contains(term)
        nonresp = cond if nonresp is None else (nonresp | cond)
    cleaned = (F.when(low == "no/dk/ref", F.lit(COMBINED_NO)).when(nonresp, F.lit(NONRESPONSE))
               .when(label != "", label).otherwise(F.concat(F.lit("Code "), raw)))
    return parsed.select("variable", raw.alias("raw_value"), label.alias("source_label"),
                         cleaned.alias("cleaned_label"), F.lit("documented code").alias("mapping_basis")) \
        .filter((F.col("raw_value") != "") & (F.lower("raw_value") != "sysmiss"))


def code_map(documented: DataFrame, fallback: DataFrame) -> DataFrame:
    """Fallback rows (variable, raw_value, cleaned_label) replace a variable's documented map."""
    fb = fallback.select("variable", "raw_value",
                         F.lit("documented range; neutral project label").alias("source_label"),
                         "cleaned_label", F.lit("documented range").alias("mapping_basis"))
    keep = documented.join(fb.select("variable").distinct(), "variable", "left_anti")
    return keep.unionByName(fb)


def require_code_maps(required: Sequence[str], cmap: DataFrame) -> DataFrame:
    """D2 gate: the map itself; raises if a required variable has no mapping at all."""
    spark = cmap.sparkSession
    req = spark.createDataFrame([(v,) for v in required], "variable string")
    missing = [r["variable"] for r in req.join(cmap.select("variable").distinct(), "variable", "left_anti").collect()]
    if missing:  # at most as many as required names
        raise ValueError(f"no code map for {sorted(missing)}")
    return cmap


def mapping_report(cmap: DataFrame, vf: DataFrame) -> DataFrame:
    """Every mapping row with its observed count, plus one ``<blank>`` row per variable."""
    counts = vf.select(F.col("column").alias("variable"), F.col("value").alias("raw_value"), "n")
    rows = cmap.join(counts, ["variable", "raw_value"], "left") \
        .withColumn("observed_count", F.coalesce(F.col("n"), F.lit(0)).cast("bigint")).drop("n")
    blanks = cmap.select("variable").distinct().join(
        counts.filter(F.col("raw_value") == ""), "variable", "left").select(
        "variable", F.lit("<blank>").alias("raw_value"), F.lit("System missing / routed blank").alias("source_label"),
        F.lit("model-specific; see feature tier").alias("cleaned_label"),
        F.lit("routing-aware missingness policy").alias("mapping_basis"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("observed_count"))
    return rows.unionByName(blanks)


def processed_schema(df: DataFrame, roles: Mapping[str, str] | None = None) -> DataFrame:
    """Per column: position, role, dtype, null count, distinct count (NULL counted), sorted categories.

    One unpivot + aggregate (NULL kept as its own group); category lists, whole, for
    the string columns that aren't keys and have at most ``LISTED`` values.
    """
    spark = df.sparkSession
    cols = df.columns
    meta = spark.createDataFrame(
        [(i + 1, c, (roles or {}).get(c, "feature"), f.dataType.simpleString())
         for i, (c, f) in enumerate(zip(cols, df.schema.fields))],
        "position int, column string, role string, dtype string")
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    vc = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    per = vc.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_count"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_count"))
    strings = [c for c, f in zip(cols, df.schema.fields)
               if f.dataType.simpleString() == "string" and (roles or {}).get(c) != "key"]
    short = per.filter(F.col("distinct_count") <= LISTED).select("column")  # the count comes first: no long column is gathered
    cats = vc.filter(F.col("column").isin(*strings) & F.col("value").isNotNull()).join(F.broadcast(short), "column").groupBy("column").agg(
        F.array_join(F.array_sort(F.collect_list("value")), "|").alias("categories"))
    return meta.join(per, "column", "left").join(cats, "column", "left").select(
        "position", "column", "role", "dtype", "null_count", "distinct_count", "categories")


def semantic_states(vf: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Count of every special label per categorical column (only columns where it occurs)."""
    return vf.filter(F.col("value").isin(*labels)).select(
        "column", F.col("value").alias("state"), F.col("n").cast("bigint").alias("n"))


def prep_template(numeric: Sequence[str], categorical: Sequence[str], scale_numeric: bool = True,
                  output: str = "features"):
    """Unfitted pyspark.ml Pipeline — median impute + standard scale numerics, one-hot
    categoricals (NULL or unknown category at transform → all-zero block; NULLs are not imputed)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    stages = []
    num_out = []
    if numeric:
        imp = [f"__imp_{c}" for c in numeric]
        stages.append(Imputer(strategy="median", inputCols=list(numeric), outputCols=imp))
        stages.append(VectorAssembler(inputCols=imp, outputCol="__num", handleInvalid="keep"))
        if scale_numeric:
            stages.append(StandardScaler(withMean=True, withStd=True, inputCol="__num", outputCol="__num_s"))
            num_out = ["__num_s"]
        else:
            num_out = ["__num"]
    idx = [f"__idx_{c}" for c in categorical]
    ohe = [f"__ohe_{c}" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        # keep-bucket index + dropLast: an unseen category becomes an all-zero block, width = training categories
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=num_out + ohe, outputCol=output))
    return Pipeline(stages=stages)
