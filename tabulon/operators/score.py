"""L — batch profile validation, routing consistency, dual-model scoring, unseen-category warnings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.exprs import all_of, any_of, trim_ws
from tabulon.operators.explain import LinearExplainer, score_struct, sigmoid


def _err(cond: Column, field: str, message: str, kind: str) -> Column:
    return F.when(cond, F.struct(F.lit(field).alias("field"), F.lit(message).alias("message"),
                                 F.lit(kind).alias("type")))


def validation_errors(df: DataFrame, allowed: Mapping[str, Sequence[str]],
                      routing: Sequence[tuple[Column, str, str]] = ()) -> Column:
    """L1 + L2: array<struct<field, message, type>> per row (empty = valid), all checks in one projection.

    ``allowed``: field → closed category set (values are trimmed first; NULL = missing).
    ``routing``: (violation condition, field, message) cross-field rules.
    """
    errs = []
    for f, values in allowed.items():
        v = trim_ws(F.col(f).cast("string"))
        errs.append(_err(v.isNull() | (v == ""), f, "Field required", "missing"))
        errs.append(_err(v.isNotNull() & (v != "") & ~v.isin(*values), f,
                         "Input should be one of the allowed categories", "enum"))
    for cond, field, message in routing:
        errs.append(_err(F.coalesce(cond, F.lit(False)), field, message, "value_error"))
    return F.array_compact(F.array(*errs))


def valid_row(allowed: Mapping[str, Sequence[str]], routing: Sequence[tuple[Column, str, str]] = ()) -> Column:
    """Whether a row has no ``validation_errors``: the same checks as one condition, each field trimmed once."""
    fields = [F.coalesce(trim_ws(F.col(f).cast("string")).isin(*[x for x in values if x != ""]), F.lit(False)) for f, values in allowed.items()]
    return all_of([*fields, *[~F.coalesce(cond, F.lit(False)) for cond, _field, _message in routing]])


def split_valid(df: DataFrame, errors: Column, valid: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their error list); with ``valid`` the lists are made for rejected rows only."""
    if valid is not None:
        return df.filter(valid), df.filter(~valid).withColumn("errors", errors)
    tagged = df.withColumn("errors", errors)
    return (tagged.filter(F.size("errors") == 0).drop("errors"), tagged.filter(F.size("errors") > 0))


def unseen_warnings(df: DataFrame, learned: Mapping[str, Mapping[str, Sequence[str]]], id_col: str) -> DataFrame:
    """L4: per row and model, features whose value was not among the training categories (literal sets).

    ``learned``: model → feature → categories. A NULL is never a learned category.
    """
    def unseen(f, cats):
        return ~F.coalesce(F.col(f).cast("string").isin(*cats), F.lit(False))

    parts = [F.when(unseen(f, cats), F.struct(F.lit(model).alias("model"), F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")))
             for model, features in learned.items() for f, cats in features.items()]
    # most rows have none: they go before the arrays are made
    return df.filter(any_of([unseen(f, cats) for features in learned.values() for f, cats in features.items()])).select(F.col(id_col), F.explode(F.array_compact(F.array(*parts))).alias("w")) \
        .select(id_col, "w.model", "w.feature", "w.value")


def dual_scoring(df: DataFrame, models: Mapping[str, LinearExplainer], id_col: str,
                 threshold: float = 0.5) -> DataFrame:
    """Every valid profile through every model in one pass; one row per (profile, model)."""
    rows = F.array(*[score_struct(ex, model) for model, ex in models.items()])
    long = df.select(F.col(id_col), F.explode(rows).alias("s")).select(id_col, "s.*").withColumn("probability", sigmoid(F.col("raw_score")))
    yes = F.col("probability") >= threshold
    return long.select(id_col, "model", "raw_score", "probability", yes.cast("int").alias("prediction"),
                       F.when(yes, "More likely than not").otherwise("Less likely than not").alias("statement"), "baseline_probability")


DISCLAIMER = "Descriptive model estimate; not a decision about any individual."


def response_records(scores: DataFrame, factors: DataFrame, warnings: DataFrame | None, id_col: str,
                     disclaimer: str = DISCLAIMER) -> DataFrame:
    """One nested record per profile — per model: probability, percent (1 dp), answer, baseline and
    the ranked factor list; plus unseen-category warnings and a disclaimer.

    Factor lists are bounded (top-n per model), so ``collect_list`` per profile is safe; arrays are
    sorted by rank explicitly (collect order is not guaranteed).
    """
    f = factors.groupBy(id_col, "model").agg(F.array_sort(F.collect_list(F.struct(
        "factor_rank", "source_feature", "profile_value", "phi", "direction", "explanation_text"))).alias("factors"))
    per_model = scores.join(f, [id_col, "model"], "left").select(
        id_col, F.struct("model", "probability", F.round(F.col("probability") * 100, 1).alias("percent"),
                         F.col("statement").alias("answer"), "baseline_probability",
                         F.coalesce("factors", F.array()).alias("factors")).alias("result"))
    rec = per_model.groupBy(id_col).agg(F.array_sort(F.collect_list("result")).alias("results"))
    if warnings is not None:
        w = warnings.groupBy(id_col).agg(F.array_sort(F.collect_list(F.concat_ws(
            ": ", "model", F.concat(F.col("feature"), F.lit(" = "), F.coalesce(F.col("value"), F.lit("(missing)")))))).alias("warnings"))
        rec = rec.join(w, id_col, "left")
    else:
        rec = rec.withColumn("warnings", F.lit(None).cast("array<string>"))
    return rec.select(id_col, "results", F.coalesce("warnings", F.array().cast("array<string>")).alias("warnings"),
                      F.lit(disclaimer).alias("disclaimer"))
