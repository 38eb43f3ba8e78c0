"""L3–L5 + K2, K7 — dual-model scoring with explanations, as one join with a table of weights.

A linear model over one-hot categories is a table (model, feature, category, w) of any
length. Rows meet the weights of all models by a join per feature, and one grouped pass per
id puts the whole answer together: score, probability, decision, the ranked factors and the
categories that a model has never seen. The table of weights is joined, never collected; only
what has a row per model and feature (the mean weights) is. Where the table is short it is
broadcast, so that rows stay whole and only one per id is shuffled.

φ = w − mean weight of the feature over the background; base + Σφ is the raw score. A null
or unseen category has weight 0 and gives a warning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.operators.explain import sigmoid
from tabulon.session import materialize

DISCLAIMER = "Descriptive model estimate; not a decision about any individual."
# Wording of the answers
DIRECTIONS = ("increased_likelihood", "reduced_likelihood", "neutral")
THRESHOLD_STATUS = "provisional"
SHORT = 100_000  # categories that are broadcast


@dataclass(frozen=True)
class Question:
    """What one model is asked and how its answer reads."""
    model: str
    bias: float
    question: str
    yes: str = "More likely than not"
    no: str = "Less likely than not"
    threshold: float = 0.5


def mean_weights(weights: DataFrame, background: DataFrame) -> dict[str, dict[str, float]]:
    """model → feature → Σ w · n / Σ n over the background's categories: a number per model and feature."""
    total = background.groupBy("feature").agg(F.sum("n").alias("__all"))
    per = background.join(weights, ["feature", "category"]).groupBy("model", "feature").agg(F.sum(F.col("w") * F.col("n")).alias("__wn"))
    out: dict[str, dict[str, float]] = {}
    for r in per.join(total, "feature").select("model", "feature", (F.col("__wn") / F.col("__all")).alias("m")).collect():
        out.setdefault(r["model"], {})[r["feature"]] = float(r["m"])
    return out


def answers(df: DataFrame, id_col: str, features: Sequence[str], weights: DataFrame, means: Mapping[str, Mapping[str, float]],
            questions: Sequence[Question], labels: Mapping[str, str] | None = None, top: int = 5) -> DataFrame:
    """``id, results``: one answer per model, in the order of ``questions``."""
    by = weights.groupBy("feature", "category").agg(F.map_from_entries(F.collect_list(F.struct("model", "w"))).alias("__w"))
    by = materialize(by)
    short = by.count() <= SHORT
    met = df.select(F.col(id_col), *[F.col(f).cast("string").alias(f) for f in features])
    of_models = F.array(*[F.struct(F.coalesce(F.try_element_at("__w", F.lit(q.model)), F.lit(0.0)).alias("w"),
                                   F.map_contains_key("__w", q.model).alias("seen")) for q in questions])
    for i, f in enumerate(features):
        w = by.where(F.col("feature") == f).select(F.col("category").alias(f"__c{i}"), of_models.alias(f"__w{i}"))
        met = met.join(F.broadcast(w) if short else w, F.col(f) == F.col(f"__c{i}"), "left")
    parts = F.array(*[F.struct(F.lit(i).alias("place"), F.col(f).alias("value"), F.col(f"__w{i}").alias("w")) for i, f in enumerate(features)])
    row = met.select(id_col, parts.alias("__parts")).groupBy(id_col).agg(F.flatten(F.collect_list("__parts")).alias("parts"))
    row = row.withColumn("parts", F.when(F.size("parts") > len(features), F.array_sort("parts", lambda a, b: a["place"] - b["place"])).otherwise(F.col("parts")))
    # a step of its own: the answer refers to the scores and to the ranked factors more than once
    row = row.select(id_col, "parts", *[c for j, q in enumerate(questions) for c in _scored(j, q, means.get(q.model, {}), features, top)])
    return row.select(id_col, F.array(*[_answer(j, q, means.get(q.model, {}), features, labels or {}) for j, q in enumerate(questions)]).alias("results"))


def _of(texts: Sequence[str], place: Column) -> Column:
    return F.get(F.array(*[F.lit(t) for t in texts]), place)


def _scored(j: int, q: Question, mean: Mapping[str, float], features: Sequence[str], top: int) -> list[Column]:
    """``__raw`` and ``__top`` of a model: its raw score, and its factors with the largest φ first, equal ones by place."""
    w = lambda p: F.coalesce(F.get(p["w"], F.lit(j))["w"], F.lit(0.0))
    means = F.array(*[F.lit(float(mean.get(f, 0.0))) for f in features])

    def factor(p: Column) -> Column:
        phi = w(p) - F.get(means, p["place"])
        return F.struct(F.abs(phi).alias("size"), (-p["place"]).alias("last"), p["value"].alias("value"), phi.alias("phi"))

    raw = F.aggregate("parts", F.lit(float(q.bias)), lambda a, p: a + w(p))
    return [raw.alias(f"__raw{j}"), F.slice(F.sort_array(F.transform("parts", factor), asc=False), 1, top).alias(f"__top{j}")]


def _answer(j: int, q: Question, mean: Mapping[str, float], features: Sequence[str], labels: Mapping[str, str]) -> Column:
    base = q.bias + sum(float(mean.get(f, 0.0)) for f in features)
    raw = F.col(f"__raw{j}")
    probability = sigmoid(raw)

    def factor(f: Column) -> Column:
        up, down, place = f["phi"] > 0, f["phi"] < 0, -f["last"]
        said = F.when(up, "raises").when(down, "lowers").otherwise("does not change")
        label = _of([labels.get(x, x) for x in features], place)
        shown = F.coalesce(f["value"], F.lit("(missing)"))
        return F.struct(_of(features, place).alias("feature"), label.alias("label"), shown.alias("value"),
                        F.when(up, DIRECTIONS[0]).when(down, DIRECTIONS[1]).otherwise(DIRECTIONS[2]).alias("direction"),
                        F.concat(label, F.lit(" = "), shown, F.lit(" "), said, F.lit(" the estimate")).alias("explanation"),
                        f["phi"].alias("contribution_log_odds"))

    unseen = F.filter("parts", lambda p: ~F.coalesce(F.get(p["w"], F.lit(j))["seen"], F.lit(False)))
    warnings = F.transform(unseen, lambda p: F.concat(F.lit(f"{q.model} has not seen "), _of(features, p["place"]), F.lit(" = "), F.coalesce(p["value"], F.lit("(missing)"))))
    return F.struct(
        F.lit(q.model).alias("model"), F.lit(q.question).alias("question"), F.when(probability >= q.threshold, q.yes).otherwise(q.no).alias("answer"),
        raw.alias("raw_score"), probability.alias("probability"), F.round(probability * 100, 1).alias("probability_percent"),
        F.lit(float(q.threshold)).alias("threshold"), F.lit(THRESHOLD_STATUS).alias("threshold_status"),
        sigmoid(F.lit(float(base))).alias("baseline_probability"), F.transform(F.col(f"__top{j}"), factor).alias("main_factors"), warnings.alias("warnings"))


def records(answered: DataFrame, id_col: str, purpose: str, disclaimer: str = DISCLAIMER) -> DataFrame:
    """One nested record per request."""
    return answered.select(F.col(id_col), F.lit(purpose).alias("purpose"), "results", F.lit(disclaimer).alias("disclaimer"))
