"""K — additive explanations for one-hot linear scores (exact in log-odds).

A linear model over one-hot categories is fully described by, per feature, a
category → weight map plus the intercept. Those maps are bounded by the model's
encoded width, so the explainer carries them as literal maps: attributions,
raw scores, factor ranking and warnings are then plain projections — no join,
no shuffle, whole-stage codegen. Global importance needs only category counts.

φ_f(x) = w_f[x_f] − Σ_c w_f[c] · share_f[c]      base = b + Σ_f Σ_c w_f[c] · share_f[c]
so base + Σ_f φ_f = b + Σ_f w_f[x_f] = the model's raw log-odds (unseen category → weight 0).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.exprs import h8

MAX_VOCABULARY = 1_000_000  # encoded width limit for literal maps


@dataclass(frozen=True)
class LinearExplainer:
    features: tuple[str, ...]
    weights: Mapping[str, Mapping[str, float]]      # feature → category → weight
    means: Mapping[str, float]                       # feature → Σ_c w·share (background)
    bias: float

    @property
    def base(self) -> float:
        return self.bias + sum(self.means[f] for f in self.features)

    def weight(self, f: str) -> Column:
        m = self.weights[f]
        if not m:
            return F.lit(0.0)
        lit_map = F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(float(v)))])
        return F.coalesce(F.try_element_at(lit_map, F.col(f).cast("string")), F.lit(0.0))

    def phi(self, f: str) -> Column:
        return self.weight(f) - F.lit(float(self.means[f]))

    def raw(self) -> Column:
        """Model raw score computed directly from the weights (independent of φ)."""
        out = F.lit(float(self.bias))
        for f in self.features:
            out = out + self.weight(f)
        return out


def category_counts(df: DataFrame, features: Sequence[str], weight: str | None = None) -> DataFrame:
    """(feature, category, n) over ``df`` — one unpivot + aggregate with map-side combine. ``weight``: how many rows a row stands for."""
    kept = [weight] if weight else []
    long = df.select(*kept, *[F.col(f).cast("string").alias(f) for f in features]).unpivot(kept, list(features),
                                                                                           "feature", "category")
    return long.groupBy("feature", "category").agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))


def rule_weights(counts: DataFrame, salt: str, spread: int = 1000) -> DataFrame:
    """Deterministic fixed weights in [−1, 1] per (feature, category): md5 rule, same in any engine."""
    key = F.concat(F.lit(salt + "|"), F.col("feature"), F.lit("|"), F.col("category"))
    return counts.select("feature", "category",
                         ((h8(key) % (2 * spread + 1) - spread) / float(spread)).alias("w"))


def build_explainer(weights: DataFrame, background_counts: DataFrame, features: Sequence[str],
                    bias: float) -> LinearExplainer:
    """Collect the (bounded) model vocabulary with its background shares into an explainer."""
    tot = background_counts.groupBy("feature").agg(F.sum("n").alias("__tot"))
    bg = background_counts.join(tot, "feature").withColumn("share", F.col("n") / F.col("__tot"))
    j = weights.join(bg.select("feature", "category", "share"), ["feature", "category"], "left")
    width = j.count()
    if width > MAX_VOCABULARY:
        raise ValueError(f"encoded width {width} exceeds {MAX_VOCABULARY}; use a join-based scorer")
    w: dict[str, dict[str, float]] = {f: {} for f in features}
    means: dict[str, float] = {f: 0.0 for f in features}
    for r in j.collect():  # bounded by the model's encoded width
        w[r["feature"]][r["category"]] = float(r["w"])
    for r in j.groupBy("feature").agg(F.sum(F.col("w") * F.coalesce(F.col("share"), F.lit(0.0))).alias("m")) \
            .collect():
        means[r["feature"]] = float(r["m"])
    return LinearExplainer(tuple(features), w, means, float(bias))


def linear_attribution(df: DataFrame, ex: LinearExplainer, id_col: str) -> DataFrame:
    """K2 + K4: (id, feature, category, phi) — one row per source feature (the source-level sum)."""
    parts = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("category"), ex.phi(f).alias("phi"))
             for f in ex.features]
    return df.select(F.col(id_col), F.explode(F.array(*parts)).alias("a")).select(id_col, "a.*")


def global_importance(counts: DataFrame, ex: LinearExplainer) -> DataFrame:
    """K5 (source level): mean |φ|, mean φ, share of total, rank — from category counts only."""
    feats = counts.filter(F.col("feature").isin(*ex.features))
    phi = None
    for f in ex.features:
        cond = F.col("feature") == f
        m = ex.weights[f]
        w = (F.coalesce(F.try_element_at(F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(float(v)))]),
                                         F.col("category")), F.lit(0.0)) if m else F.lit(0.0))
        e = w - F.lit(float(ex.means[f]))
        phi = F.when(cond, e) if phi is None else phi.when(cond, e)
    per = feats.withColumn("__phi", phi).groupBy("feature").agg(
        (F.sum(F.abs("__phi") * F.col("n")) / F.sum("n")).alias("mean_abs_phi"),
        (F.sum(F.col("__phi") * F.col("n")) / F.sum("n")).alias("mean_phi"))
    from pyspark.sql import Window
    tot = Window.partitionBy()  # ≤ number of model features rows: a tiny table
    return per.withColumn("importance_share", F.col("mean_abs_phi") / F.sum("mean_abs_phi").over(tot)) \
        .withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_abs_phi").desc(), F.col("feature"))))


def top_factors(df: DataFrame, ex: LinearExplainer, id_col: str, n: int = 5,
                labels: Mapping[str, str] | None = None) -> DataFrame:
    """K7: the n largest |φ| per row (ties keep feature order), ranked, with a sentence.

    Sorting happens inside each row's own array (no window, no shuffle).
    """
    parts = [F.struct(F.lit(i).alias("pos"), F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"),
                      ex.phi(f).alias("phi")) for i, f in enumerate(ex.features)]
    arr = F.array(*parts)
    ordered = F.array_sort(arr, lambda a, b: F.when(F.abs(a["phi"]) > F.abs(b["phi"]), -1)
                           .when(F.abs(a["phi"]) < F.abs(b["phi"]), 1)
                           .when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0))
    top = df.select(F.col(id_col), F.posexplode(F.slice(ordered, 1, n)).alias("__r", "t"))
    label = F.col("t.feature")
    if labels:
        label = F.coalesce(F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])[label], label)
    direction = F.when(F.col("t.phi") > 0, "raises").when(F.col("t.phi") < 0, "lowers").otherwise("does not change")
    return top.select(
        id_col, (F.col("__r") + 1).alias("factor_rank"), F.col("t.feature").alias("source_feature"),
        F.col("t.value").alias("profile_value"), F.col("t.phi").alias("phi"), direction.alias("direction"),
        F.format_string("%s = %s %s the estimate", label, F.col("t.value"), direction).alias("explanation_text"))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def score_struct(ex: LinearExplainer, model: str) -> Column:
    """(model, raw score, baseline) of one row as a struct."""
    return F.struct(F.lit(model).alias("model"), ex.raw().alias("raw_score"),
                    (F.lit(1.0) / (1.0 + F.exp(F.lit(-ex.base)))).alias("baseline_probability"))


def scored(df: DataFrame, ex: LinearExplainer, id_col: str, threshold: float = 0.5) -> DataFrame:
    """Raw score, probability and decision straight from the weights (K10 statement included)."""
    raw = ex.raw()
    out = df.select(F.col(id_col), raw.alias("raw_score")).withColumn("probability", sigmoid(F.col("raw_score")))
    return out.withColumn("prediction", (F.col("probability") >= threshold).cast("int")) \
        .withColumn("statement", F.when(F.col("probability") >= threshold, "More likely than not")
                    .otherwise("Less likely than not")) \
        .withColumn("baseline_probability", F.lit(1.0) / (1.0 + F.exp(F.lit(-ex.base))))


def exemplars(scores: DataFrame, id_col: str, p: str = "probability") -> DataFrame:
    """K8: lowest p, p closest to 0.5, highest p — id breaks ties (one aggregate, partial map-side)."""
    row = scores.agg(
        F.min_by(F.col(id_col), F.struct(F.col(p), F.col(id_col))).alias("lowest"),
        F.min_by(F.col(id_col), F.struct(F.abs(F.col(p) - 0.5), F.col(id_col))).alias("closest_to_half"),
        F.min_by(F.col(id_col), F.struct(-F.col(p), F.col(id_col))).alias("highest"))
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("exemplar"), F.col(k).alias(id_col))
                                          for k in ("lowest", "closest_to_half", "highest")])).alias("e")) \
        .select("e.*")


def additivity_audit(df: DataFrame, ex: LinearExplainer, tolerance: float = 1e-8) -> DataFrame:
    """K9: max |raw − (base + Σφ)| and max probability error; ``passed`` within tolerance."""
    total = F.lit(float(ex.base))
    for f in ex.features:
        total = total + ex.phi(f)
    raw = ex.raw()
    err = F.abs(raw - total)
    perr = F.abs(sigmoid(raw) - sigmoid(total))
    return df.agg(F.max(err).alias("max_raw_error"), F.max(perr).alias("max_probability_error")) \
        .withColumn("passed", F.col("max_raw_error") <= tolerance)


def explainer_from_logistic(model, indexer, encoder_features: Sequence[str], background: DataFrame,
                            weight: str | None = None) -> LinearExplainer:
    """Explainer for a fitted LogisticRegression on one-hot blocks (StringIndexer labels order)."""
    coef = model.coefficients.toArray().tolist()
    labels = indexer.labelsArray
    weights, pos = {}, 0
    for f, labs in zip(encoder_features, labels):
        weights[f] = {lab: coef[pos + i] for i, lab in enumerate(labs)}  # dropLast keeps every label
        pos += len(labs)
    spark = background.sparkSession
    wdf = spark.createDataFrame([(f, c, float(w)) for f, m in weights.items() for c, w in m.items()],
                                "feature string, category string, w double")
    return build_explainer(wdf, category_counts(background, encoder_features, weight), encoder_features,
                           float(model.intercept))
