"""I — candidate models, grouped cross-validation search, one-SE selection, persistence parity.

Rows collapse to weighted cells first: one per (profile, label, fold) with its count. The
number of cells is bounded by the product of the categories, whatever the number of rows, and
every fit uses the counts as weights. Each (setting, fold) is an independent pyspark.ml fit
submitted from a bounded driver thread pool; settings of boosting that differ only in their
rounds are one fit, read off after fewer trees. Predictions collapse to score cells in the
task that makes them and are written; all six metrics of every fit then come from ONE grouped
aggregate (plus the tie-aware AUC through the bucketed running scan).
"""

from __future__ import annotations

import json

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.exprs import case_map
from tabulon.operators.evaluate import roc_auc


@dataclass(frozen=True)
class Candidate:
    family: str                 # baseline | logistic | tree | forest | gbt
    params: dict = field(default_factory=dict)
    complexity: int = 0

    @property
    def cid(self) -> str:
        return self.family + ":" + json.dumps(self.params, sort_keys=True)


def full_grid() -> list[Candidate]:
    """The reference's search space expressed as candidates (53 settings)."""
    out = [Candidate("baseline", {}, 0)]
    k = 1
    for cw in (None, "balanced"):
        for c in (0.05, 0.2, 1.0):
            out.append(Candidate("logistic", {"C": c, "class_weight": cw}, k)); k += 1
    for cw in (None, "balanced"):
        for d in (3, 5, 8):
            for leaf in (5, 15, 30):
                out.append(Candidate("tree", {"max_depth": d, "min_leaf": leaf, "class_weight": cw}, k)); k += 1
    for d in (None, 8):
        for leaf in (1, 5, 15):
            for mf in ("sqrt", "0.5"):
                out.append(Candidate("forest", {"trees": 300, "max_depth": d, "min_leaf": leaf, "features": mf}, k))
                k += 1
    for n in (100, 200):
        for lr in (0.03, 0.1):
            for d in (1, 2):
                for leaf in (5, 15):
                    out.append(Candidate("gbt", {"rounds": n, "rate": lr, "max_depth": d, "min_leaf": leaf}, k))
                    k += 1
    return out


def with_balanced_weight(df: DataFrame, label: str, out: str = "__w") -> DataFrame:
    """n / (2 · n_class) per row — class counts are a two-row parameter."""
    counts = {r[label]: r["c"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("c")).collect()}
    n = sum(counts.values())
    expr = None
    for cls, c in counts.items():
        cond = F.col(label) == cls
        w = F.lit(n / (2.0 * c))
        expr = F.when(cond, w) if expr is None else expr.when(cond, w)
    return df.withColumn(out, expr)


def make_estimator(c: Candidate, features: str, label: str, n_train: float, weight_col: str | None = None,
                   seed: int = 42, cells: bool = False):
    """The estimator of a setting. With ``cells``, ``weight_col`` holds counts: leaves need ``min_leaf`` rows' weight."""
    from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                           RandomForestClassifier)
    p = c.params
    kw = {"featuresCol": features, "labelCol": label}
    if c.family != "logistic":
        # a leaf's weight must reach min_leaf rows; half a row off, so that rounding can't decide
        kw |= ({"minWeightFractionPerNode": min(0.49, (p["min_leaf"] - 0.5) / n_train)} if cells else {"minInstancesPerNode": p["min_leaf"]}) | {"seed": seed}
    if c.family == "logistic":
        # sklearn C ↔ Spark: minimise mean loss + λ/2‖w‖²  ⇒  λ = 1 / (C · n)
        est = LogisticRegression(regParam=1.0 / (p["C"] * n_train), elasticNetParam=0.0, standardization=False,
                                 maxIter=200, **kw)
    elif c.family == "tree":
        est = DecisionTreeClassifier(maxDepth=p["max_depth"], **kw)
    elif c.family == "forest":
        # one-hot columns split once on a path: 30 is no limit up to 30 encoded columns (Spark has no deeper trees)
        est = RandomForestClassifier(numTrees=p["trees"], maxDepth=p["max_depth"] or 30, featureSubsetStrategy=p["features"], **kw)
    elif c.family == "gbt":
        est = GBTClassifier(maxIter=p["rounds"], stepSize=p["rate"], maxDepth=p["max_depth"], **kw)
    else:
        raise ValueError(c.family)
    if weight_col and (cells or p.get("class_weight") == "balanced"):
        est.setWeightCol(weight_col)
    return est


def _positive_probability(pred: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return pred.withColumn("__p", vector_to_array("probability")[1])


def fit_predict(train: DataFrame, evals: dict[str, DataFrame], c: Candidate, features: str, label: str,
                id_col: str):
    """Fit one candidate on the rows of ``train`` and return (model or prior, {split: predictions})."""
    n = train.count()
    if c.family == "baseline":
        prior = train.agg(F.avg(F.col(label).cast("double"))).first()[0]  # one-row parameter
        return prior, {k: v.select(id_col, label, F.lit(prior).alias("__p")) for k, v in evals.items()}
    tr = with_balanced_weight(train, label) if c.params.get("class_weight") == "balanced" else train
    model = make_estimator(c, features, label, n, "__w").fit(tr)
    return model, {k: _positive_probability(model.transform(v)).select(id_col, label, "__p")
                   for k, v in evals.items()}


def profile_cells(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """One row per (keys, label) with its count ``n``: what every fit is trained on."""
    return df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))


#: A forest draws a weight per row it is given: cells are handed over in at most so many equal parts.
FOREST_PARTS = 8


def fit_cells(train: DataFrame, c: Candidate, totals: Mapping[float, int], features: str = "features", label: str = "label", count: str = "n"):
    """One setting fitted on weighted cells; ``totals`` has the rows of each class in ``train``. The baseline is its rate."""
    n = sum(totals.values())
    if c.family == "baseline":
        return sum(v for k, v in totals.items() if k == 1) / n
    w = F.col(count).cast("double")
    if c.params.get("class_weight") == "balanced":
        w = w * case_map(F.col(label), {k: n / (len(totals) * v) for k, v in totals.items()})
    train = train.withColumn("__w", w)
    if c.family == "forest":
        parts = F.least(F.col(count), F.lit(FOREST_PARTS)).cast("int")
        train = train.withColumn("__w", F.col("__w") / parts).withColumn("__part", F.explode(F.sequence(F.lit(1), parts)))
    return make_estimator(c, features, label, n, "__w", cells=True).fit(train)


def boosted_prefix(model, rounds: int):
    """A boosted classifier's first ``rounds`` trees as a model: what the same fit with fewer rounds gives."""
    from pyspark.ml.classification import GBTClassificationModel
    if rounds == len(model.treeWeights):
        return model
    own, context = model._java_obj, SparkContext.getOrCreate()  # also in threads of a pool
    jvm, gateway = context._jvm, context._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    from_trees, from_weights = own.trees(), model.treeWeights
    for i in range(rounds):
        trees[i], weights[i] = from_trees[i], from_weights[i]
    return GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{own.uid()}_{rounds}", trees, weights))


def shared_fits(candidates: Sequence[Candidate]) -> list[tuple[Candidate, list[Candidate]]]:
    """(setting to fit, settings read off it): boosting settings that differ in rounds only share the longest."""
    out: dict[str, list[Candidate]] = {}
    for c in candidates:
        key = json.dumps(c.params | {"rounds": 0}, sort_keys=True) if c.family == "gbt" else c.cid
        out.setdefault(f"{c.family}|{key}", []).append(c)
    return [(max(cs, key=lambda c: c.params.get("rounds", 0)), cs) for cs in out.values()]


def search_on_cells(cells: DataFrame, fold_col: str, candidates: Sequence[Candidate], path: str, label: str = "label",
                    count: str = "n", parallelism: int = 8, folds: Sequence[int] | None = None) -> DataFrame:
    """Every (candidate, fold) fit on weighted cells → score cells (split, y, p, n) of its training and validation rows (of all folds, or of ``folds``).

    A fit writes its predictions below ``path``, so they are kept as they come and a fit that
    fails is repeated alone; the table returned reads them all.
    """
    spark = cells.sparkSession
    totals: dict[int, dict[float, int]] = {}
    for r in cells.groupBy(fold_col, label).agg(F.sum(count).alias("c")).collect():  # folds × classes rows
        totals.setdefault(r[fold_col], {})[r[label]] = int(r["c"])
    number = {c.cid: i for i, c in enumerate(candidates)}

    def run(job: tuple[Candidate, list[Candidate], int]) -> None:
        fit, read, fold = job
        others: dict[float, int] = {}
        for f, by in totals.items():
            for k, v in by.items():
                others[k] = others.get(k, 0) + (v if f != fold else 0)
        model = fit_cells(cells.where(F.col(fold_col) != fold), fit, {k: v for k, v in others.items() if v}, label=label, count=count)
        split = F.when(F.col(fold_col) == fold, "validation").otherwise("train")
        for c in read:
            if c.family == "baseline":
                scored = cells.withColumn("__p", F.lit(float(model)))
            else:
                scored = _positive_probability((boosted_prefix(model, c.params["rounds"]) if c.family == "gbt" else model).transform(cells))
            scored.groupBy(split.alias("split"), F.col(label).cast("double").alias("y"), F.col("__p").alias("p")).agg(
                F.sum(count).cast("long").alias("n")).coalesce(1).write.mode(
                "overwrite").parquet(f"{path}/candidate={number[c.cid]}/fold={fold}")

    jobs = [(fit, read, f) for fit, read in shared_fits(candidates) for f in (sorted(totals) if folds is None else folds)]
    jobs.sort(key=lambda j: ("baseline", "tree", "logistic", "gbt", "forest").index(j[0].family), reverse=True)  # longest first
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(run, jobs))
    settings = spark.createDataFrame([(number[c.cid], c.cid, c.family, json.dumps(c.params, sort_keys=True), c.complexity) for c in candidates],
                                     "candidate int, candidate_id string, family string, params string, complexity int")
    return spark.read.schema("split string, y double, p double, n long, candidate int, fold int").parquet(path).join(F.broadcast(settings), "candidate").drop("candidate")


def fit_metrics(preds: DataFrame, threshold: float = 0.5, weight: str | None = None) -> DataFrame:
    """Six metrics per (candidate, fold, split) from one grouped aggregate + grouped tie-aware AUC; ``weight`` counts rows."""
    keys = ["candidate_id", "family", "params", "complexity", "fold", "split"]
    y, pr = F.col("y"), (F.col("p") >= threshold).cast("int")
    n = F.col(weight).cast("double") if weight else F.lit(1.0)

    def total(of) -> Column:
        return F.sum(F.when(of, n).otherwise(0.0))

    agg = preds.groupBy(*keys).agg(
        total((y == 1) & (pr == 1)).alias("tp"), total((y == 0) & (pr == 0)).alias("tn"),
        total((y == 0) & (pr == 1)).alias("fp"), total((y == 1) & (pr == 0)).alias("fn"),
        (F.sum(F.pow(F.col("p") - y, 2) * n) / F.sum(n)).alias("brier"))
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    m = agg.select(*keys,
                   F.coalesce(F.try_divide(tp + tn, tp + tn + fp + fn), F.lit(0.0)).alias("accuracy"),
                   F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
                   F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
                   F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"), "brier")
    auc = roc_auc(preds, "y", "p", by=["candidate_id", "fold", "split"], weight=weight)
    return m.join(auc, ["candidate_id", "fold", "split"], "left")


#: Simplest family first.
FAMILY_TIERS = {"baseline": 0, "logistic": 1, "tree": 2, "forest": 3, "gbt": 3}
METRICS = ("roc_auc", "accuracy", "precision", "recall", "f1", "brier")


def search_table(metrics: DataFrame, k_folds: int) -> DataFrame:
    """I7 + I9: mean and population std per metric and split, rank by validation AUC, train−CV gap."""
    keys = ["candidate_id", "family", "params", "complexity"]
    aggs = []
    for m in METRICS:
        for split in ("validation", "train"):
            v = F.when(F.col("split") == split, F.col(m))
            aggs += [F.avg(v).alias(f"{split}_{m}_mean"), F.stddev_pop(v).alias(f"{split}_{m}_std")]
    t = metrics.groupBy(*keys).agg(*aggs)
    gap = F.col("train_roc_auc_mean") - F.col("validation_roc_auc_mean")
    w = Window.partitionBy("family").orderBy(F.col("validation_roc_auc_mean").desc(), F.col("candidate_id"))
    return t.withColumn("rank_in_family", F.rank().over(w)).withColumn("auc_gap", gap) \
        .withColumn("fit_gap", F.when(gap < 0.05, "low").when(gap < 0.10, "moderate").otherwise("high")) \
        .withColumn("k_folds", F.lit(k_folds))


def one_se_selection(table: DataFrame) -> DataFrame:
    """I8: the best setting of every family competes; cutoff = best mean AUC − its std/√k (baseline
    excluded); among families at or above it the simplest one wins (``FAMILY_TIERS``). Flags on every row."""
    champion = F.col("rank_in_family") == 1
    models = table.filter((F.col("family") != "baseline") & champion)
    best = models.agg(F.max_by(F.struct("validation_roc_auc_mean", "validation_roc_auc_std", "k_folds"),
                               F.col("validation_roc_auc_mean")).alias("b")).select(
        (F.col("b.validation_roc_auc_mean") - F.col("b.validation_roc_auc_std") / F.sqrt(F.col("b.k_folds")))
        .alias("cutoff"))
    cut = best.first()["cutoff"]  # one-row parameter
    elig = (F.col("family") != "baseline") & champion & (F.col("validation_roc_auc_mean") >= F.lit(cut))
    tier = case_map(F.col("family"), FAMILY_TIERS)
    chosen = table.filter(elig).orderBy(tier.asc(), F.col("validation_roc_auc_mean").desc(),
                                        F.col("candidate_id")).limit(1).select("candidate_id").first()
    sel = chosen["candidate_id"] if chosen else None
    return table.withColumn("one_se_cutoff", F.lit(cut)).withColumn("one_se_eligible", elig) \
        .withColumn("selected", F.col("candidate_id") == F.lit(sel))


def roundtrip_parity(model, data: DataFrame, path: str, id_col: str) -> DataFrame:
    """Save → load → predictions must match (max |Δp| per dataset)."""
    from pyspark.ml import PipelineModel
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = _positive_probability(model.transform(data)).select(id_col, F.col("__p").alias("p1"))
    b = _positive_probability(loaded.transform(data)).select(id_col, F.col("__p").alias("p2"))
    return a.join(b, id_col).agg(F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_difference"),
                                 F.count(F.lit(1)).cast("bigint").alias("rows")) \
        .withColumn("parity", F.col("max_abs_difference") <= 1e-12)


def encoded_feature_map(indexer_model, features: Sequence[str]) -> list[tuple[int, str, str]]:
    """K1: encoded index → (source feature, category) from the fitted StringIndexer (keep + dropLast
    one-hot: one column per training category, in label order)."""
    out, pos = [], 0
    for f, labels in zip(features, indexer_model.labelsArray):
        for lab in labels:
            out.append((pos, f, lab))
            pos += 1
    return out
