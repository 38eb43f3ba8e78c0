"""J — evaluation of a probability column against a 0/1 label.

Threshold metrics are ratios of ``count_if`` from ONE aggregate; ranking
metrics (AUC, ROC) collapse to distinct scores and use the range-partitioned
running sums, so no task ever orders the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.operators.ordered import quantiles, running

EPS = 2.220446049250313e-16  # double machine epsilon: log-loss clip


def predict(df: DataFrame, p: str, threshold: float = 0.5, out: str = "prediction") -> DataFrame:
    """prediction = p ≥ threshold (inclusive)."""
    return df.withColumn(out, (F.col(p) >= threshold).cast("int"))


def _counts(df: DataFrame, y: str, pred: str) -> DataFrame:
    yy, pp = F.col(y), F.col(pred)
    return df.agg(F.count_if((yy == 0) & (pp == 0)).alias("tn"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
                  F.count_if((yy == 1) & (pp == 0)).alias("fn"), F.count_if((yy == 1) & (pp == 1)).alias("tp"))


def confusion(df: DataFrame, y: str, p: str, threshold: float = 0.5) -> DataFrame:
    """The four cells (zeros included) as rows."""
    c = _counts(predict(df, p, threshold), y, "prediction")
    return c.select(F.explode(F.array(
        *[F.struct(F.lit(name).alias("cell"), F.lit(a).alias("actual"), F.lit(b).alias("predicted"),
                   F.col(name).cast("bigint").alias("count"))
          for name, a, b in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))])).alias("c")).select("c.*")


def threshold_metrics(df: DataFrame, y: str, p: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy, balanced accuracy, precision, recall, F1 (0 when undefined), one row per metric."""
    c = _counts(predict(df, p, threshold), y, "prediction")
    tp, tn, fp, fn = (F.col(x).cast("double") for x in ("tp", "tn", "fp", "fn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    spec = F.coalesce(F.try_divide(tn, tn + fp), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    acc = F.coalesce(F.try_divide(tp + tn, tp + tn + fp + fn), F.lit(0.0))
    metrics = [("accuracy", acc), ("balanced_accuracy", (rec + spec) / 2), ("precision", prec),
               ("recall", rec), ("f1", f1)]
    return c.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("value"))
                                        for n, v in metrics])).alias("m")).select("m.*")


def _score_counts(df: DataFrame, y: str, p: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return df.groupBy(*by, F.col(p).cast("double").alias("__s")).agg(
        F.sum(F.when(F.col(y) == 1, w).otherwise(0.0)).alias("__pos"),
        F.sum(F.when(F.col(y) == 0, w).otherwise(0.0)).alias("__neg"))


def roc_auc(df: DataFrame, y: str, p: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """P(score of a positive > score of a negative), ties count one half (exact, tie-aware)."""
    fam = list(by) or ["__all"]
    base = df if by else df.withColumn("__all", F.lit(0))
    sc = _score_counts(base, y, p, fam, weight)
    cum = running(sc, fam, "__s", {"__neg_le": ("__neg", "sum")})
    agg = cum.groupBy(*fam).agg(
        F.sum(F.col("__pos") * (F.col("__neg_le") - F.col("__neg") / 2.0)).alias("__u"),
        F.sum("__pos").alias("__n1"), F.sum("__neg").alias("__n0"))
    out = agg.select(*fam, F.try_divide(F.col("__u"), F.col("__n1") * F.col("__n0")).alias("roc_auc"))
    return out if by else out.drop("__all")


def roc_points(df: DataFrame, y: str, p: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, thresholds descending (no point dropping)."""
    sc = _score_counts(df.withColumn("__all", F.lit(0)), y, p, ["__all"])
    cum = running(sc, ["__all"], "__s", {"tp": ("__pos", "sum"), "fp": ("__neg", "sum")}, descending=True)
    tot = sc.agg(F.sum("__pos").alias("__pos_total"), F.sum("__neg").alias("__neg_total"))  # one row
    return cum.crossJoin(F.broadcast(tot)).select(
        F.col("__s").alias("threshold"), F.col("tp").cast("bigint").alias("true_positives"),
        F.col("fp").cast("bigint").alias("false_positives"),
        F.try_divide(F.col("fp"), F.col("__neg_total")).alias("fpr"), F.try_divide(F.col("tp"), F.col("__pos_total")).alias("tpr"))


def prob_losses(df: DataFrame, y: str, p: str, eps: float = EPS) -> DataFrame:
    """Brier score and log loss (p clipped to [eps, 1 − eps])."""
    pc = F.least(F.greatest(F.col(p).cast("double"), F.lit(eps)), F.lit(1 - eps))
    yy = F.col(y).cast("double")
    return df.agg(F.avg(F.pow(F.col(p) - yy, 2)).alias("brier_score"),
                  F.avg(-(yy * F.log(pc) + (1 - yy) * F.log(1 - pc))).alias("log_loss"))


def quantile_edges(df: DataFrame, p: str, bins: int = 8) -> list[float]:
    """Exact linear-interpolated quantile edges, duplicates dropped: at most bins + 1 numbers."""
    counts = df.filter(F.col(p).isNotNull()).groupBy(F.col(p).cast("double").alias("__s"), F.lit(0).alias("__all")).agg(
        F.count(F.lit(1)).alias("__c"))
    row = quantiles(counts, ["__all"], "__s", "__c", {f"e{i}": i / bins for i in range(bins + 1)}).first()
    return sorted({float(row[f"e{i}"]) for i in range(bins + 1)}) if row else []


def calibration(df: DataFrame, y: str, p: str, bins: int = 8) -> DataFrame:
    """Quantile bins (right-closed, lowest included; NOT ntile, which splits ties)."""
    edges = quantile_edges(df, p, bins)
    pcol = F.col(p).cast("double")
    arr = F.array(*[F.lit(float(e)) for e in edges])
    binned = df.withColumn("bin", F.greatest(F.lit(1), F.size(F.filter(arr, lambda e: e < pcol))))
    agg = binned.groupBy("bin").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.avg(pcol).alias("mean_predicted_probability"),
        F.avg(F.col(y).cast("double")).alias("observed_positive_rate"),
        F.min(pcol).alias("minimum_probability"), F.max(pcol).alias("maximum_probability"))
    total = agg.agg(F.sum("n").alias("__n_total"))  # one row per bin → tiny
    err = F.abs(F.col("mean_predicted_probability") - F.col("observed_positive_rate"))
    return agg.join(F.broadcast(total), how="inner").select(
        F.col("bin").cast("int").alias("bin"), "n", "mean_predicted_probability", "observed_positive_rate",
        "minimum_probability", "maximum_probability", err.alias("absolute_calibration_error"),
        (err * F.col("n") / F.col("__n_total")).alias("weighted_error"))


def expected_calibration_error(cal: DataFrame) -> DataFrame:
    """Σ n·|error| / Σ n over the calibration bins."""
    return cal.agg((F.sum(F.col("n") * F.col("absolute_calibration_error")) / F.sum("n"))
                   .alias("expected_calibration_error"))


def poisson_cdf(mean: float = 1.0, kmax: int = 18) -> tuple[float, ...]:
    """P(K ≤ k) for k = 0..kmax-1, from the series e^-λ Σ λ^i / i!."""
    out, term, acc = [], math.exp(-mean), 0.0
    for k in range(kmax):
        if k:
            term *= mean / k
        acc += term
        out.append(acc)
    return tuple(out)


def poisson1(u: Column, kmax: int = 18) -> Column:
    """Inverse-CDF Poisson(1) draw from a uniform u in (0, 1); P(K ≥ 18) is below the grain of u."""
    expr = None
    for k, c in enumerate(poisson_cdf(1.0, kmax)):
        expr = F.when(u < c, F.lit(k)) if expr is None else expr.when(u < c, F.lit(k))
    return expr.otherwise(F.lit(kmax))


def uniform(key: Column) -> Column:
    """A uniform in (0, 1) with 52 bits, from the md5 of a key."""
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") + 0.5) / float(1 << 52)


def poisson_tables(counts: DataFrame, col: str) -> DataFrame:
    """``col, k0, cdf``: per distinct positive count c the distribution function of Poisson(c) at k0, k0 + 1, …

    The support is c ± (9√c + 16), beyond which less than 2^-53 of the mass lies. Weights follow
    from w(k) / w(k-1) = c / k and are divided by their sum, so every mean takes the same way, and a
    table has O(√c) rows however many rows a cell holds."""
    c, k = F.col(col), F.col("__k")
    reach = (F.ceil(9 * F.sqrt(c.cast("double"))) + 16).cast("bigint")
    ks = counts.select(c.cast("bigint").alias(col)).distinct().select(
        col, F.greatest(F.lit(0), c - reach).alias("k0"), F.explode(F.sequence(F.greatest(F.lit(0), c - reach), c + reach)).alias("__k"))
    upto = Window.partitionBy(col).orderBy("__k").rowsBetween(Window.unboundedPreceding, 0)
    ratio = F.when(k == F.col("k0"), 0.0).otherwise(F.log1p((c - k) / k))
    cum = ks.withColumn("__w", F.exp(F.sum(ratio).over(upto))).withColumn("__cum", F.sum("__w").over(upto))
    at = F.array_sort(F.collect_list(F.struct("__k", "__cum")))
    return cum.groupBy(col).agg(F.min("k0").alias("k0"), at.alias("__at")).select(
        col, "k0", F.transform("__at", lambda x: x["__cum"] / F.element_at("__at", -1)["__cum"]).alias("cdf"))


def poisson_draw(k0: Column, cdf: Column, u: Column) -> Column:
    """The smallest k with CDF(k) ≥ u, by halving the table: exact for every mean, in O(log √c) steps."""
    def half(span, _):
        mid = F.shiftright(span["lo"] + span["hi"], 1)
        low = F.coalesce(F.get(cdf, mid) < u, F.lit(False))
        return F.struct(F.when(low, mid + 1).otherwise(span["lo"]).alias("lo"), F.when(low, span["hi"]).otherwise(mid).alias("hi"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cdf) + 1.0)).cast("int"))
    return k0 + F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(cdf).alias("hi")), half)["lo"]


def bootstrap_cells(df: DataFrame, y: str, p: str, replicates: int = 1000, threshold: float = 0.5,
                    salt: str = "bootc", score_bins: int | None = None) -> DataFrame:
    """Rows collapse to (label, prediction, score) cells ONCE; each (cell, replicate) draws
    its Poisson(count) weight (the sum of count Poisson(1) draws), so the work is cells × replicates,
    independent of the row count. Same metrics and renormalisation as :func:`bootstrap_intervals`;
    equal in distribution, not draw for draw. Draws are exact at every count: the CDF of Poisson(count)
    is built once per distinct count and searched per replicate. With continuous scores pass
    ``score_bins`` (e.g. 10⁴): scores are floored to that grid so the cell count stays bounded (AUC/Brier
    then use binned scores; the threshold metrics keep the exact prediction)."""
    from tabulon.session import materialize
    pred = (F.col(p) >= threshold).cast("int")
    score = F.col(p).cast("double")
    if score_bins:
        score = F.floor(score * score_bins) / float(score_bins)
    cells = materialize(df.groupBy(F.col(y).cast("int").alias("__y"), pred.alias("__pr"), score.alias("__s"))
                        .agg(F.count(F.lit(1)).alias("__c")))
    key = F.concat_ws("|", F.lit(salt), F.col("__y").cast("string"), F.col("__pr").cast("string"),
                      F.col("__s").cast("string"), F.col("__b").cast("string"))
    # the cell table is small, so AQE would coalesce it into one task — and the ×replicates fan-out
    # with it. An explicit partition count (kept by AQE) spreads the fan-out over the cluster.
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    drawn = materialize(cells.join(poisson_tables(cells, "__c"), "__c").repartition(n)
                        .withColumn("__b", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
                        .withColumn("__w", poisson_draw(F.col("k0"), F.col("cdf"), uniform(key)))
                        .select("__b", "__y", "__pr", "__s", "__w", "__c"))
    return _replicate_metrics(drawn, replicates, "class-renormalised Poisson bootstrap (cell draws)")


def bootstrap_intervals(df: DataFrame, id_col: str, y: str, p: str, replicates: int = 200,
                        threshold: float = 0.5, salt: str = "boot") -> DataFrame:
    """Poisson bootstrap with per-class renormalisation.

    Every row gets a seeded Poisson(1) count per replicate (md5 uniform of
    (salt, row id, replicate)), partially aggregated map-side to
    (replicate, label, prediction, score) cells, so the shuffle is
    replicates × cells. Weighted sums stay integers (exact, partition-order
    independent); rescaling each class to its original size is applied
    analytically: class factor n_c / W_c. AUC is scale-free: U / (W1·W0).
    """
    pred = (F.col(p) >= threshold).cast("int")
    u = uniform(F.concat(F.lit(salt + "|"), F.col(id_col).cast("string"), F.lit("|"), F.col("__b").cast("string")))
    rows = df.select(F.col(y).cast("int").alias("__y"), F.col(p).cast("double").alias("__s"), pred.alias("__pr"),
                     F.col(id_col), F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("__b"))
    rows = rows.withColumn("__w", poisson1(u).cast("bigint"))
    cells = rows.groupBy("__b", "__y", "__pr", "__s").agg(F.sum("__w").alias("__w"),
                                                         F.count(F.lit(1)).alias("__c"))
    return _replicate_metrics(cells, replicates, "class-renormalised Poisson bootstrap")


def _replicate_metrics(cells: DataFrame, replicates: int, method: str) -> DataFrame:
    """Per-replicate metrics from (replicate, label, prediction, score, weight, count) cells → percentiles."""
    w, yy, pr = F.col("__w"), F.col("__y"), F.col("__pr")
    per = cells.groupBy("__b").agg(
        F.sum(F.when((yy == 1) & (pr == 1), w).otherwise(0)).alias("TP"),
        F.sum(F.when((yy == 0) & (pr == 0), w).otherwise(0)).alias("TN"),
        F.sum(F.when((yy == 0) & (pr == 1), w).otherwise(0)).alias("FP"),
        F.sum(F.when((yy == 1) & (pr == 0), w).otherwise(0)).alias("FN"),
        F.sum(F.when(yy == 1, F.col("__c")).otherwise(0)).alias("n1"),
        F.sum(F.when(yy == 0, F.col("__c")).otherwise(0)).alias("n0"),
        F.sum(F.when(yy == 1, w * F.pow(F.col("__s") - 1.0, 2))).alias("B1"),
        F.sum(F.when(yy == 0, w * F.pow(F.col("__s"), 2))).alias("B0"))
    s1 = F.col("n1") / (F.col("TP") + F.col("FN"))
    s0 = F.col("n0") / (F.col("TN") + F.col("FP"))
    tp, fn, tn, fp = F.col("TP") * s1, F.col("FN") * s1, F.col("TN") * s0, F.col("FP") * s0
    nn = F.col("n1") + F.col("n0")
    per = per.select(
        "__b",
        F.coalesce(F.try_divide(tp + tn, nn), F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
        F.try_divide(F.col("B1") * s1 + F.col("B0") * s0, nn).alias("brier_score"))
    sc = cells.groupBy("__b", "__s").agg(F.sum(F.when(yy == 1, w).otherwise(0)).cast("double").alias("__pos"),
                                         F.sum(F.when(yy == 0, w).otherwise(0)).cast("double").alias("__neg"))
    cum = running(sc, ["__b"], "__s", {"__neg_le": ("__neg", "sum")})
    auc = cum.groupBy("__b").agg(
        F.try_divide(F.sum(F.col("__pos") * (F.col("__neg_le") - F.col("__neg") / 2.0)),
                     F.sum("__pos") * F.sum("__neg")).alias("roc_auc"))
    per = per.join(auc, "__b")
    names = ["accuracy", "precision", "recall", "f1", "roc_auc", "brier_score"]
    long = per.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("v"))
                                          for n in names])).alias("m")).select("m.*")
    qs = F.percentile("v", F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975)))
    return long.groupBy("metric").agg(qs.alias("__q")).select(
        "metric", F.col("__q")[0].alias("lower_95"), F.col("__q")[1].alias("median"),
        F.col("__q")[2].alias("upper_95"), F.lit(replicates).alias("iterations"),
        F.lit(method).alias("method"))
