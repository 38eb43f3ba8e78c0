"""H — group-aware splitting: profile keys, grouped stratified folds, audits, coverage.

Folds are a pure function of the profile key (md5 with a salt), so no profile
is ever on two sides, reruns and recomputation after executor loss give the
same assignment, and the only shuffle is the profile-level aggregate. Heavy
profiles (more than ``rows / (heavy_groups_per_fold · k)`` rows — a bounded set)
are dealt out in serpentine order of size within their label stratum so a few
big groups cannot unbalance the folds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.exprs import h8
from tabulon.session import materialize

NULL_TOKEN = "\\N"
SEP = "\u001f"


def profile_key(features: Sequence[str]) -> Column:
    """H1: md5 over the ordered predictor values (unit separator, explicit NULL token)."""
    parts = []
    for i, f in enumerate(features):
        if i:
            parts.append(F.lit(SEP))
        parts.append(F.coalesce(F.col(f).cast("string"), F.lit(NULL_TOKEN)))
    return F.md5(F.concat(*parts))


def _profile_table(df: DataFrame, key: str, label: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"),
                               F.sum(F.col(label).cast("bigint")).alias("__pos"))


def dealt_folds(prof: DataFrame, key: str, k: int, rows_total: int, heavy_groups_per_fold: int, out: str) -> DataFrame:
    """(key, out) of the heavy profiles only: those with more than rows_total / (heavy_groups_per_fold · k) rows.

    There are at most heavy_groups_per_fold · k of them. They are dealt in
    serpentine order of size within their label stratum.
    """
    heavy = prof.filter(F.col("__n") > F.lit(rows_total / (heavy_groups_per_fold * k)))
    stratum = F.when(F.col("__pos") * 2 >= F.col("__n"), 1).otherwise(0)
    r = F.row_number().over(Window.partitionBy(stratum).orderBy(F.col("__n").desc(), F.col(key))) - 1
    serp = F.when(F.floor(r / k) % 2 == 0, r % k).otherwise(k - 1 - r % k)
    return heavy.select(key, serp.cast("int").alias(out))


def light_fold(key: str, k: int, salt: str) -> Column:
    """Fold of every other profile: a hash of its key, computed where the row is."""
    return (h8(F.concat(F.lit(salt + "|"), F.col(key))) % k).cast("int")


def group_folds(df: DataFrame, key: str, label: str, k: int = 5, salt: str = "fold",
                heavy_groups_per_fold: int = 10, out: str = "fold") -> DataFrame:
    """H2/H3: fold in [0, k) per row, constant within a profile, label-stratified for heavy profiles.

    Rows are not shuffled: light folds are a projection, the heavy ones a bounded broadcast.
    """
    prof = materialize(_profile_table(df, key, label))
    total = prof.agg(F.sum("__n")).first()[0] or 0  # one-row parameter
    dealt = dealt_folds(prof, key, k, total, heavy_groups_per_fold, "__dealt")
    return df.join(F.broadcast(dealt), key, "left") \
        .withColumn(out, F.coalesce("__dealt", light_fold(key, k, salt))).drop("__dealt")


def holdout_split(df: DataFrame, key: str, label: str, k: int = 5, test_fold: int = 0,
                  salt: str = "holdout", cv_k: int = 5, cv_salt: str = "cv",
                  heavy_groups_per_fold: int = 10) -> DataFrame:
    """H2 + H3: side = test for one of k grouped folds; cv_fold on training profiles only.

    Both assignments come from ONE profile-level table; rows get them by
    projection and one bounded broadcast of the heavy profiles.
    """
    prof = materialize(_profile_table(df, key, label))
    total = prof.agg(F.sum("__n")).first()[0] or 0
    hold = dealt_folds(prof, key, k, total, heavy_groups_per_fold, "__h")
    side = F.when(F.coalesce("__h", light_fold(key, k, salt)) != test_fold, "train").otherwise("test")
    train = prof.join(F.broadcast(hold), key, "left").filter(side == "train")
    train_total = train.agg(F.sum("__n")).first()[0] or 0
    cv = dealt_folds(train, key, cv_k, train_total, heavy_groups_per_fold, "__c")
    dealt = hold.join(cv, key, "full")
    return df.join(F.broadcast(dealt), key, "left").withColumn("side", side).withColumn(
        "cv_fold", F.when(F.col("side") == "train", F.coalesce("__c", light_fold(key, cv_k, cv_salt)))).drop("__h", "__c")


def profile_summary(df: DataFrame, key: str, label: str) -> DataFrame:
    """H4 (profile part): rows, unique profiles, duplicate rows/groups, label-conflict groups/rows."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                            F.count_distinct(F.col(label)).alias("labels"))
    return g.agg(
        F.sum("n").cast("bigint").alias("rows"),
        F.count(F.lit(1)).cast("bigint").alias("unique_profiles"),
        (F.sum("n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"),
        F.count_if(F.col("n") > 1).cast("bigint").alias("duplicate_groups"),
        F.count_if(F.col("labels") > 1).cast("bigint").alias("conflict_groups"),
        F.coalesce(F.sum(F.when(F.col("labels") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("conflict_rows"),
    )


def split_audit(df: DataFrame, key: str, label: str, fold_col: str = "cv_fold",
                side_col: str = "side") -> DataFrame:
    """H4: per split (holdout, and every cv fold on training rows) sizes, positive rates, overlap.

    Rows are aggregated once to (profile, side, fold); every figure is then
    derived from that table (validation = the fold, train = all training − fold).
    """
    pt = materialize(df.groupBy(key, side_col, fold_col).agg(F.count(F.lit(1)).alias("__n"),
                                                            F.sum(F.col(label).cast("double")).alias("__p")))
    is_tr = F.col(side_col) == "train"
    hold = pt.agg(
        F.sum(F.when(is_tr, F.col("__n"))).alias("train_rows"),
        F.sum(F.when(~is_tr, F.col("__n"))).alias("validation_rows"),
        F.sum(F.when(is_tr, F.col("__p"))).alias("__tp"),
        F.sum(F.when(~is_tr, F.col("__p"))).alias("__vp"))
    hold_ov = pt.groupBy(key).agg(F.count_distinct(side_col).alias("__s")) \
        .agg(F.count_if(F.col("__s") > 1).alias("profile_overlap_count"))
    hold = hold.crossJoin(hold_ov).select(
        F.lit("holdout").alias("split"), "train_rows", "validation_rows",
        (F.col("__tp") / F.col("train_rows")).alias("train_positive_rate"),
        (F.col("__vp") / F.col("validation_rows")).alias("validation_positive_rate"),
        "profile_overlap_count")
    train = pt.filter(is_tr)
    per_fold = train.groupBy(F.col(fold_col).alias("__f")).agg(F.sum("__n").alias("__fold_n"),
                                                               F.sum("__p").alias("__fold_p"))
    tot = train.agg(F.sum("__n").alias("__all_n"), F.sum("__p").alias("__all_p"))
    sets = train.groupBy(key).agg(F.collect_set(fold_col).alias("__fs"))  # ≤ k values per profile
    ov = sets.filter(F.size("__fs") > 1).select(F.explode("__fs").alias("__f")) \
        .groupBy("__f").agg(F.count(F.lit(1)).alias("__ov"))
    cv = per_fold.crossJoin(F.broadcast(tot)).join(ov, "__f", "left").select(
        F.concat(F.lit("cv"), F.col("__f").cast("string")).alias("split"),
        (F.col("__all_n") - F.col("__fold_n")).alias("train_rows"), F.col("__fold_n").alias("validation_rows"),
        ((F.col("__all_p") - F.col("__fold_p")) / (F.col("__all_n") - F.col("__fold_n"))).alias("train_positive_rate"),
        (F.col("__fold_p") / F.col("__fold_n")).alias("validation_positive_rate"),
        F.coalesce(F.col("__ov"), F.lit(0)).alias("profile_overlap_count"))
    out = hold.unionByName(cv)
    return out.select("split", F.col("train_rows").cast("bigint"), F.col("validation_rows").cast("bigint"),
                      "train_positive_rate", "validation_positive_rate",
                      F.col("profile_overlap_count").cast("bigint"))


def split_signature(df: DataFrame, id_col: str, fold_col: str) -> DataFrame:
    """H5: order-insensitive fingerprint of (row id, fold): Σ of 32-bit md5 prefixes (exact decimal sum)."""
    h = h8(F.concat(F.col(id_col).cast("string"), F.lit("|"),
                    F.coalesce(F.col(fold_col).cast("string"), F.lit(NULL_TOKEN))))
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                  F.sum(h.cast("decimal(38,0)")).cast("string").alias("signature"))


def category_coverage(df: DataFrame, features: Sequence[str], side_col: str = "side",
                      train: str = "train", test: str = "test") -> DataFrame:
    """H6: per feature, distinct categories in train and test and test categories unseen in train."""
    long = df.select(F.col(side_col), *[F.col(f).cast("string").alias(f) for f in features]) \
        .unpivot([side_col], list(features), "feature", "category")
    cats = long.groupBy("feature", "category").agg(
        F.max(F.col(side_col) == train).alias("__in_train"), F.max(F.col(side_col) == test).alias("__in_test"))
    return cats.groupBy("feature").agg(
        F.count_if("__in_train").cast("bigint").alias("train_categories"),
        F.count_if("__in_test").cast("bigint").alias("test_categories"),
        F.count_if(F.col("__in_test") & ~F.col("__in_train")).cast("bigint").alias("unseen_test_categories"))
