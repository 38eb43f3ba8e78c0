"""K3 — exact path-dependent Shapley attributions of tree ensembles, as joins with a path table.

A fitted ensemble becomes a node table and that a path table: one row per leaf, with the
leaf's value and, for every feature on its path, the tests that lead there and z, the share
of the training cover that passes them. A row x passes (o = 1) or fails (o = 0) the tests of
a feature, and a leaf's part of the game is v · Π_{j∈S} o_j · Π_{j∉S} z_j. Its Shapley value
for feature i is v · (o_i − z_i) times the coefficients of Π_{j≠i} (z_j + o_j t), weighted by
k! (m−k−1)! / m!: quadratic in the path's features instead of exponential, for any depth.

Rows first collapse to distinct profiles; profiles join the path table by model, and one
grouped sum gives the attributions. The path table has as many rows as the model has leaves;
that number is known when the table is written, so the join may broadcast it. All of it runs
as Spark expressions. A boosted classifier's margin is Σ weight · tree(x), its log-odds twice
that; leaf values are scaled so that they add up to the log-odds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.session import materialize

MOST_ON_PATH = 30  # features on one path: Spark's trees are no deeper

_TEST = "struct<lo:double,hi:double,cats:array<double>,inside:boolean>"
_COND = f"array<struct<feature:int,share:double,test:{_TEST}>>"


def node_table(spark: SparkSession, model, path: str, name: str) -> DataFrame:
    """``model, tree, node, left, right, feature, threshold, cats, cover, value`` of a fitted boosted classifier, saved to ``path``."""
    model.write().overwrite().save(path)
    weights = spark.createDataFrame([(i, 2.0 * float(w)) for i, w in enumerate(model.treeWeights)], "tree int, scale double")
    n = F.col("nodeData")
    continuous = n["split"]["numCategories"] == -1
    nodes = spark.read.parquet(f"{path}/data").select(
        F.lit(name).alias("model"), F.col("treeID").alias("tree"), n["id"].alias("node"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.when(continuous, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(~continuous, n["split"]["leftCategoriesOrThreshold"]).alias("cats"), n["rawCount"].cast("double").alias("cover"),
        n["prediction"].alias("value"))
    return nodes.join(weights, "tree").withColumn("value", F.col("value") * F.col("scale")).drop("scale")


def path_table(nodes: DataFrame, depth: int) -> DataFrame:
    """``model, tree, leaf, value, features``: one row per leaf; ``features`` has (feature, z, tests) for each feature on its path."""
    nodes = materialize(nodes)
    child = nodes.select("model", "tree", F.col("node").alias("at"), F.col("cover").alias("child_cover"))
    edges = []
    for side, left in (("left", True), ("right", False)):
        inf = F.lit(float("inf"))
        test = F.struct(
            F.when(F.col("cats").isNull(), -inf if left else F.col("threshold")).alias("lo"),
            F.when(F.col("cats").isNull(), F.col("threshold") if left else inf).alias("hi"),
            F.col("cats").alias("cats"), F.lit(left).alias("inside"))
        edges.append(nodes.where("left >= 0").withColumn("at", F.col(side)).join(child, ["model", "tree", "at"]).select(
            "model", "tree", "node", "at", F.struct(F.col("feature").cast("int").alias("feature"), (F.col("child_cover") / F.col("cover")).alias("share"),
                                                    test.alias("test")).alias("cond")))
    edges = materialize(edges[0].unionByName(edges[1]))
    level = nodes.where("node = 0").select("model", "tree", F.lit(0).alias("node"), F.expr(f"cast(array() as {_COND})").alias("conds"))
    walked = level
    for _ in range(depth):
        level = level.join(edges, ["model", "tree", "node"]).select("model", "tree", F.col("at").alias("node"), F.array_append("conds", F.col("cond")).alias("conds"))
        walked = walked.unionByName(level)
    leaves = nodes.where("left < 0").select("model", "tree", "node", "value").join(walked, ["model", "tree", "node"])
    one = F.aggregate
    of = F.transform(F.array_distinct(F.transform("conds", lambda c: c["feature"])), lambda f: F.struct(
        f.alias("feature"),
        one(F.filter("conds", lambda c: c["feature"] == f), F.lit(1.0), lambda a, c: a * c["share"]).alias("z"),
        F.transform(F.filter("conds", lambda c: c["feature"] == f), lambda c: c["test"]).alias("tests")))
    return materialize(leaves.select("model", "tree", F.col("node").alias("leaf"), "value", of.alias("features")))


def _passed(x: Column, tests: Column) -> Column:
    return F.forall(tests, lambda t: F.when(t["cats"].isNull(), (x > t["lo"]) & (x <= t["hi"])).otherwise(F.array_contains(t["cats"], x) == t["inside"]))


def _shapley_weights() -> Column:
    """k! (m−k−1)! / m! by m and k: a fixed table."""
    return F.array(*[F.array(*[F.lit(1.0 / (m * math.comb(m - 1, k))) for k in range(m)]) if m else F.array(F.lit(0.0)) for m in range(MOST_ON_PATH + 1)])


def leaf_games(cells: DataFrame, paths: DataFrame, key: Sequence[str], x: str) -> DataFrame:
    """``key, model, value, parts`` for every cell and leaf of its model; ``parts`` has (feature, z, o)."""
    parts = F.transform("features", lambda f: F.struct(
        f["feature"].alias("feature"), f["z"].alias("z"),
        F.when(_passed(F.element_at(F.col(x), f["feature"] + 1), f["tests"]), 1.0).otherwise(0.0).alias("o")))
    return cells.select(*key, "model", x).join(paths, "model").select(*key, "model", "value", parts.alias("parts"))


def attributions(cells: DataFrame, paths: DataFrame, key: Sequence[str], x: str = "x") -> DataFrame:
    """``key, model, feature, phi`` over the features that the model uses (0 where a path has none)."""
    games = leaf_games(cells, paths, key, x)
    weights = _shapley_weights()

    def phi(p: Column, i: Column) -> Column:
        others = F.filter("parts", lambda q, j: j != i)
        poly = F.aggregate(others, F.array(F.lit(1.0)), lambda acc, q: F.zip_with(
            F.concat(acc, F.array(F.lit(0.0))), F.concat(F.array(F.lit(0.0)), acc), lambda a, b: a * q["z"] + b * q["o"]))
        share = F.aggregate(F.zip_with(poly, F.get(weights, F.size("parts")), lambda c, w: c * w), F.lit(0.0), lambda a, b: a + b)
        return F.struct(p["feature"].alias("feature"), (F.col("value") * (p["o"] - p["z"]) * share).alias("phi"))

    each = games.select(*key, "model", F.explode(F.transform("parts", phi)).alias("p"))
    return each.groupBy(*key, "model", F.col("p.feature").alias("feature")).agg(F.sum("p.phi").alias("phi"))


def margins(cells: DataFrame, paths: DataFrame, key: Sequence[str], x: str = "x") -> DataFrame:
    """``key, model, base, raw``: the expected log-odds and those of each cell."""
    times = lambda field: F.aggregate("parts", F.lit(1.0), lambda a, p: a * p[field])
    games = leaf_games(cells, paths, key, x)
    return games.groupBy(*key, "model").agg(F.sum(F.col("value") * times("z")).alias("base"), F.sum(F.col("value") * times("o")).alias("raw"))


def tree_attribution(df: DataFrame, paths: DataFrame, id_col: str, profile: Sequence[str], x: str, source_of: Mapping[int, str] | DataFrame) -> DataFrame:
    """``id, source_feature, phi``: attributions summed to source features; every row gets those of its profile.

    ``profile`` are the columns that determine the encoded vector ``x`` (array of doubles);
    ``source_of`` maps encoded features to source features, by a mapping or a table
    ``feature, source_feature``.
    """
    spark = df.sparkSession
    if not isinstance(source_of, DataFrame):
        source_of = spark.createDataFrame([(int(k), v) for k, v in source_of.items()], "feature int, source_feature string")
    cells = materialize(df.groupBy(*profile).agg(F.first(x).alias("x")).withColumn("cell", F.monotonically_increasing_id())
                        .withColumn("model", F.lit(paths.select("model").first()[0])))
    phi = attributions(cells, paths, ["cell"]).join(F.broadcast(source_of), "feature").groupBy("cell", "source_feature").agg(F.sum("phi").alias("phi"))
    own = cells.select(F.col("cell").alias("__cell"), *[F.col(c).alias(f"__{c}") for c in profile])
    same = F.lit(True)
    for c in profile:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return df.join(own, same).select(id_col, F.col("__cell").alias("cell")).join(phi, "cell").select(id_col, "source_feature", "phi")


def tree_additivity(cells: DataFrame, paths: DataFrame, key: Sequence[str], model_raw: DataFrame, x: str = "x") -> DataFrame:
    """``rows, max_raw_error``: |the model's own log-odds (``key, __raw``) − (base + Σφ)| over all cells."""
    total = attributions(cells, paths, key, x).groupBy(*key).agg(F.sum("phi").alias("phi"))
    rebuilt = margins(cells, paths, key, x).join(total, list(key), "left").select(*key, (F.col("base") + F.coalesce("phi", F.lit(0.0))).alias("__rebuilt"))
    return rebuilt.join(model_raw, list(key)).agg(F.count("*").alias("rows"), F.max(F.abs(F.col("__rebuilt") - F.col("__raw"))).alias("max_raw_error"))
