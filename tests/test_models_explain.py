"""Explanations, splits, rules and sinks: invariants from the reference's test strategy."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import codebook as C
from tabulon.operators import explain as K
from tabulon.operators import splits as H
from tabulon.operators import tree_explain as T


def _expected(nodes, node, x, known):
    """A tree's value for x where only the features in ``known`` are known: other splits by cover."""
    _, left, right, feature, threshold, cats, _cover, value = nodes[node]
    if left < 0:
        return value
    if feature in known:
        goes = x[feature] in cats if cats is not None else x[feature] <= threshold
        return _expected(nodes, left if goes else right, x, known)
    return sum(nodes[c][6] * _expected(nodes, c, x, known) for c in (left, right)) / (nodes[left][6] + nodes[right][6])


def test_path_table_gives_the_permutation_values(spark):
    """Depth four, a feature twice on a path, a categorical split, a tree without splits: φ by all orders of the features."""
    trees = {0: [(0, 1, 2, 0, 0.5, None, 100.0, 0.0), (1, 3, 4, 1, 0.5, None, 60.0, 0.0), (2, 5, 6, 2, None, [1.0, 3.0], 40.0, 0.0),
                 (3, -1, -1, -1, None, None, 20.0, 1.0), (4, 7, 8, 1, 1.5, None, 40.0, 0.0), (5, -1, -1, -1, None, None, 10.0, 3.0),
                 (6, -1, -1, -1, None, None, 30.0, 0.5), (7, -1, -1, -1, None, None, 25.0, -2.0), (8, 9, 10, 3, 0.5, None, 15.0, 0.0),
                 (9, -1, -1, -1, None, None, 5.0, 4.0), (10, -1, -1, -1, None, None, 10.0, -1.5)],
             1: [(0, -1, -1, -1, None, None, 100.0, 0.25)]}
    rows = [("m", t, *n) for t, nodes in trees.items() for n in nodes]
    table = spark.createDataFrame(rows, "model string, tree int, node int, left int, right int, feature int, threshold double, "
                                        "cats array<double>, cover double, value double")
    xs = [[0.0, 1.0, 0.0, 1.0], [1.0, 0.0, 1.0, 0.0], [0.0, 2.0, 1.0, 0.0], [0.0, 2.0, 3.0, 1.0], [1.0, 2.0, 0.0, 1.0]]
    cells = spark.createDataFrame([(i, "m", x) for i, x in enumerate(xs)], "cell int, model string, x array<double>")
    paths = T.path_table(table, 4)
    got = {(r.cell, r.feature): r.phi for r in T.attributions(cells, paths, ["cell"]).collect()}
    sums = {r.cell: (r.base, r.raw) for r in T.margins(cells, paths, ["cell"]).collect()}
    for i, x in enumerate(xs):
        value = lambda known: sum(_expected({n[0]: n for n in nodes}, 0, x, known) for nodes in trees.values())  # noqa: B023, E731
        orders = list(itertools.permutations(range(4)))
        for f in range(4):
            want = sum(value(set(o[:o.index(f) + 1])) - value(set(o[:o.index(f)])) for o in orders) / len(orders)
            assert got[i, f] == pytest.approx(want, abs=1e-12)
        assert sums[i] == pytest.approx((value(set()), value({0, 1, 2, 3})))


def test_cell_fit_equals_row_fit(spark):
    """Weighted cells give the model of their rows: logistic coefficients, a tree's predictions, and the shared boosting fit."""
    from pyspark.ml.feature import VectorAssembler
    from tabulon.operators import models as I
    r = np.random.default_rng(5)
    a, b = r.integers(0, 2, 900), r.integers(0, 2, 900)
    y = (r.random(900) < 0.2 + 0.3 * a + 0.3 * a * b).astype(int)
    rows = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), (i % 3 for i in range(900)), y.tolist())), "a int, b int, fold int, label int")
    cells = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(I.profile_cells(rows, ["a", "b", "fold"], "label")).cache()
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).withColumn("n", F.lit(1))
    totals = {0: int((y == 0).sum()), 1: int((y == 1).sum())}
    for c in (I.Candidate("logistic", {"C": 0.2, "class_weight": "balanced"}), I.Candidate("tree", {"max_depth": 3, "min_leaf": 15, "class_weight": None}),
              I.Candidate("gbt", {"rounds": 4, "rate": 0.1, "max_depth": 2, "min_leaf": 5})):
        one, two = I.fit_cells(cells, c, totals), I.fit_cells(rows, c, totals)
        p = [sorted((x["a"], x["b"], round(x["__p"], 5)) for x in I._positive_probability(m.transform(cells.dropDuplicates(["a", "b"]))).collect()) for m in (one, two)]
        assert p[0] == p[1]
    long, short = (I.fit_cells(cells, I.Candidate("gbt", {"rounds": k, "rate": 0.1, "max_depth": 2, "min_leaf": 5}), totals) for k in (6, 3))
    pairs = [sorted(round(x["__p"], 10) for x in I._positive_probability(m.transform(cells)).collect()) for m in (I.boosted_prefix(long, 3), short)]
    assert pairs[0] == pairs[1]
    cells.unpersist()


def test_search_writes_every_setting_and_fold(spark, tmp_path):
    from pyspark.ml.feature import VectorAssembler
    from tabulon.operators import models as I
    rows = spark.createDataFrame([(i % 2, i // 2 % 2, i % 3, int((i * 7919) % 10 < 4 + 4 * (i % 2))) for i in range(600)], "a int, b int, fold int, label int")
    cells = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(I.profile_cells(rows, ["a", "b", "fold"], "label"))
    some = [c for c in I.full_grid() if c.family in ("baseline", "logistic")][:3] + [
        I.Candidate("gbt", {"rounds": k, "rate": 0.1, "max_depth": 1, "min_leaf": 5}, 9) for k in (2, 4)]
    assert len(I.shared_fits(some)) == 4 and len(I.full_grid()) == 53
    scores = I.search_on_cells(cells, "fold", some, str(tmp_path / "s"))
    table = I.search_table(I.fit_metrics(scores, weight="n"), 3).collect()
    assert len(table) == 5 and all(r.validation_accuracy_mean >= 0.4 for r in table)
    assert scores.groupBy("candidate_id", "fold").agg(F.sum("n").alias("n")).where("n <> 600").isEmpty()


def test_linear_explainer_additivity_and_topk(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "a", "y"), (4, "c", "y")],
                               "id int, f1 string, f2 string")
    counts = K.category_counts(df.filter("id < 4"), ["f1", "f2"])  # 'c' unseen in background
    ex = K.build_explainer(K.rule_weights(counts, "t"), counts, ["f1", "f2"], 0.3)
    audit = K.additivity_audit(df, ex).collect()[0]
    assert audit.max_raw_error <= 1e-12 and audit.passed
    top = K.top_factors(df, ex, "id", 1).collect()
    assert len(top) == 4 and all(r.factor_rank == 1 for r in top)


def test_rule_compiler_first_match(spark):
    df = spark.createDataFrame([("con7",), ("y_a",), ("zzz",)], "variable string")
    rules = [({"name_in": ["y_a"]}, "TARGET"), ({"name_prefix": "con"}, "DIGITAL"),
             ({"name_prefix": "co"}, "NEVER")]
    out = {r.variable: r.c for r in df.select("variable", C.compile_rules(rules, "FINANCIAL").alias("c")).collect()}
    assert out == {"con7": "DIGITAL", "y_a": "TARGET", "zzz": "FINANCIAL"}


def test_group_folds_no_overlap_and_deterministic(spark):
    rows = [(i, f"k{i % 37}", i % 2) for i in range(600)] + [(1000 + i, "heavy", 1) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, key string, y int")
    a = H.holdout_split(df, "key", "y")
    b = H.holdout_split(df.repartition(5), "key", "y")
    assert a.groupBy("key").agg(F.countDistinct("side").alias("s")).filter("s > 1").count() == 0
    da = {r.id: (r.side, r.cv_fold) for r in a.collect()}
    db = {r.id: (r.side, r.cv_fold) for r in b.collect()}
    assert da == db
    audit = {r.split: r for r in H.split_audit(a, "key", "y").collect()}
    assert all(r.profile_overlap_count == 0 for r in audit.values())
    assert sum(r.validation_rows for k, r in audit.items() if k.startswith("cv")) == audit["holdout"].train_rows


def test_text_normalise(spark):
    df = spark.createDataFrame([("  “Quoted”  —\tdash\n\nend ",)], "t string")
    assert df.select(C.normalise_text("t").alias("n")).first().n == '"Quoted" - dash end'


def test_sink_refuses_empty(spark, tmp_path):
    from tabulon.sources.csv_raw import read_raw_csv, write_table
    empty = spark.createDataFrame([], "a string")
    with pytest.raises(ValueError):
        write_table(empty, str(tmp_path / "e"), "csv")
    df = spark.createDataFrame([("x", ""), ("y", "2")], "a string, b string")
    write_table(df, str(tmp_path / "w"), "csv")
    back = read_raw_csv(spark, str(tmp_path / "w"))
    assert sorted(tuple(r) for r in back.collect()) == [("x", ""), ("y", "2")]


def test_bom_and_cp1252_fallback(spark, tmp_path):
    from tabulon.sources.csv_raw import read_raw_csv
    p = tmp_path / "bom.csv"
    p.write_bytes("﻿id,name\n1,café\n".encode("utf-8"))
    assert read_raw_csv(spark, str(p)).columns == ["id", "name"]
    q = tmp_path / "cp.csv"
    q.write_bytes("id,name\n1,café\n".encode("cp1252"))
    assert read_raw_csv(spark, str(q)).first().name == "café"


def test_file_fingerprint_matches_hashlib(spark, tmp_path):
    import hashlib
    from tabulon.sources.fingerprint import file_fingerprints
    p = tmp_path / "f.bin"
    p.write_bytes(b"abc" * 1000)
    r = file_fingerprints(spark, str(p)).first()
    assert r.sha256 == hashlib.sha256(b"abc" * 1000).hexdigest() and r.bytes == 3000


def test_cell_bootstrap_agrees_with_row_bootstrap(spark):
    from conftest import SF_SMALL
    from tabulon.operators import evaluate as J
    from tabulon.sources import fixtures as fx
    sc = fx.scored_survey(spark, SF_SMALL)
    a = {r.metric: r for r in J.bootstrap_intervals(sc, "respondent_id", "y", "p", replicates=100).collect()}
    b = {r.metric: r for r in J.bootstrap_cells(sc, "y", "p", replicates=100).collect()}
    for m in a:
        assert abs(a[m].median - b[m].median) < 0.02, m
        assert b[m].lower_95 <= b[m].median <= b[m].upper_95


def test_poisson_draws_are_exact(spark):
    """The tables against the definition, draws against a plain search, at small and large counts alike."""
    from bisect import bisect_left
    from math import exp, lgamma, log
    from tabulon.operators.evaluate import poisson_draw, poisson_tables
    counts = [1, 2, 7, 50, 51, 1000, 250_000]
    tables = poisson_tables(spark.createDataFrame([(c,) for c in counts + counts], "c bigint"), "c")
    got = {r["c"]: r for r in tables.collect()}
    assert sorted(got) == counts
    for c, r in got.items():
        acc = 0.0
        for k, x in enumerate(r["cdf"], r["k0"]):
            acc += exp(k * log(c) - c - lgamma(k + 1))
            assert abs(x - acc) < 1e-9
        assert r["cdf"][-1] == 1.0 and len(r["cdf"]) <= 2 * (9 * c ** 0.5 + 17) + 1
    us = [1e-15, 0.001, 0.25, 0.5, 0.75, 0.999, 1 - 1e-15]
    u = F.explode(F.array(*[F.lit(x) for x in us])).alias("u")
    for r in tables.select("c", "k0", "cdf", u).withColumn("w", poisson_draw(F.col("k0"), F.col("cdf"), F.col("u"))).collect():
        assert r["w"] == r["k0"] + bisect_left(r["cdf"], r["u"])


def test_poisson_draw_moments(spark):
    from tabulon.operators.evaluate import poisson_draw, poisson_tables, uniform
    t = poisson_tables(spark.createDataFrame([(1,), (4,), (120,)], "c bigint"), "c")
    many = t.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(40000))))
    key = F.concat_ws("|", F.col("c").cast("string"), F.col("i").cast("string"))
    drawn = many.withColumn("w", poisson_draw(F.col("k0"), F.col("cdf"), uniform(key)))
    for r in drawn.groupBy("c").agg(F.avg("w").alias("m"), F.variance("w").alias("v"), F.max("w").alias("top")).collect():
        assert abs(r["m"] - r["c"]) < 0.05 * r["c"] ** 0.5 and abs(r["v"] - r["c"]) < 0.05 * r["c"]
        assert r["c"] > 1 or r["top"] >= 7


def test_stream_restart_processes_each_file_once(spark, tmp_path):
    from tabulon.streaming.scoring import run_stream
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id bigint, v string"
    spark.createDataFrame([(1, "a"), (2, "bad")], schema).coalesce(1).write.parquet(src + "/b1")

    def validate(df):
        return df.filter(F.col("v") != "bad"), df.filter(F.col("v") == "bad")

    def score(df):
        return df.withColumn("s", F.length("v"))

    acc, rej = run_stream(spark, src + "/*", schema, out, validate, score)
    assert spark.read.parquet(acc).count() == 1 and spark.read.parquet(rej).count() == 1
    run_stream(spark, src + "/*", schema, out, validate, score)  # restart, nothing new: no duplicates
    assert spark.read.parquet(acc).count() == 1
    spark.createDataFrame([(3, "ccc")], schema).coalesce(1).write.parquet(src + "/b2")
    run_stream(spark, src + "/*", schema, out, validate, score)  # only the new file
    assert sorted(r.id for r in spark.read.parquet(acc).collect()) == [1, 3]


def test_stream_failure_between_sinks_is_exactly_once(spark, tmp_path):
    """The accepted sink is written, then the rejected one fails: the retried batch replaces what it wrote."""
    from tabulon.streaming.scoring import run_stream
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id bigint, v string"
    spark.createDataFrame([(i, "bad" if i % 3 == 0 else "a") for i in range(10)], schema).coalesce(1).write.parquet(src + "/b1")
    broken = {"now": True}

    def validate(df):
        bad = df.filter(F.col("v") == "bad")
        if broken["now"]:
            bad = bad.withColumn("v", F.raise_error(F.lit("sink down")).cast("string"))
        return df.filter(F.col("v") != "bad"), bad

    def score(df):
        return df.withColumn("s", F.length("v"))

    with pytest.raises(Exception):
        run_stream(spark, src + "/*", schema, out, validate, score)
    assert spark.read.parquet(out + "/accepted").count() == 6
    broken["now"] = False
    acc, rej = run_stream(spark, src + "/*", schema, out, validate, score)
    assert spark.read.parquet(acc).count() == 6 and spark.read.parquet(rej).count() == 4


def test_one_se_picks_the_simplest_family(spark):
    from tabulon.operators.models import one_se_selection
    rows = [("baseline:0", "baseline", 1, 0.50, 0.0), ("logistic:1", "logistic", 2, 0.60, 0.02), ("logistic:2", "logistic", 1, 0.735, 0.02),
            ("tree:1", "tree", 1, 0.70, 0.03), ("forest:1", "forest", 1, 0.745, 0.02), ("gbt:1", "gbt", 1, 0.75, 0.04)]
    table = spark.createDataFrame([(c, f, r, m, s, 5) for c, f, r, m, s in rows],
                                  "candidate_id string, family string, rank_in_family int, validation_roc_auc_mean double, "
                                  "validation_roc_auc_std double, k_folds int")
    out = {r.candidate_id: r for r in one_se_selection(table).collect()}
    assert [c for c, r in out.items() if r.selected] == ["logistic:2"]
    trees = one_se_selection(table.filter("family <> 'logistic'"))  # forest and boosting share a tier: the better AUC decides
    assert [r.candidate_id for r in trees.collect() if r.selected] == ["gbt:1"]
    assert {c for c, r in out.items() if r.one_se_eligible} == {"logistic:2", "forest:1", "gbt:1"}


def test_null_is_never_a_learned_category(spark):
    from tabulon.operators.score import unseen_warnings
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, f string")
    got = unseen_warnings(df, {"a": {"f": ["x"]}, "b": {"f": ["x", "y"]}}, "id").collect()
    assert sorted((r.id, r.model) for r in got) == [(2, "a"), (3, "a"), (3, "b")]


def test_lists_are_whole(spark):
    """Thirteen target values, fifty-one categories: nothing is left out."""
    from tabulon.operators import profile as B
    from tabulon.operators.clean import processed_schema
    df = spark.createDataFrame([(str(i % 13), f"c{i:02d}") for i in range(51)], "t string, c string")
    vf = B.value_frequency(df)
    row = B.target_summary(vf, ["t"], df.columns).first()
    assert row.observed_values.count("|") == 12 and row.distribution.count(":") == 13
    assert B.code_set_checks(vf, ["t"]).first()["check"].count("|") == 12
    assert {r.column: r.categories.count("|") for r in processed_schema(df).collect()} == {"t": 12, "c": 50}


def test_heavy_profiles_are_dealt_without_a_row_shuffle(spark):
    from tabulon.operators.splits import group_folds
    df = spark.range(4000).select(F.when(F.col("id") % 4 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"),
                                  (F.col("id") % 3 == 0).cast("int").alias("y"))
    out = group_folds(df, "key", "y")
    assert out.groupBy("key").agg(F.count_distinct("fold").alias("n")).filter("n > 1").isEmpty()
    assert out.filter("fold is null or fold not between 0 and 4").isEmpty()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_csv_records_are_faithful(spark, tmp_path):
    """Quoted line ends and separators, ragged records, a data record equal to the header, blank and repeated names."""
    from tabulon.sources.csv_raw import csv_structure, header_issues, read_raw_csv
    p = tmp_path / "odd.csv"
    p.write_text('a,b,a,\n1,"x, y\nz ""q""",3,4\na,b,a,\n5,6\n7,8,9,10,"11, 12",13\n,,,\n', encoding="utf-8")
    df = read_raw_csv(spark, str(p), extra_col="extra")
    assert df.columns == ["a_1", "b", "a_3", "column_4", "extra"]
    assert [tuple(r) for r in df.collect()] == [
        ("1", 'x, y\nz "q"', "3", "4", []), ("a", "b", "a", "", []), ("5", "6", "", "", []), ("7", "8", "9", "10", ["11, 12", "13"]), ("", "", "", "", [])]
    assert {r["width"]: r["rows"] for r in csv_structure(spark, str(p)).collect()} == {4: 3, 2: 1, 6: 1}
    assert [tuple(r) for r in header_issues(spark, str(p)).collect()] == [(4, "", "blank"), (3, "a", "duplicate")]
    with pytest.raises(Exception, match="longer than the header"):
        read_raw_csv(spark, str(p)).collect()


def test_strict_contracts(spark):
    """A changed pin, a repeated key and a variable without a code map are refused or reported."""
    from tabulon.operators.clean import require_code_maps
    from tabulon.operators.contracts import assert_unique
    from tabulon.operators.profile import scalar_profile
    from tabulon.sources.fingerprint import assert_pinned, table_fingerprint
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "")], "id int, v string")
    pin = table_fingerprint(df).first().fingerprint
    assert assert_pinned(table_fingerprint(df.repartition(3)), pin).count() == 1
    with pytest.raises(Exception, match="fingerprint changed"):
        assert_pinned(table_fingerprint(df.limit(2)), pin).collect()
    assert [tuple(r) for r in assert_unique(df, ["id"]).collect()] == [(2, 2)]
    cmap = spark.createDataFrame([("x", "1")], "variable string, raw_value string")
    assert require_code_maps(["x"], cmap) is cmap
    with pytest.raises(ValueError, match="y"):
        require_code_maps(["x", "y"], cmap)
    assert {r.column: (r.rows, r.non_missing_count, r.unique_count, r.min) for r in scalar_profile(df, ["id", "v"]).collect()} == {
        "id": (4, 3, 2, 1.0), "v": (4, 3, 3, None)}
