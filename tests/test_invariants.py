"""Reconciliation, metamorphic and permutation invariants (the reference's test strategy, §5)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from tabulon.operators import evaluate as J
from tabulon.operators import survey as E
from tabulon.plans import q_features as QF
from tabulon.sources import fixtures as fx

Q = entry_mod.queries()


def test_subgroup_reconciles_to_overall(spark):
    rates = Q["subgroup_rates"](spark, SF_SMALL)
    overall = {r.target: r for r in Q["overall_rates"](spark, SF_SMALL).collect()}
    sums = rates.groupBy("target", "dimension").agg(F.sum("n").alias("n"), F.sum("positive_count").alias("p"))
    for r in sums.collect():
        assert r.n == overall[r.target].n and r.p == overall[r.target].positive_count


def test_contingency_totals_match_included_rows(spark):
    cells = Q["contingency"](spark, SF_SMALL)
    chi = {r.test_id: r for r in Q["chi_square"](spark, SF_SMALL).collect()}
    tot = cells.groupBy("target", "dimension").agg(F.sum("observed_count").alias("o")).collect()
    for r in tot:
        assert r.o == chi[f"{r.target}:{r.dimension}"].n_included


def test_target_flip_leaves_features_unchanged(spark):
    clean = fx.clean_survey(spark, SF_SMALL)
    flipped = clean.withColumn(QF.TARGET, 1 - F.col(QF.TARGET))
    cols = ["respondent_id", *QF.MODEL_FEATURES]
    a = QF.derived(clean).select(*cols).exceptAll(QF.derived(flipped).select(*cols))
    assert a.count() == 0


def test_confusion_total_equals_rows(spark):
    sc = fx.scored_survey(spark, SF_SMALL)
    total = sum(r["count"] for r in J.confusion(sc, "y", "p").collect())
    assert total == sc.count()


def test_importance_shares_sum_to_one(spark):
    shares = [r.importance_share for r in Q["global_importance"](spark, SF_SMALL).collect()]
    assert sum(shares) == pytest.approx(1.0, abs=1e-5)


def test_rates_invariant_to_row_order_and_partitioning(spark):
    clean = fx.clean_survey(spark, SF_SMALL)
    a = E.subgroup_rates(clean, fx.TARGETS, fx.DIMENSIONS, "wgt", scale=2)
    b = E.subgroup_rates(clean.orderBy(F.rand(7)).repartition(3), fx.TARGETS, fx.DIMENSIONS, "wgt", scale=2)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_unexpected_category_raises(spark):
    clean = fx.clean_survey(spark, SF_SMALL)
    dims = [d if d[0] != "gender" else (d[0], d[1], d[2], ("Female",)) for d in fx.DIMENSIONS]
    with pytest.raises(Exception):
        E.subgroup_rates(clean, fx.TARGETS, dims, "wgt").collect()


def test_unknown_code_raises_in_strict_recode(spark):
    from tabulon.operators.clean import recode_categoricals
    df = spark.createDataFrame([("1",), ("7",)], "female string")
    with pytest.raises(Exception):
        recode_categoricals(df, {"female": {"1": "Female", "2": "Male"}}, core=["female"]).collect()


def test_fractional_age_and_zero_weight_rejected(spark):
    from tabulon.operators.clean import validate_whole_number
    with pytest.raises(Exception):
        validate_whole_number(spark.createDataFrame([("15.5",)], "age string"), "age", 15, 110).collect()
    with pytest.raises(Exception):
        E.assert_valid_weights(spark.createDataFrame([(0.0,)], "w double"), "w").collect()


def test_all_tied_scores_auc_half(spark):
    df = spark.createDataFrame([(i % 2, 0.3) for i in range(50)], "y int, p double")
    assert J.roc_auc(df, "y", "p").first().roc_auc == pytest.approx(0.5)


def test_running_equals_one_window(spark):
    from pyspark.sql import Window
    from tabulon.operators.ordered import quantiles, running
    rows = [(f % 3, float((i * 37) % 101), float(i % 7)) for f in range(3) for i in range(400)]
    df = spark.createDataFrame(rows, "fam int, x double, v double").groupBy("fam", "x").agg(F.sum("v").alias("v"))
    specs = {"cum": ("v", "sum"), "mn": ("v", "min")}
    for descending in (False, True):
        order = F.col("x").desc() if descending else F.col("x")
        w = Window.partitionBy("fam").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        a = df.select("*", F.sum("v").over(w).alias("cum"), F.min("v").over(w).alias("mn"))
        for n in (1, 7):
            b = running(df, ["fam"], "x", specs, descending=descending, buckets=n)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    counts = df.select("fam", "x", F.col("v").cast("long").alias("c"))
    got = {r.fam: r.m for r in quantiles(counts, ["fam"], "x", "c", {"m": 0.3}).collect()}
    want = counts.where("c > 0").select("fam", F.explode(F.array_repeat("x", F.col("c").cast("int"))).alias("x")).groupBy("fam").agg(F.percentile("x", 0.3).alias("m"))
    assert all(got[r.fam] == pytest.approx(r.m) for r in want.collect())


def test_chi_square_matches_spark_ml_chisquaretest(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest
    from tabulon.operators import stats as S
    clean = fx.clean_survey(spark, SF_SMALL)
    dims = [d for d in fx.DIMENSIONS if d[0] == "income_quintile"]
    ours = S.chi_square_tests(S.contingency(clean, {"y_a": "A"}, dims, "wgt")).first()
    idx = StringIndexer(inputCol="inc_q", outputCol="i").fit(clean).transform(clean)
    vec = VectorAssembler(inputCols=["i"], outputCol="f").transform(idx)
    ml = ChiSquareTest.test(vec, "f", "y_a").first()
    assert ours.chi_square == pytest.approx(float(ml.statistics[0]), rel=1e-9)
    assert ours.degrees_freedom == ml.degreesOfFreedom[0]


def test_auc_matches_exact_binary_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    sc = fx.scored_survey(spark, SF_SMALL).withColumn("y", F.col("y").cast("double"))
    ours = J.roc_auc(sc, "y", "p").first().roc_auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", metricName="areaUnderROC", numBins=0)
    assert ours == pytest.approx(ev.evaluate(sc), abs=1e-9)


def test_response_records_nested(spark):
    r = Q["response_records"](spark, SF_SMALL).first()
    assert len(r.results) == 2 and all(1 <= len(x.factors) <= 5 for x in r.results)
    assert [f.factor_rank for f in r.results[0].factors] == sorted(f.factor_rank for f in r.results[0].factors)
