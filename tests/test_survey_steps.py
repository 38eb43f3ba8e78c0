"""Steps that go over the survey rows: how often, and in code that the JVM compiles."""

import re

import pytest
from pyspark.sql import functions as F

from tabulon.operators import features as G
from tabulon.operators import score as L
from tabulon.plans import q_codebook, q_explain, q_features, q_models
from tabulon.session import written
from tabulon.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
COMPILED = 8000  # bytes of bytecode; the JVM interprets longer methods


def plan(df, kind="formatted"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), kind)


def longest_method(df):
    spark = df.sparkSession
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", plan(df.select("*"), "codegen"))))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_unresolved_states_hash_each_row_once(spark):
    df = fx.clean_survey(spark, SF).withColumn("draft", G.route(q_features.phone_rules(with_nonresponse=False)))
    got = G.unresolved_states(df, "draft", ["con1", "con9"])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 2  # the salts of the two sources
    want = df.where("draft is null").groupBy("con1", "con9").count()
    assert sorted(got.collect()) == sorted(want.collect())


def test_unresolved_states_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a", None), ("x", "a", None), (None, "a", None), ("x", "b", None), (None, None, None)], "s string, k string, l string")
    assert sorted(map(str, G.unresolved_states(df, "s", ["k", "l"]).collect())) == [
        "Row(k='a', l=None, n=2)", "Row(k=None, l=None, n=1)"]


def test_survey_steps_are_compiled(spark):
    raw = fx.raw_survey(spark, SF)
    clean = fx._cleaned(written(raw))
    survey = fx.written_survey(spark, SF)
    for step in (raw, clean, q_features.keyed(spark, SF, survey), q_explain.profiles(spark, SF, survey)):
        assert longest_method(step) < COMPILED
    assert sorted(survey.collect()) == sorted(fx.clean_survey(spark, SF).collect())


@pytest.mark.parametrize("build", [q_features.split_frame, q_codebook.q_prep])
def test_survey_is_read_from_its_table(spark, build):
    assert "orders.parquet" not in plan(build(spark, SF))


def test_rule_search_goes_over_the_survey_once(spark, monkeypatch):
    seen = []
    real = q_models.I.fit_metrics
    monkeypatch.setattr(q_models.I, "fit_metrics", lambda cells, **k: seen.append(plan(cells)) or real(cells, **k))
    assert q_models.q_rule_search(spark, SF).count() == len(q_models.RULE_SETTINGS)
    assert "parquet" not in seen[0]


def test_valid_row_is_no_errors(spark):
    allowed, routing = {"a": ("x", "y", ""), "b": ("u",)}, [(F.col("a") == F.col("c"), "c", "same")]
    rows = [(a, b, c) for a in ("x", " y ", "z", "", " ", None) for b in ("u", None, "v") for c in ("x", None, "q")]
    df = spark.createDataFrame(rows + rows[:3], "a string, b string, c string")
    errors = L.validation_errors(df, allowed, routing)
    old, new = L.split_valid(df, errors), L.split_valid(df, errors, L.valid_row(allowed, routing))
    for one, other in zip(old, new, strict=True):
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect())) != []


def test_unseen_warnings_of_null_and_new_values(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", "u"), (3, "n", "u"), (3, "n", "u")], "id long, a string, b string")
    got = L.unseen_warnings(df, {"m": {"a": ["x"], "b": ["u"]}}, "id")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "m", "b", None), (3, "m", "a", "n"), (3, "m", "a", "n")]
