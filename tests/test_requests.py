"""The closed request contract and the join-based answers on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from tabulon.operators import contract as L
from tabulon.operators import respond as R

FIELDS = {"sex": ("Female", "Male"), "net": ("Yes", "No"), "buy": ("Daily", "None")}


def _check(spark, *bodies):
    rules = [((F.col("net") == "No") & (F.col("buy") == "Daily"), "buy", "non-users buy nothing"),
             ((F.col("sex") == "Male") & (F.col("net") == "No"), "sex", "a second rule")]
    df = spark.createDataFrame([(i, b if b is None or isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], "id int, body string")
    ok, bad = L.checked(df, "body", FIELDS, rules, ["id"])
    return {r.id: (r.sex, r.net, r.buy) for r in ok.collect()}, {r.id: [(e.field, e.type) for e in r.errors] for r in bad.collect()}


def test_contract(spark):
    ok, bad = _check(
        spark, {"sex": " Female ", "net": "Yes", "buy": "Daily"}, {"sex": "Female", "net": "Yes"}, {"sex": "X", "net": "Yes", "buy": "Daily", "b": 1, "a": [2]},
        {"sex": 1, "net": None, "buy": ""}, {"sex": "Male", "net": "No", "buy": "Daily"}, {"sex": "X", "net": "No", "buy": "Daily"}, "[1]", "{broken", None, "{}",
        {"sex": "Male", "net": "No", "buy": "None"}, "null", '{"sex": "Male", "sex": "Male", "net": "Yes", "buy": "Daily"}')
    assert ok == {0: ("Female", "Yes", "Daily")}
    assert bad == {
        1: [("buy", "missing")], 2: [("sex", "enum"), ("a", "extra_forbidden"), ("b", "extra_forbidden")], 3: [("sex", "enum"), ("net", "enum"), ("buy", "enum")],
        4: [("buy", "value_error")],  # the first broken rule only
        5: [("sex", "enum")],  # rules wait for the fields
        6: [("body", "object_type")], 7: [("body", "object_type")], 8: [("body", "object_type")], 9: [(f, "missing") for f in FIELDS],
        10: [("sex", "value_error")], 11: [("body", "object_type")], 12: [("body", "object_type")]}


def test_answers(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "z", "x")], "id int, f string, g string")
    weights = spark.createDataFrame([("m", "f", "a", 1.0), ("m", "f", "b", -2.0), ("m", "g", "x", 0.5), ("o", "f", "a", 0.25)], "model string, feature string, category string, w double")
    background = spark.createDataFrame([("f", "a", 3), ("f", "b", 1), ("g", "x", 4)], "feature string, category string, n long")
    means = R.mean_weights(weights, background)
    assert means == {"m": {"f": 0.25, "g": 0.5}, "o": {"f": 0.1875}}
    got = R.answers(rows, "id", ["f", "g"], weights, means, [R.Question("m", 0.1, "How?"), R.Question("o", 0.0, "Why?", threshold=0.6)], {"f": "Form"})
    out = {r.id: r.results for r in R.records(got, "id", "test").collect()}
    m = out[1][0]
    assert m.raw_score == pytest.approx(1.6) and m.answer == "More likely than not" and m.warnings == []
    assert [(f.feature, f.label, f.direction) for f in m.main_factors] == [("f", "Form", "increased_likelihood"), ("g", "g", "neutral")]
    assert sum(f.contribution_log_odds for f in m.main_factors) + 0.1 + 0.75 == pytest.approx(m.raw_score)
    assert out[2][0].warnings == ["m has not seen g = (missing)"] and out[3][0].warnings == ["m has not seen f = z"]
    assert out[1][1].answer == "Less likely than not" and out[1][1].threshold == 0.6 and out[1][1].warnings == ["o has not seen g = x"]
    assert all(r.threshold_status == "provisional" for rs in out.values() for r in rs)


def _plan(df, kind):
    spark = df.sparkSession
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        return getattr(df._jdf.queryExecution(), kind)().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_a_request_hashes_once_per_field(spark, monkeypatch):
    """One md5 per salt, however many values a field is picked from."""
    from tabulon.plans import q_requests
    survey = spark.createDataFrame([(1, "Female", "15–24", "Secondary education", "Income quintile 1", "Yes", "Yes", "A smartphone")],
                                   "respondent_id long, female string, age_group string, educ string, inc_q string, internet_use string, con1 string, con9 string")
    monkeypatch.setattr(q_requests.fx, "clean_survey", lambda spark, d: survey)
    monkeypatch.setattr(q_requests, "materialize", lambda df: df)
    plan = _plan(q_requests.requests(spark, ""), "optimizedPlan")
    assert plan.count("md5(") == len(q_requests.DERIVED) + 1


def test_answers_keep_rows_whole(spark):
    """Weights are looked up per feature: no row per feature is made or shuffled."""
    from tabulon.operators import respond as R
    weights = spark.createDataFrame([("m", "a", "x", 1.0), ("m", "b", "y", -2.0)], "model string, feature string, category string, w double")
    rows = spark.createDataFrame([(1, "x", "y"), (2, None, "z"), (2, "x", None)], "id long, a string, b string")
    got = R.answers(rows, "id", ["a", "b"], weights, {}, [R.Question("m", 0.5, "?")])
    assert "Expand" not in _plan(got, "executedPlan")
    by = {r["id"]: r["results"][0] for r in got.collect()}
    assert by[1]["raw_score"] == -0.5 and by[2]["raw_score"] == 1.5
    assert len(by[2]["warnings"]) == 3 and [f["feature"] for f in by[2]["main_factors"]] == ["a", "a", "b", "b"]


def test_the_audit_reads_one_survey_and_fits_cells(spark, monkeypatch):
    """One written survey feeds requests, split and fits; each model is fitted once, on counted cells."""
    from conftest import SF_SMALL
    from tabulon.plans import q_requests
    raw, fits, surveys, models = q_requests.fx.raw_survey, q_requests.fitted_models, [], []
    monkeypatch.setattr(q_requests.fx, "raw_survey", lambda *a: surveys.append(1) or raw(*a))
    monkeypatch.setattr(q_requests, "fitted_models", lambda *a: models.append(fits(*a)) or models[-1])
    got = {r["model"]: r for r in q_requests.q_fitted_records_audit(spark, SF_SMALL).collect()}
    assert len(surveys) == len(models) == 1
    assert set(got) == set(models[0]) and all(r["same_probability"] and r["factors_add_up"] for r in got.values())
    assert all(model.stages[-1].getWeightCol() == "__n" for model, _ in models[0].values())


def test_fields_are_looked_up_in_compiled_steps(spark):
    """No list over the contract's fields is gone through for a request in order: each field has a lookup of its own."""
    df = spark.createDataFrame([(1, "{}")], "id int, body string")
    plan = _plan(L.parsed(df, "body", FIELDS, ["id"]), "executedPlan")
    assert sum(f"__there{i}" in plan for i in range(len(FIELDS))) == len(FIELDS)
