"""L-family queries over JSON requests: the closed contract in batch and stream, and fitted answers by join."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabulon.functions.exprs import h8, sql_str
from tabulon.operators import contract as L
from tabulon.operators import explain as K
from tabulon.operators import respond as R
from tabulon.plans.base import Query
from tabulon.plans.q_explain import FITTED, KX_CTE, MODELS, fitted_models
from tabulon.plans.q_features import (ENGAGEMENT_MAP, MODEL_FEATURES, NO_PHONE, OFFLINE, OFFLINE_SKIP, OWN_NR, PHONE_TYPE_MAP,
                                      SPLIT_CTE, derived, split_frame)
from tabulon.session import materialize, shared_scratch, written
from tabulon.sources import fixtures as fx
from tabulon.streaming.scoring import run_stream

# ---------------------------------------------------------------------------
# The request contract (field → closed set)
# ---------------------------------------------------------------------------
YES_NO = ("Yes", "No", fx.NONRESPONSE)
ROUTED = (*YES_NO, fx.NOT_APPLICABLE)
FREQUENCY = ("Daily", "Weekly", "Monthly", "Less than once a month", "Never", fx.NONRESPONSE, fx.NOT_APPLICABLE)
PURCHASE = ("Purchases data daily", "Purchases data weekly", "Purchases data monthly", "Purchases data less than monthly",
            "Reports purchasing data but frequency never", "Data-purchase frequency nonresponse", "Does not purchase data",
            "Data-purchase status nonresponse", OFFLINE_SKIP)
FIELDS = {
    "female": ("Female", "Male"), "age_group": tuple(b[2] for b in fx.AGE_BANDS), "educ": fx.DIMENSIONS[2][3], "inc_q": fx.DIMENSIONS[3][3],
    "emp_in": ("In the workforce", "Out of the workforce"), "fin24c": YES_NO, "internet_use": ("Yes", fx.COMBINED_NO),
    "internet_engagement_level": (*ENGAGEMENT_MAP.values(), OFFLINE), "phone_access_tier": (*PHONE_TYPE_MAP.values(), NO_PHONE, OWN_NR),
    "con11": ROUTED, "con12": FREQUENCY, "con14": ROUTED, "con16": ROUTED, "con18": ROUTED, "con20": ROUTED,
    "data_purchase_pattern": PURCHASE, "fin46": YES_NO,
}
PHONE_FIELDS = ("con11", "con12", "con14", "con16", "con18", "con20")
PURPOSE = "Educational estimate of two survey outcomes from one profile."
QUESTIONS = {"model_a": "How likely is outcome A?", "model_b": "How likely is outcome B?"}

#: (violation, field, message): non-use and the no-use states go together, a person without a phone skips its fields.
_RULES = (
    ("internet_use = {no} and internet_engagement_level <> {off}", "internet_engagement_level", "must be the no-use state for a non-user"),
    ("internet_use = {no} and data_purchase_pattern <> {skip}", "data_purchase_pattern", "must be the no-use state for a non-user"),
    ("internet_use = 'Yes' and internet_engagement_level = {off}", "internet_engagement_level", "cannot be the no-use state for a user"),
    ("internet_use = 'Yes' and data_purchase_pattern = {skip}", "data_purchase_pattern", "cannot be the no-use state for a user"),
    ("phone_access_tier = {none} and not (" + " and ".join(f"{c} = {{na}}" for c in PHONE_FIELDS) + ")", "phone_access_tier",
     "phone fields must be skipped without a phone"),
)


def _rule(text: str) -> str:
    """A rule's condition; Spark reads single quotes within single-quoted text differently, so values are given in its own way."""
    return text.format(no=sql_str(fx.COMBINED_NO), off=sql_str(OFFLINE), skip=sql_str(OFFLINE_SKIP), none=sql_str(NO_PHONE), na=sql_str(fx.NOT_APPLICABLE))


def routing_rules():
    net, eng, buy, tier = (F.col(c) for c in ("internet_use", "internet_engagement_level", "data_purchase_pattern", "phone_access_tier"))
    skipped = F.lit(True)
    for c in PHONE_FIELDS:
        skipped = skipped & (F.col(c) == fx.NOT_APPLICABLE)
    broken = ((net == fx.COMBINED_NO) & (eng != OFFLINE), (net == fx.COMBINED_NO) & (buy != OFFLINE_SKIP), (net == "Yes") & (eng == OFFLINE),
              (net == "Yes") & (buy == OFFLINE_SKIP), (tier == NO_PHONE) & ~skipped)
    return [(cond, field, message) for cond, (_sql, field, message) in zip(broken, _RULES, strict=True)]


def _pick(salt: str, values) -> str:
    """One of ``values`` by the id, as SQL text of both engines (``{h}`` is filled in)."""
    return "case " + " ".join(f"when {{h:{salt}}} % {len(values)} = {i} then {sql_str(v)}" for i, v in enumerate(values)) + " end"


#: What the survey lacks, derived from the id; phone fields are skipped without a phone, purchases without internet use.
DERIVED = {"emp_in": _pick("emp", FIELDS["emp_in"]), "fin24c": _pick("f24", YES_NO), "fin46": _pick("f46", YES_NO)}
DERIVED |= {c: f"case when phone_access_tier = {sql_str(NO_PHONE)} then {sql_str(fx.NOT_APPLICABLE)} else {_pick(c, FIELDS[c][:-1])} end" for c in PHONE_FIELDS}
DERIVED["data_purchase_pattern"] = "case when internet_use <> 'Yes' then " + sql_str(OFFLINE_SKIP) + f" else {_pick('buy', PURCHASE[:-1])} end"
#: Faults by id: (number, field, what it becomes); the others are made on the text of the request.
CHANGED = ((2, "female", "'Unknown'"), (3, "female", "concat('  ', female, ' ')"),
           (4, "internet_engagement_level", f"case when internet_use = 'Yes' then {sql_str(OFFLINE)} else 'Online, income quintile 1' end"),
           (5, "data_purchase_pattern", f"case when internet_use = 'Yes' then {sql_str(OFFLINE_SKIP)} else 'Does not purchase data' end"),
           (6, "con14", "'Yes'"), (12, "educ", "' '"))
FAULTS = 200


def _render(text: str, dialect: str) -> str:
    import re
    return re.sub(r"\{h:(\w+)\}", lambda m: fx.h8_sql(f"concat('{m.group(1)}|', cast(respondent_id as string))", dialect), text)


def requests(spark, d, survey=None):
    """``respondent_id, body``: one JSON request per survey row, with faults that the id decides.

    A hash that a field is picked by is computed once, in its own projection; so is each
    form of the request that the faults are made on.
    """
    import re
    survey = fx.clean_survey(spark, d) if survey is None else survey
    base = derived(survey).select("respondent_id", *[c for c in FIELDS if c not in DERIVED])
    salts = sorted({m for v in DERIVED.values() for m in re.findall(r"\{h:(\w+)\}", v)})
    base = materialize(base).select("*", *[F.expr(_render("{h:%s}" % m, "spark")).alias(f"__h_{m}") for m in salts],
                                    (h8(F.concat(F.lit("req|"), F.col("respondent_id").cast("string"))) % FAULTS).alias("__fault"))
    quoted = {k: re.sub(r"\{h:(\w+)\}", r"__h_\1", v).replace("''", "\\'") for k, v in DERIVED.items()}
    base = base.select("*", *[F.expr(v).alias(k) for k, v in quoted.items()])
    for number, field, text in CHANGED:
        base = base.withColumn(field, F.when(F.col("__fault") == number, F.expr(text.replace("''", "\\'"))).otherwise(F.col(field)))
    fault = F.col("__fault")
    pairs = [F.struct(F.lit(f).alias("k"), F.col(f).alias("v")) for f in FIELDS]
    kept = F.filter(F.array(*pairs), lambda p: ~((fault.isin(1, 8)) & (p["k"] == "educ")))
    kept = F.when(fault.isin(0, 8), F.concat(kept, F.array(F.struct(F.lit("shoe_size").alias("k"), F.lit("42").alias("v"))))).otherwise(kept)
    base = base.select("respondent_id", "__fault", F.to_json(F.map_from_entries(kept)).alias("__body"))
    body = F.col("__body")
    body = (F.when(fault == 7, F.regexp_replace(body, '"fin46":"[^"]*"', '"fin46":1')).when(fault == 9, F.substring(body, 1, 40))
            .when(fault == 10, F.concat(F.lit("["), body, F.lit("]"))).when(fault == 11, F.regexp_replace(body, '"inc_q":"[^"]*"', '"inc_q":null')).otherwise(body))
    return base.select("respondent_id", body.alias("body"))


def arrived(spark, d, survey=None):
    """The requests as a written table, as they arrive; ``survey`` is a written table too."""
    return written(requests(spark, d, fx.written_survey(spark, d) if survey is None else survey), "requests")


def _checked(df):
    return L.checked(df, "body", FIELDS, routing_rules(), ["respondent_id"])


def _errors(rejected):
    return rejected.select("respondent_id", F.explode("errors").alias("e")).select("respondent_id", "e.field", "e.message", "e.type")


def q_contract(spark, d):
    return _errors(_checked(arrived(spark, d))[1])


def q_accepted(spark, d, survey=None):
    return _checked(arrived(spark, d, survey))[0]


def _questions(biases):
    return [R.Question(m, b, QUESTIONS[m]) for m, b in biases.items()]


def _rule_model(spark, d, survey):
    """Both fixed rule models as a table of weights, over the training categories."""
    counts = materialize(K.category_counts(split_frame(spark, d, survey).filter(F.col("side") == "train"), MODEL_FEATURES))
    weights = None
    for name, (salt, _bias) in MODELS.items():
        w = K.rule_weights(counts, salt).withColumn("model", F.lit(name))
        weights = w if weights is None else weights.unionByName(w)
    return weights, R.mean_weights(weights, counts), _questions({m: b for m, (_s, b) in MODELS.items()})


def q_answers(spark, d):
    """L3–L5 with the fixed rule models, one row per request and model, lists as text."""
    survey = fx.written_survey(spark, d)
    weights, means, questions = _rule_model(spark, d, survey)
    got = R.answers(q_accepted(spark, d, survey), "respondent_id", MODEL_FEATURES, weights, means, questions)
    a = got.select("respondent_id", F.explode("results").alias("a")).select("respondent_id", "a.*")
    return a.withColumn("main_factors", F.array_join(F.transform("main_factors", lambda f: F.concat_ws("|", f["feature"], f["value"], f["direction"], f["explanation"])), "; ")) \
        .withColumn("warnings", F.array_join("warnings", "; "))


def fitted_answers(spark, d, survey):
    """Both fitted logistic models as tables of weights, what their answers start from, and the fitted pipelines."""
    sp = written(split_frame(spark, d, survey), "split")
    counts = materialize(K.category_counts(sp.filter(F.col("side") == "train"), MODEL_FEATURES))
    rows, biases, models = [], {}, fitted_models(spark, d, sp, survey)
    for name, (model, _ex) in models.items():
        indexer = next(s for s in model.stages if s.__class__.__name__ == "StringIndexerModel")
        coefficients = iter(model.stages[-1].coefficients.toArray().tolist())
        rows += [(name, f, c, next(coefficients)) for f, labels in zip(MODEL_FEATURES, indexer.labelsArray, strict=True) for c in labels]
        biases[name] = float(model.stages[-1].intercept)
    weights = spark.createDataFrame(rows, "model string, feature string, category string, w double")
    return weights, R.mean_weights(weights, counts), _questions(biases), models


def q_fitted_records(spark, d):
    survey = fx.written_survey(spark, d)
    weights, means, questions, _models = fitted_answers(spark, d, survey)
    return R.records(R.answers(q_accepted(spark, d, survey), "respondent_id", MODEL_FEATURES, weights, means, questions), "respondent_id", PURPOSE)


def q_fitted_records_audit(spark, d):
    """The records of fitted models against the pipelines themselves: every accepted request, same probability, all factors."""
    from pyspark.ml.functions import vector_to_array
    survey = fx.written_survey(spark, d)
    ok = q_accepted(spark, d, survey)  # read from a written table
    weights, means, questions, models = fitted_answers(spark, d, survey)
    got = R.answers(ok, "respondent_id", MODEL_FEATURES, weights, means, questions, top=len(MODEL_FEATURES))
    a = got.select("respondent_id", F.explode("results").alias("a")).select("respondent_id", "a.model", "a.raw_score", "a.probability", "a.baseline_probability", F.expr(
        "aggregate(a.main_factors, cast(0 as double), (t, f) -> t + f.contribution_log_odds)").alias("phi"))
    own = None
    for name, (model, _ex) in models.items():
        p = model.transform(ok.select("respondent_id", *MODEL_FEATURES)).select(
            "respondent_id", F.lit(name).alias("model"), vector_to_array("probability")[1].alias("own"))
        own = p if own is None else own.unionByName(p)
    base = F.log(F.col("baseline_probability") / (1 - F.col("baseline_probability")))
    return a.join(own.hint("merge"), ["respondent_id", "model"]).groupBy("model").agg(
        F.count("*").alias("rows"), (F.max(F.abs(F.col("probability") - F.col("own"))) <= 1e-9).alias("same_probability"),
        (F.max(F.abs(base + F.col("phi") - F.col("raw_score"))) <= 1e-8).alias("factors_add_up"))


def _streamed(spark, d):
    survey = fx.written_survey(spark, d)
    weights, means, questions = _rule_model(spark, d, survey)
    weights = materialize(weights)
    root = shared_scratch(spark, f"requests/{uuid.uuid4().hex}")
    requests(spark, d, survey).write.parquet(f"{root}/in")  # arriving request files

    def score(ok):
        got = R.answers(ok, "respondent_id", MODEL_FEATURES, weights, means, questions)
        return got.select("respondent_id", F.explode("results").alias("a")).select("respondent_id", "a.model", "a.probability", "a.answer")

    return run_stream(spark, f"{root}/in", "respondent_id bigint, body string", f"{root}/out", _checked, score, read_once=True)


def q_stream_answers(spark, d):
    return spark.read.parquet(_streamed(spark, d)[0]).drop("epoch")


def q_stream_requests(spark, d):
    return _errors(spark.read.parquet(_streamed(spark, d)[1]))


# ----------------------------------------------------------------- oracle text
def _h8(salt: str) -> str:
    return fx.h8_sql(f"concat('{salt}|', cast(respondent_id as varchar))", "duckdb")


def _requests_cte() -> str:
    raw = "rq0 as (select respondent_id, " + ", ".join(c for c in FIELDS if c not in DERIVED) + ", " \
        + ", ".join(f"{_render(v, 'duckdb')} as {k}" for k, v in DERIVED.items()) + f", {_h8('req')} % {FAULTS} as fault from der)"
    changed = {f: f for f in FIELDS}
    for number, field, text in CHANGED:
        changed[field] = f"case when fault = {number} then {text} else {changed[field]} end"
    rows = "rq1 as (select respondent_id, fault, " + ", ".join(f"trim({v}) as {k}" for k, v in changed.items()) + " from rq0)"
    checks = ["select respondent_id, 'body' as field, 'Input should be a valid JSON object' as message, 'object_type' as type from rq1 where fault in (9, 10)"]
    for f, values in FIELDS.items():
        gone = "fault in (1, 8)" if f == "educ" else "false"
        odd = {"fin46": "fault = 7", "inc_q": "fault = 11"}.get(f, "false")
        checks.append(f"select respondent_id, '{f}', 'Field required', 'missing' from rq1 where fault not in (9, 10) and {gone}")
        checks.append(f"select respondent_id, '{f}', 'Input should be one of the allowed categories', 'enum' from rq1 where fault not in (9, 10) and not ({gone}) "
                      f"and ({odd} or {f} not in ({', '.join(sql_str(v) for v in values)}))")
    checks.append("select respondent_id, 'shoe_size', 'Extra inputs are not permitted', 'extra_forbidden' from rq1 where fault in (0, 8)")
    first = "case " + " ".join(f"when {_rule(c)} then {i}" for i, (c, _f, _m) in enumerate(_RULES)) + " end"
    rules = "(values " + ", ".join(f"({i}, {sql_str(f)}, {sql_str(m)})" for i, (_c, f, m) in enumerate(_RULES)) + ") r(i, field, message)"
    return (raw + ", " + rows + ", fe as (" + " union all ".join(checks) + "), "
            f"re as (select q.respondent_id, r.field, r.message, 'value_error' as type from (select *, {first} as broken from rq1 "
            f"where respondent_id not in (select respondent_id from fe)) q join {rules} on r.i = q.broken), "
            "er as (select * from fe union all select * from re), "
            "okr as (select * from rq1 where respondent_id not in (select respondent_id from er))")


REQ_CTE = SPLIT_CTE + ", " + _requests_cte()
_POS = "case " + " ".join(f"when a.feature = '{f}' then {i}" for i, f in enumerate(MODEL_FEATURES)) + " end"
ANSWER_CTE = KX_CTE + ", " + _requests_cte() + (
    ", al as (select respondent_id, feature, category from okr unpivot (category for feature in (" + ", ".join(MODEL_FEATURES) + "))), "
    f"ap as (select a.respondent_id, mo.model, a.feature, a.category, {_POS} as pos, coalesce(w.w, 0.0) as w, coalesce(w.w, 0.0) - mo.m as phi, w.w is null as unseen "
    "from al a join means mo on mo.feature = a.feature left join wts w on w.model = mo.model and w.feature = a.feature and w.category = a.category), "
    "ar as (select *, row_number() over (partition by respondent_id, model order by abs(phi) desc, pos) as r, "
    "case when phi > 0 then 'increased_likelihood' when phi < 0 then 'reduced_likelihood' else 'neutral' end as direction, "
    "case when phi > 0 then 'raises' when phi < 0 then 'lowers' else 'does not change' end as said from ap), "
    "atx as (select respondent_id, model, string_agg(concat_ws('|', feature, category, direction, printf('%s = %s %s the estimate', feature, category, said)), '; ' order by r) "
    "filter (where r <= 5) as main_factors, coalesce(string_agg(concat(model, ' has not seen ', feature, ' = ', category), '; ' order by pos) filter (where unseen), '') as warnings, "
    "sum(w) as sw from ar group by all), "
    "aq as (select t.*, b.bias + sw as raw_score, bs.base from atx t join (select distinct model, bias from wts) b using (model) join base bs using (model))")
ANSWER_SQL = (
    "select respondent_id, model, case model " + " ".join(f"when '{m}' then {sql_str(q)}" for m, q in QUESTIONS.items()) + " end as question, "
    "case when 1.0 / (1.0 + exp(-raw_score)) >= 0.5 then 'More likely than not' else 'Less likely than not' end as answer, raw_score, "
    "1.0 / (1.0 + exp(-raw_score)) as probability, round(100 * (1.0 / (1.0 + exp(-raw_score))), 1) as probability_percent, 0.5::double as threshold, "
    "'provisional' as threshold_status, 1.0 / (1.0 + exp(-base)) as baseline_probability, main_factors, warnings from aq")

QUERIES = [
    Query("request_contract", "L1,L2", q_contract, "select * from er", ctes=REQ_CTE),
    Query("request_accepted", "L1,L2", q_accepted, "select respondent_id, " + ", ".join(FIELDS) + " from okr", ctes=REQ_CTE),
    Query("request_answers", "L3,L4,L5,K2,K7,K10", q_answers, ANSWER_SQL, ("raw_score", "probability", "probability_percent", "baseline_probability"), ctes=ANSWER_CTE),
    Query("fitted_records", "L3,L5,K2", q_fitted_records),
    Query("fitted_records_audit", "L3,L5,K9", q_fitted_records_audit,
          f"select m.model, count(*) as rows, true as same_probability, true as factors_add_up from okr cross join (values {', '.join(f'({sql_str(m)})' for m in FITTED)}) m(model) "
          "group by m.model", ctes=REQ_CTE),
    Query("stream_requests", "L1,L2,L6", q_stream_requests, "select * from er", ctes=REQ_CTE),
    Query("stream_answers", "L3,L6", q_stream_answers,
          "select respondent_id, model, 1.0 / (1.0 + exp(-raw_score)) as probability, case when 1.0 / (1.0 + exp(-raw_score)) >= 0.5 then 'More likely than not' "
          "else 'Less likely than not' end as answer from aq", ("probability",), ctes=ANSWER_CTE),
]
