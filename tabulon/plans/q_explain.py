"""K/L-family queries: linear attributions with fixed rule weights, validation, scoring, streaming."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from tabulon.functions.exprs import h8, sql_str
from tabulon.operators import explain as K
from tabulon.operators import score as L
from tabulon.plans.base import Query
from tabulon.plans.q_features import (ENGAGEMENT_MAP, MODEL_FEATURES, OFFLINE, SPLIT_CTE, TARGET, derived,
                                      split_frame)
from tabulon.session import materialize, shared_scratch, written
from tabulon.sources import fixtures as fx
from tabulon.streaming.scoring import run_stream

# The two linear models of the fixture (rule salt, intercept)
MODELS = {"model_a": ("wa", -0.25), "model_b": ("wb", 0.4)}
FEATURE_LABELS = {"female": "Gender", "age_group": "Age group", "educ": "Education", "inc_q": "Income quintile",
                  "internet_use": "Recent internet use", "phone_access_tier": "Phone access"}


def _split(spark, d, survey=None):
    """The split survey frame, written once to the shared checkpoint folder: every K/L query
    reads it several times (background counts, test rows, vocabulary)."""
    return written(split_frame(spark, d, survey), "split")


def explainers(spark, d, split=None):
    sp = split if split is not None else _split(spark, d)
    counts = K.category_counts(sp.filter(F.col("side") == "train"), MODEL_FEATURES)
    out = {}
    for name, (salt, bias) in MODELS.items():
        out[name] = K.build_explainer(K.rule_weights(counts, salt), counts, MODEL_FEATURES, bias)
    return out


def _test_and_explainer(spark, d, model="model_a"):
    sp = _split(spark, d)
    return sp.filter(F.col("side") == "test"), explainers(spark, d, sp)[model]


def q_attr(spark, d):
    t, ex = _test_and_explainer(spark, d)
    return K.linear_attribution(t, ex, "respondent_id")


def q_global(spark, d):
    t, ex = _test_and_explainer(spark, d)
    return K.global_importance(K.category_counts(t, MODEL_FEATURES), ex)


def q_top(spark, d):
    t, ex = _test_and_explainer(spark, d)
    return K.top_factors(t, ex, "respondent_id", 5, FEATURE_LABELS)


def q_exemplars(spark, d):
    t, ex = _test_and_explainer(spark, d)
    return K.exemplars(K.scored(t, ex, "respondent_id"), "respondent_id")


def q_additivity(spark, d):
    t, ex = _test_and_explainer(spark, d)
    return K.additivity_audit(t, ex)


# ---------------------------------------------------------------- L: validation
ALLOWED = {
    "female": ("Female", "Male"), "age_group": tuple(b[2] for b in fx.AGE_BANDS),
    "educ": fx.DIMENSIONS[2][3], "inc_q": fx.DIMENSIONS[3][3], "internet_use": ("Yes", fx.COMBINED_NO),
    "con1": ("Yes", "No", fx.NONRESPONSE), "con9": fx.DIMENSIONS[6][3],
}


def profiles(spark, d, survey=None):
    """Scoring requests: the derived survey rows, with deterministic data-derived faults injected."""
    base = derived(fx.clean_survey(spark, d) if survey is None else survey)
    u = h8(F.concat(F.lit("fault|"), F.col("respondent_id").cast("string"))) % 200
    return base.withColumns({
        "female": F.when(u == 0, F.lit("Unknown")).otherwise(F.col("female")),
        "educ": F.when(u == 1, F.lit("")).otherwise(F.col("educ")),
        "con9": F.when(u == 2, F.lit("A smartphone")).otherwise(F.col("con9")),
        "internet_engagement_level": F.when(u == 3, F.lit(OFFLINE)).otherwise(F.col("internet_engagement_level")),
    })


def routing_rules():
    net, eng = F.col("internet_use"), F.col("internet_engagement_level")
    return [
        ((net == fx.COMBINED_NO) != (eng == OFFLINE), "internet_engagement_level",
         "Non-users must have the no-use engagement state and vice versa"),
        ((F.col("con1") == "No") & (F.col("con9") != fx.NOT_APPLICABLE), "con9",
         "Respondents without a phone must have phone fields skipped"),
    ]


def q_validate(spark, d):
    p = profiles(spark, d)
    errs = L.validation_errors(p, ALLOWED, routing_rules())
    return p.select("respondent_id", F.explode(errs).alias("e")).select("respondent_id", "e.field", "e.message",
                                                                        "e.type")


def _checked(df):
    """(valid rows, rejected rows with their errors)."""
    return L.split_valid(df, L.validation_errors(df, ALLOWED, routing_rules()), L.valid_row(ALLOWED, routing_rules()))


def _valid_profiles(spark, d, survey):
    """Every valid profile.

    The requests are a written table: the checks would otherwise repeat the nested
    derivations of every field they look at.
    """
    p = written(profiles(spark, d, survey), "profiles")
    return _checked(p)[0]


def _learned(sp):
    """Model → feature → training categories. Both models see the same encoded training features."""
    vocab = K.category_counts(sp.filter(F.col("side") == "train"), MODEL_FEATURES)
    if vocab.count() > K.MAX_VOCABULARY:  # the learned categories are the model's encoded width
        raise ValueError("training vocabulary exceeds the literal-set limit")
    by_feature = {}
    for r in vocab.collect():
        by_feature.setdefault(r["feature"], []).append(r["category"])
    return {m: by_feature for m in MODELS}


def q_batch(spark, d):
    survey = fx.written_survey(spark, d)
    exs = explainers(spark, d, _split(spark, d, survey))
    return L.dual_scoring(_valid_profiles(spark, d, survey), exs, "respondent_id")


def q_responses(spark, d):
    survey = fx.written_survey(spark, d)
    sp = _split(spark, d, survey)
    exs = explainers(spark, d, sp)
    ok = written(_valid_profiles(spark, d, survey), "valid")
    scores = L.dual_scoring(ok, exs, "respondent_id")
    factors = None
    for name, ex in exs.items():
        f = K.top_factors(ok, ex, "respondent_id", 5, FEATURE_LABELS).withColumn("model", F.lit(name))
        factors = f if factors is None else factors.unionByName(f)
    warn = L.unseen_warnings(ok, _learned(sp), "respondent_id")
    return L.response_records(scores, factors, warn, "respondent_id")


def q_unseen(spark, d):
    survey = fx.written_survey(spark, d)
    return L.unseen_warnings(profiles(spark, d, survey), _learned(_split(spark, d, survey)), "respondent_id")


def _streamed(spark, d):
    survey = fx.written_survey(spark, d)
    exs = explainers(spark, d, _split(spark, d, survey))
    p = profiles(spark, d, survey).select("respondent_id", *ALLOWED, "internet_engagement_level", "phone_access_tier")
    root = shared_scratch(spark, f"stream/{uuid.uuid4().hex}")
    p.write.parquet(f"{root}/in")  # arriving request files
    schema = p.schema.simpleString()[len("struct<"):-1].replace(":", " ")

    return run_stream(spark, f"{root}/in", schema, f"{root}/out", _checked,
                      lambda ok: L.dual_scoring(ok, exs, "respondent_id"))


def q_stream(spark, d):
    return spark.read.parquet(_streamed(spark, d)[0]).drop("epoch")


def q_stream_rejected(spark, d):
    rejected = spark.read.parquet(_streamed(spark, d)[1])
    return rejected.select("respondent_id", F.explode("errors").alias("e")).select("respondent_id", "e.field", "e.message", "e.type")


# ---------------------------------------------------------------- fitted models
FIT_PARTS = 100_000
FITTED = {"model_a": ("y_a", 1.0), "model_b": ("y_b", 0.2)}  # outcome and inverse regularisation


def fitted_models(spark, d, sp, survey=None):
    """Model → (fitted pipeline, its explainer): one logistic model per outcome, trained on the training side.

    Rows collapse to cells, one per combination of features and outcomes, in parts of at most one
    in ``FIT_PARTS`` of all rows; parts are fitted with their counts as weights. There are at most
    ``FIT_PARTS`` of them beside the cells. Whole cells as weights would scale the features
    otherwise than rows do, and the solver would stop elsewhere (by 7e-6 at 15,000 rows).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from tabulon.operators import clean as D
    survey = fx.clean_survey(spark, d) if survey is None else survey
    outcomes = survey.select("respondent_id", *fx.TARGETS)
    # both are tables of all rows, which Spark may take for small by their size on disk
    rows = sp.filter(F.col("side") == "train").select("respondent_id", *MODEL_FEATURES).join(outcomes.hint("merge"), "respondent_id")
    cells = materialize(rows.groupBy(*MODEL_FEATURES, *fx.TARGETS).agg(F.count(F.lit(1)).alias("__n")))
    n = cells.agg(F.sum("__n")).first()[0] or 0
    most = max(n // FIT_PARTS, 1)
    parts = cells.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(most).cast("long"))))
    train = materialize(parts.withColumn("__n", F.least(F.lit(most).cast("long"), F.col("__n") - F.col("__from"))).drop("__from"))
    out = {}
    for name, (target, c) in FITTED.items():
        fit = Pipeline(stages=D.prep_template([], MODEL_FEATURES).getStages() + [LogisticRegression(
            regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=200, weightCol="__n")])
        model = fit.fit(train.withColumn("label", F.col(target).cast("double")))
        indexer = next(s for s in model.stages if s.__class__.__name__ == "StringIndexerModel")
        out[name] = (model, K.explainer_from_logistic(model.stages[-1], indexer, MODEL_FEATURES, train, "__n"))
    return out


def _fitted_scores(spark, d):
    """Every valid profile through both fitted pipelines, beside the score that its attributions add up to."""
    from functools import reduce
    from pyspark.ml.functions import vector_to_array
    survey = fx.written_survey(spark, d)
    sp = _split(spark, d, survey)
    ok = _valid_profiles(spark, d, survey)
    parts = []
    for name, (model, ex) in fitted_models(spark, d, sp, survey).items():
        total = F.lit(float(ex.base))
        for f in ex.features:
            total = total + ex.phi(f)
        parts.append(model.transform(ok.select("respondent_id", *MODEL_FEATURES)).select(
            "respondent_id", F.lit(name).alias("model"), vector_to_array("rawPrediction")[1].alias("raw_score"),
            vector_to_array("probability")[1].alias("probability"), F.col("prediction").cast("int").alias("prediction"),
            total.alias("explained_score"), F.lit(1.0 / (1.0 + math.exp(-ex.base))).alias("baseline_probability")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_fitted_additivity(spark, d):
    """K9 against the fitted model itself: its raw prediction and base + Σφ."""
    s = _fitted_scores(spark, d)
    return s.groupBy("model").agg(F.count(F.lit(1)).alias("rows"), (F.max(F.abs(F.col("raw_score") - F.col("explained_score"))) <= 1e-8).alias("passed"))


# ----------------------------------------------------------------- oracle text
def h8d(e: str) -> str:
    return f"cast(('0x' || substr(md5({e}), 1, 8)) as bigint)"


KX_CTE = SPLIT_CTE + (
    ", trn_long as (select feature, category, count(*) as n from (select * from split where side = 'train') "
    f"unpivot (category for feature in ({', '.join(MODEL_FEATURES)})) group by feature, category), "
    "trn_share as (select *, n / sum(n) over (partition by feature) as share from trn_long), "
    "wts as (" + " union all ".join(
        f"select '{m}' as model, {bias} as bias, feature, category, share, "
        f"({h8d(f"concat('{salt}|', feature, '|', category)")} % 2001 - 1000) / 1000.0 as w from trn_share"
        for m, (salt, bias) in MODELS.items()) + "), "
    "means as (select model, min(bias) as bias, feature, sum(w * share) as m from wts group by model, feature), "
    "base as (select model, min(bias) + sum(m) as base from means group by model), "
    "tst_long as (select respondent_id, feature, category from (select * from split where side = 'test') "
    f"unpivot (category for feature in ({', '.join(MODEL_FEATURES)}))), "
    "phis as (select t.respondent_id, t.feature, t.category, mo.model, coalesce(w.w, 0.0) as w, "
    "coalesce(w.w, 0.0) - mo.m as phi from tst_long t join means mo on mo.feature = t.feature "
    "left join wts w on w.model = mo.model and w.feature = t.feature and w.category = t.category)")

ATTR_SQL = "select respondent_id, feature, category, phi from phis where model = 'model_a'"
GLOBAL_SQL = (
    "select feature, avg(abs(phi)) as mean_abs_phi, avg(phi) as mean_phi, "
    "avg(abs(phi)) / sum(avg(abs(phi))) over () as importance_share, "
    "cast(row_number() over (order by avg(abs(phi)) desc, feature) as integer) as rank from phis where model = 'model_a' "
    "group by feature")
_POS = "case " + " ".join(f"when feature = '{f}' then {i}" for i, f in enumerate(MODEL_FEATURES)) + " end"
_LAB = "case " + " ".join(f"when feature = '{f}' then {sql_str(v)}" for f, v in FEATURE_LABELS.items()) \
    + " else feature end"
TOP_SQL = (
    "select respondent_id, cast(factor_rank as integer) as factor_rank, source_feature, profile_value, phi, direction, "
    "printf('%s = %s %s the estimate', lab, profile_value, direction) as explanation_text from "
    f"(select respondent_id, feature as source_feature, category as profile_value, phi, {_LAB} as lab, "
    "case when phi > 0 then 'raises' when phi < 0 then 'lowers' else 'does not change' end as direction, "
    f"row_number() over (partition by respondent_id order by abs(phi) desc, {_POS}) as factor_rank "
    "from phis where model = 'model_a') where factor_rank <= 5")
SCORES_CTE = KX_CTE + (
    ", raws as (select p.respondent_id, p.model, min(b.bias) + sum(p.w) as raw_score from phis p "
    "join (select distinct model, bias from wts) b using (model) group by p.respondent_id, p.model), "
    "scores as (select r.*, 1.0 / (1.0 + exp(-raw_score)) as probability, bs.base from raws r join base bs using (model))")
EXEMPLAR_SQL = (
    "select 'lowest' as exemplar, arg_min(respondent_id, (probability, respondent_id)) as respondent_id "
    "from scores where model = 'model_a' union all select 'closest_to_half', arg_min(respondent_id, "
    "(abs(probability - 0.5), respondent_id)) from scores where model = 'model_a' union all select 'highest', "
    "arg_min(respondent_id, (-probability, respondent_id)) from scores where model = 'model_a'")

_FAULT = h8d("concat('fault|', cast(respondent_id as varchar))") + " % 200"
def _allowed_sql(f, values):
    vals = ", ".join(sql_str(v) for v in values)
    return (f"select respondent_id, '{f}' as field, 'Field required' as message, 'missing' as type from prof "
            f"where {f} is null or trim({f}) = '' union all select respondent_id, '{f}', "
            f"'Input should be one of the allowed categories', 'enum' from prof where {f} is not null and "
            f"trim({f}) <> '' and trim({f}) not in ({vals})")


PROF_CTE = SPLIT_CTE + (
    f", prof as (select respondent_id, age_group, inc_q, internet_use, con1, phone_access_tier, "
    f"case when {_FAULT} = 0 then 'Unknown' else female end as female, "
    f"case when {_FAULT} = 1 then '' else educ end as educ, "
    f"case when {_FAULT} = 2 then 'A smartphone' else con9 end as con9, "
    f"case when {_FAULT} = 3 then {sql_str(OFFLINE)} else internet_engagement_level end as internet_engagement_level "
    "from der)")
VALIDATE_SQL = (" union all ".join(_allowed_sql(f, v) for f, v in ALLOWED.items())
                + f" union all select respondent_id, 'internet_engagement_level', 'Non-users must have the no-use "
                  f"engagement state and vice versa', 'value_error' from prof where (internet_use = "
                  f"{sql_str(fx.COMBINED_NO)}) <> (internet_engagement_level = {sql_str(OFFLINE)})"
                + f" union all select respondent_id, 'con9', 'Respondents without a phone must have phone fields "
                  f"skipped', 'value_error' from prof where con1 = 'No' and con9 <> {sql_str(fx.NOT_APPLICABLE)}")
BATCH_CTE = KX_CTE + PROF_CTE[len(SPLIT_CTE):] + (
    ", bad as (select distinct respondent_id from (" + VALIDATE_SQL + ")), "
    "okp as (select p.* from prof p where respondent_id not in (select respondent_id from bad)), "
    "okl as (select respondent_id, feature, category from okp unpivot (category for feature in ("
    + ", ".join(MODEL_FEATURES) + "))), "
    "okw as (select o.respondent_id, mo.model, coalesce(w.w, 0.0) as w from okl o join means mo on "
    "mo.feature = o.feature left join wts w on w.model = mo.model and w.feature = o.feature and "
    "w.category = o.category), "
    "braw as (select respondent_id, model, min(b.bias) + sum(w) as raw_score from okw join (select distinct model, "
    "bias from wts) b using (model) group by respondent_id, model)")
BATCH_SQL = (
    "select r.respondent_id, r.model, r.raw_score, 1.0 / (1.0 + exp(-r.raw_score)) as probability, "
    "cast(1.0 / (1.0 + exp(-r.raw_score)) >= 0.5 as integer) as prediction, case when 1.0 / (1.0 + "
    "exp(-r.raw_score)) >= 0.5 then 'More likely than not' else 'Less likely than not' end as statement, "
    "1.0 / (1.0 + exp(-bs.base)) as baseline_probability from braw r join base bs using (model)")
SCORE_DOUBLES = ("raw_score", "probability", "baseline_probability")

UNSEEN_SQL = (
    "select respondent_id, model, feature, category as value from (select p.*, m.model from prof p cross join "
    f"(values {', '.join(f'({sql_str(m)})' for m in MODELS)}) m(model)) unpivot (category for feature "
    f"in ({', '.join(MODEL_FEATURES)})) t where not exists (select 1 from trn_long l where l.feature = t.feature "
    "and l.category = t.category)")

QUERIES = [
    Query("linear_attribution", "K1,K2,K4", q_attr, ATTR_SQL, ("phi",), ctes=KX_CTE),
    Query("global_importance", "K5", q_global, GLOBAL_SQL, ("mean_abs_phi", "mean_phi", "importance_share"),
          ctes=KX_CTE),
    Query("top_factors", "K7", q_top, TOP_SQL, ("phi",), ctes=KX_CTE),
    Query("exemplars", "K8,K10", q_exemplars, EXEMPLAR_SQL, ctes=SCORES_CTE),
    Query("additivity_audit", "K9", q_additivity,
          "select max(abs(r.raw_score - (s.base + r.sphi))) as max_raw_error, max(abs(1.0 / (1.0 + exp(-r.raw_score)) "
          "- 1.0 / (1.0 + exp(-(s.base + r.sphi))))) as max_probability_error, "
          "max(abs(r.raw_score - (s.base + r.sphi))) <= 1e-8 as passed from (select p.respondent_id, "
          "min(b.bias) + sum(p.w) as raw_score, sum(p.phi) as sphi from phis p join (select distinct model, bias "
          "from wts) b using (model) where p.model = 'model_a' group by p.respondent_id) r cross join "
          "(select base from base where model = 'model_a') s",
          ("max_raw_error", "max_probability_error"), ctes=SCORES_CTE),
    Query("validate_profiles", "L1,L2", q_validate, VALIDATE_SQL, ctes=PROF_CTE),
    Query("batch_scoring", "L3,L5,K10", q_batch, BATCH_SQL, SCORE_DOUBLES, ctes=BATCH_CTE),
    Query("unseen_warnings", "L4", q_unseen, UNSEEN_SQL, ctes=KX_CTE + PROF_CTE[len(SPLIT_CTE):]),
    Query("stream_scoring", "L6", q_stream, BATCH_SQL, SCORE_DOUBLES, ctes=BATCH_CTE),
    Query("fitted_scoring", "L3,K2", _fitted_scores),
    Query("fitted_additivity", "K9", q_fitted_additivity,
          f"select m.model, count(*) as rows, true as passed from (values {', '.join(f'({sql_str(m)})' for m in FITTED)}) m(model) "
          "cross join prof where respondent_id not in (select respondent_id from (" + VALIDATE_SQL + ")) group by m.model",
          ctes=PROF_CTE),
    Query("stream_rejected", "L6", q_stream_rejected, VALIDATE_SQL, ctes=PROF_CTE),
    Query("response_records", "L5", q_responses),
]
