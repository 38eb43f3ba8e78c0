"""C/D-family queries: catalogue classification, eligibility, dictionary, code maps, recode reports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from tabulon.functions.exprs import h8, sql_str
from tabulon.operators import clean as D
from tabulon.operators import codebook as C
from tabulon.operators import dictionary as N
from tabulon.operators import profile as B
from tabulon.plans.base import Query, values_sql
from tabulon.plans.q_profile import PROFILE_CTE, RAW_COLS, VF_CTE
from tabulon.session import materialize, shared_scratch, written
from tabulon.sources import fixtures as fx
from tabulon.sources.tables import table

# ---------------------------------------------------------------------------
# Variable sets and rule tables of the fixture catalogue (parameters)
# ---------------------------------------------------------------------------
OUTCOMES = ["y_a", "y_b"]
PARALLEL = {"y_a": "y_b", "y_b": "y_a"}
SETS = {
    "targets": ["y_a", "y_b"], "metadata": ["wgt", "region"], "identifiers": ["respondent_id"],
    "demographic": ["female", "age"], "socioeconomic": ["educ", "inc_q", "segment"], "identity": [],
    "constructed": ["age_group"], "post_digital": [], "non_capacity": [], "redundant": [],
}
CORE = {"y_a": ["female", "age", "educ", "inc_q", "internet_use"], "y_b": ["female", "age", "educ", "inc_q", "con1"]}
CONDITIONAL = {"y_a": ["con1", "con9"], "y_b": ["con9", "internet_use"]}
DIRECT = {"y_a": [], "y_b": []}
OTHER_SCOPE = {o: sorted({v for p in OUTCOMES if p != o for v in CORE[p] + CONDITIONAL[p]}) for o in OUTCOMES}
LABELS = {"respondent_id": "Respondent identifier", "wgt": "Survey weight", "age": "Respondent age",
          "female": "Respondent is female", "educ": "Education level", "inc_q": "Within-economy income quintile",
          "internet_use": "Used the internet recently", "con1": "Owns a mobile phone", "con9": "Type of phone",
          "y_a": "Outcome A", "y_b": "Outcome B"}
DOCUMENTED = {
    "female": [{"value": "1", "label": "Female"}, {"value": "2", "label": "Male"}],
    "educ": [{"value": "1", "label": "Primary education or less"}, {"value": "2", "label": "Secondary education"},
             {"value": "3", "label": "Tertiary education or more"}, {"value": "sysmiss", "label": "System missing"}],
    "internet_use": [{"value": "1", "label": "Yes"}, {"value": "", "label": "No/DK/Ref"}],
    "con1": [{"value": "1", "label": "Yes"}, {"value": "2", "label": "No"}, {"value": "9", "label": "Refused"}],
    "con9": [{"value": "1", "label": "A smartphone"}, {"value": "2", "label": "A basic text phone"},
             {"value": "8", "label": "Don't know"}],
    "inc_q": [],
}
FALLBACK = {"inc_q": {str(k): f"Income quintile {k}" for k in range(1, 6)}}
#: Codebook entries (label, definition) of variables, some of which have no label of their own.
CODEBOOK = {"segment": ("Market segment", "Segment the customer belongs to."), "region": ("Region", ""), "age": ("Age in years", "Age at the interview."),
            "con9": ("", "Kind of phone, if any.")}
MODE_COLS = ["educ", "con9", "segment"]
SPECIAL_LABELS = (fx.NOT_APPLICABLE, fx.CORE_MISSING, fx.NONRESPONSE, fx.COMBINED_NO)

CATEGORY_RULES = [
    ({"name_in": SETS["targets"]}, "TARGET"), ({"name_in": SETS["metadata"]}, "METADATA"),
    ({"name_in": SETS["identifiers"]}, "IDENTIFIER"), ({"name_in": SETS["demographic"]}, "DEMOGRAPHIC"),
    ({"name_in": SETS["socioeconomic"]}, "SOCIOECONOMIC"), ({"name_in": SETS["identity"]}, "IDENTITY"),
    ({"any": [{"name_in": ["internet_use"]}, {"name_prefix": "con"}]}, "DIGITAL"),
]
ORIGIN_RULES = [
    ({"name_in": SETS["constructed"]}, "CONSTRUCTED"),
    ({"name_in": SETS["metadata"] + SETS["identifiers"]}, "FILE_METADATA"),
    ({"name_in": SETS["demographic"] + ["educ", "inc_q"]}, "RESPONDENT_PROFILE"),
]
LEAKAGE_RULES = [
    ({"name_eq_col": "outcome"}, ("TARGET", "This is what the model predicts.")),
    ({"name_eq_col": "parallel_outcome"}, ("HIGH", "Other outcome of the same survey, known only together with the target.")),
    ({"name_in_by": {"col": "outcome", "sets": DIRECT}}, ("DIRECT", "Part of the target, or enough to rebuild it.")),
    ({"name_in": SETS["post_digital"]}, ("MODERATE", "Describes use that can start after the outcome.")),
    ({"name_in": SETS["non_capacity"]}, ("MODERATE", "Records what people do now rather than what they could reach before.")),
    ({"col_eq": {"category": "FINANCIAL"}}, ("HIGH", "Money matters asked about for the same period as the outcome.")),
    ({"col_in": {"category": ["DEMOGRAPHIC", "SOCIOECONOMIC", "DIGITAL", "IDENTITY"]}},
     ("LOW", "Who the respondent is; known before the outcome.")),
]
LEAKAGE_DEFAULT = ("NONE", "Carries nothing about the outcome.")
ELIGIBILITY_RULES = [
    ({"name_eq_col": "outcome"}, ("TARGET", "NOT_APPLICABLE", "The target cannot be a feature.")),
    ({"name_eq_col": "parallel_outcome"}, ("EXCLUDE_PARALLEL_OUTCOME", "NO", "See the leakage basis.")),
    ({"name_in": SETS["identifiers"]}, ("EXCLUDE_IDENTIFIER", "NO", "Only names a row.")),
    ({"name_in": SETS["metadata"]}, ("EXCLUDE_METADATA", "NO", "Describes the sample, not the respondent.")),
    ({"col_ge": {"missing_pct": 100}}, ("EXCLUDE_ALL_MISSING", "NO", "The column is empty.")),
    ({"col_le": {"unique_count": 1}}, ("EXCLUDE_NO_VARIANCE", "NO", "One value at most.")),
    ({"name_in_by": {"col": "outcome", "sets": CORE}}, ("CANDIDATE_CORE", "YES", "Known before the outcome and asked of everyone.")),
    ({"name_in_by": {"col": "outcome", "sets": CONDITIONAL}},
     ("CANDIDATE_CONDITIONAL", "CONDITIONAL", "Usable once skipped questions have their own state.")),
    ({"name_in_by": {"col": "outcome", "sets": OTHER_SCOPE}},
     ("EXCLUDE_MODEL_SCOPE", "CONDITIONAL", "Belongs to the other model.")),
    ({"name_in": SETS["redundant"]}, ("EXCLUDE_REDUNDANT", "YES", "A complete indicator already holds it.")),
    ({"col_ge": {"missing_pct": 50}}, ("EXCLUDE_HIGH_MISSING", "CONDITIONAL", "Half of the rows or more are blank.")),
    ({"name_in": SETS["post_digital"]}, ("EXCLUDE_POST_OUTCOME", "NO", "See the leakage basis.")),
    ({"name_in": SETS["non_capacity"]}, ("EXCLUDE_CONCEPTUAL", "CONDITIONAL", "See the leakage basis.")),
    ({"col_eq": {"risk": "DIRECT"}}, ("EXCLUDE_DIRECT_LEAKAGE", "NO", "See the leakage basis.")),
    ({"any": [{"col_eq": {"category": "FINANCIAL"}}, {"col_eq": {"risk": "HIGH"}}]},
     ("EXCLUDE_POST_OUTCOME", "NO", "See the leakage basis.")),
]
#: Statuses whose reason is the basis of the leakage rating.
BASIS_STATUSES = ("EXCLUDE_PARALLEL_OUTCOME", "EXCLUDE_POST_OUTCOME", "EXCLUDE_CONCEPTUAL", "EXCLUDE_DIRECT_LEAKAGE")
ELIGIBILITY_DEFAULT = ("EXCLUDE_NOT_ELIGIBLE", "CONDITIONAL", "No rule selects it.")


def catalogue(spark, d):
    """One row per variable of the raw survey view: profile + C3/C4/C5 classes."""
    prof = B.column_profile(B.value_frequency(fx.raw_text(spark, d)), top_k=0) \
        .withColumnRenamed("column", "variable")
    return C.classify(prof, {"category": (CATEGORY_RULES, "FINANCIAL"), "origin": (ORIGIN_RULES, "QUESTIONNAIRE")}) \
        .withColumn("band", B.missingness_band(F.col("missing_pct")))


def ratings(spark, d):
    """C6 + C7 per (variable, outcome): outcome list expanded with explode (bounded, no join)."""
    cat = catalogue(spark, d)
    par = F.create_map(*[x for k, v in PARALLEL.items() for x in (F.lit(k), F.lit(v))])
    out = C.classify(cat, {}, per={"outcome": OUTCOMES}).withColumn("parallel_outcome", par[F.col("outcome")])
    out = out.withColumn("__leak", C.compile_rules(LEAKAGE_RULES, LEAKAGE_DEFAULT)) \
        .withColumn("risk", F.col("__leak._0")).withColumn("basis", F.col("__leak._1"))
    out = out.withColumn("__el", C.compile_rules(ELIGIBILITY_RULES, ELIGIBILITY_DEFAULT))
    return out.select("position", "variable", "outcome", "category", "origin", "band", "missing_pct",
                      "unique_count", "risk", "basis", F.col("__el._0").alias("status"),
                      F.col("__el._1").alias("available"),
                      F.when(F.col("__el._0").isin(*BASIS_STATUSES), F.col("basis"))
                      .otherwise(F.col("__el._2")).alias("reason"))


def documented_codes(spark, d):
    codes = spark.createDataFrame([(k, json.dumps(v)) for k, v in DOCUMENTED.items()],
                                  "variable string, codes_json string")
    # Repair the blank-valued combined code where '0' is observed in the data
    zero = B.value_frequency(fx.raw_text(spark, d)).filter(F.col("value") == "0") \
        .select(F.col("column").alias("variable"), F.lit(True).alias("__zero"))
    repaired = codes.join(zero, "variable", "left").withColumn(
        "codes_json", F.to_json(C.repair_documented_codes(F.from_json("codes_json", D.CODES_SCHEMA),
                                                          F.coalesce(F.col("__zero"), F.lit(False)))))
    fb = spark.createDataFrame([(v, k, lab) for v, m in FALLBACK.items() for k, lab in m.items()],
                               "variable string, raw_value string, cleaned_label string")
    return D.require_code_maps([*DOCUMENTED, *FALLBACK], D.code_map(D.documented_code_map(repaired), fb))


def q_dictionary(spark, d):
    r = ratings(spark, d)
    st = r.groupBy("variable").pivot("outcome", OUTCOMES).agg(F.first("status"))
    st = st.select("variable", *[F.col(o).alias(f"status_{o}") for o in OUTCOMES])
    cat = catalogue(spark, d)
    cm = documented_codes(spark, d).groupBy("variable").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "raw_value", "cleaned_label"))), "|")
        .alias("documented_codes"))
    lab = spark.createDataFrame(list(LABELS.items()), "variable string, __label string")
    tags = F.array_join(F.array_distinct(F.array_compact(F.array(
        F.when(F.col("category") == "TARGET", "target"), F.when(F.col("band") != "NONE", "has_missing"),
        F.when(F.col("inferred_type").isin("integer", "float"), "numeric"),
        F.when(F.col("is_constant_non_missing"), "constant"), F.when(F.col("documented_codes").isNotNull(), "coded"),
        F.when(F.col("origin") == "FILE_METADATA", "metadata")))), ";")
    j = cat.join(F.broadcast(lab), "variable", "left").join(cm, "variable", "left").join(st, "variable", "left")
    return j.select("position", "variable", F.coalesce("__label", "variable").alias("label"), "inferred_type",
                    "missing_pct", "band", "category", "origin", "documented_codes", tags.alias("tags"),
                    *[f"status_{o}" for o in OUTCOMES])


def q_strict(spark, d):
    """C9 whole: every part must know every variable; label falls back to the codebook, then to the name."""
    vf = materialize(B.value_frequency(fx.raw_text(spark, d)))
    r = materialize(ratings(spark, d))
    per = r.groupBy("variable").pivot("outcome", OUTCOMES).agg(*[F.first(c).alias(c) for c in ("status", "available", "risk", "reason")])
    per = per.select("variable", *[F.col(f"{o}_{c}").alias(f"{c}_{o}") for o in OUTCOMES for c in ("status", "available", "risk", "reason")])
    names = spark.createDataFrame([(c, LABELS.get(c), CODEBOOK.get(c, ("", ""))[0], CODEBOOK.get(c, ("", ""))[1]) for c in RAW_COLS],
                                  "variable string, __label string, __codebook_label string, definition string")
    codes = documented_codes(spark, d).groupBy("variable").agg(F.array_sort(F.collect_list(
        F.struct(F.col("raw_value").alias("value"), F.col("source_label").alias("label")))).alias("codes"))
    codes = names.select("variable").join(codes, "variable", "left")  # a variable without codes has none: defined, not unmatched
    j = N.strict_parts({"catalogue": catalogue(spark, d), "codebook": names, "codes": codes, "observed": N.observed_counts(vf), "ratings": per})
    label = F.coalesce(F.nullif(F.col("__label"), F.lit("")), F.nullif(F.col("__codebook_label"), F.lit("")), F.col("variable"))
    text = F.coalesce(F.array_join(F.transform("codes", lambda c: F.concat_ws("=", c["value"], c["label"])), "|"), F.lit(""))
    return j.select("position", "variable", label.alias("label"), "definition", text.alias("documented_codes"),
                    F.coalesce(N.special_codes(F.col("codes")), F.lit("")).alias("special_codes"), "observed_values", "observed_digest",
                    "inferred_type", "unique_count", F.col("non_missing_count").alias("valid_count"), "missing_count", "missing_pct", "band", "category", "origin",
                    N.tags(OUTCOMES).alias("tags"), *[f"{c}_{o}" for o in OUTCOMES for c in ("status", "available", "risk", "reason")])


def q_modes(spark, d):
    """Modes learned from the training rows of the raw text (blank is missing), saved, loaded, and applied to all rows."""
    from pyspark.ml import Pipeline, PipelineModel
    from tabulon.operators.impute import ModeImputer
    raw = fx.raw_text(spark, d).select("respondent_id", *MODE_COLS)
    side = h8(F.concat(F.lit("mode|"), F.col("respondent_id"))) % 5
    fitted = Pipeline(stages=[ModeImputer(inputCols=MODE_COLS, outputCols=[f"{c}_full" for c in MODE_COLS], blanks=[""])]).fit(raw.where(side > 0))
    path = shared_scratch(spark, f"models/{uuid.uuid4().hex}")
    fitted.write().save(path)
    full = PipelineModel.load(path).transform(raw)
    long = full.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_full").alias("value"), (F.col(c) == "").alias("imputed")) for c in MODE_COLS])).alias("x"))
    return long.groupBy("x.column", "x.value").agg(F.count("*").alias("n"), F.count_if("x.imputed").alias("imputed"))


def q_categories(spark, d):
    """D9 as rows: every value of every text column that is no key, with its count; no column is gathered in one place."""
    clean = fx.clean_survey(spark, d)
    cols = [f.name for f in clean.schema.fields if f.dataType.simpleString() == "string"]
    long = clean.select(*cols).unpivot([], cols, "column", "value")
    return long.where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))


def q_contract(spark, d):
    approved = C.candidates(ratings(spark, d).filter(F.col("outcome") == "y_a"), "status") \
        .select(F.col("variable").alias("feature"))
    configured = spark.createDataFrame([(f,) for f in ["female", "age", "educ", "inc_q", "internet_use", "con1",
                                                        "segment"]], "feature string")
    return C.contract_drift(approved, configured)


def q_sections(spark, d):
    lines = C.split_lines(table(spark, d, "documents"), "doc_id", "text")
    words = F.size(F.split(F.trim(F.col("line")), " "))
    is_key = (F.trim(F.col("line")) != "") & (words <= 2)
    return C.carry_forward_sections(lines, "doc_id", is_key, F.trim(F.col("line")))


def recode_survey(spark, d):
    cleaned = D.recode_categoricals(fx.raw_survey(spark, d), fx.CODE_MAPS, core=fx.CORE_FIELDS,
                                    routed=fx.ROUTED_FIELDS)
    return cleaned.select("respondent_id", *fx.CODE_MAPS)


def q_unknown(spark, d):
    maps = dict(fx.CODE_MAPS)
    maps["con1"] = {k: v for k, v in maps["con1"].items() if k != "9"}  # draft map without the nonresponse code
    raw = fx.raw_survey(spark, d)
    q = D.recode_categoricals(raw, maps, core=fx.CORE_FIELDS, routed=fx.ROUTED_FIELDS, strict=False)
    flagged = q.select("respondent_id", *[F.col(c).isNull().alias(c) for c in maps]) \
        .join(raw.select("respondent_id", *[F.col(c).alias(f"__raw_{c}") for c in maps]), "respondent_id")
    long = flagged.select(F.explode(F.array(*[F.when(F.col(c), F.struct(F.lit(c).alias("variable"),
                                                                         F.col(f"__raw_{c}").alias("code")))
                                                for c in maps])).alias("u")).filter(F.col("u").isNotNull())
    return long.groupBy("u.variable", "u.code").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def q_mapping(spark, d):
    return D.mapping_report(documented_codes(spark, d), B.value_frequency(fx.raw_text(spark, d)))


def q_processed_schema(spark, d):
    return D.processed_schema(fx.clean_survey(spark, d), {"respondent_id": "key", "wgt": "weight",
                                                         "y_a": "target", "y_b": "target"})


def q_semantic(spark, d):
    clean = fx.clean_survey(spark, d)
    cols = ["female", "educ", "inc_q", "internet_use", "con1", "con9"]
    return D.semantic_states(B.value_frequency(clean.select(*cols), trim=False), SPECIAL_LABELS)


def q_prep(spark, d):
    from pyspark.ml.functions import vector_to_array
    from tabulon.plans.q_features import MODEL_FEATURES, split_frame
    survey = fx.written_survey(spark, d)
    # two tables of all rows: from its size on disk Spark would take a narrow one for small and gather it on the driver
    ages = survey.select("respondent_id", "age").hint("merge")
    # each stage of the template is fitted in a pass of its own
    df = written(split_frame(spark, d, survey).join(ages, "respondent_id"), "template")
    pipe = D.prep_template(["age"], [c for c in MODEL_FEATURES if c != "age_group"])
    model = pipe.fit(df.filter(F.col("side") == "train"))
    out = model.transform(df)
    arr = vector_to_array("features")
    return out.select("respondent_id", "side", F.size(arr).alias("width"), arr[0].alias("age_scaled"))


# ----------------------------------------------------------------- oracle text
def cond_sql(spec, name="variable") -> str:
    parts = []
    for key, arg in spec.items():
        if key == "name_in":
            parts.append(f"{name} in ({', '.join(sql_str(v) for v in arg)})" if arg else "false")
        elif key == "name_prefix":
            parts.append(f"starts_with({name}, {sql_str(arg)})")
        elif key == "name_eq_col":
            parts.append(f"{name} = {arg}")
        elif key == "col_eq":
            parts += [f"{c} = {sql_str(v)}" for c, v in arg.items()]
        elif key == "col_in":
            parts += [f"{c} in ({', '.join(sql_str(x) for x in v)})" for c, v in arg.items()]
        elif key == "col_ge":
            parts += [f"{c} >= {v}" for c, v in arg.items()]
        elif key == "col_le":
            parts += [f"{c} <= {v}" for c, v in arg.items()]
        elif key == "name_in_by":
            ors = [f"({arg['col']} = {sql_str(k)} and " + (f"{name} in ({', '.join(sql_str(x) for x in v)})"
                                                         if v else "false") + ")" for k, v in arg["sets"].items()]
            parts.append("(" + " or ".join(ors) + ")")
        elif key == "any":
            parts.append("(" + " or ".join(cond_sql(c, name) for c in arg) + ")")
        else:
            raise ValueError(key)
    return "(" + " and ".join(parts) + ")" if parts else "true"


def rules_sql(rules, default, idx=None) -> str:
    def val(v):
        v = v[idx] if idx is not None else v
        return sql_str(v)
    d = default[idx] if (idx is not None and default is not None) else default
    return ("case " + " ".join(f"when {cond_sql(c)} then {val(r)}" for c, r in rules)
            + (f" else {sql_str(d)}" if d is not None else "") + " end")


BAND_SQL = ("case when missing_pct = 100 then 'ALL_MISSING' when missing_pct >= 75 then 'HIGH_75_PLUS' "
            "when missing_pct >= 50 then 'HIGH_50_TO_74' when missing_pct >= 25 then 'MODERATE_25_TO_49' "
            "when missing_pct > 0 then 'LOW_UNDER_25' else 'NONE' end")
CAT_CTE = PROFILE_CTE + (
    ", cat0 as (select \"column\" as variable, * exclude (\"column\") from prof), "
    f"cat as (select *, {rules_sql(CATEGORY_RULES, 'FINANCIAL')} as category, "
    f"{rules_sql(ORIGIN_RULES, 'QUESTIONNAIRE')} as origin, {BAND_SQL} as band from cat0), "
    "rat0 as (select c.*, o.outcome, o.parallel_outcome from cat c cross join "
    f"{values_sql(list(PARALLEL.items()), ['outcome', 'parallel_outcome'])} o), "
    f"rat1 as (select *, {rules_sql(LEAKAGE_RULES, LEAKAGE_DEFAULT, 0)} as risk, "
    f"{rules_sql(LEAKAGE_RULES, LEAKAGE_DEFAULT, 1)} as basis from rat0), "
    f"rat as (select position, variable, outcome, category, origin, band, missing_pct, unique_count, risk, basis, "
    f"{rules_sql(ELIGIBILITY_RULES, ELIGIBILITY_DEFAULT, 0)} as status, "
    f"{rules_sql(ELIGIBILITY_RULES, ELIGIBILITY_DEFAULT, 1)} as available, "
    f"case when {rules_sql(ELIGIBILITY_RULES, ELIGIBILITY_DEFAULT, 0)} in ({', '.join(sql_str(x) for x in BASIS_STATUSES)}) then basis "
    f"else {rules_sql(ELIGIBILITY_RULES, ELIGIBILITY_DEFAULT, 2)} end as reason from rat1)")


def _code_rows():
    rows = []
    for var, codes in DOCUMENTED.items():
        if var in FALLBACK:
            continue
        for c in codes:
            rows.append((var, c["value"], c["label"]))
    return rows


CODES_CTE = (
    f"dc0 as (select * from {values_sql(_code_rows(), ['variable', 'value', 'label'])}), "
    "zero as (select distinct \"column\" as variable from vf where value = '0'), "
    "dc1 as (select d.variable, case when trim(d.value) = '' and d.label = 'No/DK/Ref' and z.variable is not null "
    "then '0' else trim(d.value) end as raw_value, trim(d.label) as source_label from dc0 d "
    "left join zero z using (variable)), "
    "dc as (select variable, raw_value, source_label, case when lower(source_label) = 'no/dk/ref' then "
    f"{sql_str(fx.COMBINED_NO)} when contains(lower(source_label), 'don''t know') or contains(lower(source_label), "
    "'dont know') or contains(lower(source_label), 'refused') then 'Nonresponse' when source_label <> '' then "
    "source_label else 'Code ' || raw_value end as cleaned_label, 'documented code' as mapping_basis from dc1 "
    "where raw_value <> '' and lower(raw_value) <> 'sysmiss'), "
    "cmap as (select * from dc union all select variable, raw_value, 'documented range; neutral project label', "
    "cleaned_label, 'documented range' from "
    f"{values_sql([(v, k, lab) for v, m in FALLBACK.items() for k, lab in m.items()], ['variable', 'raw_value', 'cleaned_label'])})")

DICT_SQL = (
    "select c.position, c.variable, coalesce(l.label, c.variable) as label, c.inferred_type, c.missing_pct, c.band, "
    "c.category, c.origin, m.documented_codes, array_to_string((list_filter([case when c.category = "
    "'TARGET' then 'target' end, case when c.band <> 'NONE' then 'has_missing' end, case when c.inferred_type in "
    "('integer', 'float') then 'numeric' end, case when c.is_constant_non_missing then 'constant' end, case when "
    "m.documented_codes is not null then 'coded' end, case when c.origin = 'FILE_METADATA' then 'metadata' end], "
    "lambda x: x is not null)), ';') as tags, "
    + ", ".join(f"(select status from rat r where r.variable = c.variable and r.outcome = '{o}') as status_{o}"
                for o in OUTCOMES)
    + f" from cat c left join {values_sql(list(LABELS.items()), ['variable', 'label'])} l using (variable) "
    "left join (select variable, string_agg(raw_value || '=' || cleaned_label, '|' order by raw_value || '=' || "
    "cleaned_label) as documented_codes from cmap group by variable) m using (variable)")

STRICT_SQL = (
    "select c.position, c.variable, coalesce(nullif(n.l, ''), nullif(n.cl, ''), c.variable) as label, n.def as definition, coalesce(m.codes, '') as documented_codes, "
    "coalesce(m.special, '') as special_codes, o.k as observed_values, o.digest as observed_digest, c.inferred_type, c.unique_count, c.non_missing_count as valid_count, "
    "c.missing_count, c.missing_pct, c.band, c.category, c.origin, array_to_string(list_filter([c.category, case when c.origin = 'CONSTRUCTED' then 'CONSTRUCTED' end, "
    "case when c.missing_pct >= 50 then 'HIGH_MISSING' end, case when c.missing_pct = 100 then 'ALL_MISSING' end, case when c.unique_count <= 1 then 'LOW_VARIANCE' end, "
    + ", ".join(f"case when starts_with(r{i}.status, 'CANDIDATE') then 'CANDIDATE_MODEL_{i}' end" for i in (1, 2))
    + ", case when r1.risk in ('DIRECT', 'HIGH') or r2.risk in ('DIRECT', 'HIGH') then 'POSSIBLE_LEAKAGE' end, "
    "case when starts_with(r1.status, 'EXCLUDE') and starts_with(r2.status, 'EXCLUDE') then 'EXCLUDED' end], lambda x: x is not null), ';') as tags, "
    + ", ".join(f"r{i}.{c} as {c}_{o}" for i, o in enumerate(OUTCOMES, 1) for c in ("status", "available", "risk", "reason"))
    + " from cat c join " + values_sql([(c, LABELS.get(c, ""), *CODEBOOK.get(c, ("", ""))) for c in RAW_COLS], ["v", "l", "cl", "def"]) + " n on n.v = c.variable "
    + " ".join(f"join rat r{i} on r{i}.variable = c.variable and r{i}.outcome = '{o}'" for i, o in enumerate(OUTCOMES, 1))
    + " join (select \"column\" as variable, count(*) as k, cast(sum(cast(cast(('0x' || substr(md5(concat(value, '=', cast(n as varchar))), 1, 8)) as bigint) "
    "as decimal(38,0))) as varchar) as digest from vf group by 1) o on o.variable = c.variable "
    "left join (select variable, string_agg(raw_value || '=' || source_label, '|' order by raw_value, source_label) as codes, "
    "string_agg(raw_value, ';' order by raw_value, source_label) filter (where contains(lower(source_label), 'don''t know') or contains(lower(source_label), 'refused') "
    "or contains(lower(source_label), 'no/dk/ref')) as special from cmap group by variable) m on m.variable = c.variable")
MODE_SQL = (
    "with_side as (select *, cast(('0x' || substr(md5(concat('mode|', respondent_id)), 1, 8)) as bigint) % 5 as side from raw_text), "
    "ml as (select side, c as \"column\", v as value from with_side unpivot (v for c in (" + ", ".join(MODE_COLS) + "))), "
    "mm as (select \"column\", arg_min(value, (-n, value)) as mode from (select \"column\", value, count(*) as n from ml where side > 0 and value <> '' group by all) group by 1)")
CATEGORY_COLS = ["age_group", *fx.CODE_MAPS, *fx.PASSTHROUGH]
LINES_CTE = (
    "ln0 as (select doc_id, unnest(string_split(text, chr(10))) as line, "
    "unnest(range(1, len(string_split(text, chr(10))) + 1)) as line_no from documents), "
    "ln as (select *, case when trim(line) <> '' and len(string_split(trim(line), ' ')) <= 2 then trim(line) end "
    "as k from ln0)")
SECTIONS_SQL = ("select doc_id, cast(line_no as integer) as line_no, line, last_value(k ignore nulls) over (partition by doc_id order by "
                "line_no rows between unbounded preceding and current row) as section from ln")

WS = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}]+"
TEXT_SQL = ("select doc_id, trim(regexp_replace(translate(coalesce(text, ''), '‘’“”–—', '''''\"\"--'), "
            f"'{WS}', ' ', 'g')) as text from documents")

UNKNOWN_SQL = "select 'con1' as variable, con1 as code, count(*) as n from raw_survey where con1 = '9' group by con1"

RECODE_SQL = "select respondent_id, female, educ, inc_q, internet_use, con1, con9 from clean_survey"

_CLEAN_COLS = ["respondent_id", "wgt", "age", "age_group", "female", "educ", "inc_q", "internet_use", "con1",
               "con9", "segment", "region", "y_a", "y_b"]
_DTYPES = {"respondent_id": "bigint", "wgt": "double", "age": "int", "y_a": "int", "y_b": "int"}
_ROLES = {"respondent_id": "key", "wgt": "weight", "y_a": "target", "y_b": "target"}
SCHEMA_SQL = (
    "select m.position, m.\"column\", m.role, m.dtype, coalesce(a.null_count, 0) as null_count, a.distinct_count, "
    "case when m.dtype = 'string' and m.role <> 'key' then a.cats end as categories from "
    + values_sql([(i + 1, c, _ROLES.get(c, "feature"), _DTYPES.get(c, "string")) for i, c in enumerate(_CLEAN_COLS)],
                 ["position", "column", "role", "dtype"])
    + " m left join (select c as \"column\", cast(sum(n) filter (where v is null) as bigint) as null_count, "
    "count(*) as distinct_count, string_agg(v, '|' order by v) filter (where v is not null) as cats from "
    "(select c, v, count(*) as n from (select " + ", ".join(f"cast({c} as varchar) as {c}" for c in _CLEAN_COLS)
    + " from clean_survey) unpivot include nulls (v for c in (" + ", ".join(_CLEAN_COLS) + ")) group by c, v) "
    "group by c) a on a.\"column\" = m.\"column\"")

SEM_COLS = ["female", "educ", "inc_q", "internet_use", "con1", "con9"]
SEM_SQL = ("select c as \"column\", v as state, count(*) as n from (unpivot (select " + ", ".join(SEM_COLS)
           + " from clean_survey) on " + ", ".join(SEM_COLS) + " into name c value v) where v in ("
           + ", ".join(sql_str(x) for x in SPECIAL_LABELS) + ") group by c, v")

MAPPING_SQL = (
    "select m.variable, m.raw_value, m.source_label, m.cleaned_label, m.mapping_basis, "
    "coalesce(v.n, 0) as observed_count from cmap m left join vf v on v.\"column\" = m.variable and "
    "v.value = m.raw_value union all select x.variable, '<blank>', 'System missing / routed blank', "
    "'model-specific; see feature tier', 'routing-aware missingness policy', coalesce(v.n, 0) from "
    "(select distinct variable from cmap) x left join vf v on v.\"column\" = x.variable and v.value = ''")

CONTRACT_SQL = (
    "select coalesce(a.f, c.f) as feature, case when c.f is null then 'approved_not_configured' else "
    "'configured_not_approved' end as drift from (select distinct variable as f from rat where outcome = 'y_a' "
    "and starts_with(status, 'CANDIDATE')) a full outer join "
    + values_sql([(f,) for f in ["female", "age", "educ", "inc_q", "internet_use", "con1", "segment"]], ["f"])
    + " c on a.f = c.f where a.f is null or c.f is null")

QUERIES = [
    Query("text_normalise", "C1", lambda s, d: table(s, d, "documents").select(
        "doc_id", C.normalise_text("text").alias("text")), TEXT_SQL, survey=False),
    Query("section_carry_forward", "C2", q_sections, SECTIONS_SQL, survey=False, ctes=LINES_CTE),
    Query("variable_classes", "C3,C4,C5", lambda s, d: catalogue(s, d).select(
        "position", "variable", "category", "origin", "band"),
        "select position, variable, category, origin, band from cat", ctes=CAT_CTE),
    Query("leakage_ratings", "C6", lambda s, d: ratings(s, d).select("variable", "outcome", "risk", "basis"),
          "select variable, outcome, risk, basis from rat", ctes=CAT_CTE),
    Query("eligibility", "C7", lambda s, d: ratings(s, d).select("variable", "outcome", "status", "available",
                                                                 "reason"),
          "select variable, outcome, status, available, reason from rat", ctes=CAT_CTE),
    Query("status_counts", "C10", lambda s, d: C.status_counts(ratings(s, d), "status", ["outcome"]),
          "select outcome, status, count(*) as n from rat group by outcome, status", ctes=CAT_CTE),
    Query("candidates", "C11", lambda s, d: C.candidates(ratings(s, d), "status", columns=[
        "variable", "outcome", "status", "available", "missing_pct", "category"]),
        "select variable, outcome, status, available, missing_pct, category from rat "
        "where starts_with(status, 'CANDIDATE')", ("missing_pct",), ctes=CAT_CTE),
    Query("contract_drift", "C12", q_contract, CONTRACT_SQL, ctes=CAT_CTE),
    Query("documented_codes", "C8,D1,D2", documented_codes, "select * from cmap", ctes=VF_CTE + ", " + CODES_CTE),
    Query("dictionary", "C9", q_dictionary, DICT_SQL, ("missing_pct",), ctes=CAT_CTE + ", " + CODES_CTE),
    Query("recode_survey", "D3,D4,D5", recode_survey, RECODE_SQL),
    Query("unknown_codes", "D3", q_unknown, UNKNOWN_SQL),
    Query("mapping_report", "D8", q_mapping, MAPPING_SQL, ctes=VF_CTE + ", " + CODES_CTE),
    Query("processed_schema", "D9", q_processed_schema, SCHEMA_SQL),
    Query("semantic_states", "D10", q_semantic, SEM_SQL),
    Query("prep_template", "D11", q_prep),
    Query("dictionary_strict", "C9", q_strict, STRICT_SQL, ("missing_pct",), ctes=CAT_CTE + ", " + CODES_CTE),
    Query("mode_imputation", "D11", q_modes, "select l.\"column\", case when value = '' then mode else value end as value, count(*) as n, "
          "count(*) filter (where value = '') as imputed from ml l join mm using (\"column\") group by 1, 2", ctes=MODE_SQL),
    Query("category_values", "D9", q_categories, "select c as \"column\", v as value, count(*) as n from clean_survey unpivot (v for c in ("
          + ", ".join(CATEGORY_COLS) + ")) group by all"),
]
