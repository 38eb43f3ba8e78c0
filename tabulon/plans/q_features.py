"""G/H-family queries: bands, routed states, feature frame, grouped folds, split audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions.exprs import sql_str
from tabulon.operators import features as G
from tabulon.operators import splits as H
from tabulon.sources import fixtures as fx
from tabulon.plans.base import Query

# ---------------------------------------------------------------------------
# Derived-state labels of the fixture routing rules
# ---------------------------------------------------------------------------
PHONE_TYPE_MAP = {"A smartphone": "Smartphone", "A basic text phone": "Basic text phone",
                  fx.NONRESPONSE: "Phone type nonresponse"}
NO_PHONE, OWN_NR = "No personal mobile phone", "Phone ownership nonresponse"
OFFLINE = "No recent internet use / no-DK-ref"
ENGAGEMENT_MAP = {f"Income quintile {k}": f"Online, income quintile {k}" for k in range(1, 6)}
OFFLINE_SKIP = "No recent internet use / skipped"
ONLINE_NO_PHONE, ONLINE_OWN_NR = "Online without a phone", "Online, phone ownership nonresponse"
ONLINE_TYPE_MAP = {"A smartphone": "Online with a smartphone", "A basic text phone": "Online with a basic phone",
                   fx.NONRESPONSE: "Online, phone type nonresponse"}

MODEL_FEATURES = ["female", "age_group", "educ", "inc_q", "internet_use", "phone_access_tier"]
ENGINEERED = ["age_group", "phone_access_tier", "internet_engagement_level", "online_phone_pattern"]
TARGET = "y_a"


def phone_rules(with_nonresponse: bool = True):
    own = F.col("con1")
    type_map = PHONE_TYPE_MAP if with_nonresponse else {k: v for k, v in PHONE_TYPE_MAP.items()
                                                        if k != fx.NONRESPONSE}
    rules = [(own == "No", NO_PHONE)]
    if with_nonresponse:
        rules.append((own == fx.NONRESPONSE, OWN_NR))
    return rules + G.mapped_rules(own == "Yes", "con9", type_map)


def engagement_rules():
    net = F.col("internet_use")
    return [(net == fx.COMBINED_NO, OFFLINE)] + G.mapped_rules(net == "Yes", "inc_q", ENGAGEMENT_MAP)


def pattern_rules():
    net, own = F.col("internet_use"), F.col("con1")
    on = net == "Yes"
    return ([(net == fx.COMBINED_NO, OFFLINE_SKIP), (on & (own == "No"), ONLINE_NO_PHONE),
             (on & (own == fx.NONRESPONSE), ONLINE_OWN_NR)]
            + G.mapped_rules(on & (own == "Yes"), "con9", ONLINE_TYPE_MAP))


def derived(df):
    return G.derive_states(df, {
        "phone_access_tier": (phone_rules(), ["con1", "con9"]),
        "internet_engagement_level": (engagement_rules(), ["internet_use", "inc_q"]),
        "online_phone_pattern": (pattern_rules(), ["internet_use", "con1", "con9"]),
    })


def feature_frame(spark, d, survey=None):
    """Key + target + model features (sources replaced by derived states)."""
    return derived(fx.clean_survey(spark, d) if survey is None else survey).select("respondent_id", TARGET, *MODEL_FEATURES, "segment", "region")


def keyed(spark, d, survey=None):
    ff = feature_frame(spark, d, survey)
    return ff.withColumn("profile_key", H.profile_key(MODEL_FEATURES))


def split_frame(spark, d, survey=None):
    """The split survey rows; the survey, read for the profiles and for the rows, is a written table."""
    return H.holdout_split(keyed(spark, d, fx.written_survey(spark, d) if survey is None else survey), "profile_key", TARGET)


# ----------------------------------------------------------------- oracle text
def _case(rules_sql) -> str:
    return "case " + " ".join(f"when {c} then {sql_str(v)}" for c, v in rules_sql) + " end"


def _mapped_sql(gate: str, col: str, mapping) -> list:
    return [(f"{gate} and {col} = {sql_str(k)}", v) for k, v in mapping.items()]


PHONE_SQL = _case([("con1 = 'No'", NO_PHONE), (f"con1 = '{fx.NONRESPONSE}'", OWN_NR)]
                  + _mapped_sql("con1 = 'Yes'", "con9", PHONE_TYPE_MAP))
ENG_SQL = _case([(f"internet_use = {sql_str(fx.COMBINED_NO)}", OFFLINE)]
                + _mapped_sql("internet_use = 'Yes'", "inc_q", ENGAGEMENT_MAP))
PAT_SQL = _case([(f"internet_use = {sql_str(fx.COMBINED_NO)}", OFFLINE_SKIP),
                 ("internet_use = 'Yes' and con1 = 'No'", ONLINE_NO_PHONE),
                 (f"internet_use = 'Yes' and con1 = '{fx.NONRESPONSE}'", ONLINE_OWN_NR)]
                + _mapped_sql("internet_use = 'Yes' and con1 = 'Yes'", "con9", ONLINE_TYPE_MAP))
DRAFT_PHONE_SQL = _case([("con1 = 'No'", NO_PHONE)] + _mapped_sql(
    "con1 = 'Yes'", "con9", {k: v for k, v in PHONE_TYPE_MAP.items() if k != fx.NONRESPONSE}))


def h8d(e: str) -> str:
    return f"cast(('0x' || substr(md5({e}), 1, 8)) as bigint)"


KEY_SQL = "md5(concat(" + ", chr(31), ".join(f"coalesce(cast({f} as varchar), '\\N')" for f in MODEL_FEATURES) + "))"

FF_CTE = (
    f"der as (select *, {PHONE_SQL} as phone_access_tier, {ENG_SQL} as internet_engagement_level, "
    f"{PAT_SQL} as online_phone_pattern from clean_survey), "
    f"ff as (select respondent_id, {TARGET}, {', '.join(MODEL_FEATURES)}, segment, region from der), "
    f"kf as (select *, {KEY_SQL} as profile_key from ff)")


def fold_sql(src: str, salt: str, k: int, name: str, per_fold: int = 10) -> str:
    return (
        f"{name}_p as (select profile_key, count(*) as n, sum({TARGET}) as pos from {src} group by profile_key), "
        f"{name}_t as (select sum(n) as total from {name}_p), "
        f"{name}_q as (select p.*, p.n > t.total / {per_fold * k} as heavy, "
        f"case when p.pos * 2 >= p.n then 1 else 0 end as stratum from {name}_p p, {name}_t t), "
        f"{name}_h as (select profile_key, row_number() over (partition by stratum order by n desc, profile_key) - 1 "
        f"as r from {name}_q where heavy), "
        f"{name} as (select profile_key, cast(case when floor(r / {k}) % 2 = 0 then r % {k} else {k - 1} - r % {k} end "
        f"as integer) as fold from {name}_h union all select profile_key, "
        f"cast({h8d(f"concat('{salt}|', profile_key)")} % {k} as integer) as fold from {name}_q where not heavy)")


SPLIT_CTE = (
    FF_CTE + ", " + fold_sql("kf", "holdout", 5, "hf") + ", "
    "sides as (select kf.*, case when hf.fold = 0 then 'test' else 'train' end as side from kf "
    "join hf using (profile_key)), trn as (select * from sides where side = 'train'), "
    + fold_sql("trn", "cv", 5, "cf") + ", "
    "split as (select t.*, c.fold as cv_fold from trn t join cf c using (profile_key) "
    "union all select s.*, cast(null as integer) as cv_fold from sides s where side = 'test')")

SPLIT_AUDIT_SQL = (
    "select 'holdout' as split, count(*) filter (where side = 'train') as train_rows, "
    "count(*) filter (where side = 'test') as validation_rows, "
    f"sum({TARGET}) filter (where side = 'train') / count(*) filter (where side = 'train') as train_positive_rate, "
    f"sum({TARGET}) filter (where side = 'test') / count(*) filter (where side = 'test') as validation_positive_rate, "
    "(select count(*) from (select profile_key from split group by profile_key having count(distinct side) > 1)) "
    "as profile_overlap_count from split "
    "union all select 'cv' || cast(f.cv_fold as varchar), t.n - f.n, f.n, (t.p - f.p) / (t.n - f.n), f.p / f.n, "
    "coalesce(o.ov, 0) from (select cv_fold, count(*) as n, sum(" + TARGET + ") as p from split "
    "where side = 'train' group by cv_fold) f cross join (select count(*) as n, sum(" + TARGET + ") as p "
    "from split where side = 'train') t left join (select unnest(fs) as cv_fold, count(*) as ov from "
    "(select list(distinct cv_fold) as fs from split where side = 'train' group by profile_key) "
    "where len(fs) > 1 group by 1) o on o.cv_fold = f.cv_fold")

QUERIES = [
    Query("age_bands", "G1", lambda s, d: fx.raw_survey(s, d).select(
        "respondent_id", "age", G.band("age", fx.AGE_BANDS).alias("age_group")),
        "select respondent_id, age, age_group from clean_survey"),
    Query("routed_states", "G2,G3,G4", lambda s, d: derived(fx.clean_survey(s, d)).select(
        "respondent_id", "phone_access_tier", "internet_engagement_level", "online_phone_pattern"),
        "select respondent_id, phone_access_tier, internet_engagement_level, online_phone_pattern from der",
        ctes=FF_CTE),
    Query("unresolved_states", "G5", lambda s, d: G.unresolved_states(
        fx.clean_survey(s, d).withColumn("draft", G.route(phone_rules(with_nonresponse=False))), "draft",
        ["con1", "con9"]),
        f"select con1, con9, count(*) as n from clean_survey where ({DRAFT_PHONE_SQL}) is null group by con1, con9"),
    Query("feature_frame", "G6,D6,D7", feature_frame, "select * from ff", ctes=FF_CTE),
    Query("feature_distribution", "G7", lambda s, d: G.distribution(derived(fx.clean_survey(s, d)), ENGINEERED),
          "select feature, category, n, n / sum(n) over (partition by feature) as proportion from "
          "(select feature, category, count(*) as n from (unpivot (select " + ", ".join(ENGINEERED) + " from der) "
          "on " + ", ".join(ENGINEERED) + " into name feature value category) group by feature, category)",
          ("proportion",), ctes=FF_CTE),
    Query("profile_groups", "H1", lambda s, d: keyed(s, d).select("respondent_id", "profile_key"),
          "select respondent_id, profile_key from kf", ctes=FF_CTE),
    Query("group_folds", "H2,H3", lambda s, d: split_frame(s, d).select(
        "respondent_id", "profile_key", "side", "cv_fold"),
        "select respondent_id, profile_key, side, cv_fold from split", ctes=SPLIT_CTE),
    Query("split_audit", "H4", lambda s, d: H.split_audit(split_frame(s, d), "profile_key", TARGET),
          SPLIT_AUDIT_SQL, ("train_positive_rate", "validation_positive_rate"), ctes=SPLIT_CTE),
    Query("profile_summary", "H4", lambda s, d: H.profile_summary(keyed(s, d), "profile_key", TARGET),
          "select cast(sum(n) as bigint) as rows, count(*) as unique_profiles, cast(sum(n) - count(*) as bigint) "
          "as duplicate_rows, count(*) filter (where n > 1) as duplicate_groups, "
          "count(*) filter (where labels > 1) as conflict_groups, "
          "cast(coalesce(sum(n) filter (where labels > 1), 0) as bigint) as conflict_rows from "
          f"(select profile_key, count(*) as n, count(distinct {TARGET}) as labels from kf group by profile_key)",
          ctes=FF_CTE),
    Query("split_signature", "H5", lambda s, d: H.split_signature(
        split_frame(s, d).withColumn("fold_tag", F.concat_ws(":", "side", F.coalesce(
            F.col("cv_fold").cast("string"), F.lit("-")))), "respondent_id", "fold_tag"),
        "select count(*) as rows, cast(sum(cast(" + h8d(
            "concat(cast(respondent_id as varchar), '|', side || ':' || coalesce(cast(cv_fold as varchar), '-'))")
        + " as decimal(38,0))) as varchar) as signature from split", ctes=SPLIT_CTE),
    Query("category_coverage", "H6", lambda s, d: H.category_coverage(split_frame(s, d), MODEL_FEATURES),
          "select feature, count(*) filter (where tr) as train_categories, count(*) filter (where te) "
          "as test_categories, count(*) filter (where te and not tr) as unseen_test_categories from "
          "(select feature, category, bool_or(side = 'train') as tr, bool_or(side = 'test') as te from "
          "(unpivot (select side, " + ", ".join(MODEL_FEATURES) + " from split) on " + ", ".join(MODEL_FEATURES)
          + " into name feature value category) group by feature, category) group by feature", ctes=SPLIT_CTE),
]
