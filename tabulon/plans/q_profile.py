"""B-family (and C5) queries: audit of the all-string survey view and duplicate checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.operators import profile as B
from tabulon.plans.base import Query, values_sql
from tabulon.sources import fixtures as fx
from tabulon.sources.tables import table

RAW_COLS = [n for n, _ in fx.RAW_TEMPLATE]
TARGET_COLS = ["y_a", "y_b", "y_missing"]
RANGE_RULES = (("age", 15.0, 110.0, "expected range 15 to 110"),
               ("inc_q", 1.0, 5.0, "expected range 1 to 5"),
               ("y_a", 0.0, 1.0, "expected range 0 to 1"),
               ("y_b", 0.0, 1.0, "expected range 0 to 1"))
INDICATORS = ("female", "internet_use", "con1", "y_a")
ROLES = (("respondent_id", "IDENTIFIER", "Respondent identifier; uniqueness must be checked."),
         ("wgt", "METADATA", "Survey weight; used for estimates, not as a predictor."),
         ("region", "METADATA", "Geographic label attached to the record."))
DOC_CONTENT = ["text", "lang", "source"]
EVENT_CONTENT = ["ts", "user_id", "event_type", "value", "props"]


def _vf(spark, d):
    return B.value_frequency(fx.raw_text(spark, d))


def _profile(spark, d, top_k=8):
    return B.column_profile(_vf(spark, d), top_k=top_k)


def q_target_summary(spark, d):
    return B.target_summary(_vf(spark, d), TARGET_COLS, RAW_COLS)


def q_range_checks(spark, d):
    rules = spark.createDataFrame(list(RANGE_RULES), "column string, lo double, hi double, check string")
    vf = _vf(spark, d)
    return B.range_checks(vf, rules).unionByName(
        B.positive_checks(vf, ["wgt"], "survey weight must be positive"))


def q_roles(spark, d):
    roles = spark.createDataFrame(list(ROLES), "column string, preliminary_role string, rationale string")
    return B.field_roles(_profile(spark, d, top_k=0), roles)


def q_missingness_bands(spark, d):
    p = _profile(spark, d, top_k=0)
    return p.select("position", "column", "missing_pct", B.missingness_band(F.col("missing_pct")).alias("band"))


# ----------------------------------------------------------------- oracle text
_POS = "case " + " ".join(f"when c = '{c}' then {i + 1}" for i, c in enumerate(RAW_COLS)) + " end"
_TRIM = r"regexp_replace(coalesce(v, ''), '^\s+|\s+$', '', 'g')"
VF_CTE = (
    f"vf0 as (select c, {_TRIM} as v from (unpivot raw_text on {', '.join(RAW_COLS)} "
    f"into name c value v)), "
    f"vf as (select {_POS} as position, c as \"column\", v as value, count(*) as n from vf0 group by c, v)")
DEC_RE = B.DECIMAL_RE
INT_RE = B.INTEGER_RE
PROFILE_CTE = VF_CTE + (
    ", pc as (select position, \"column\", sum(n) as rows, "
    "sum(case when value <> '' then n else 0 end) as nm, count(*) filter (where value <> '') as uq, "
    f"bool_and(value = '' or regexp_full_match(value, '{INT_RE}')) as all_int, "
    f"bool_and(value = '' or (regexp_full_match(value, '{DEC_RE}') and try_cast(value as double) is not null)) as all_num, "
    f"min(case when value <> '' and regexp_full_match(value, '{DEC_RE}') then try_cast(value as double) end) as mn, "
    f"max(case when value <> '' and regexp_full_match(value, '{DEC_RE}') then try_cast(value as double) end) as mx, "
    f"sum(case when value <> '' and regexp_full_match(value, '{DEC_RE}') then try_cast(value as double) * n end) as sm "
    "from vf group by position, \"column\"), "
    "prof as (select position, \"column\", "
    "case when nm = 0 then 'empty' when all_int then 'integer' when all_num then 'float' else 'string' end as inferred_type, "
    "cast(nm as bigint) as non_missing_count, cast(rows - nm as bigint) as missing_count, "
    "round(coalesce(cast(rows - nm as double) * 100.0 / nullif(rows, 0), 0.0), 4) as missing_pct, "
    "cast(uq as bigint) as unique_count, "
    "round(coalesce(cast(uq as double) * 100.0 / nullif(nm, 0), 0.0), 4) as unique_pct_non_missing, "
    "nm = 0 as is_all_missing, uq <= 1 as is_constant_non_missing, (nm > 0 and uq = nm) as is_unique_non_missing, "
    "case when nm > 0 and (all_int or all_num) then mn end as min, "
    "case when nm > 0 and (all_int or all_num) then mx end as max, "
    "case when nm > 0 and (all_int or all_num) then sm / nm end as mean from pc), "
    "topv as (select \"column\", value, n, row_number() over (partition by \"column\" order by n desc, value) as rank "
    "from vf where value <> '' qualify rank <= 8)")
PROFILE_DOUBLES = ("missing_pct", "unique_pct_non_missing", "min", "max", "mean")

PROFILE_SQL = (
    "select p.*, cast(coalesce(t.top_values, '[]') as varchar) as top_values from prof p left join "
    "(select \"column\", cast(to_json(list({'value': value, 'count': n} order by rank)) as varchar) as top_values "
    "from topv group by \"column\") t using (\"column\")")


def _collist(cond: str) -> str:
    return f"cast(coalesce(to_json(list(\"column\" order by position) filter (where {cond})), '[]') as varchar)"


SMALL_CTE = (", small as (select position, \"column\", count(*) as k, "
             "list(value order by value) as vals, string_agg(value, '|' order by value) as obs "
             "from vf where value <> '' group by position, \"column\" having count(*) <= 12), "
             "every as (select \"column\", string_agg(value, '|' order by value) as obs from vf where value <> '' group by \"column\")")

TARGET_SQL = (
    f"select t.target, t.target in ({', '.join(repr(c) for c in RAW_COLS)}) as present, "
    "cast(a.position as integer) as position, a.missing_count, s.obs as observed_values, "
    "case when s.obs is not null then '{' || (select string_agg('\"' || value || '\":' || n, ',' order by value) "
    "from vf x where x.\"column\" = t.target and x.value <> '') || '}' end as distribution, "
    f"(t.target in ({', '.join(repr(c) for c in RAW_COLS)}) and coalesce(s.obs = '0|1', false) "
    "and a.missing_count = 0) as valid_binary_0_1, "
    "cast(a.pos as double) / nullif(a.nb, 0) as unweighted_positive_rate "
    f"from {values_sql([(c,) for c in TARGET_COLS], ['target'])} t "
    "left join (select \"column\", min(position) as position, "
    "cast(sum(case when value = '' then n else 0 end) as bigint) as missing_count, "
    "sum(case when value = '1' then n else 0 end) as pos, sum(case when value <> '' then n else 0 end) as nb "
    "from vf group by \"column\") a on a.\"column\" = t.target "
    "left join every s on s.\"column\" = t.target")

SPECIAL_SQL = (
    "select \"column\", value as token, 'textual_candidate' as kind, n as count from vf where upper(value) in ("
    + ", ".join("'" + t.replace("'", "''") + "'" for t in B.SPECIAL_MISSING_TOKENS) + ") "
    "union all select \"column\", value as token, 'numeric_candidate' as kind, n as count from vf where value in ("
    + ", ".join(f"'{c}'" for c in B.CANDIDATE_NUMERIC_CODES) + ")")

VALUE_SETS_SQL = (
    "select cast(to_json(vals) as varchar) as observed_values, count(*) as column_count, "
    "cast(to_json(list(\"column\" order by position)) as varchar) as columns from small group by vals")

_num = f"case when regexp_full_match(value, '{DEC_RE}') then try_cast(value as double) end"
RANGE_SQL = (
    f"select r.\"column\", r.check, cast(sum(case when v < r.lo or v > r.hi then n else 0 end) as bigint) as flagged_count, "
    "case when sum(case when v < r.lo or v > r.hi then n else 0 end) = 0 then 'PASS' else 'REVIEW' end as status "
    f"from (select \"column\", n, {_num} as v from vf where value <> '') x "
    f"join {values_sql(RANGE_RULES, ['column', 'lo', 'hi', 'check'])} r on r.\"column\" = x.\"column\" "
    "where v is not null group by r.\"column\", r.check "
    "union all select \"column\", 'survey weight must be positive' as check, "
    "cast(sum(case when v <= 0 then n else 0 end) as bigint) as flagged_count, "
    "case when sum(case when v <= 0 then n else 0 end) = 0 then 'PASS' else 'REVIEW' end as status "
    f"from (select \"column\", n, {_num} as v from vf where value <> '' and \"column\" = 'wgt') y "
    "where v is not null group by \"column\"")

CODESET_SQL = (
    "select a.\"column\", 'observed indicator codes ' || coalesce(s.obs, '') as check, "
    "case when coalesce(s.obs in ('0|1', '1|2'), false) then cast(0 as bigint) else a.rows end as flagged_count, "
    "a.offending_count, case when coalesce(s.obs in ('0|1', '1|2'), false) then 'PASS' else 'REVIEW' end as status "
    "from (select \"column\", cast(sum(n) as bigint) as rows, "
    "cast(sum(case when value <> '' and value not in ('0', '1', '2') then n else 0 end) as bigint) as offending_count "
    f"from vf where \"column\" in ({', '.join(repr(c) for c in INDICATORS)}) group by \"column\") a "
    "left join every s using (\"column\")")

TYPE_SQL = ("select inferred_type, count(*) as column_count, cast(to_json(list(\"column\" order by position)) as varchar) as columns "
            "from prof group by inferred_type")

CARD_SQL = (
    "select 'constant' as kind, count(*) filter (where is_constant_non_missing) as column_count, "
    f"{_collist('is_constant_non_missing')} as columns from prof "
    "union all select 'unique', count(*) filter (where is_unique_non_missing), "
    f"{_collist('is_unique_non_missing')} from prof "
    "union all select 'binary_0_1', count(*) filter (where b), "
    f"{_collist('b')} from (select p.*, coalesce(s.obs = '0|1', false) as b "
    "from prof p left join small s using (\"column\")) q")

MISS_SUMMARY_SQL = (
    f"select cast(sum(missing_count) as bigint) as blank_cells, {_collist('is_all_missing')} as all_missing_columns, "
    + ", ".join(f"{_collist(f'missing_pct >= {t}')} as columns_ge_{t}pct_missing" for t in (50, 75, 90))
    + " from prof")

BANDS_SQL = (
    "select position, \"column\", missing_pct, case when missing_pct = 100 then 'ALL_MISSING' "
    "when missing_pct >= 75 then 'HIGH_75_PLUS' when missing_pct >= 50 then 'HIGH_50_TO_74' "
    "when missing_pct >= 25 then 'MODERATE_25_TO_49' when missing_pct > 0 then 'LOW_UNDER_25' else 'NONE' end "
    "as band from prof")

ROLES_SQL = (
    "select p.\"column\", r.preliminary_role, r.rationale, p.unique_count, p.missing_pct from prof p "
    f"join {values_sql(ROLES, ['column', 'preliminary_role', 'rationale'])} r on r.\"column\" = p.\"column\"")


def _dup_sql(tbl: str, cols: list[str]) -> str:
    return ("select cast(count(*) as bigint) as exact_duplicate_groups, "
            "cast(coalesce(sum(c - 1), 0) as bigint) as duplicate_rows_excluding_first, "
            "cast(coalesce(sum(c), 0) as bigint) as rows_in_duplicate_groups "
            f"from (select count(*) as c from {tbl} group by {', '.join(cols)} having count(*) > 1) g")


DUP_ID_SQL = (
    "select cast(count(*) - count(distinct regexp_replace(cast(doc_id as varchar), '^\\s+|\\s+$', '', 'g')) as bigint) "
    "as duplicate_identifier_values, "
    "(select cast(count(*) as bigint) from (select 1 from documents group by text, lang, source, n_chars "
    "having count(*) > 1)) as duplicate_profiles_excluding_identifier_groups, "
    "(select cast(coalesce(sum(c - 1), 0) as bigint) from (select count(*) as c from documents "
    "group by text, lang, source, n_chars having count(*) > 1)) "
    "as duplicate_profiles_excluding_identifier_rows_excluding_first from documents")

def q_routes(spark, d):
    return B.route_columns(fx.raw_text(spark, d))


QUERIES = [
    Query("value_frequency", "A1,B0", _vf, "select * from vf", (), ctes=VF_CTE),
    Query("column_routes", "B0", q_routes),
    Query("column_profile", "B1,B2,B3", _profile, PROFILE_SQL, PROFILE_DOUBLES, ctes=PROFILE_CTE),
    Query("top_values", "B3", lambda s, d: B.top_values(_vf(s, d), 8),
          "select \"column\", cast(rank as integer) as rank, value, n from topv", (), ctes=PROFILE_CTE),
    Query("type_rollup", "B14", lambda s, d: B.type_rollup(_profile(s, d, 0)), TYPE_SQL, (), ctes=PROFILE_CTE),
    Query("cardinality_rollup", "B14", lambda s, d: B.cardinality_rollup(_profile(s, d, 0), _vf(s, d)),
          CARD_SQL, (), ctes=PROFILE_CTE + SMALL_CTE),
    Query("missingness_bands", "B13,C5", q_missingness_bands, BANDS_SQL, ("missing_pct",), ctes=PROFILE_CTE),
    Query("missingness_summary", "B13", lambda s, d: B.missingness_summary(_profile(s, d, 0)),
          MISS_SUMMARY_SQL, (), ctes=PROFILE_CTE),
    Query("target_summary", "B4", q_target_summary, TARGET_SQL, ("unweighted_positive_rate",),
          ctes=VF_CTE + SMALL_CTE),
    Query("special_tokens", "B8", lambda s, d: B.special_tokens(_vf(s, d)), SPECIAL_SQL, (), ctes=VF_CTE),
    Query("value_sets", "B9", lambda s, d: B.value_sets(_vf(s, d)), VALUE_SETS_SQL, (), ctes=VF_CTE + SMALL_CTE),
    Query("range_checks", "B10,B11", q_range_checks, RANGE_SQL, (), ctes=VF_CTE),
    Query("code_set_checks", "B12", lambda s, d: B.code_set_checks(_vf(s, d), INDICATORS), CODESET_SQL, (),
          ctes=VF_CTE + SMALL_CTE),
    Query("variable_roles", "B7", q_roles, ROLES_SQL, ("missing_pct",), ctes=PROFILE_CTE),
    Query("duplicate_summary", "B5", lambda s, d: B.duplicate_summary(table(s, d, "documents"), DOC_CONTENT),
          _dup_sql("documents", DOC_CONTENT), survey=False),
    Query("duplicate_events", "B5", lambda s, d: B.duplicate_summary(table(s, d, "events"), EVENT_CONTENT),
          _dup_sql("events", EVENT_CONTENT), survey=False),
    Query("duplicate_ignoring_id", "B6",
          lambda s, d: B.duplicate_ignoring_id(table(s, d, "documents"), "doc_id"), DUP_ID_SQL, survey=False),
]
