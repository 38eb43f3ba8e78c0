"""Survey views derived from the driver tables (orders ⋈ customer ⋈ nation ⋈ region).

The raw view is ONE expression template with a dialect switch for the 32-bit
md5 prefix; Spark evaluates it with ``selectExpr`` (whole-stage codegen, no
Python), DuckDB receives the same text as a CTE in the oracle queries.
The clean view is produced on the Spark side by the library's own recode and
banding operators, and by plain CASE text on the oracle side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.exprs import sql_case_map
from tabulon.session import written
from tabulon.sources.tables import table

# ---------------------------------------------------------------------------
# Survey codes, labels and dimension orders of the fixture views
# ---------------------------------------------------------------------------
NOT_APPLICABLE = "Not applicable / skipped"
CORE_MISSING = "Missing or nonresponse"
NONRESPONSE = "Nonresponse"
COMBINED_NO = "No / don't know / refused"
NON_SUBSTANTIVE = (NONRESPONSE, CORE_MISSING)

AGE_BANDS = ((15, 25, "15–24"), (25, 35, "25–34"), (35, 45, "35–44"),
             (45, 55, "45–54"), (55, 65, "55–64"), (65, 111, "65+"))

CODE_MAPS = {
    "female": {"1": "Female", "2": "Male"},
    "educ": {"1": "Primary education or less", "2": "Secondary education",
             "3": "Tertiary education or more"},
    "inc_q": {str(k): f"Income quintile {k}" for k in range(1, 6)},
    "internet_use": {"1": "Yes", "0": COMBINED_NO},
    "con1": {"1": "Yes", "2": "No", "9": NONRESPONSE},
    "con9": {"1": "A smartphone", "2": "A basic text phone", "8": NONRESPONSE},
}
# blank handling: core fields → CORE_MISSING, routed (conditional) fields → NOT_APPLICABLE
CORE_FIELDS = ("female", "educ", "inc_q", "internet_use", "con1")
ROUTED_FIELDS = ("con9",)
PASSTHROUGH = ("segment", "region")
TARGETS = {"y_a": "Outcome A", "y_b": "Outcome B"}

# (key, column, label, declared category order)
DIMENSIONS = (
    ("gender", "female", "Gender", ("Female", "Male")),
    ("age_group", "age_group", "Age group", tuple(b[2] for b in AGE_BANDS)),
    ("education", "educ", "Education", ("Primary education or less", "Secondary education",
                                        "Tertiary education or more", CORE_MISSING)),
    ("income_quintile", "inc_q", "Household income quintile",
     tuple(f"Income quintile {k}" for k in range(1, 6))),
    ("internet_use", "internet_use", "Recent internet use", ("Yes", COMBINED_NO)),
    ("phone_ownership", "con1", "Mobile phone ownership", ("Yes", "No", NONRESPONSE)),
    ("phone_type", "con9", "Phone type", ("A smartphone", "A basic text phone",
                                          NOT_APPLICABLE, NONRESPONSE)),
    ("segment", "segment", "Market segment",
     ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
    ("region", "region", "Region", ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")),
)

# Raw view: one template for both engines; {U:salt} is a 0..9999 uniform per order.
RAW_TEMPLATE = (
    ("respondent_id", "cast(o_orderkey as bigint)"),
    ("wgt", "cast(c_acctbal + 1000.0 as double)"),
    ("age", "cast(15 + {U:age} % 86 as int)"),
    ("female", "case when {U:sex} % 100 < 63 then '1' else '2' end"),
    ("educ", "case when {U:edu} % 100 = 0 then '' else cast(1 + {U:edu} % 3 as string) end"),
    ("inc_q", "substr(o_orderpriority, 1, 1)"),
    ("internet_use", "case when {U:net} % 100 < 60 then '1' else '0' end"),
    ("con1", "case when {U:own} % 1000 = 0 then '9' when {U:own} % 100 < 88 then '1' else '2' end"),
    ("con9", "case when {U:own} % 1000 = 0 or {U:own} % 100 >= 88 then '' "
             "when {U:typ} % 100 = 0 then '8' when {U:typ} % 100 < 62 then '1' else '2' end"),
    ("segment", "c_mktsegment"),
    ("region", "r_name"),
    ("y_a", "case when {U:ya} < 3000 + 500 * cast(substr(o_orderpriority, 1, 1) as int) "
            "+ (case when {U:net} % 100 < 60 then 1500 else 0 end) then 1 else 0 end"),
    ("y_b", "case when {U:yb} < 3500 + (case when {U:own} % 100 < 88 then 2500 else 0 end) "
            "then 1 else 0 end"),
)

SCORE_TEMPLATE = (
    "cast(150 + 60 * cast(inc_q as int) + 100 * cast(internet_use as int) "
    "+ ({H8:concat('score|', cast(respondent_id as string))} % 300) as double) / cast(1000 as double)"
)


def h8_sql(inner: str, dialect: str) -> str:
    if dialect == "spark":
        return f"cast(conv(substr(md5({inner}), 1, 8), 16, 10) as bigint)"
    if dialect == "duckdb":
        return f"cast(('0x' || substr(md5({inner}), 1, 8)) as bigint)"
    raise ValueError(dialect)


def render(expr: str, dialect: str) -> str:
    expr = re.sub(r"\{U:(\w+)\}",
                  lambda m: "(" + h8_sql(f"concat('{m.group(1)}|', cast(o_orderkey as string))", dialect)
                  + " % 10000)", expr)
    return re.sub(r"\{H8:(.*?)\}", lambda m: h8_sql(m.group(1), dialect), expr)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt out by the key that the join below needs anyway
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority").repartition("o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal",
                                                       "c_mktsegment")
    # nation ⋈ region is bounded by the fixed set of nations: safe to broadcast
    geo = (table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
           .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))


def raw_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded survey rows: routed blanks, explicit nonresponse codes, positive weight.

    Each per-order uniform is computed once in its own projection (one md5 per
    salt) and the template then refers to it by name.
    """
    salts = sorted({m for _n, e in RAW_TEMPLATE for m in re.findall(r"\{U:(\w+)\}", e)})
    base = _joined(spark, sf_dir).select(
        "o_orderkey", "o_orderpriority", "c_acctbal", "c_mktsegment", "r_name",
        *[F.expr(render("{U:%s}" % salt, "spark")).alias(f"__u_{salt}") for salt in salts])
    return base.selectExpr(*[f"{re.sub(r'{U:(\w+)}', r'__u_\1', e)} as {name}" for name, e in RAW_TEMPLATE])


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw view as an all-string table (what a raw CSV scan yields).

    The weight keeps its two decimals so both engines print it identically.
    """
    raw = raw_survey(spark, sf_dir)
    cols = []
    for name, _ in RAW_TEMPLATE:
        if name == "wgt":
            cols.append(F.col(name).cast("decimal(12,2)").cast("string").alias(name))
        else:
            cols.append(F.col(name).cast("string").alias(name))
    return raw.select(*cols)


def clean_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled survey frame built by the library's recode (D3/D4/D5) and band (G1) operators."""
    return _cleaned(raw_survey(spark, sf_dir))


def written_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clean_survey`` as a written table, for queries that go over it more than once.

    The coded rows are written first: the whole chain in one stage makes a method that
    the JVM refuses to compile (over 8000 bytes of bytecode) and interprets for every row.
    """
    return written(_cleaned(written(raw_survey(spark, sf_dir))))


def _cleaned(raw: DataFrame) -> DataFrame:
    from tabulon.operators.clean import recode_categoricals, validate_binary, validate_whole_number
    from tabulon.operators.features import band

    labelled = recode_categoricals(raw, CODE_MAPS, core=CORE_FIELDS, routed=ROUTED_FIELDS)
    labelled = validate_binary(labelled, list(TARGETS), cast="int")
    labelled = validate_whole_number(labelled, "age", 15, 110, cast="int")
    labelled = labelled.withColumn("age_group", band("age", AGE_BANDS))
    return labelled.select("respondent_id", "wgt", "age", "age_group", "female", "educ", "inc_q",
                           "internet_use", "con1", "con9", *PASSTHROUGH, *TARGETS)


def scored_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic score in (0,1) with ties, for the evaluation operators."""
    return raw_survey(spark, sf_dir).selectExpr(
        "respondent_id", "y_a as y", f"{render(SCORE_TEMPLATE, 'spark')} as p")


# ---------------------------------------------------------------------------
# Oracle side (DuckDB): the same views as CTE text
# ---------------------------------------------------------------------------
def _clean_sql() -> str:
    band = "case " + " ".join(f"when age < {hi} then '{label}'" for _, hi, label in AGE_BANDS[:-1]) \
        + f" else '{AGE_BANDS[-1][2]}' end"
    parts = ["respondent_id", "wgt", "age", f"{band} as age_group"]
    for name in ("female", "educ", "inc_q", "internet_use", "con1", "con9"):
        mapping = dict(CODE_MAPS[name])
        if name in ROUTED_FIELDS:
            mapping[""] = NOT_APPLICABLE
        elif name in CORE_FIELDS:
            mapping[""] = CORE_MISSING
        parts.append(f"{sql_case_map(name, mapping)} as {name}")
    parts += list(PASSTHROUGH) + list(TARGETS)
    return "select " + ", ".join(parts) + " from raw_survey"


def oracle_views(dialect: str = "duckdb") -> str:
    """``WITH`` prefix defining raw_survey, raw_text, clean_survey, scored_survey."""
    raw = ("select " + ", ".join(f"{render(e, dialect)} as {n}" for n, e in RAW_TEMPLATE)
           + " from orders join customer on o_custkey = c_custkey"
             " join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
    text_cols = ", ".join(
        (f"cast(cast(wgt as decimal(12,2)) as varchar) as wgt" if n == "wgt" else f"cast({n} as varchar) as {n}")
        for n, _ in RAW_TEMPLATE)
    scored = (f"select respondent_id, y_a as y, {render(SCORE_TEMPLATE, dialect)} as p from raw_survey")
    return (f"with raw_survey as ({raw}),\n raw_text as (select {text_cols} from raw_survey),\n"
            f" clean_survey as ({_clean_sql()}),\n scored_survey as ({scored})\n")
