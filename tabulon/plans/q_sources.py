"""A-family queries: raw CSV round trip, structure, XML codebook, fingerprints, gates."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabulon.operators import contracts as A
from tabulon.operators import profile as B
from tabulon.plans.base import Query, values_sql
from tabulon.plans.q_codebook import CODES_CTE, LABELS, documented_codes
from tabulon.plans.q_features import FF_CTE, MODEL_FEATURES, TARGET, feature_frame
from tabulon.plans.q_profile import PROFILE_CTE, RAW_COLS, VF_CTE
from tabulon.session import materialize, shared_scratch
from tabulon.sources import csv_raw, fingerprint, xml_codebook
from tabulon.sources import fixtures as fx
from tabulon.sources.tables import table


def _written_csv(spark, d):
    path = shared_scratch(spark, f"raw_csv/{uuid.uuid4().hex}")
    csv_raw.write_table(fx.raw_text(spark, d), path, "csv")
    return path


def q_roundtrip(spark, d):
    return csv_raw.read_raw_csv(spark, _written_csv(spark, d))


def q_structure(spark, d):
    return csv_raw.csv_structure(spark, _written_csv(spark, d))


def q_xml(spark, d):
    prof = B.column_profile(B.value_frequency(fx.raw_text(spark, d)), top_k=0)
    codes = documented_codes(spark, d).groupBy("variable").agg(F.array_sort(F.collect_list(F.struct(
        F.col("raw_value").alias("catValu"), F.col("cleaned_label").alias("labl")))).alias("catgry"))
    labels = spark.createDataFrame(list(LABELS.items()), "variable string, label string")
    recs = prof.join(codes, prof["column"] == codes["variable"], "left").drop("variable") \
        .join(F.broadcast(labels), prof["column"] == labels["variable"], "left")
    recs = recs.select(
        F.concat(F.lit("V"), F.col("position").cast("string")).alias("_ID"), F.col("column").alias("_name"),
        F.coalesce("label", "column").alias("labl"),
        F.struct(F.concat(F.lit("Question about "), F.col("column")).alias("qstnLit")).alias("qstn"),
        F.lit(None).cast("string").alias("notes"), F.struct(F.when(F.col("inferred_type") == "string", "character")
                                                            .otherwise("numeric").alias("_type")).alias("varFormat"),
        F.array(F.struct(F.lit("vald").alias("_type"), F.col("non_missing_count").cast("string").alias("_VALUE")),
                F.struct(F.lit("invd").alias("_type"), F.col("missing_count").cast("string").alias("_VALUE")))
        .alias("sumStat"), "catgry")
    path = shared_scratch(spark, f"codebook/{uuid.uuid4().hex}")
    xml_codebook.write_codebook(recs, path)
    cb = xml_codebook.read_codebook(spark, path)
    return cb.select("id", "name", "label", "type", F.col("sum_stats")["vald"].cast("bigint").alias("valid"),
                     F.col("sum_stats")["invd"].cast("bigint").alias("invalid"),
                     F.size("codes").alias("n_codes"),
                     F.array_join(F.transform("codes", lambda c: F.concat_ws("=", c["catValu"], c["labl"])), "|")
                     .alias("codes"))


XML_SQL = (
    "select 'V' || cast(p.position as varchar) as id, p.\"column\" as name, coalesce(l.label, p.\"column\") as label, "
    "case when p.inferred_type = 'string' then 'character' else 'numeric' end as type, p.non_missing_count as valid, "
    "p.missing_count as invalid, cast(coalesce(m.k, 0) as integer) as n_codes, coalesce(m.codes, '') as codes from prof p "
    f"left join {values_sql(list(LABELS.items()), ['variable', 'label'])} l on l.variable = p.\"column\" "
    "left join (select variable, count(*) as k, string_agg(raw_value || '=' || cleaned_label, '|' order by raw_value, "
    "cleaned_label) as codes from cmap group by variable) m on m.variable = p.\"column\"")

GATE_COLS = ["respondent_id", TARGET, *MODEL_FEATURES, "segment", "region"]
GATE_SQL = (
    "select 'ordered_columns' as \"check\", cast(0 as bigint) as violations, true as passed "
    "union all select 'prohibited_columns', cast(0 as bigint), true "
    "union all select 'null_cells', cast(" + " + ".join(f"count(*) filter (where {c} is null)" for c in GATE_COLS)
    + " as bigint), (" + " + ".join(f"count(*) filter (where {c} is null)" for c in GATE_COLS) + ") = 0 from ff "
    f"union all select 'non_binary_target', count(*) filter (where {TARGET} is null or cast({TARGET} as varchar) "
    f"not in ('0', '1')), count(*) filter (where {TARGET} is null or cast({TARGET} as varchar) not in ('0', '1')) = 0 "
    "from ff")

PIN_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
PIN_SQL = ("select count(*) as rows, cast(sum(cast(cast(('0x' || substr(md5(concat_ws(chr(31), " + ", ".join(f"cast({c} as varchar)" for c in PIN_COLS)
           + ")), 1, 8)) as bigint) as decimal(38,0))) as varchar) as fingerprint from orders")


def q_manifest(spark, d):
    """Two written artifacts; one is written again from other rows: the manifests show which files differ, the other is unchanged."""
    root = shared_scratch(spark, f"artifacts/{uuid.uuid4().hex}")
    orders = table(spark, d, "orders").select(*PIN_COLS)
    orders.coalesce(1).write.option("compression", "none").csv(f"{root}/a")
    orders.coalesce(1).write.option("compression", "none").csv(f"{root}/b")
    before = {k: materialize(fingerprint.manifest(spark, f"{root}/{k}")) for k in "ab"}
    orders.where("o_orderkey % 2 = 0").coalesce(1).write.mode("overwrite").csv(f"{root}/b")
    out = None
    for k in "ab":
        diff = fingerprint.manifest_diff(before[k], fingerprint.manifest(spark, f"{root}/{k}"))
        one = diff.agg(F.lit(k).alias("artifact"), (F.count_if(F.col("change") != "same") == 0).alias("unchanged"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = [
    Query("table_pin", "A4", lambda s, d: fingerprint.table_fingerprint(table(s, d, "orders"), PIN_COLS, portable=True), PIN_SQL, survey=False),
    Query("artifact_manifest", "A4,I10", q_manifest, "select 'a' as artifact, true as unchanged union all select 'b', false", survey=False),
    Query("raw_csv_roundtrip", "A1,A6", q_roundtrip, "select * from raw_text"),
    Query("csv_structure", "A2", q_structure, "select 13 as width, count(*) as rows from raw_text"),
    Query("xml_codebook", "A7", q_xml, XML_SQL, ctes=PROFILE_CTE + ", " + CODES_CTE),
    Query("table_fingerprint", "A4", lambda s, d: fingerprint.table_fingerprint(table(s, d, "orders"))),
    Query("file_fingerprint", "A4", lambda s, d: fingerprint.file_fingerprints(s, f"{d}/orders.parquet").drop("path")),
    Query("unique_key_check", "A3", lambda s, d: A.key_summary(table(s, d, "events"), ["user_id", "event_type"]),
          "select cast(sum(c) as bigint) as rows, count(*) as distinct_keys, count(*) filter (where c > 1) "
          "as duplicate_keys, cast(coalesce(sum(c) filter (where c > 1), 0) as bigint) as rows_in_duplicate_keys "
          "from (select count(*) as c from events group by user_id, event_type)", survey=False),
    Query("schema_gate", "A5", lambda s, d: A.schema_gate(feature_frame(s, d), GATE_COLS, TARGET,
                                                          prohibited=["y_b", "wgt"]), GATE_SQL, ctes=FF_CTE),
]
