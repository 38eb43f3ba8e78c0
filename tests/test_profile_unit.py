"""Audit operators on the small synthetic CSV used by the reference's unit test, plus edge cases."""

import pytest
from pyspark.sql import functions as F

from tabulon.operators import profile as B


@pytest.fixture()
def audit_df(spark):
    rows = [("a", "1", "0", ""), ("b", "0", "1", ""), ("b", "0", "1", "")]
    return spark.createDataFrame(rows, "id string, target_a string, target_b string, empty string")


def test_profile_flags(audit_df):
    vf = B.value_frequency(audit_df)
    prof = {r.column: r for r in B.column_profile(vf).collect()}
    assert prof["empty"].inferred_type == "empty"
    assert prof["empty"].is_all_missing and prof["empty"].is_constant_non_missing  # kept oddity
    assert prof["empty"].missing_pct == 100.0
    assert prof["target_a"].inferred_type == "integer"
    assert prof["id"].unique_count == 2
    assert prof["target_a"].top_values == '[{"value":"0","count":2},{"value":"1","count":1}]'


def test_duplicates_and_targets(audit_df):
    d = B.duplicate_summary(audit_df).collect()[0]
    assert (d.exact_duplicate_groups, d.duplicate_rows_excluding_first, d.rows_in_duplicate_groups) == (1, 1, 2)
    vf = B.value_frequency(audit_df)
    t = {r.target: r for r in B.target_summary(vf, ["target_a", "target_b", "nope"], audit_df.columns).collect()}
    assert t["target_a"].valid_binary_0_1 and t["target_b"].valid_binary_0_1
    assert not t["nope"].present


def test_type_inference_edges(spark):
    df = spark.createDataFrame([("1.5", "x", " 7 ", "1e3"), ("-2", "3", "8", ".5")], "a string, b string, c string, d string")
    prof = {r.column: r.inferred_type for r in B.column_profile(B.value_frequency(df)).collect()}
    assert prof == {"a": "float", "b": "string", "c": "integer", "d": "float"}


def test_code_set_flags_all_rows(spark):
    df = spark.createDataFrame([("1",), ("2",), ("9",)], "female string")
    r = B.code_set_checks(B.value_frequency(df), ["female"]).collect()[0]
    assert r.flagged_count == 3 and r.offending_count == 1 and r.status == "REVIEW"


def test_route_columns_sends_ids_to_scalar_path(spark):
    rows = [(str(i), str(i % 3), "") for i in range(500)]
    df = spark.createDataFrame(rows, "id string, code string, empty string")
    r = {x.column: x for x in B.route_columns(df).collect()}
    assert r["id"].path == "scalar" and r["code"].path == "value_frequency" and r["empty"].non_missing == 0
    sp = B.scalar_profile(df, ["id"]).first()
    assert sp.unique_count == 500 and sp.max == 499.0


def test_stitch_multi_line_keys(spark):
    from tabulon.operators import codebook as C
    lines = spark.createDataFrame([(1, 1, "fin24"), (1, 2, "c"), (1, 3, "text about it"), (1, 4, "age"),
                                   (1, 5, "more")], "doc int, line_no int, line string")
    keys = spark.createDataFrame([("fin24c",), ("age",)], "key string")
    out = {r.line_no: r for r in C.stitch_keys(lines, "doc", keys).collect()}
    assert out[1].key == "fin24c" and out[2].continuation and out[4].key == "age" and out[3].key is None
    sections = C.carry_forward_sections(C.stitch_keys(lines, "doc", keys).filter("not continuation"), "doc",
                                        F.col("key").isNotNull(), F.col("key"))
    got = {r.line_no: r.section for r in sections.collect()}
    assert got == {1: "fin24c", 3: "fin24c", 4: "age", 5: "age"}
