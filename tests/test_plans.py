"""Plan-shape guards: the scale properties are asserted on the physical plans, not only on results."""

import __spark_entry__ as entry_mod
from conftest import SF_SMALL

Q = entry_mod.queries()


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_values_limits_before_the_shuffle(spark):
    p = _plan(Q["top_values"](spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_subgroup_rates_single_grouping_sets_pass(spark):
    p = _plan(Q["subgroup_rates"](spark, SF_SMALL))
    assert p.count("Expand") == 1
    assert "partial_count" in p or "partial_sum" in p


def test_duplicate_scan_reads_only_content_columns(spark):
    p = _plan(Q["duplicate_summary"](spark, SF_SMALL))
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert scans and all("doc_id" not in s and "n_chars" not in s for s in scans)


def test_fixture_scan_prunes_orders_columns(spark):
    p = _plan(Q["weight_checks"](spark, SF_SMALL))
    orders = [line for line in p.splitlines() if "FileScan parquet" in line and "orders.parquet" in line]
    assert orders
    for scan in orders:  # the weight check needs only the join key from orders
        assert "ReadSchema: struct<o_custkey:bigint>" in scan and "PushedFilters: [IsNotNull(o_custkey)]" in scan


def test_prep_template_gathers_no_rows_on_the_driver(spark, monkeypatch):
    """The ages of all rows are joined in a shuffle, however small the written table looks."""
    from tabulon.plans import q_codebook
    plans, written = [], q_codebook.written

    def seen(df, name="survey"):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString()))
        return written(df, name)

    monkeypatch.setattr(q_codebook, "written", seen)
    q_codebook.q_prep(spark, SF_SMALL)
    plan = dict(plans)["template"]
    assert "SortMergeJoin [respondent_id" in plan and "BroadcastHashJoin [respondent_id" not in plan
