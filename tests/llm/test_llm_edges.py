"""Every operator and stage on hostile and on empty tables; their defined results."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_fixtures import SF_SMALL, empty, hostile  # noqa: F401
from tabulon.llm import (ann_collision, blob_ledger, decontam, exact_packing, langid, lm_mixing, mil_quality, minhash_dedup,
                         suffix_dedup, surrogates)
from tabulon.llm.queries import tokenizer_file


def bench(spark):
    return spark.createDataFrame([(1, "no id here"), (None, "of the"), (3, None)], "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, None), (None, 1), (4, 1)], "doc_id long, quality int")


OPERATORS = {
    "lm": lambda s, d: lm_mixing.scored(d),
    "decontam": lambda s, d: decontam.judged(d, bench(s)),
    "quality": lambda s, d: mil_quality.scored(d, mil_quality.fitted(d, labels(s))),
    "minhash": lambda s, d: minhash_dedup.near_duplicates(d),
    "substrings": lambda s, d: suffix_dedup.deduplicated(d),
    "ledger": lambda s, d: blob_ledger.digest(d),
    "language": lambda s, d: langid.identified(d, langid.fitted(d)),
    "surrogates": lambda s, d: surrogates.masked(d, b"k"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_hostile_rows(spark, hostile, name):
    """One result row per input row, whatever it holds; equal rows get equal results."""
    got = OPERATORS[name](spark, hostile)
    rows = got.collect()
    assert len(rows) == hostile.count()
    nulls = [r for r in rows if r["doc_id"] is None]
    assert len(nulls) == 3
    if name != "minhash":
        assert len({str(r) for r in rows if r["doc_id"] == 0}) <= 2


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, empty, name):
    assert OPERATORS[name](spark, empty).collect() == []


def test_defined_values(spark, hostile):
    lm = {r["doc_id"]: r for r in OPERATORS["lm"](spark, hostile).collect()}
    assert lm[100]["n_tokens"] == lm[101]["n_tokens"] == lm[102]["n_tokens"] == 1
    near = OPERATORS["minhash"](spark, hostile).collect()
    assert all(r["kept"] and r["component_id"] is None for r in near if r["doc_id"] is None)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near}[104][1] == 103
    cut = {r["doc_id"]: r for r in OPERATORS["substrings"](spark, hostile).collect()}
    assert cut[104]["n_removed"] == cut[104]["n_words"] == 7000 and cut[100]["n_words"] == 0
    lang = {r["doc_id"]: r for r in OPERATORS["language"](spark, hostile).collect()}
    assert all(lang[i]["lang_pred"] == "und" and lang[i]["rejected"] for i in (100, 101, 102, 105))
    assert all(r["held_out"] is not None for r in lang.values()) and lang[None]["held_out"] is False
    masked = {r["doc_id"]: r["text"] for r in OPERATORS["surrogates"](spark, hostile).collect()}
    assert masked[100] is None and masked[101] == ""
    judged = {r["doc_id"]: r for r in OPERATORS["decontam"](spark, hostile).collect()}
    assert judged[100]["n_words"] == 0 and not judged[100]["contaminated"]


def test_packing_hostile(spark, hostile, empty):
    got = exact_packing.packed(hostile, tokenizer_file()).collect()
    assert sum(r["start"] == 0 for r in got) == hostile.count()
    assert all(r["length"] == 1 for r in got if r["doc_id"] in (100, 101, 102))
    assert exact_packing.packed(empty, tokenizer_file()).collect() == []


def test_neighbours_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, score double")
    assert ann_collision.nearest(none, F.col("vec_id") % 20 == 0).collect() == []
    one = spark.createDataFrame([(20, [1.0, 0.0]), (21, [0.5, 0.1])], "vec_id long, embedding array<float>")
    assert [tuple(r)[:3] for r in ann_collision.nearest(one, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 21)]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, hostile, empty, name, stage):
    """All but the last stage return their input's columns; nothing crashes on hostile or empty tables."""
    for docs in (hostile, empty):
        out = stage(spark, docs, SF_SMALL)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == docs.columns
        out.collect()


def test_pipeline(spark):
    """Every stage's decisions take effect, and the last one packs what is left."""
    from tabulon.llm.common import read_table, saved
    docs = read_table(spark, SF_SMALL, "documents")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept, _p = saved(stage(spark, kept, SF_SMALL), "stage")
    near = minhash_dedup.near_duplicates(langid.accepted(docs, langid.fitted(docs))).where("kept")
    clean = decontam.judged(docs, read_table(spark, SF_SMALL, "benchmark")).where("not contaminated")
    want = {r["doc_id"] for r in near.join(clean, "doc_id", "left_semi").collect()}
    assert {r["doc_id"] for r in kept.collect()} == want
    packed = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in packed} == want


def test_bands_are_dealt_out_once(spark, monkeypatch):
    import re

    from tabulon.llm import minhash_dedup
    plans, real = {}, minhash_dedup.saved

    def saved(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(minhash_dedup, "saved", saved)
    docs = spark.createDataFrame([(i, f"one two three four five six {i % 3}") for i in range(9)] + [(1, "other words under one id")], "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got[4, 3] == got[7, 3] == 1 and got[0, 3] == 0
    assert set(re.findall(r"hashpartitioning\(band#\w+(?:, node#\w+)?, \d+\), (\w+)", plans["members"])) == {"REPARTITION_BY_COL"}
