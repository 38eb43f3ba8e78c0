"""What a task of an operator holds or sends at a time."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tabulon.llm import decontam, lm_mixing, minhash_dedup


class Rows:
    """Stands in for a DataFrame: runs the function of a task on rows in this process."""

    def __init__(self, rows: pd.DataFrame):
        self.rows = rows

    def select(self, *names):
        return Rows(self.rows[list(names)])

    def mapInPandas(self, run, schema):
        return pd.concat(run(iter([self.rows])))

    def mapInArrow(self, run, schema):
        return pa.Table.from_batches(run(iter([pa.RecordBatch.from_pandas(self.rows)]))).to_pandas()


@pytest.mark.parametrize("step", ["gathered", "evidenced"])
def test_lm_tasks_hold_the_decisions_of_few_tokens(step, monkeypatch):
    rows = Rows(pd.DataFrame({"doc_id": range(30), "text": [" ".join(f"w{i}x{j}" for j in range(1200)) for i in range(30)]}))
    asked, decisions = [], lm_mixing.decisions
    monkeypatch.setattr(lm_mixing, "decisions", lambda tokens, code: asked.append(len(tokens)) or decisions(tokens, code))
    shared = SimpleNamespace(value=[np.zeros(2 << b, np.int32) for b in lm_mixing.SLOT_BITS])
    out = lm_mixing.gathered(rows, np.ones(256)) if step == "gathered" else lm_mixing.evidenced(rows, np.ones(256), shared, 6400)
    assert len(out) and sum(asked) >= 30 * 1200 and max(asked) <= 5_000


@pytest.mark.parametrize("slop", [0, 2])
def test_decontam_candidates_travel_without_words(spark, monkeypatch, slop):
    item = [f"b{i}" for i in range(15)]
    docs = [(1, "x y " + " ".join(item)), (1, "x y " + " ".join(item)), (2, " ".join([*item[:6], "new", *item[6:13]])), (3, "other words b1 b2 b3"), (4, None)]
    bench = [(7, " ".join(item)), (8, "b1 b2")]
    tables, saved = {}, decontam.saved

    def kept(df, name):
        tables[name], path = saved(df, name)
        return tables[name], path

    monkeypatch.setattr(decontam, "saved", kept)
    found = decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"), slop=slop)
    got = {(r["k1"], r["item_id"], r["kind"], r["start"], r["length"]) for r in found.collect()}
    exact = {(1, 7, "exact", s, 13) for s in (2, 3, 4)} | {(1, 8, "exact", 3, 2), (2, 8, "exact", 1, 2), (3, 8, "exact", 2, 2)}
    assert got == exact | ({(2, 7, "near", 0, 14)} if slop else set())
    asked = [tables[n] for n in ("asked", "close") if n in tables]
    assert len(asked) == (2 if slop else 1) and not any("terms" in t.schema.simpleString() for t in asked)
    assert tables["index"].count() == tables["index"].distinct().count()


def test_bucket_rows_are_told_apart_after_the_join(spark, monkeypatch):
    """Tasks hold one entry a bucket and the members of shared buckets, not every bucket row several times."""
    plans, saved = {}, minhash_dedup.saved

    def kept(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return saved(df, name)

    monkeypatch.setattr(minhash_dedup, "saved", kept)
    docs = [(i, " ".join([*(f"w{i // 2}x{j}" for j in range(80)), f"end{i}"])) for i in range(20)] + [(20, None), (None, "a b c d e f"), (0, "under an id of its own")]
    got = {(r["doc_id"], r["component_id"]) for r in minhash_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {(i, i // 2 * 2) for i in range(20)} | {(20, 20), (None, None)}
    below = plans["members"][plans["members"].index("Join"):]
    assert "Aggregate(keys=[band#" in below and ", node#" not in "".join(x for x in below.splitlines() if "Aggregate(keys=[band#" in x)


def test_a_crowd_is_compared_in_its_bucket(spark, monkeypatch):
    """Texts alike, but not alike enough: their pairs are compared inside the bucket blocks and never become rows of a join."""
    import random
    r = random.Random(5)
    core = [f"core{i}" for i in range(60)]
    rows = []
    for i in range(60):  # pairs of the crowd are at 0.5 to 0.7, every tenth has a near copy
        own = [f"own{i}x{j}" for j in range(14)]
        rows.append((i, " ".join([*core, *own])))
        if i % 10 == 0:
            rows.append((100 + i, " ".join([*core, *own, "more"])))
    rows += [(3, ""), (13, None), (0, " "), (100, None), (200, "\t")]  # blank copies under the ids of texts
    r.shuffle(rows)
    asked, real = [], minhash_dedup.confirmed

    def confirmed(pairs, bodies):
        asked.append(pairs.count())
        return real(pairs, bodies)

    monkeypatch.setattr(minhash_dedup, "confirmed", confirmed)
    monkeypatch.setattr(minhash_dedup, "MARGIN", 0.6)  # every pair of a bucket has to be confirmed
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).where("n_shingles > 0").collect()
    assert {(x["doc_id"], x["component_id"]) for x in got} == {(i, i - 100 if i >= 100 else i) for i, t in rows if t and t.strip()}
    assert sum(asked) < 32 * 66  # at most one pair a member and band, no square of the crowd
    assert len(asked) == 1


def test_linked_counts_full_sets():
    import numpy as np
    rng = np.random.default_rng(3)
    x, y = ({i: np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for i in range(5)} for _ in range(2))
    at = np.array([(i, j) for i in range(5) for j in range(5) if (i + j) % 3])
    want = [100 * len(np.intersect1d(x[i], y[j])) >= 75 * len(np.union1d(x[i], y[j])) for i, j in at.tolist()]
    assert minhash_dedup._linked(x, y, at).tolist() == want
    x[2] = y[2]
    assert minhash_dedup._linked(x, y, at)[at.tolist().index([2, 2])]


def test_pipeline_sends_short_batches_to_python(spark):
    """Every stage of the pipeline lowers the rows that a Python worker gets at a time; a smaller setting stays."""
    import pandas as pd

    import corpus_pipeline
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(i, "en", "web", f"Mail to anna{i}@mail.example.com about it.", 0) for i in range(1200)],
                                 "doc_id long, lang string, source string, text string, n_chars long").coalesce(1)
    try:
        for stage in (corpus_pipeline.language, corpus_pipeline.near_dedup, corpus_pipeline.privacy, corpus_pipeline.packing):
            spark.conf.set(name, "10000")
            stage(spark, docs, "")
            sizes = [r["n"] for r in docs.mapInPandas(lambda frames: (pd.DataFrame({"n": [len(f)]}) for f in frames), "n long").collect()]
            assert sum(sizes) == 1200 and max(sizes) <= 500
        spark.conf.set(name, "100")
        masked = corpus_pipeline.privacy(spark, docs, "").collect()
        assert spark.conf.get(name) == "100"
        assert len({r["text"] for r in masked}) == 1200 and not any("anna" in r["text"] for r in masked)
    finally:
        spark.conf.set(name, before)
