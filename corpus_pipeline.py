"""The corpus pipeline: filter, deduplicate, decontaminate, mask and pack ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and reread as the next stage's documents. All but the last return the columns
of ``documents``. SQL can't express a fitted model or a tokenizer, so ``ORACLE_SQL`` is
None and the stages are held against brute-force versions in ``tests/llm``.

Defined results: null texts have no language and go with the first stage; an empty table
passes through every stage as an empty table; repeated rows are copies, of which one stays.

The stages share executors, whose memory fills from stage to stage. So each sets the
session's ``spark.sql.execution.arrow.maxRecordsPerBatch`` to ``common.short_batches``
(500 rows, where it was more); it stays set, as stages are lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import decontam, exact_packing, langid, minhash_dedup, surrogates
from tabulon.llm.common import read_table, saved, short_batches
from tabulon.llm.queries import EXAMPLE_KEY, tokenizer_file


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: keep the documents whose language the calibrated model doesn't reject."""
    short_batches(spark)
    return langid.accepted(docs, langid.fitted(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near-duplicates stays."""
    short_batches(spark)
    return minhash_dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold too much of ``benchmark`` go."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: personal data become surrogates; ``n_chars`` follows the text."""
    short_batches(spark)
    out = surrogates.masked(docs, EXAMPLE_KEY)
    kinds = next(c for c in reversed(out.columns))
    n_chars = F.when(F.size(kinds) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.select(*[n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: cut and pack the tokens of what is left."""
    short_batches(spark)
    return exact_packing.packed(docs, tokenizer_file(), remember=8 << 20)  # its workers have served four stages before


STAGES = [("language ID", language), ("near-duplicates", near_dedup), ("decontamination", decontamination),
          ("PII", privacy), ("best-fit packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a written table."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs, _path = saved(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
