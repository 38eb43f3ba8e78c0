"""A7 — XML codebook (one record per ``<var>``) through Spark's built-in XML source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VAR_SCHEMA = ("_ID string, _name string, labl string, qstn struct<qstnLit:string>, notes string, "
              "varFormat struct<_type:string>, sumStat array<struct<_type:string, _VALUE:string>>, "
              "catgry array<struct<catValu:string, labl:string>>")


def read_codebook(spark: SparkSession, path: str) -> DataFrame:
    """Parse ``<var>`` records with an explicit schema (codes stay strings, never inferred numbers)."""
    raw = spark.read.format("xml").option("rowTag", "var").schema(VAR_SCHEMA).load(path)
    stats = F.map_from_entries(F.transform(F.coalesce(F.col("sumStat"), F.array()),
                                           lambda s: F.struct(s["_type"], s["_VALUE"])))
    return raw.select(
        F.col("_ID").alias("id"), F.col("_name").alias("name"), F.col("labl").alias("label"),
        F.col("qstn.qstnLit").alias("question"), "notes", F.col("varFormat._type").alias("type"),
        stats.alias("sum_stats"), F.coalesce(F.col("catgry"), F.array().cast(
            "array<struct<catValu:string,labl:string>>")).alias("codes"))


def write_codebook(df: DataFrame, path: str) -> str:
    """Write records shaped like :data:`VAR_SCHEMA` as ``<codeBook><var .../>...</codeBook>``."""
    df.write.format("xml").option("rootTag", "codeBook").option("rowTag", "var").mode("overwrite").save(path)
    return path
