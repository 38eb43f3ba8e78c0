"""A4 — content fingerprints: per file (SHA-256 of the bytes), per folder (a manifest) and per table (order-insensitive)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.exprs import h8

BLOCK = 4 << 20  # bytes read at a time


def _sha256(path: str) -> str:
    """Running digest over blocks, so a file of any size takes one block of memory."""
    from pyarrow import fs
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    store, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    digest = hashlib.sha256()
    with store.open_input_stream(name, buffer_size=0) as f:
        while block := f.read(BLOCK):
            digest.update(block)
    return digest.hexdigest()


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256) per file below ``path``. Spark lists the files (their contents are not read into rows);
    each is hashed block by block in the task that it is dealt to."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(sha256=[_sha256(p) for p in f["path"]])

    hashed = files.repartition("path").mapInPandas(run, "path string, length long, sha256 string")
    return hashed.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), "sha256", "path")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(file, bytes, sha256) with the path below ``root``, without the job's own marks (names that start with ``_`` or ``.``)."""
    out = file_fingerprints(spark, root).withColumn("file", F.regexp_replace(F.substring_index("path", root.rstrip("/").split("/")[-1] + "/", -1), "^/", ""))
    return out.where(~F.element_at(F.split("file", "/"), -1).rlike("^[_.]")).select("file", "bytes", "sha256")


def manifest_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(file, change): ``added``, ``removed``, ``changed`` or ``same`` for every file of either manifest."""
    b, a = (m.select("file", F.col("sha256").alias(c)) for m, c in ((before, "__b"), (after, "__a")))
    change = F.when(F.col("__b").isNull(), "added").when(F.col("__a").isNull(), "removed").when(F.col("__a") != F.col("__b"), "changed").otherwise("same")
    return b.join(a, "file", "full_outer").select("file", change.alias("change"))


def table_fingerprint(df: DataFrame, cols: Sequence[str] | None = None, portable: bool = False) -> DataFrame:
    """Order- and partition-insensitive fingerprint: row count + Σ hash of the row (exact decimal sum; a sum, not
    XOR, so duplicate pairs do not cancel). ``portable`` sums 32 bits of the md5 of the row's text, which other engines can repeat."""
    cols = list(cols or df.columns)
    if portable:
        h = h8(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols]))
    else:
        h = F.xxhash64(*[F.col(c) for c in cols])
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("fingerprint"))


def assert_pinned(fp: DataFrame, expected: str, column: str = "fingerprint") -> DataFrame:
    """Refuse to continue when the pinned fingerprint differs (raises when evaluated)."""
    return fp.withColumn(column, F.when(F.col(column) != expected, F.raise_error(
        F.concat(F.lit(f"{column} changed: expected {expected}, found "), F.col(column))))
        .otherwise(F.col(column)))
