"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.session import ensure_checkpoint_dir, ship_package, shared_scratch


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, text)`` of any table with an id and a text column; other columns can't clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def saved(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet below the cluster's shared checkpoint folder; return (reread table, path).

    A written table cuts the lineage like ``checkpoint()`` does, is compressed and
    columnar, and survives the loss of any executor.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = shared_scratch(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that no later step reads."""
    jvm = spark._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


SMALL, SMALL_BYTES = 500_000, 32 << 20


def _bytes(column: "F.Column", kind) -> "F.Column":
    """About how much a value takes: texts by their bytes, arrays by their elements."""
    name = kind.typeName()
    if name in ("string", "binary"):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if name == "array":
        return F.coalesce(F.aggregate(column, F.lit(0).cast("long"), lambda t, x: t + _bytes(x, kind.elementType)), F.lit(0)) + 16
    if name == "struct":
        return sum((_bytes(column[f.name], f.dataType) for f in kind.fields), F.lit(8))
    return F.lit(8)


def if_small(df: DataFrame, limit: int = SMALL, most: int = SMALL_BYTES) -> DataFrame:
    """Broadcast a written table whose rows and bytes have been counted; beyond either limit leave the join to shuffle."""
    size = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))
    got = df.agg(F.count("*").alias("n"), F.sum(size).alias("b")).first()
    return F.broadcast(df) if got["n"] <= limit and (got["b"] or 0) <= most else df


def short_batches(spark: SparkSession, rows: int = 500) -> None:
    """From here on at most ``rows`` texts travel between Spark and a Python worker at a time.

    Both hold a batch several times over (Arrow buffers, strings, results), beside what
    earlier stages have left behind. A smaller setting of the session stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


#: What a Python worker keeps from task to task, by operator: how to let go of it.
_KEPT: dict[str, Callable[[], None]] = {}


def kept_in_worker(operator: str, forget: Callable[[], None]) -> None:
    _KEPT[operator] = forget


def free_others(operator: str) -> None:
    """Called where a task of ``operator`` starts: a worker serves one stage after the other, and lets go of what earlier ones kept."""
    for name in [k for k in _KEPT if k != operator]:
        _KEPT.pop(name)()


def crc_mod5(col) -> "F.Column":
    """crc32 of the id written as text, mod 5: the fold that the contracts name."""
    return (F.crc32(col.cast("string")) % 5).cast("int")


def crc_mod5_py(doc_id: int) -> int:
    return zlib.crc32(str(int(doc_id)).encode()) % 5


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an unsigned array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word."""
    from xxhash import xxh3_64_intdigest
    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of ``k`` consecutive word hashes (Horner, then a finaliser)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    m = np.uint64(0x9E3779B97F4A7C15)
    for i in range(k):
        out = out * m + h[i:i + n]
    return mix64(out)


def batched(frames, rows: int = 2000):
    """Cut the incoming pandas frames into smaller ones, so that long texts stay bounded in memory."""
    for f in frames:
        for i in range(0, len(f), rows):
            yield f.iloc[i:i + rows]


def empty_frame(schema: dict[str, str]) -> pd.DataFrame:
    return pd.DataFrame({k: pd.Series(dtype=v) for k, v in schema.items()})
