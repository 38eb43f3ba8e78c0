"""Operator 6: nearest neighbours by collision-counting hashing.

Inner-product search becomes a distance search by one added coordinate that evens out
the norms. Every row is indexed: a shard of rows keeps, for each of ``PROJECTIONS``
single random projections, its rows sorted by projection value. A query opens a window
around its own projection value in every sorted array; virtual rehashing widens all
windows step by step, counting in how many projections each row has collided. Rows
whose count reaches the threshold are verified with the exact measure, all of them; the
windows widen until at least ``k`` plus a share ``verify`` of the shard has been.

Rows are dealt to shards and queries to blocks by a hash of their ids; each (block,
shard) pair is one task of bounded size, and each query keeps its ``k`` best per shard.

Defined results: vectors that are null, zero or hold null or non-finite components
take no part; only vectors of equal length are compared; a row with the query's id is
the query's own; equal scores go to the smaller id; with fewer candidates than ``k``
all are returned; an empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS, THRESHOLD = 32, 0.7  # the threshold is a share of the projections
SHARD, BLOCK = 4096, 1024
VERIFY = 0.45
WIDTH, GROWTH = 0.7, 1.15


def usable(rows: DataFrame, vec: str = "embedding") -> F.Column:
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def projections(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).normal(size=(dim + 1, PROJECTIONS))


class Shard:
    """Sorted single-projection arrays of some rows."""

    def __init__(self, x: np.ndarray, longest: float):
        y = x / longest
        y = np.hstack([y, np.sqrt(np.clip(1 - (y * y).sum(axis=1, keepdims=True), 0, None))])
        p = y @ projections(x.shape[1])
        self.order = np.argsort(p, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(p, self.order.T, axis=0).T.copy()
        self.n = len(x)

    def candidates(self, queries: np.ndarray, least: int):
        """For every query its number and the rows whose collision count reached the threshold when at least ``least`` rows had.

        The window bounds of all queries are looked up together; each query counts
        only the rows by which its windows have grown.
        """
        unit = queries / np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        at = np.hstack([unit, np.zeros((len(unit), 1))]) @ projections(queries.shape[1])
        need, half, live = math.ceil(THRESHOLD * PROJECTIONS), WIDTH, np.arange(len(queries))
        lo = np.stack([v.searchsorted(at[:, i]) for i, v in enumerate(self.values)], axis=1)
        hi, counts = lo.copy(), np.zeros((len(queries), self.n), dtype=np.uint8)
        while len(live):
            low = np.stack([v.searchsorted(at[live, i] - half) for i, v in enumerate(self.values)], axis=1)
            high = np.stack([v.searchsorted(at[live, i] + half, side="right") for i, v in enumerate(self.values)], axis=1)
            more = []
            for k, q in enumerate(live.tolist()):
                left = zip(self.order, low[k].tolist(), lo[q].tolist(), strict=True)
                right = zip(self.order, hi[q].tolist(), high[k].tolist(), strict=True)
                fresh = [o[a:b] for o, a, b in left] + [o[a:b] for o, a, b in right]
                counts[q] += np.bincount(np.concatenate(fresh), minlength=self.n).astype(np.uint8)
                found = np.flatnonzero(counts[q] >= need)
                if len(found) >= min(least, self.n):
                    yield q, found
                else:
                    more.append(k)
            lo[live], hi[live] = low, high
            live, half = live[more], half * GROWTH


def nearest(rows: DataFrame, is_query: F.Column, k: int = 20, id_col: str = "vec_id", vec: str = "embedding",
            verify: float = VERIFY) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest inner product found for every query row."""
    spark = rows.sparkSession
    good = rows.where(usable(rows, vec) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"), is_query.alias("q"))
    good = good.withColumn("dim", F.size("v"))
    norms = good.groupBy("dim").agg(
        F.count("*").alias("n"), F.sum(F.col("q").cast("long")).alias("nq"),
        F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("longest"))
    spread = norms.select("dim", "longest", F.ceil(F.col("n") / SHARD).cast("int").alias("shards"),
                          F.greatest(F.lit(1), F.ceil(F.col("nq") / BLOCK).cast("int")).alias("blocks"))
    joined = good.join(F.broadcast(spread.where("blocks > 0")), "dim") if norms.count() <= 10_000 else good.join(spread, "dim")
    to = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    base = joined.select("dim", "longest", "id", "v", to("shards", 1).alias("shard"),
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    asked = joined.where("q").select(F.col("dim").alias("q_dim"), F.col("id").alias("q_id"), F.col("v").alias("q_v"), to("blocks", 2).alias("q_block"),
                                     F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("q_shard"))
    columns = ["query_id", "vec_id", "score"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        ids, x = left["id"].to_numpy(), np.stack(left["v"].to_numpy())
        shard = Shard(x, float(left["longest"].iloc[0]))
        least = k + 1 + math.ceil(verify * len(ids))
        out, asks, qs = [], right["q_id"].tolist(), np.stack(right["q_v"].to_numpy())
        for at, found in shard.candidates(qs, least):
            qid, q = asks[at], qs[at]
            found = found[ids[found] != qid]
            scores = x[found] @ q
            best = np.lexsort((ids[found], -scores))[:k]
            out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[found][best], "score": scores[best]}))
        return pd.concat(out, ignore_index=True)[columns]

    found = base.groupBy("dim", "shard", "block").cogroup(asked.groupBy("q_dim", "q_shard", "q_block")).applyInPandas(search, "query_id long, vec_id long, score double")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
