"""Operator 12: how the sources of a language differ, by a dominance skyband of terms.

A group is a (lang, source) pair. Every language keeps the terms that occur in at least
``MIN_DOCS`` of its documents; group and language give each of its V kept terms the weight
p = 1 + floor(10^9 * (count + 2) / (N + 2 V)). Two weights p and q differ by
f = floor((p - q)^2 / (p + q)).

``term``: the terms that a group uses more than its language does (p > q), the ten with the
largest f. Where p > q, f grows with the group's count and falls with the language's. So a
term that ten others dominate (a group count as high, a language count as low, an earlier
UTF-8 form) can't be among the first ten. Each partition keeps its k-skyband (the terms that
fewer than k others dominate), partial skybands are merged over salted keys, and only what
is left is given its f and ranked exactly.

``pair``: f summed over all kept terms, for every two sources of a language. Sources are
cut into blocks and terms into chunks; a task has one chunk of terms and two blocks of
sources as two dense arrays and returns the sums of its pairs.

Scale: one scan of the texts counts terms per task before anything is shuffled, so a hot
group costs a row per task and term. Skybands are small (their size grows with the square
of the logarithm of the number of terms); a group's partial ones meet in about the square
root of the number of partitions first. The output itself has a row for every two sources.

Defined results: null text, lang and source are ''; a row is a document, so repeated rows
count again and the id plays no part; groups without terms take part with counts of zero; a
language without kept terms gives pairs with value 0 and no terms; ties are ranked by UTF-8
order; an empty table gives an empty result; other columns are ignored. Sums of counts
must stay below 9 * 10^15 in a group, beyond which an error is raised.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import dropped, saved

MIN_DOCS, RANKS, UNIT = 10, 10, 1_000_000_000
HELD = 500_000  # distinct (group, term) entries that a task holds before it hands them on
BUFFERED = 200_000  # rows that a task gathers before it takes their skybands
TERMS, SOURCES = 8192, 64  # terms in a chunk, sources in a block

_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")  # over UTF-8: ASCII letters and every other character beyond ASCII


def counted(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents; a null term has the group's documents."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, inside = defaultdict(Counter), defaultdict(Counter)
        size = 0

        def rows() -> pd.DataFrame:
            parts = [pd.DataFrame({"lang": g[0], "source": g[1], "term": [t if t is None else t.decode() for t in of], "n": list(map(n[g].__getitem__, of)),
                                   "docs": of.values()}) for g, of in inside.items()]
            n.clear()
            inside.clear()
            return pd.concat(parts)

        for f in frames:
            for lang, source, text in zip(f["lang"], f["source"], f["text"], strict=True):
                words = _TERM.findall(text.encode().lower())
                before = len(inside[lang, source])
                n[lang, source].update(words)
                inside[lang, source].update(set(words))
                inside[lang, source][None] += 1
                size += len(inside[lang, source]) - before
                if size > HELD:
                    yield rows()
                    size = 0
        if inside:
            yield rows()

    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = read.mapInPandas(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _weight(n: str, total: str, kept: str) -> F.Column:
    """p of a count, exactly: the product is a decimal."""
    return F.expr(f"1 + (cast({UNIT} as decimal(10, 0)) * cast({n} + 2 as decimal(19, 0))) div cast({total} + 2 * {kept} as decimal(19, 0))")


_DIFFERENCE = "cast((cast(p - q as decimal(19, 0)) * cast(p - q as decimal(19, 0))) div cast(p + q as decimal(19, 0)) as bigint)"


def _band(n: np.ndarray, other: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Which rows fewer than ``k`` others dominate: n as high, other as low, an earlier term.

    Rows are taken from the highest n on, so all that dominate a row come before it, and
    the first k of those are in the band themselves: a row is held against the band only.
    """
    place = np.empty(len(term), dtype=np.int64)
    place[np.argsort(term, kind="stable")] = np.arange(len(term))  # Python's order of strings is that of their UTF-8
    order = np.lexsort((place, other, -n))
    new = np.flatnonzero(np.diff(n[order], prepend=-1).astype(bool) | np.diff(other[order], prepend=-1).astype(bool))
    order = order[np.arange(len(order)) - np.repeat(new, np.diff([*new, len(order)])) < k]  # of equal counts the first k terms
    b_other, b_place, band, size = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64), [], 0
    for i in range(0, len(order), 512):
        at = order[i:i + 512]
        at = at[((b_other[:size][None] <= other[at][:, None]) & (b_place[:size][None] < place[at][:, None])).sum(axis=1) < k]
        for r, o, q in zip(at.tolist(), other[at].tolist(), place[at].tolist(), strict=True):
            if np.count_nonzero((b_other[:size] <= o) & (b_place[:size] < q)) < k:
                band.append(r)
                b_other[size], b_place[size] = o, q
                size += 1
    return np.array(band, dtype=np.int64)


def skyband(rows: DataFrame, k: int = RANKS) -> DataFrame:
    """Each partition's k-skyband of ``lang, source, term, n, lang_n`` by group."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def bands() -> list[pd.DataFrame]:
            every = pd.concat(held, ignore_index=True)
            return [part.iloc[_band(part["n"].to_numpy(), part["lang_n"].to_numpy(), part["term"].to_numpy(), k)]
                    for _, part in every.groupby(["lang", "source"], sort=False)]

        for f in frames:
            held.append(f)
            size += len(f)
            if size >= BUFFERED:
                held = bands()
                size = 0  # bands are small beside what comes
        if held:
            yield pd.concat(bands())

    return rows.select("lang", "source", "term", "n", "lang_n").mapInPandas(run, "lang string, source string, term string, n long, lang_n long")


def _weights(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """p of counts over ``total`` = N + 2 V, by long division in steps of three digits."""
    if total.max(initial=0) > 9_000_000_000_000_000:
        raise ValueError("a group has more than 9 * 10^15 occurrences")
    p, rest = np.zeros_like(n), n + 2
    for _ in range(3):
        p, rest = p * 1000 + rest * 1000 // total, rest * 1000 % total
    return p + 1


def _pair_sums(key: tuple, terms: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """The sums over one chunk of terms, between the sources of two blocks (both ways)."""
    _, one, two, _ = key
    name, block, total = sources["source"].to_numpy(), sources["block"].to_numpy(), sources["total"].to_numpy()
    a, b = np.flatnonzero(block == one), np.flatnonzero(block == two)
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    at = {s: i for i, s in enumerate(name)}
    step = max(1, 4_000_000 // max(1, len(a) * len(b)))
    entries = terms["by"].to_numpy()
    for i in range(0, len(entries), step):
        part = entries[i:i + step]
        n = np.zeros((len(part), len(name)), dtype=np.int64)
        for j, of in enumerate(part):
            for e in of:
                n[j, at[e["source"]]] = e["n"]
        p = _weights(n, total[None])
        x, y = p[:, a][:, :, None], p[:, b][:, None, :]
        out += ((x - y) ** 2 // (x + y)).sum(axis=0)
    i, j = (np.arange(len(a))[:, None] + 0 * out).ravel(), (np.arange(len(b))[None] + 0 * out).ravel()
    differ = a[i] != b[j]
    i, j = i[differ], j[differ]
    f = pd.DataFrame({"source": name[a[i]], "item": name[b[j]], "value": out[i, j]})
    if one != two:
        f = pd.concat([f, f.rename(columns={"source": "item", "item": "source"})])
    return f.assign(lang=key[0])[["lang", "source", "item", "value"]]


def divergence(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """``lang, source, part, item, value, rank``: all pairs of a language's sources, and each group's leading terms."""
    counts, counts_path = saved(counted(docs), "counts")
    kept = (counts.where("term is not null").groupBy("lang", "term")
            .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("by"))
            .where(F.col("docs") >= MIN_DOCS).drop("docs"))
    kept, _ = saved(kept, "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    entries = kept.select("lang", "term", "lang_n", F.explode("by").alias("e")).select("lang", "term", "lang_n", "e.source", "e.n")
    groups = (counts.where("term is null").select("lang", "source")
              .join(entries.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(langs, "lang", "left").na.fill(0, ["total", "v", "lang_total"]))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups, _ = saved(groups.withColumn("block", F.floor(place / SOURCES).cast("int")), "groups")
    dropped(docs.sparkSession, counts_path)

    terms = (entries.join(groups, ["lang", "source"]).withColumn("p", _weight("n", "total", "v")).withColumn("q", _weight("lang_n", "lang_total", "v"))
             .where("p > q"))
    parts = skyband(terms, ranks)
    salts = max(1, math.isqrt(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    parts = skyband(parts.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(salts))), ranks)
    band = skyband(parts.repartition("lang", "source"), ranks)
    first = band.join(groups, ["lang", "source"]).withColumn("p", _weight("n", "total", "v")).withColumn("q", _weight("lang_n", "lang_total", "v"))
    first = first.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_DIFFERENCE).alias("value"))

    blocks = groups.groupBy("lang").agg((F.max("block") + 1).alias("blocks"), F.greatest(F.lit(1), F.ceil(F.max("v") / TERMS)).cast("int").alias("chunks"))
    both = blocks.select("lang", "chunks", F.explode(F.expr("sequence(0, blocks - 1)")).alias("one"), "blocks").select(
        "lang", "chunks", "one", F.explode(F.expr("sequence(one, blocks - 1)")).alias("two"))
    chunk = F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int")
    block_of = groups.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("source", "block"))).alias("block_of"))
    rows = kept.join(block_of, "lang").join(both, "lang").select(
        "lang", "one", "two", chunk.alias("chunk"), F.expr("filter(by, e -> block_of[e.source] in (one, two))").alias("by"))
    of = groups.join(both, "lang").where("block in (one, two)").select(
        F.col("lang").alias("lang"), F.col("one").alias("one"), F.col("two").alias("two"), F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"), "source", "block", (F.col("total") + 2 * F.col("v")).alias("total"))
    keys = ["lang", "one", "two", "chunk"]
    pairs = (rows.groupBy(*keys).cogroup(of.groupBy(*keys)).applyInPandas(_pair_sums, "lang string, source string, item string, value long")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value"))

    ranked = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pairs.unionByName(first).withColumn("rank", ranked.cast("int")).where((F.col("part") == "pair") | (F.col("rank") <= ranks))
