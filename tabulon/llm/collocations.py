"""Operator 13: phrase collocations from an FM-index per shard over word ids.

A task numbers the words of its texts language by language and, after ``SHARD`` words,
builds the FM-index of that shard: the rotations of the sequence of word ids, sorted to
``DEPTH`` words, give the Burrows-Wheeler transform; the reversed sequence gives a second
one. A phrase is a pair of intervals of equal length, one in each index. Extending it to
the left by a word reads the words before the first interval: the new first interval
starts at the mapping of the first such word, the second moves on by what is smaller.
The same step with the two indexes swapped extends to the right. What the intervals say
about separators gives the occurrences at the edge of a piece.

Phrases grow by levels. Every shard extends the phrases that the whole corpus holds often
enough, and a longer phrase goes on only if its part without the last word does too, so
that at every level both parts have global numbers: a phrase is a pair of numbers, its
count the sum of the counts of the shards. A shard deals its phrases out by what they
extend, in packed blocks; the task of a range adds them up, numbers the phrases that are
left and returns to each shard the intervals of its own. The indexes are written once, bucketed
by shard, and never move again; only blocks and intervals do.

Scale: nothing is held beyond one shard or one range; the number of ranges grows with the
words. A phrase costs at most an entry per shard, wherever it is frequent. Lists of
intervals are bounded by the words of a shard.

Defined results: null texts are empty, a null lang is 'und'; a row is a document, so
repeated rows count again and ids play no part; pieces don't cross documents; ties in the
ranking go to the smaller phrase in UTF-8 order; an empty table gives an empty result;
other columns are ignored. Arithmetic on counts is decimal.
"""

from __future__ import annotations

import itertools
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.llm.common import dropped, if_small, mix64, saved
from tabulon.session import shared_scratch

DEPTH, LEAST, CONTAINED, TOP, SCALE = 4, 30, (80, 100), 2000, 2_000_000
SHARD = 3 << 19  # words and separators
SALTED = 1 << 19  # occurrences of a phrase from which on its extensions are dealt out further
RANGE = 1 << 22  # words for each range of phrases that is added up at once, at most on average

#: Ends of pieces become '.', which so is in no word; A-Z become lower case.
_EDGES = bytes(b"."[0] if c in b".,;:!?\n\x0b\x0c\r" else c for c in bytes(range(256)).lower())


def tokens(text: str) -> list[bytes]:
    """The words of a text, with a '.' at the end of every piece."""
    return text.encode().translate(_EDGES).replace(b".", b" . ").split()


def transform(s: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Burrows-Wheeler transform of the rotations of ``s``, sorted to ``depth`` symbols by doubling."""
    key, width = s.astype(np.int64), 1
    while width < depth:
        rank = key if width == 1 else np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = rank * (rank.max() + 1) + np.roll(rank, -width)
        width *= 2
    return np.roll(s, 1)[np.argsort(key, kind="stable")]


def _packed(a: np.ndarray) -> bytes:
    """32-bit numbers as planes of bytes: the upper ones are nearly empty and compress to nothing."""
    return a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def indexed(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """``shard, lang, words, vocabulary, counts, starts, bwt, reverse``: the FM-indexes, one row each.

    ``starts`` is where the rotations that begin with a word start, in either index.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, seqs = {}, defaultdict(list)
        size: dict[str, int] = defaultdict(int)

        def built(lang: str) -> pd.DataFrame:
            s, of = np.concatenate(seqs.pop(lang)), ids.pop(lang)
            size.pop(lang)
            n = np.bincount(s, minlength=len(of))
            return pd.DataFrame([(uuid.uuid4().int >> 65, lang, int(len(s) - n[0]), [w.decode() for w in of], n, np.cumsum(n) - n, _packed(transform(s)), _packed(transform(s[::-1])))],
                                columns=["shard", "lang", "words", "vocabulary", "counts", "starts", "bwt", "reverse"])

        for f in frames:
            for lang, text in zip(f["lang"], f["text"], strict=True):
                if not (words := tokens(text)):
                    continue
                if lang not in ids:
                    ids[lang] = defaultdict(itertools.count().__next__)
                    ids[lang][b"."]  # 0
                words.append(b".")
                seqs[lang].append(np.fromiter(map(ids[lang].__getitem__, words), dtype=np.int32, count=len(words)))
                size[lang] += len(words)
                if size[lang] >= shard:
                    yield built(lang)
                elif sum(size.values()) >= 2 * shard:  # many languages
                    yield built(max(size, key=size.get))
        for lang in list(ids):
            yield built(lang)

    read = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return read.mapInPandas(run, "shard long, lang string, words long, vocabulary array<string>, counts array<long>, starts array<long>, bwt binary, reverse binary")


class Shard:
    """One shard's two transforms and what is read from them."""

    def __init__(self, bwt: np.ndarray, reverse: np.ndarray):
        self.bwt, self.symbols = bwt, int(bwt.max(initial=0)) + 1
        self.lf = np.empty(len(bwt), dtype=np.int64)
        self.lf[np.argsort(bwt.astype(np.uint16) if self.symbols <= 1 << 16 else bwt, kind="stable")] = np.arange(len(bwt))
        self.edge, self.r_edge = (np.concatenate([[0], np.cumsum(x == 0)]) for x in (bwt, reverse))

    def left(self, lo: np.ndarray, r_lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions by a word to the left: ``node, word, lo, r_lo, n`` of the new phrases."""
        node = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        key, where, many = np.unique(node * self.symbols + self.bwt[at], return_index=True, return_counts=True)
        node, word = key // self.symbols, key % self.symbols
        before = np.cumsum(many) - many
        r = r_lo[node] + before - before[np.searchsorted(node, node)]  # what is smaller, within the node
        real = word > 0
        return node[real], word[real], self.lf[at[where[real]]], r[real], many[real]

    def edges(self, lo: np.ndarray, r_lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences at the start and at the end of a piece."""
        return self.edge[lo + n] - self.edge[lo], self.r_edge[r_lo + n] - self.r_edge[r_lo]


_FIELDS = (("before", np.int64), ("after", np.int64), ("lo", np.int32), ("r_lo", np.int32), ("n", np.int32), ("starts", np.int32), ("ends", np.int32))


_OWN = (("lo", np.int32), ("r_lo", np.int32), ("n", np.int32), ("number", np.int64), ("salts", np.int32))


def _block(columns: dict[str, np.ndarray], fields: tuple = _FIELDS) -> bytes:
    """Columns as compressed planes of bytes of their differences."""
    planes = [np.diff(columns[c].astype(t), prepend=t(0)).view(np.uint8).reshape(-1, t().itemsize).T.tobytes() for c, t in fields]
    return zstandard.compress(b"".join(planes), 5)


def _unblocked(data: bytes, fields: tuple = _FIELDS) -> dict[str, np.ndarray]:
    raw, at, out = np.frombuffer(zstandard.decompress(data), dtype=np.uint8), 0, {}
    size = len(raw) // sum(t().itemsize for _, t in fields)
    for c, t in fields:
        width = t().itemsize
        out[c] = np.cumsum(np.ascontiguousarray(raw[at:at + size * width].reshape(width, size).T).view(t).ravel(), dtype=t)
        at += size * width
    return out


def extended(index: DataFrame, alive: DataFrame, ranges: int) -> DataFrame:
    """``part, shard, block``: every shard's phrases one word longer, dealt out by ranges.

    All that extends a phrase lies in one range, where it compresses best; what extends a
    phrase so frequent that it could fill a good part of a range is dealt out further by the
    word before it (``salts``, which follows from the phrase's count over all shards).
    A block's columns are the numbers of the parts without the last and without the first
    word, the intervals, the count, and the occurrences at the edges of pieces.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples():
                own = [_unblocked(b, _OWN) for b in r.blocks]
                lo, r_lo, n, number, salts = (np.concatenate([b[c] for b in own]).astype(np.int64) for c, _ in _OWN)
                order = np.argsort(lo)
                lo, r_lo, n, number, salts = lo[order], r_lo[order], n[order], number[order], salts[order]
                s = Shard(_unpacked(r.bwt), _unpacked(r.reverse))
                got = []
                for i in _slices(n):
                    node, _, new, r_new, many = s.left(lo[i], r_lo[i], n[i])
                    of = np.maximum(np.searchsorted(lo, new, side="right") - 1, 0)  # without its last word it starts at the same place
                    known = (lo[of] <= new) & (new < lo[of] + n[of])
                    node, of, new, r_new, many = (x[known] for x in (node, of, new, r_new, many))
                    got.append((number[of], number[i][node], new, r_new, many, *s.edges(new, r_new, many), salts[i][node]))
                columns = {c: np.concatenate(x) for c, x in zip([*(c for c, _ in _FIELDS), "salts"], zip(*got, strict=True), strict=True)} if got else {}
                if not columns or not len(columns["n"]):
                    continue
                salt = mix64(columns["before"].view(np.uint64) + np.uint64(1)) % columns.pop("salts").view(np.uint64)
                part = (mix64(columns["after"].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt) % np.uint64(ranges)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
                yield pd.DataFrame([(int(part[at[0]]), r.shard, _block({c: x[at] for c, x in columns.items()})) for at in np.split(order, cuts[1:])],
                                   columns=["part", "shard", "block"])

    lists = alive.groupBy("shard").agg(F.collect_list("block").alias("blocks"))
    both = index.select("shard", "bwt", "reverse").join(lists.hint("shuffle_hash"), "shard").select("shard", "bwt", "reverse", "blocks")
    return both.mapInPandas(run, "part long, shard long, block binary")


def _own_blocks(f: pd.DataFrame) -> pd.DataFrame:
    """``shard, block``: of (shard, lo, r_lo, n, number, salts), each shard's phrases as one block."""
    f = f.sort_values(["shard", "lo"])
    parts = [(int(shard), _block({c: part[c].to_numpy() for c, _ in _OWN}, _OWN)) for shard, part in f.groupby("shard", sort=False)]
    return pd.DataFrame(parts, columns=["shard", "block"])


def summed(blocks: DataFrame, least: int, ranges: int) -> DataFrame:
    """The phrases with ``least`` occurrences or more over all shards (rows without a block), and for each shard a block of its own ones, to go on with.

    ``number, before, after, n, starts, ends, shard, block``. Numbers are dense: a phrase's
    place in its range times the ranges, plus the range.
    """
    def of(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        parts = [_unblocked(b) for b in f["block"]]
        shard = np.repeat(f["shard"].to_numpy(), [len(p["n"]) for p in parts])
        c = {k: np.concatenate([p[k] for p in parts]).astype(np.int64) for k, _ in _FIELDS}
        order = np.lexsort((c["before"], c["after"]))
        c, shard = {k: x[order] for k, x in c.items()}, shard[order]
        start = np.flatnonzero(np.concatenate([[True], (np.diff(c["before"]) != 0) | (np.diff(c["after"]) != 0)]))
        run = np.repeat(np.arange(len(start)), np.diff([*start, len(shard)]))
        total = np.add.reduceat(c["n"], start)
        often = total >= least
        number = (np.cumsum(often) - 1) * ranges + int(key[0])
        every = pd.DataFrame({"number": number, "before": c["before"][start], "after": c["after"][start], "n": total, "starts": np.add.reduceat(c["starts"], start),
                              "ends": np.add.reduceat(c["ends"], start), "shard": 0, "block": None})[often]
        own = _own_blocks(pd.DataFrame({"shard": shard, "lo": c["lo"], "r_lo": c["r_lo"], "n": c["n"], "number": number[run], "salts": 1 + total[run] // SALTED})[often[run]])
        return pd.concat([every, own.assign(number=0, before=0, after=0, n=0, starts=0, ends=0)[list(every.columns)]])

    return blocks.groupBy("part").applyInPandas(of, "number long, before long, after long, n long, starts long, ends long, shard long, block binary")


def _slices(n: np.ndarray, most: int = 1 << 20) -> Iterator[slice]:
    """Cut nodes so that their occurrences stay bounded in memory (one node's never exceed the shard's)."""
    cuts = np.unique(np.searchsorted(np.cumsum(n), np.arange(most, int(n.sum()) + most, most)) + 1)
    for i, j in itertools.pairwise([0, *np.minimum(cuts, len(n))]):
        if j > i:
            yield slice(i, j)


def bucketed(index: DataFrame) -> tuple[DataFrame, str, str]:
    """The indexes as a table bucketed by shard, in the shared folder: joins by shard don't move it."""
    spark = index.sparkSession
    name = f"fm_index_{uuid.uuid4().hex}"
    path = shared_scratch(spark, name)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, "shard").saveAsTable(name)
    return spark.table(name), name, path


def phrases(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, shard: int = SHARD) -> tuple[DataFrame, list[DataFrame]]:
    """``lang, n`` (all words) and, by level, every phrase that occurs ``least`` times or more.

    A level has ``number, lang, phrase, f``, ``starts`` and ``ends`` (occurrences at the
    edges of pieces), ``before`` and ``after`` (the numbers of its parts on the level below)
    and the counts of its first and last one and two words.
    """
    spark: SparkSession = docs.sparkSession
    index, table, path = bucketed(indexed(docs, shard))
    words, _ = saved(index.groupBy("lang").agg(F.sum("words").alias("n")), "words")
    ones = index.select("shard", "lang", F.posexplode(F.arrays_zip("vocabulary", "counts", "starts")).alias("id", "w")).where("id > 0").select(
        "shard", "lang", F.col("w.vocabulary").alias("phrase"), F.col("w.starts").alias("lo"), F.col("w.counts").alias("n"))
    total = ones.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(words.agg(F.sum("n")).first()[0] or 0) // RANGE))
    part = F.pmod(F.xxhash64("lang", "phrase"), F.lit(ranges))
    number = (F.row_number().over(Window.partitionBy(part).orderBy("lang", "phrase")) - 1) * ranges + part
    level, _ = saved(total.select(number.cast("long").alias("number"), "*", *[F.col("f").alias(c) for c in ("f_first", "f_last")]), "level1")
    levels = [level]
    alive = (ones.join(if_small(level.select("lang", "phrase", "number", "f")), ["lang", "phrase"]).select("shard", "lo", F.col("lo").alias("r_lo"), "n", "number", (1 + F.floor(F.col("f") / SALTED)).alias("salts"))
             .groupBy("shard").applyInPandas(_own_blocks, "shard long, block binary"))
    paths = [path]
    for d in range(2, depth + 1):
        found, found_path = saved(summed(extended(index, alive, ranges), least, ranges), f"summed{d}")
        paths.append(found_path)
        total, alive = found.where("block is null"), found.where("block is not null").select("shard", "block")
        b, a = levels[-1].alias("b"), levels[-1].alias("a")
        named = total.alias("t").join(b, F.col("t.before") == F.col("b.number")).join(a, F.col("t.after") == F.col("a.number"))
        last = F.substring_index("a.phrase", " ", -1)
        two = {2: ("t.n", "t.n"), 3: ("b.f", "a.f"), 4: ("b.f_two", "a.f_last_two")}[d]
        level, _ = saved(named.select(
            "t.number", "b.lang", F.concat_ws(" ", "b.phrase", last).alias("phrase"), F.col("t.n").alias("f"), "t.starts", "t.ends",
            "t.before", "t.after", "b.f_first", "a.f_last", F.col("b.f").alias("f_before"), F.col("a.f").alias("f_after"),
            F.col(two[0]).alias("f_two"), F.col(two[1]).alias("f_last_two")), f"level{d}")
        levels.append(level)
    spark.sql(f"drop table {table}")
    dropped(spark, *paths)
    return words, levels


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, shard: int = SHARD) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``, and ``starts`` and ``ends``, of each language's leading phrases."""
    words, levels = phrases(docs, least, DEPTH, shard)
    cuts = {2: [("f_before", "f_after")], 3: [("f_first", "f_after"), ("f_before", "f_last")],
            4: [("f_first", "f_after"), ("f_two", "f_last_two"), ("f_before", "f_last")]}
    out = []
    for d, level in enumerate(levels[1:], 2):
        each = [F.struct(F.expr(f"cast((cast({SCALE} as decimal(18, 0)) * cast(f as decimal(19, 0))) div (cast({x} as decimal(19, 0)) + cast({y} as decimal(19, 0))) as bigint)").alias("score"),
                         F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r")) for k, (x, y) in enumerate(cuts[d], 1)]
        level = level.withColumn("cut", F.least(*each) if len(each) > 1 else each[0])
        if d < DEPTH:  # a phrase inside any longer one is inside one with a single word more, which occurs as often at least
            longer = levels[d]
            inside = longer.select(F.explode(F.array("before", "after")).alias("number"), F.col("f").alias("longest")).groupBy("number").agg(F.max("longest").alias("longest"))
            level = level.join(inside, "number", "left").where(F.expr(
                f"longest is null or cast({CONTAINED[1]} as decimal(5, 0)) * longest < cast({CONTAINED[0]} as decimal(5, 0)) * f"))
        out.append(level.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score", "starts", "ends"))
    every = reduce(DataFrame.unionByName, out)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (every.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).join(words, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "starts", "ends"))
