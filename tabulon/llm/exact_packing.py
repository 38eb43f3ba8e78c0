"""Operator 8: best-fit packing by exact-complement hashing.

``tokenised`` turns whole texts into pieces of at most ``capacity`` tokens; ``pack``
places any table of pieces into sequences. The plan is made on the histogram of
lengths, which has at most ``capacity`` rows whatever the corpus: single, pair and
triple length sums are indexed, combinations that exactly fill a gap are consumed
as many times as the availability counts allow, and what is left goes best-fit.
The plan is a list of (pattern of lengths, multiplicity); every piece finds its
place from its rank among the pieces of its length, so no task sees all pieces.

Defined results: a null text counts as empty; an empty text is one piece holding the
end id alone; an empty table gives no pieces; equal rows are packed each; further
columns of the input are ignored.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import batched, kept_in_worker, saved, texts

CAPACITY = 2048
#: Bytes of words and ids that a Python worker remembers from task to task. The first it meets (so the
#: frequent ones) stay as long as it packs, the others until their share is full; another operator's task
#: frees both. In memory they take about eight times as much.
REMEMBERED, CORE_SHARE = 26 << 20, 0.6


class WordTokens:
    """Ids of whole texts, remembered word by word.

    The vocabulary's pre-tokeniser drops white space and never joins across it, so the
    ids of a text are the ids of its blank-separated words in order.
    """

    def __init__(self, tokenizer_file: str, remember: int = REMEMBERED):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one thread a task
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(tokenizer_file)
        self.known: dict[str, bytes] = {}
        self.passing: list[str] = []
        self.core_bytes = self.passing_bytes = 0
        self.core_most = int(remember * CORE_SHARE)
        self.passing_most = remember - self.core_most

    def forget(self) -> None:
        """Only the core stays."""
        for w in self.passing:
            del self.known[w]
        self.passing, self.passing_bytes = [], 0

    def learn(self, words: list[str]) -> None:
        if self.passing_bytes > self.passing_most:
            self.forget()
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        for w, e in zip(new, self.tok.encode_batch_fast(new, add_special_tokens=False), strict=True):
            ids = array("I", e.ids).tobytes() if sys.byteorder == "little" else np.array(e.ids, "<u4").tobytes()
            self.known[w] = ids
            size = len(w.encode()) + len(ids)
            if self.core_bytes + size <= self.core_most:
                self.core_bytes += size
            else:
                self.passing.append(w)
                self.passing_bytes += size

    def ids(self, text: str | None, end_id: int = 0) -> bytes:
        """Little-endian unsigned 32-bit ids of the text, then the end id."""
        words = text.replace("\n", " ").split(" ") if text else []
        try:
            body = b"".join(map(self.known.__getitem__, words))
        except KeyError:
            self.learn(words)
            body = b"".join(map(self.known.__getitem__, words))
        return body + int(end_id).to_bytes(4, "little")


@cache
def word_tokens(tokenizer_file: str, remember: int = REMEMBERED) -> WordTokens:
    """One for each Python worker, which runs many tasks."""
    return WordTokens(tokenizer_file, remember)


def tokenised(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, remember: int = REMEMBERED) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every document cut into pieces of at most ``capacity`` ids."""
    step = 4 * capacity

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_in_worker("packing", word_tokens.cache_clear)
        tok = word_tokens(tokenizer_file, remember)
        for f in batched(frames):
            out = []
            for doc_id, text in zip(f["doc_id"], f["text"], strict=True):
                ids = tok.ids(text)
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs).mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _sub(avail: np.ndarray, parts: tuple[int, ...]) -> int:
    """How often all of ``parts`` can be taken together."""
    need = defaultdict(int)
    for p in parts:
        need[p] += 1
    return min(int(avail[p]) // k for p, k in need.items())


def _pair(avail: np.ndarray, total: int) -> tuple[int, int] | None:
    """The available pair with that sum whose larger part is largest."""
    if total < 2:
        return None
    a = np.arange(total - 1, (total - 1) // 2, -1)
    a = a[a >= total - a]
    b = total - a
    ok = (avail[a] > 0) & (avail[b] > 0) & ((a != b) | (avail[a] > 1))
    i = int(ok.argmax()) if len(ok) else 0
    return (int(a[i]), int(b[i])) if len(ok) and ok[i] else None


def _triple(avail: np.ndarray, total: int) -> tuple[int, int, int] | None:
    """The available triple with that sum whose largest part is largest."""
    for a in np.flatnonzero(avail[:max(total - 1, 1)])[::-1].tolist():
        if 3 * a < total:
            return None
        avail[a] -= 1
        rest = _pair(avail, total - a)
        avail[a] += 1
        if rest:
            return a, *rest
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used; every counted piece is used exactly once."""
    avail = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        avail[length] = n
    out: list[tuple[tuple[int, ...], int]] = []
    left: list[tuple[int, int]] = []
    for length in range(capacity, 0, -1):
        while avail[length]:
            gap = capacity - length
            avail[length] -= 1  # the piece that opens the sequence
            parts = () if not gap else (gap,) if avail[gap] else _pair(avail, gap) or _triple(avail, gap)
            avail[length] += 1
            if parts is None:
                left.append((length, int(avail[length])))
                avail[length] = 0
                break
            whole = (length, *parts)
            times = _sub(avail, whole)
            for p in whole:
                avail[p] -= times
            out.append((whole, times))
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by gap
    for length, n in left:  # longest first, each to the tightest gap
        while n:
            gap = min((g for g, b in bins.items() if b and g >= length), default=None)
            if gap is None:
                fit = min(capacity // length, n)
                for k, times in ((fit, n // fit), (n % fit, 1)):
                    if k and times:
                        bins[capacity - k * length].append(((length,) * k, times))
                n = 0
                continue
            parts, have = bins[gap].pop()
            times = min(have, n)
            if have > times:
                bins[gap].append((parts, have - times))
            bins[gap - length].append(((*parts, length), times))
            n -= times
    out += [x for b in bins.values() for x in b]
    return out


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank of each run, its first sequence and its offset in the sequence."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    base = 0
    for parts, times in patterns:
        offset = 0
        for p in parts:
            runs[p].append((used[p], base, offset))
            used[p] += times
            offset += p
        base += times
    return {p: tuple(np.array(x, dtype=np.int64) for x in zip(*r, strict=True)) for p, r in runs.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces with a ``length`` of 1 to ``capacity``.

    ``order`` names the columns that tell the pieces apart. A length held by many
    pieces is ranked in salted groups, whose sizes are summed per length.
    """
    spark = pieces.sparkSession
    names = pieces.columns
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "salt").count()
    before = sizes.select("length", "salt", (F.sum("count").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("count")).alias("before"))
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places(plan(counts, capacity)))  # by length: bounded by capacity
    ranked = (salted.withColumn("rank_in", F.row_number().over(Window.partitionBy("length", "salt").orderBy(*order)) - 1)
              .join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("rank_in")))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            seq, off = np.zeros(len(f), dtype=np.int64), np.zeros(len(f), dtype=np.int64)
            rank = f["rank"].to_numpy()
            for length, rows in f.groupby("length").indices.items():
                first, base, offset = places.value[int(length)]
                run = np.searchsorted(first, rank[rows], side="right") - 1
                seq[rows], off[rows] = base[run] + rank[rows] - first[run], offset[run]
            yield f[names].assign(sequence_id=seq, offset=off)

    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.select(*pieces.columns, "rank").mapInPandas(place, schema)


def packed(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, remember: int = REMEMBERED) -> DataFrame:
    """Tokenise, cut and pack whole documents. Tokenised once: the pieces are a written table. ``remember`` bounds a worker's word cache."""
    pieces, _ = saved(tokenised(docs, tokenizer_file, capacity, remember), "pieces")
    return pack(pieces, capacity)
