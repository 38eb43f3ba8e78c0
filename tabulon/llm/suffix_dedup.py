"""Operator 5: substring deduplication over prefix-partitioned suffix trees.

Every word position of a document starts a suffix. A suffix of at least ``WINDOW`` words
is put into a group by a prefix of variable length, 25 to 50 words: up to the end of the
25-word run with the smallest hash in its first 50 words. Equal windows have equal
prefixes, so all leaves below one tree node of depth 50 share a group, and one row per
(document, run) carries a whole stretch of suffixes. A group is one subtree, cut at
depth 50: its nodes are found by the fingerprint of their first 50 words while the
suffixes stream by, sorted by document, so memory holds one node per distinct window of
one group. Leaves with an earlier leaf below the same node are repeats; neighbouring
ones merge into maximal repeats.

Prefixes that a sample shows to be frequent have their suffixes dealt out by document;
then the first leaves of every part meet under the full 50-word prefix, as minima that
are aggregated before they travel. The sample only decides how work is dealt out.

Defined results: a null text has no words and loses nothing; a document of fewer than
50 words loses nothing; repeats inside one document, and between rows of one id, stay;
a null id neither loses words nor makes others lose them; an empty table gives an empty
result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import batched, mix64, saved, texts, word_hashes

WINDOW, RUN = 50, 25
SAMPLE = 16  # one document of so many is looked at for frequent prefixes
FREQUENT, MOST = 64, 65_536  # in the sample; how many prefixes can be frequent at most
PLACE = np.uint64((1 << 28) - 1)  # low bits that hold a word position


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * np.uint64(0x9E3779B97F4A7C15) + b)


def ladder(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of 25 and of 50 words, from runs of 1, 2, 4, 8 and 16."""
    n = len(h)
    h1 = mix64(h)
    h2 = joined(h1[:-1], h1[1:])
    h4 = joined(h2[:-2], h2[2:])
    h8 = joined(h4[:-4], h4[4:])
    h16 = joined(h8[:-8], h8[8:])
    h25 = joined(joined(h16[:n - 24], h8[16:n - 8]), h1[24:])
    return h25, joined(h25[:n - 49], h25[25:])


def stretches(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(prefix key, first suffix, number of suffixes) of every stretch, and all suffixes' 50-word fingerprints."""
    if len(words) < WINDOW:
        return None
    h25, h50 = ladder(word_hashes(words))
    v = (h25 & ~PLACE) | np.arange(len(h25), dtype=np.uint64)
    m2 = np.minimum(v[:-1], v[1:])
    m4 = np.minimum(m2[:-2], m2[2:])
    m8 = np.minimum(m4[:-4], m4[4:])
    m16 = np.minimum(m8[:-8], m8[8:])
    n = len(h50)  # the least of the 26 runs inside each window, ties to the left
    at = (np.minimum(m16[:n], m16[10:10 + n]) & PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return h25[at[first]], first, np.diff(np.append(first, n)), h50


def suffixes(docs: DataFrame, frequent=None, salts: int = 1) -> DataFrame:
    """``prefix, part, doc_id, row, start, nodes`` of every stretch; ``row`` is a hash of the text, ``nodes`` its fingerprints.

    ``part`` is 0, or 1 + a hash of the document for frequent prefixes.
    """
    t = texts(docs).where("doc_id is not null and text is not null").withColumn("row", F.xxhash64("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot = frequent.value if frequent is not None else np.empty(0, np.uint64)
        for f in batched(frames, 500):
            out = []
            for doc_id, row, text in zip(f["doc_id"], f["row"], f["text"], strict=True):
                if (s := stretches(text.encode().split())) is None:
                    continue
                prefix, first, n, h50 = s
                part = np.zeros(len(prefix), np.int32)
                if len(hot):
                    part[hot[np.searchsorted(hot, prefix).clip(max=len(hot) - 1)] == prefix] = 1 + doc_id * 2654435761 % salts
                raw = h50.tobytes()
                out.append(pd.DataFrame({
                    "prefix": prefix.view(np.int64), "part": part, "doc_id": doc_id, "row": row, "start": first.astype(np.int32),
                    "nodes": [raw[8 * a:8 * (a + k)] for a, k in zip(first.tolist(), n.tolist(), strict=True)]}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return t.mapInPandas(run, "prefix long, part int, doc_id long, row long, start int, nodes binary")


def frequent_prefixes(docs: DataFrame) -> np.ndarray:
    """Sorted prefixes that many documents of a sample hold; at most ``MOST`` of them."""
    t = texts(docs).where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    seen = suffixes(t).groupBy("prefix").count()
    top = seen.where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "prefix").limit(MOST)
    return np.sort(np.array([r["prefix"] for r in top.select("prefix").collect()], dtype=np.int64).view(np.uint64))


def _runs(flags: list[bool], start: int) -> Iterator[tuple[int, int]]:
    """(first, end) of every stretch of true flags."""
    at = None
    for i, x in enumerate(flags):
        if x and at is None:
            at = i
        elif not x and at is not None:
            yield start + at, start + i
            at = None
    if at is not None:
        yield start + at, start + len(flags)


def leaves(sorted_suffixes: DataFrame) -> DataFrame:
    """Walk partitions sorted by prefix, part and document: ``doc_id, row, first, end, node``.

    With ``node`` null, suffixes ``first`` to ``end`` have an earlier document below their
    node. With ``node`` set, the suffix is the first leaf of its node in a dealt-out part.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, nodes = None, {}
        for f in frames:
            prefix, part = f["prefix"].to_numpy(), f["part"].to_numpy()
            doc, row, start, prints = f["doc_id"].tolist(), f["row"].tolist(), f["start"].tolist(), f["nodes"].tolist()
            new = np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])))
            edge = np.append(np.flatnonzero(new), len(f))
            out = []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                key = (int(prefix[a]), int(part[a]))
                if key != now:
                    now, nodes = key, {}
                    if b - a == 1 and b < len(f) and not key[1]:
                        continue  # a lone leaf
                for i in range(a, b):
                    mine, d = np.frombuffer(prints[i], "<i8").tolist(), doc[i]
                    firsts = [nodes.setdefault(x, d) for x in mine]
                    out += [(d, row[i], s, e, None) for s, e in _runs([x < d for x in firsts], start[i])]
                    if key[1]:
                        out += [(d, row[i], start[i] + j, start[i] + j + 1, mine[j]) for j, x in enumerate(firsts) if x == d]
            g = pd.DataFrame(out, columns=["doc_id", "row", "first", "end", "node"])
            yield g.assign(node=g["node"].astype("Int64"))

    return sorted_suffixes.mapInPandas(run, "doc_id long, row long, first int, end int, node long")


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, row, first, end``: positions whose 50-word window also starts in a document with a smaller id."""
    spark = docs.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = spark.sparkContext.broadcast(frequent_prefixes(docs))  # at most MOST numbers
    dealt = suffixes(docs, frequent, salts).repartition(salts, "prefix", "part").sortWithinPartitions("prefix", "part", "doc_id")
    found, _ = saved(leaves(dealt), "leaves")
    inside = found.where("node is null").select("doc_id", "row", "first", "end")
    firsts = found.where("node is not null")
    least = firsts.groupBy("node").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("node", "least")
    across = firsts.join(least, "node").where("doc_id > least").select("doc_id", "row", "first", "end")
    return inside.unionByName(across)


def deduplicated(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row, and ``text_kept`` (null without ``with_text``)."""
    spans = repeats(docs).groupBy("doc_id", "row").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    t = texts(docs).withColumn("row", F.xxhash64("text"))
    both = t.join(spans, ["doc_id", "row"], "left").select("doc_id", "text", "spans")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batched(frames, 500):
            out = []
            for doc_id, text, cut in zip(f["doc_id"], f["text"], f["spans"], strict=True):
                words = text.encode().split() if text else []
                gone = np.zeros(len(words) + 1, np.int32)
                for s in (cut if cut is not None else ()):
                    gone[s["first"]] += 1
                    gone[s["end"] + WINDOW - 1] -= 1
                keep = np.cumsum(gone)[:-1] == 0
                kept = b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k) if cut is not None else b" ".join(words)
                out.append((doc_id, len(words), int(len(words) - keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            g = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "text_kept"])
            yield g.assign(doc_id=g["doc_id"].astype("Int64"))

    return both.mapInPandas(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, text_kept string")
