"""Operator 4: near-duplicates by b-bit MinHash.

Every document's set of distinct 5-word shingles gives 512 minima. Two low bits of each
mixed minimum are packed into sixteen longs, and 32 bands of four whole minima give bucket
keys. Documents with equal sets form a class, of which one goes on. The similarity of a
pair is first estimated from the packed signatures by bit counts, corrected for the
chance that low bits agree by accident; pairs that may reach the threshold are confirmed
on full sets.

A bucket's members are never all paired. First everyone meets the bucket's smallest
member, and the links found make components. A bucket that then still holds several
components goes on with the members outside its largest one: blocks of them meet blocks
of the others, and a pair is asked about once, in the first bucket it shares, if it lies
in two components, if the estimate allows a link, and if the similarities of both to the
bucket's smallest member do (one minus similarity is a metric). So every candidate pair
that could still join two components is looked at, at any size of bucket. The texts come
with the block, where the full sets of an asking member and all it may link with are
compared at once; only links leave it, so a crowd's pairs are never rows of a table.

At similarity 0.75 a pair misses all bands with probability 5e-6 and falls below the
estimate's margin with less than 1e-6.

Defined results: null and blank texts have no shingles, are linked with nothing and
kept; fewer than five words are one shingle; equal rows share a class; a null id is
linked with nothing, has a null component and is kept; an empty table gives an empty
result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import batched, dropped, free_others, if_small, mix64, saved, texts, window_hashes, word_hashes

SHINGLE, PERMUTATIONS, BANDS, ROWS, BITS = 5, 512, 32, 4, 2
SIMILARITY = (75, 100)
MARGIN = 0.117  # five standard deviations of the estimate at 0.75
BLOCK = 1024  # members of a bucket that meet in one step
BLOCK_SHINGLES = 1 << 20  # and about how many shingles of theirs
LONGS = [f"s{i}" for i in range(PERMUTATIONS * BITS // 64)]


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(words)
    return np.unique(window_hashes(h, min(k, len(h))))


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(4)
    a = r.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
    return a[:, None], r.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)[:, None]


def minima(shingles: np.ndarray, perms: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    a, b = perms
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(PERMUTATIONS, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 1024):
        out = np.minimum(out, (x[None, i:i + 1024] * a + b).min(axis=1))
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, k1, k2`` (the set's 128-bit key), ``s0..`` (packed low bits), ``bands``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free_others("minhash")
        perms = _permutations()
        lanes = (np.arange(PERMUTATIONS, dtype=np.uint64) % np.uint64(32)) * np.uint64(BITS)
        band_seed = mix64(np.arange(1, BANDS + 1, dtype=np.uint64))
        for f in batched(frames):
            out = []
            for doc_id, text in zip(f["doc_id"], f["text"], strict=True):
                s = shingle_set(text)
                if not len(s):
                    out.append((doc_id, 0, 0, 0, *[0] * len(LONGS), []))
                    continue
                low = minima(s, perms)
                bits = ((low * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint64)
                packed = np.bitwise_or.reduce((bits << lanes).reshape(-1, 32), axis=1).view(np.int64)
                wide = low[:BANDS * ROWS].astype(np.uint64).reshape(-1, ROWS)
                key = band_seed.copy()
                for i in range(ROWS):
                    key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, i])
                k1 = np.add.reduce(mix64(s)).astype(np.uint64).view(np.int64)
                k2 = np.bitwise_xor.reduce(mix64(s + np.uint64(0x51ED270B))).view(np.int64)
                out.append((doc_id, len(s), int(k1), int(k2), *packed.tolist(), key.view(np.int64).tolist()))
            g = pd.DataFrame(out, columns=["doc_id", "n_shingles", "k1", "k2", *LONGS, "bands"])
            yield g.assign(doc_id=g["doc_id"].astype("Int64"))

    return texts(docs).mapInPandas(
        run, f"doc_id long, n_shingles long, k1 long, k2 long, {', '.join(f'{c} long' for c in LONGS)}, bands array<long>")


def estimate(a: str, b: str) -> F.Column:
    """Collision-corrected similarity of two packed signatures, by bit counts."""
    even = F.lit(0x5555555555555555)
    unlike = sum((F.bit_count((x := F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))).bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(even))
                  for c in LONGS), F.lit(0))
    chance = 1 / (1 << BITS)
    return ((1 - unlike / PERMUTATIONS) - chance) / (1 - chance)


def confirmed(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """``a, b, similarity, linked`` of the pairs, on full shingle sets."""
    num, den = SIMILARITY
    one, two = bodies.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), bodies.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, set_a = None, None  # rows of one representative come together
        for f in batched(frames, 500):
            got = []
            for text_a, text_b in zip(f["text_a"], f["text_b"], strict=True):
                if text_a != last:
                    last, set_a = text_a, shingle_set(text_a)
                set_b = shingle_set(text_b)
                both = len(np.intersect1d(set_a, set_b, assume_unique=True))
                union = len(set_a) + len(set_b) - both
                got.append((both / union, den * both >= num * union))
            yield f[["a", "b"]].assign(similarity=[x for x, _ in got], linked=[x for _, x in got])

    return pairs.join(one, "b").join(two.hint("merge"), "a").select("a", "b", "text_a", "text_b").mapInPandas(
        run, "a long, b long, similarity double, linked boolean")


def _across(x: dict, y: dict) -> np.ndarray:
    """Which of members ``x`` (rows) and ``y`` (columns) of one bucket still have to be confirmed."""
    ok = x["component"][:, None] != y["component"][None]
    lo, hi = np.minimum(x["n_shingles"][:, None], y["n_shingles"][None]), np.maximum(x["n_shingles"][:, None], y["n_shingles"][None])
    ok &= SIMILARITY[1] * lo >= SIMILARITY[0] * hi
    with np.errstate(invalid="ignore"):  # unknown similarities are NaN and rule nothing out
        ok &= ~(np.abs(x["to_first"][:, None] - y["to_first"][None]) > 1 - SIMILARITY[0] / SIMILARITY[1] + 1e-9)
    at = np.argwhere(ok)
    if not len(at):
        return at
    i, j = at.T
    differ = x["sig"][i] ^ y["sig"][j]
    unlike = np.bitwise_count((differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1)
    chance = 1 / (1 << BITS)
    likely = ((1 - unlike / PERMUTATIONS) - chance) / (1 - chance) >= SIMILARITY[0] / SIMILARITY[1] - MARGIN
    at = at[likely]
    i, j = at.T
    earlier = (x["bands"][i] == y["bands"][j]) & (np.arange(BANDS)[None] < x["at"][i][:, None])
    return at[~earlier.any(axis=1)]


def _linked(x: dict[int, np.ndarray], y: dict[int, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Which of the pairs ``at`` (numbers in the sets ``x``, in the sets ``y``, sorted by the first) are links, on full sets."""
    num, den = SIMILARITY
    asked, k = np.unique(at[:, 1], return_inverse=True)
    sizes = np.array([len(y[j]) for j in asked.tolist()])
    every = np.concatenate([y[j] for j in asked.tolist()])
    known = np.unique(np.concatenate([x[i] for i in np.unique(at[:, 0]).tolist()]))
    number = np.searchsorted(known, every).clip(max=len(known) - 1)
    number[known[number] != every] = len(known)
    out, first = np.zeros(len(at), bool), np.cumsum(sizes) - sizes
    for of in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at[:, 0])) + 1):
        a, own = x[at[of[0], 0]], np.zeros(len(known) + 1, np.int32)
        own[np.searchsorted(known, a)] = 1
        both = np.add.reduceat(own[number], first)[k[of]]
        out[of] = den * both >= num * (len(a) + sizes[k[of]] - both)
    return out


def between_components(members: DataFrame, marks: DataFrame, bodies: DataFrame) -> DataFrame:
    """``a, b``: links inside buckets that join two components, confirmed on full shingle sets.

    ``members``: band, node, component of open buckets, its number of shingles and its
    similarity to the bucket's smallest member, where that was confirmed.
    """
    salts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = members.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("k"))
    sizes = sizes.groupBy("band").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.max(F.struct("n", "component", "k")).alias("top"))
    blocks = lambda n, k: F.ceil(F.greatest(n / BLOCK, k / BLOCK_SHINGLES)).cast("int")
    sizes = sizes.select("band", F.col("top.component").alias("largest"), blocks(F.col("n"), F.col("k")).alias("mb"),
                         blocks(F.col("n") - F.col("top.n"), F.col("k") - F.col("top.k")).alias("ob"))
    rows = members.join(sizes, "band").join(marks.drop("n_shingles").join(bodies.withColumnRenamed("doc_id", "node"), "node"), "node")
    rows = rows.withColumn("outside", F.col("component") != F.col("largest"))
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("ob") - 1)).alias("o"), place("mb").alias("m"), F.lit(False).alias("asks"))
    asking = rows.where("outside").select("*", place("ob").alias("o"), F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("m"), F.lit(True).alias("asks"))
    both = every.unionByName(asking).select("band", "o", "m", "asks", "node", "component", "outside", "similarity", "n_shingles", "bands", "text", *LONGS)
    both = both.repartition(salts, "band", "o", "m").sortWithinPartitions("band", "o", "m")

    def columns(f: pd.DataFrame) -> dict:
        bands = np.stack(f["bands"].to_numpy())
        return {"component": f["component"].to_numpy(), "n_shingles": f["n_shingles"].to_numpy(), "to_first": f["similarity"].to_numpy(dtype=float),
                "sig": f[LONGS].to_numpy().view(np.uint64), "bands": bands, "at": (bands == f["band"].to_numpy()[:, None]).argmax(axis=1),
                "node": f["node"].to_numpy(), "outside": f["outside"].to_numpy(), "text": f["text"].to_numpy()}

    def links(f: pd.DataFrame) -> Iterator[pd.DataFrame]:
        cut = np.flatnonzero((f[["band", "o", "m"]].to_numpy()[1:] != f[["band", "o", "m"]].to_numpy()[:-1]).any(axis=1)) + 1
        asks, every_row = f["asks"].to_numpy(), columns(f)
        for rows_of in np.split(np.arange(len(f)), cut):
            ask, rest = rows_of[asks[rows_of]], rows_of[~asks[rows_of]]
            y, sets = {k: v[rest] for k, v in every_row.items()}, {}
            for i in range(0, len(ask), 64):
                x = {k: v[ask[i:i + 64]] for k, v in every_row.items()}
                at = _across(x, y)
                once = ~y["outside"][at[:, 1]] | (x["node"][at[:, 0]] < y["node"][at[:, 1]])  # two outsiders meet twice
                at = at[once]
                if not len(at):
                    continue
                for j in set(at[:, 1].tolist()) - sets.keys():
                    sets[j] = shingle_set(y["text"][j])
                asking = {j: shingle_set(x["text"][j]) for j in set(at[:, 0].tolist())}
                at = at[_linked(asking, sets, at)]
                p, q = x["node"][at[:, 0]], y["node"][at[:, 1]]
                if len(at):
                    yield pd.DataFrame({"a": np.minimum(p, q), "b": np.maximum(p, q)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None  # the last bucket block may go on in the next frame
        for f in frames:
            f = pd.concat([kept, f], ignore_index=True) if kept is not None else f
            if not len(f):
                continue
            key = f[["band", "o", "m"]].to_numpy()
            done = int(np.flatnonzero((key != key[-1]).any(axis=1)).max(initial=-1)) + 1
            kept = f.iloc[done:]
            if done:
                yield from links(f.iloc[:done].reset_index(drop=True))
        if kept is not None and len(kept):
            yield from links(kept.reset_index(drop=True))

    return both.mapInPandas(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node of the links ``(a, b)``, by alternating stars.

    Every node hangs its larger neighbours, then its smaller ones, to the smallest of
    them, until every node hangs at one that hangs nowhere; grouping is by minima only,
    so a node with any number of links is pre-aggregated.
    """
    spark = links.sparkSession
    edges, path = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        ups = edges.groupBy("a").agg(F.count("*").alias("n"))
        roots = edges.select(F.col("b").alias("a")).distinct()
        if ups.join(roots.withColumn("root", F.lit(True)), "a", "left").where("n > 1 or root").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        edges, new = saved(small, "links")
        dropped(spark, path)
        path = new


def merged(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links: the new links join components, not documents."""
    if comps is None:
        return saved(components(links), "components")[0]
    of = lambda c: comps.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b").distinct()
    moved = components(between)
    old = comps.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    return saved(old.select("node", F.coalesce("to", "component").alias("component")).unionByName(
        moved.join(comps, "node", "left_anti")), "components")[0]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    spark = docs.sparkSession
    sketches, _ = saved(sketch(docs), "sketches")
    classes, _ = saved(sketches.where("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("node")), "classes")
    nodes = sketches.where("n_shingles > 0").join(classes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    nodes = nodes.withColumnRenamed("doc_id", "node")
    # dealt out by band once: the buckets of several nodes, the join and its distinct rows need no further shuffle;
    # only members of shared buckets, few of all rows, are held to tell them apart
    rows = nodes.select(F.explode("bands").alias("band"), "node").repartition("band")
    shared = rows.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("hi")).where("least < hi").select("band", "least")
    members, path = saved(rows.join(shared, "band").distinct(), "members")
    active, active_path = saved(members.select(F.col("node").alias("doc_id")).distinct(), "active")
    wanted = if_small(active)
    worded = texts(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))  # a blank copy under the id of a text has no set
    bodies, _ = saved(worded.join(wanted, "doc_id", "left_semi"), "bodies")
    marks, _ = saved(nodes.select("node", "n_shingles", *LONGS, "bands").join(wanted, nodes["node"] == wanted["doc_id"], "left_semi"), "marks")
    # everyone meets the bucket's smallest member
    others = members.where("node <> least")
    pairs = others.select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    likely = (pairs.join(marks.alias("x"), F.col("a") == F.col("x.node")).join(marks.alias("y"), F.col("b") == F.col("y.node"))
              .where((SIMILARITY[1] * F.least("x.n_shingles", "y.n_shingles") >= SIMILARITY[0] * F.greatest("x.n_shingles", "y.n_shingles"))
                     & (estimate("x", "y") >= SIMILARITY[0] / SIMILARITY[1] - MARGIN)).select("a", "b").distinct())
    met, _ = saved(confirmed(likely, bodies), "met")
    comps = merged(None, met.where("linked"))
    # what is left joins components
    rest = others.join(comps, "node", "left").select("band", "least", "node", F.coalesce("component", "node").alias("component"))
    open_bands = rest.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("band")
    rest = rest.join(open_bands, "band", "left_semi").join(marks.select("node", "n_shingles"), "node")
    to_first = met.select(F.col("a").alias("least"), F.col("b").alias("node"), "similarity")
    rest, rest_path = saved(rest.join(to_first, ["least", "node"], "left").drop("least"), "rest")
    more, _ = saved(between_components(rest, marks, bodies), "links")
    comps = merged(comps, more)
    dropped(spark, path, active_path, rest_path)
    out = sketches.select("doc_id", "n_shingles", "k1", "k2").join(classes, ["k1", "k2"], "left").join(comps, "node", "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    out = out.withColumn("component_id", F.when(linked, F.coalesce("component", "node")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of every group of near-duplicates; rows of one id count as one document."""
    judged, _ = saved(near_duplicates(docs), "judged")
    gone, _ = saved(judged.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    again, _ = saved(judged.where("doc_id is not null").groupBy(F.col("doc_id").alias("__again")).count().where("count > 1").select("__again"), "again")
    out = docs.join(if_small(gone), F.col("doc_id") == F.col("__gone"), "left_anti")
    if again.isEmpty():
        return out
    repeated = F.col("doc_id") == F.col("__again")
    return out.join(if_small(again), repeated, "left_anti").unionByName(
        out.join(if_small(again), repeated, "left_semi").dropDuplicates(["doc_id"]))
