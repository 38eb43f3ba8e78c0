"""Operator 11: Jaccard join of documents over 5-word shingles, by a token-group matrix.

A token is the 64-bit hash of a shingle; a document's set holds its distinct tokens. Two
documents link from a similarity of 0.8 on, so a document shares at least ceil(0.8 n) of its
n tokens with each of its partners.

1. Documents with equal sets form a class, of which one goes on.
2. Tokens in the lower part of the hash range (``SAMPLE`` of it) are looked up across classes.
   At most n - ceil(0.8 n) tokens of a document may be missing from a partner, so one that has
   more tokens in that range which no other class has can't link and is done.
3. What is left is partitioned into groups of similar documents: those with the same most
   frequent token meet (of the tokens in a fixed eighth that several documents hold), and are
   cut into groups of bounded members and tokens, to each of which the least document of all
   that met is added as well.
4. The matrix: a row (token, group) for every token of a group's union. Within a group its
   members are joined; what links there gives components.
5. Across groups: tokens are ordered by the number of groups that hold them. If two documents
   link, their first n - ceil(0.8 n) + 1 tokens in that order have one in common. So the rows of
   the matrix of first tokens give pairs of groups. In a pair, a query's overlap with the other
   group's union bounds its overlap with every member: only if that reaches ceil(0.8 n) is the
   group opened and the query held against its members, on full sets. Pairs of groups that lie
   in one component are left out, and pairs of documents in one component are not asked about.

A task has two groups at a time and returns a spanning forest of the links it finds, not all
of them; the components of the forests are those of all links.

Scale: tokens of one batch are combined before the shuffle, so a token that a third of all
documents hold costs a row per batch. A crowd of n similar documents makes (n / MEMBERS)^2
pairs of groups as long as it isn't one component. No link is lost: the order of tokens and
the sample only decide what is looked at. Sets are compared as 64-bit hashes, of which two
differing shingles agree with a chance of 2^-64.

Defined results: null and blank texts have no tokens and are linked with nothing; fewer than
five words are one shingle; equal rows share a class; rows of one id are one node; a null id
is linked with nothing and has a null component; an empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import batched, dropped, if_small, mix64, saved, texts, window_hashes, word_hashes
from tabulon.llm.minhash_dedup import components

SHINGLE, LEAST = 5, (80, 100)
SAMPLE = 0.4  # of the hash range
MEMBERS, TOKENS = 256, 1 << 18  # in a group
LIMIT = np.uint64(int(SAMPLE * 2**64))
SEEN, ONE, SEVERAL = 0, 1, 2
HELD = 1 << 20  # tokens that a task combines before it hands them on


def tokens(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(words)
    return np.unique(window_hashes(h, min(k, len(h))))


def needed(n: np.ndarray) -> np.ndarray:
    """The least overlap with a partner."""
    return -(-LEAST[0] * n // LEAST[1])


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, sampled, k1, k2``: the size, the number of sampled tokens and a 128-bit key of every document's set."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batched(frames):
            sets = [tokens(t) for t in f["text"]]
            keys = [_key(s) for s in sets]
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "n_shingles": [len(s) for s in sets], "sampled": [int(np.searchsorted(s, LIMIT)) for s in sets],
                                "k1": [k for k, _ in keys], "k2": [k for _, k in keys]})

    return texts(docs).mapInPandas(run, "doc_id long, n_shingles long, sampled long, k1 long, k2 long")


def _key(s: np.ndarray) -> tuple[int, int]:
    return int(np.add.reduce(mix64(s)).astype(np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix64(s + np.uint64(0x51ED270B))).astype(np.uint64).view(np.int64))


def _sampled(docs: DataFrame) -> DataFrame:
    """``token, key, kind, known``: the sampled tokens of each batch's classes, once each.

    A token is of one class of the batch (``ONE``) or of several (``SEVERAL``, without key);
    ``SEEN`` rows say how many tokens of a class the batch itself has seen in others.
    """
    def rows(sets: dict[int, np.ndarray]) -> pd.DataFrame:
        token = np.concatenate(list(sets.values()))
        key = np.repeat(np.array(list(sets), dtype=np.int64), [len(s) for s in sets.values()])
        distinct, first, of, many = np.unique(token, return_index=True, return_inverse=True, return_counts=True)
        there, known = np.unique(key[(many > 1)[of]], return_counts=True)
        return pd.concat([
            pd.DataFrame({"token": distinct.view(np.int64), "key": np.where(many > 1, 0, key[first]), "kind": np.where(many > 1, SEVERAL, ONE), "known": 0}),
            pd.DataFrame({"token": 0, "key": there, "kind": SEEN, "known": known})])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        size = 0
        for f in frames:
            for text in f["text"]:
                s = tokens(text)
                if len(s) and (k := _key(s)[0]) not in held:
                    held[k] = s[:np.searchsorted(s, LIMIT)]
                    size += len(held[k])
                if size >= HELD:
                    yield rows(held)
                    held, size = {}, 0
        if held:
            yield rows(held)

    return texts(docs).where("doc_id is not null").mapInPandas(run, "token long, key long, kind int, known long")


def _credits(rows: DataFrame) -> DataFrame:
    """``key, known``: by class, how many of its sampled tokens another class has too (sums over parts)."""
    def of(f: pd.DataFrame) -> pd.DataFrame:
        """From whole runs of tokens."""
        token, key, kind = (f[c].to_numpy() for c in ("token", "key", "kind"))
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        run = np.repeat(np.arange(len(start)), np.diff([*start, len(token)]))
        several = np.logical_or.reduceat(kind == SEVERAL, start)
        least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        lo, hi = np.minimum.reduceat(np.where(kind == ONE, key, most), start), np.maximum.reduceat(np.where(kind == ONE, key, least), start)
        shared = (several | (lo < hi))[run] & (kind == ONE)
        pairs = pd.DataFrame({"run": run[shared], "key": key[shared]}).drop_duplicates()  # a class may come from several batches
        there, known = np.unique(pairs["key"].to_numpy(), return_counts=True)
        return pd.DataFrame({"key": there, "known": known})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None  # the last token may go on in the next frame
        for f in frames:
            seen = f["kind"] == SEEN
            yield f.loc[seen, ["key", "known"]]
            f = f[~seen] if kept is None else pd.concat([kept, f[~seen]])
            if len(f):
                last = (f["token"] == f["token"].iloc[-1]).to_numpy()
                kept = f[last].drop_duplicates(["key", "kind"])
                if not last.all():
                    yield of(f[~last])
        if kept is not None:
            yield of(kept)

    spread = rows.repartition(F.when(F.col("kind") == SEEN, F.col("key")).otherwise(F.col("token"))).sortWithinPartitions("token")
    return spread.mapInPandas(run, "key long, known long").groupBy("key").agg(F.sum("known").alias("known"))


def candidates(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``node, n, set, least``: one document of each class that may link with another, its set, and its least token under a second hash.

    The sampled tokens that are in no other class must all be among the n - ceil(0.8 n)
    that a partner may lack; a class without a shared one in the sample goes on if they are.
    """
    credits = _credits(_sampled(docs))
    node = (keys.where("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2")
            .agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.max("sampled").alias("sampled")))
    known = F.coalesce("known", F.lit(0))  # none: a small set may share only what lies outside the sample
    may = node.join(credits.withColumnRenamed("key", "k1"), "k1", "left").where(
        LEAST[1] * (F.col("n") - F.col("sampled") + known) >= LEAST[0] * F.col("n"))
    may, _ = saved(may.select("node", "k1", "k2"), "may")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batched(frames, 500):
            out = []
            for node, k1, k2, text in zip(f["node"], f["k1"], f["k2"], f["text"], strict=True):
                s = tokens(text)
                if _key(s) == (k1, k2):  # and not another text under a used id
                    out.append((node, len(s), s.view(np.int64), int(mix64(s).min().view(np.int64)), k1, k2))
            yield pd.DataFrame(out, columns=["node", "n", "set", "least", "k1", "k2"])

    found = texts(docs).join(if_small(may), F.col("doc_id") == F.col("node")).select("node", "k1", "k2", "text")
    got = found.mapInPandas(run, "node long, n long, set array<long>, least long, k1 long, k2 long")
    return got.dropDuplicates(["node", "k1", "k2"]).drop("k1", "k2")  # an id may have several classes


def keyed_alike(sets: DataFrame) -> DataFrame:
    """``sets`` with ``least``, the token to meet under: of the tokens in a fixed eighth that several documents hold, the one that most hold.

    Copies with a few words changed hold their original's common tokens, so nearly all of a
    crowd meet under one key; a document without such a token keeps its own least one.
    """
    some = sets.select("node", F.explode(F.filter("set", lambda t: F.pmod(F.xxhash64(t), F.lit(8)) == 0)).alias("token"))
    many = some.groupBy("token").agg(F.countDistinct("node").alias("many")).where("many > 1")
    best = some.join(many, "token").groupBy("node").agg(F.max(F.struct("many", "token")).alias("best"))
    return sets.join(best, "node", "left").withColumn("least", F.coalesce("best.token", "least")).drop("best")


def grouped(sets: DataFrame) -> DataFrame:
    """``g, members``: groups of at most ``MEMBERS`` similar documents (and the least of all that met), about ``TOKENS`` tokens at most unless one alone has more."""
    sets = keyed_alike(sets)
    met = sets.groupBy("least").agg(F.count("*").alias("many"), F.sum("n").alias("tokens"), F.min("node").alias("first"))
    cuts = F.greatest(F.ceil(F.col("many") / (MEMBERS - 56)), F.ceil(F.col("tokens") / TOKENS)).cast("int")  # cuts by hash aren't even
    placed = sets.join(met.select("least", "first", cuts.alias("cuts")), "least")
    cut = F.when(F.col("cuts") > 1, F.pmod(F.xxhash64("node"), F.col("cuts"))).otherwise(0).cast("int")
    member = F.struct("node", "n", "set")
    own = placed.select("least", cut.alias("cut"), member.alias("m"))
    led = placed.where("node = first and cuts > 1").select("least", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"), member.alias("m"))
    return own.unionByName(led).groupBy("least", "cut").agg(F.collect_set("m").alias("members")).select(F.monotonically_increasing_id().alias("g"), "members")


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of links that make a spanning forest."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    out = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append(i)
    return out


class Group:
    """The members of a group and its row of the matrix, with the members of each token."""

    def __init__(self, members: list, comps: list | None):
        self.node = np.array([m["node"] for m in members], dtype=np.int64)
        self.n = np.array([m["n"] for m in members], dtype=np.int64)
        self.comp = self.node if comps is None else np.array(comps, dtype=np.int64)
        sets = [np.asarray(m["set"], dtype=np.int64) for m in members]
        token, member = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.n)
        order = np.argsort(token, kind="stable")
        self.sets, self.member = sets, member[order]
        self.union, self.start = np.unique(token[order], return_index=True)
        self.stop = np.append(self.start[1:], len(token))

    def links(self, other: Group) -> tuple[np.ndarray, np.ndarray]:
        """Places of linked queries (of ``other``) and members, among those not in one component yet."""
        q, m = [], []
        for i, s in enumerate(other.sets):
            at = np.searchsorted(self.union, s)
            at[at == len(self.union)] = 0
            at = at[self.union[at] == s]
            if len(at) < needed(other.n[i]):
                continue  # the bound: no member can have more of the query
            many = self.stop[at] - self.start[at]
            rows = self.member[np.repeat(self.start[at] - np.cumsum(many) + many, many) + np.arange(many.sum())]
            both = np.bincount(rows, minlength=len(self.n))
            linked = (LEAST[1] * both >= LEAST[0] * (self.n + other.n[i] - both)) & (self.comp != other.comp[i])
            at = np.flatnonzero(linked)
            q.append(np.full(len(at), i))
            m.append(at)
        return (np.concatenate(q), np.concatenate(m)) if q else (np.empty(0, dtype=np.int64),) * 2


def _linked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of rows that hold one group (``members``) or two (and ``others``, ``comps``, ``other_comps``)."""
    for f in frames:
        for r in f.to_dict("records"):
            one = Group(r["members"], r.get("comps"))
            two = Group(r["others"], r["other_comps"]) if "others" in r else one
            q, m = one.links(two)
            a, b = one.node[m], two.node[q]
            at = _forest(one.comp[m], two.comp[q])
            if at:
                yield pd.DataFrame({"a": a[at], "b": b[at]})


def joined(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    spark = docs.sparkSession
    keys, _ = saved(keyed(docs), "keys")
    sets, sets_path = saved(candidates(docs, keys), "sets")
    groups, groups_path = saved(grouped(sets), "groups")
    inside, _ = saved(groups.select("members").mapInPandas(_linked, "a long, b long"), "links")
    comps, comps_path = saved(components(inside), "components")

    # the matrix of what is left: tokens by the number of groups that hold them
    rows = groups.select("g", F.explode("members").alias("m")).select("g", F.col("m.node").alias("node"), F.col("m.n").alias("n"), F.col("m.set").alias("set"))
    entry = rows.select("g", F.explode("set").alias("token")).distinct()
    held = entry.groupBy("token").agg(F.count("*").alias("groups")).where("groups > 1")
    shared = rows.select("g", "node", "n", F.explode("set").alias("token")).join(held, "token")
    sorted_ = F.array_sort(F.collect_list(F.struct("groups", "token")))
    spare = F.col("n") - F.ceil(F.col("n") * LEAST[0] / LEAST[1]) + 1
    own = F.col("n") - F.size("rare")  # tokens of this group alone come first in the order
    first = (shared.groupBy("g", "node", "n").agg(sorted_.alias("rare")).where(own < spare)
             .select("g", F.explode(F.slice("rare", F.lit(1), (spare - own).cast("int"))).alias("r")).select("g", F.col("r.token").alias("token")).distinct())
    first, first_path = saved(first, "first")
    at = groups.select("g", F.explode("members").alias("m")).select("g", F.col("m.node").alias("node")).join(comps, "node", "left").groupBy("g").agg(
        F.collect_set(F.struct("node", F.coalesce("component", "node").alias("component"))).alias("of"))
    at = at.withColumn("single", F.when(F.expr("array_min(of.component) = array_max(of.component)"), F.expr("array_min(of.component)")))
    at, at_path = saved(at, "at")
    single = at.select("g", "single")
    side = first.join(single, "g")
    pairs = (side.alias("x").join(side.alias("y"), "token").where("x.g < y.g and (x.single is null or y.single is null or x.single <> y.single)")
             .select(F.col("x.g").alias("g"), F.col("y.g").alias("h")).distinct())
    comp_of = F.expr("transform(members, m -> element_at(map_from_entries(of), m.node))")
    full = groups.join(at.select("g", "of"), "g").select("g", "members", comp_of.alias("comps"))
    other = full.select(F.col("g").alias("h"), F.col("members").alias("others"), F.col("comps").alias("other_comps"))
    across = pairs.join(full, "g").join(other, "h").select("members", "comps", "others", "other_comps").mapInPandas(_linked, "a long, b long")
    more, _ = saved(inside.unionByName(across), "links")
    comps, _ = saved(components(more), "components")
    dropped(spark, sets_path, groups_path, comps_path, first_path, at_path)

    node = keys.where("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
    out = keys.join(node, ["k1", "k2"], "left").join(comps, "node", "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return out.select("doc_id", "n_shingles", F.when(linked, F.coalesce("component", "node")).otherwise(F.col("doc_id")).alias("component_id"))
