"""Operator 2: benchmark decontamination with a distributed positional inverted index.

Benchmark items are cut into windows (13 words; a shorter item is one window). The index
holds (term, document, position) postings of the training tokens for the terms that the
test side asks for: of every window its three rarest terms by corpus frequency. Lists
are intersected from the rarest term on, shifted by the terms' distances in the window,
off by at most ``slop``. With all shifts exact the window is a phrase candidate, else a
proximity candidate; both are confirmed on all words of the window in the document. A
proximity match has every word of the window, each at a place of its own, and from word
to word the places in the document run ahead of those in the window by amounts that lie
within ``slop`` of each other: words put in between, or words that changed places.

Everything is DataFrame functions. Test-side tables are broadcast only after a count
shows them to be small (``common.if_small``), otherwise the same joins shuffle.

Defined results: a null text has no words, documents and items without words match
nothing; equal rows are judged each, rows that share an id by their own text, a null
id like any other; items with a null item_id count as one item, which the digest of the
ids leaves out; empty tables give an empty result or no matches. Further columns are
ignored.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import if_small, saved

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing A-Z
WINDOW, ANCHORS, SLOP = 13, 3, 3


def words(text) -> F.Column:
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), BETWEEN), "")


def n_words(text) -> F.Column:
    """As many as ``words`` has, without lower-casing."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), ""))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, k1, k2, text``: two longs that tell rows apart by id and text, nulls included."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k1"),
        F.xxhash64("text", F.col("doc_id").isNull()).alias("k2"), "text")


def windows(bench: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(``wid, terms`` of distinct windows, ``item_id, wid``)."""
    items = bench.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    cut = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("terms"))
    cut, _ = saved(cut.withColumn("wid", F.md5(F.encode(F.concat_ws(" ", "terms"), "UTF-8"))), "windows")
    return cut.select("wid", "terms").dropDuplicates(["wid"]), cut.select("item_id", "wid").distinct()


def rarest_first(keys: DataFrame, wins: DataFrame) -> DataFrame:
    """Windows all of whose terms occur, with their rarest terms: ``wid, terms, o1, t1, t2, g2, t3, g3``; ``g`` is the distance from the first."""
    terms, _ = saved(wins.select(F.explode("terms").alias("term")).distinct(), "terms")
    freq = keys.select(F.explode(words(F.col("text"))).alias("term")).join(if_small(terms), "term", "left_semi").groupBy("term").count()
    at = wins.select("wid", F.size("terms").alias("n"), F.posexplode("terms").alias("o", "term")).join(freq, "term")
    ranked = at.groupBy("wid", "n").agg(F.array_sort(F.collect_list(F.struct("count", "o", "term"))).alias("r")).where(F.size("r") == F.col("n"))
    get = lambda i, f: F.get(F.col("r"), F.lit(i))[f]
    cols = [get(0, "o").alias("o1"), get(0, "term").alias("t1")]
    for i in range(1, ANCHORS):
        cols += [get(i, "term").alias(f"t{i + 1}"), (get(i, "o") - get(0, "o")).alias(f"g{i + 1}")]
    live, _ = saved(ranked.select("wid", *cols).join(wins, "wid"), "live")
    return live


def index(keys: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional inverted index of some terms: ``term, k1, k2, pos``, a written table; equal rows have their postings once."""
    tokens = keys.select("k1", "k2", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    wanted, _ = saved(terms, "wanted")
    postings, _ = saved(tokens.join(if_small(wanted), "term", "left_semi").select("term", "k1", "k2", "pos").distinct(), "index")
    return postings


def intersected(postings: DataFrame, live: DataFrame, slop: int) -> DataFrame:
    """``k1, k2, p1, off`` and the anchors' shape: where all anchors stand at their distances, off by ``off`` in all."""
    shape = ["t1", *[c for i in range(2, ANCHORS + 1) for c in (f"t{i}", f"g{i}")]]
    shapes, _ = saved(live.select(*shape).distinct(), "shapes")
    rows = postings.join(if_small(shapes), F.col("term") == F.col("t1")).select(
        "k1", "k2", F.col("pos").alias("p1"), *shape, F.lit(0).alias("off"))
    # places asked for are looked up by the one or two cells they lie in
    cell = lambda at: F.floor(at / F.lit(2 * slop + 1))
    for i in range(2, ANCHORS + 1):
        other = postings.select(F.col("term").alias(f"t{i}"), "k1", "k2", F.col("pos").alias("at")).withColumn("cell", cell(F.col("at")))
        want = F.col("p1") + F.col(f"g{i}")
        asked = rows.where(F.col(f"t{i}").isNotNull()).withColumn(
            "cell", F.explode(F.array_distinct(F.array(cell(want - slop), cell(want + slop)))))
        met = asked.join(other, [f"t{i}", "k1", "k2", "cell"]).withColumn("s", F.col("at") - want)
        met = met.where((F.abs("s") <= slop) & (F.col("at") != F.col("p1"))).withColumn("off", F.col("off") + F.abs("s"))
        rows = met.select(*rows.columns).unionByName(rows.where(F.col(f"t{i}").isNull()))
    found, _ = saved(rows.groupBy("k1", "k2", "p1", *shape).agg(F.min("off").alias("off")), "met")
    return found


def ahead(w, terms, base, slop: int) -> F.Column:
    """The places in ``w`` of all ``terms``, none used twice, each 0 to ``slop`` behind its place from ``base`` on; fewer, if some have none."""
    def place(used, j):
        free = F.filter(F.sequence(base + j, base + j + slop), lambda k: (F.get(w, k) == F.get(terms, j)) & ~F.array_contains(used, k))
        return F.concat(used, F.slice(free, 1, 1))

    return F.aggregate(F.sequence(F.lit(0), F.size(terms) - 1), F.array().cast("array<int>"), place)


def matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """``k1, k2, item_id, kind, start, length``: exact phrase matches, and proximity matches of items without one.

    ``k1, k2`` are the keys of ``keyed``; positions count words from 0. A proximity match
    is from the first to the last of its places.
    """
    keys = keyed(docs)
    wins, items = windows(bench, window)
    live = rarest_first(keys, wins)
    needed = reduce(DataFrame.unionByName, [live.select(F.col(f"t{i}").alias("term")) for i in range(1, ANCHORS + 1)])
    postings = index(keys, needed.where("term is not null").distinct())
    met = intersected(postings, live, slop)
    same = reduce(lambda a, b: a & b, [F.col(f"m.{c}").eqNullSafe(F.col(f"l.{c}")) for c in met.columns if c[0] in "tg"])
    spots = met.alias("m").join(if_small(live).alias("l"), same).select(
        "m.k1", "m.k2", (F.col("m.p1") - F.col("l.o1")).alias("start"), "off", "l.wid", F.size("l.terms").alias("n"))

    def on_words(candidates: DataFrame, name: str, *what: str) -> DataFrame:
        """A document's candidates travel to its words, once and without the words of their windows; texts without any stay where they are."""
        asked, _ = saved(candidates.groupBy("k1", "k2").agg(F.collect_set(F.struct(*what)).alias("c")), name)
        held = keys.select("k1", "k2", "text").join(if_small(asked.select("k1", "k2")), ["k1", "k2"], "left_semi")
        return held.join(if_small(asked), ["k1", "k2"]).select("k1", "k2", "c", words(F.col("text")).alias("w"))

    there = F.transform("c", lambda c: F.struct(c["start"].alias("start"), F.slice("w", c["start"] + 1, c["n"]).alias("terms")))
    exact = on_words(spots.where("off = 0 and start >= 0"), "asked", "start", "n").select("k1", "k2", F.explode(there).alias("c")).select(
        "k1", "k2", "c.start", "c.terms", F.md5(F.encode(F.concat_ws(" ", "c.terms"), "UTF-8")).alias("wid"))
    exact = exact.join(if_small(live.select("wid", "terms")), ["wid", "terms"]).select("k1", "k2", "wid", "start", F.size("terms").alias("length")).distinct()
    exact, _ = saved(exact.join(if_small(items), "wid").select("k1", "k2", "item_id", F.lit("exact").alias("kind"), "start", "length").distinct(), "exact")
    if slop == 0:
        return exact
    near = spots.join(if_small(items), "wid").join(exact.select("k1", "k2", "item_id").distinct(), ["k1", "k2", "item_id"], "left_anti")
    # of a document only the words around a candidate go on
    first = lambda c: F.greatest(c["start"] - slop, F.lit(0))
    around = F.transform("c", lambda c: F.struct(
        c["wid"].alias("wid"), first(c).alias("first"), (c["start"] - first(c)).alias("at"),
        F.slice("w", first(c) + 1, c["n"] + 2 * slop).alias("w")))
    cut = on_words(near, "close", "start", "wid", "n").select("k1", "k2", F.explode(around).alias("c")).select("k1", "k2", "c.*")
    cut = cut.join(if_small(live.select("wid", "terms")), "wid")
    cut = cut.withColumn("base", F.explode(F.sequence(F.col("at") - slop, F.col("at"))))
    cut = cut.withColumn("p", ahead(F.col("w"), F.col("terms"), F.col("base"), slop)).where(F.size("p") == F.size("terms"))
    cut, _ = saved(cut.select("k1", "k2", "wid", (F.col("first") + F.array_min("p")).alias("start"), (F.array_max("p") - F.array_min("p") + 1).alias("length")), "near")
    near = cut.join(if_small(items), "wid").join(exact.select("k1", "k2", "item_id").distinct(), ["k1", "k2", "item_id"], "left_anti")
    return exact.unionByName(near.select("k1", "k2", "item_id", F.lit("near").alias("kind"), "start", "length").distinct())


def judged(docs: DataFrame, bench: DataFrame, window: int = WINDOW, slop: int = SLOP, near: bool = True) -> DataFrame:
    """Per row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, the keys ``k1, k2``, with ``near`` also ``n_near_items``."""
    found, _ = saved(matches(docs, bench, window, slop if near else 0), "matches")
    exact, close = found.where("kind = 'exact'"), found.where("kind = 'near'")
    spans = exact.select("k1", "k2", "start", "length").distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "length")).alias("s"))
    covered = F.array_distinct(F.flatten(F.transform("s", lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1))))
    hits = spans.select("k1", "k2", F.size(covered).alias("n_hit"))
    ids = exact.select("k1", "k2", F.col("item_id").cast("string").alias("i")).distinct().groupBy("k1", "k2").agg(
        F.count("*").alias("n_items"), F.concat_ws(",", F.array_sort(F.collect_list("i"))).alias("ids"))
    close = close.select("k1", "k2", "item_id").distinct().groupBy("k1", "k2").agg(F.count("*").alias("n_near_items"))
    rows = keyed(docs).select("doc_id", "k1", "k2", n_words(F.col("text")).cast("long").alias("n_words"))
    for part in (hits, ids, close) if near else (hits, ids):
        rows = rows.join(part, ["k1", "k2"], "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.encode(F.coalesce("ids", F.lit("")), "UTF-8"), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"), "k1", "k2",
        *([F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items")] if near else []))


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the benchmark doesn't contaminate, with their columns."""
    bad, _ = saved(judged(docs, bench, near=False).where("contaminated").select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct(), "contaminated")
    mine = (F.coalesce(F.col("doc_id").cast("long"), F.lit(0)) == F.col("__k1")) & (F.xxhash64("text", F.col("doc_id").isNull()) == F.col("__k2"))
    return docs.join(if_small(bad), mine, "left_anti")
