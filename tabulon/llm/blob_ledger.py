"""Operator 7: secret scans with an incremental blob ledger.

Every version of every path is addressed by the sha-256 of its content. The ledger
holds the (blob, rule, rule version) triples that were scanned before; a run scans
only the unseen ones, one scan per distinct content however many paths hold it, and
joins findings back to all paths that ever held the blob.

Defined results: a null text counts as empty, an empty text has no findings, an empty
table gives empty findings and an empty ledger; equal versions share one scan; further
columns of the input are ignored. Findings carry the version of their rule: once a rule's
version is raised and its blobs are scanned again, what older versions found no longer
counts, also where the newer one finds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import batched, saved, texts


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` holds the value, which needs ``least`` characters; ``hint`` must occur for a match, with ``fold`` in any case (it is lower-case then)."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1
    hint: str = ""
    fold: bool = False


#: Base kinds, in the order in which equal starts are listed.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, hint="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
#: Kinds that the method adds.
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="-----BEGIN"),
    Rule("bearer", r"(?i:bearer)\x20+([A-Za-z0-9._~+/-]{20,}=*)", version=2, group=1, least=20, hint="bearer", fold=True),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\s/:@]+:([^\s/@]+)@", group=1, hint="://"),
)
RULES = BASE + EXTRA
SPAN = "kind:string,rule_version:int,start:int,end:int"


class Scanner:
    """All spans of some rules in a text: leftmost, non-overlapping per rule, failing matches dropped."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern, re.ASCII)) for r in rules]

    def spans(self, text: str, wanted: set[str] | None = None) -> list[tuple[int, int, str]]:
        found, low = [], None
        for at, (rule, pattern) in enumerate(self.rules):
            if wanted is not None and rule.kind not in wanted:
                continue
            if rule.fold and low is None:
                low = text.lower()
            if rule.hint and rule.hint not in (low if rule.fold else text):
                continue
            found += [(m.start(), at, m.end(), rule.kind) for m in pattern.finditer(text)
                      if len(m[rule.group]) >= rule.least]
        return [(start, end, kind) for start, _, end, kind in sorted(found)]


def versions(docs: DataFrame) -> DataFrame:
    """``path, blob, text``: every row of a documents table as a version of the path ``doc_id``."""
    t = texts(docs).withColumn("text", F.coalesce("text", F.lit("")))
    return t.select(F.col("doc_id").alias("path"), F.sha2(F.encode("text", "UTF-8"), 256).alias("blob"), "text")


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], "blob string, kind string, rule_version int")


def unseen(history: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, path, kinds``: distinct contents with rules not yet run on them; ``path`` is one holder."""
    spark = history.sparkSession
    blobs = history.groupBy("blob").agg(F.min("path").alias("path"))
    current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version")) for r in rules])
    done = ledger.groupBy("blob").agg(F.collect_set(F.struct("kind", "rule_version")).alias("done"))
    left = blobs.join(done, "blob", "left")
    kinds = F.transform(F.array_except(current, F.coalesce("done", F.array_except(current, current))), lambda x: x["kind"])
    return left.select("blob", "path", kinds.alias("kinds")).where(F.size("kinds") > 0)


def scan(history: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings, ledger increment) of the unseen (blob, rule version) pairs.

    Findings: ``blob, spans`` for blobs with any span, each with its rule's version. The increment has a row for every
    pair scanned now; append it to the ledger once the findings are stored. Contents
    travel to their distinct blob by path id: the text is shuffled once, next to ids.
    """
    spark = history.sparkSession
    todo, _ = saved(unseen(history, ledger if ledger is not None else empty_ledger(spark), rules), "unseen")
    scanner_rules = tuple(rules)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(scanner_rules)
        of = {r.kind: r.version for r in scanner_rules}
        for f in batched(frames):
            rows = []
            for blob, text, kinds in zip(f["blob"], f["text"], f["kinds"], strict=True):
                got = scanner.spans(text, set(kinds))
                if got:
                    rows.append((blob, [{"kind": k, "rule_version": of[k], "start": s, "end": e} for s, e, k in got]))
            yield pd.DataFrame(rows, columns=["blob", "spans"])

    holders = todo.select(F.col("path").alias("holder"), F.col("blob").alias("todo_blob"), "kinds")
    content = history.join(holders.hint("shuffle_hash"), (F.col("blob") == F.col("todo_blob")) & F.col("path").eqNullSafe(F.col("holder")))
    findings = content.select("blob", "text", "kinds").mapInPandas(run, f"blob string, spans array<struct<{SPAN}>>")
    version = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    done = todo.select("blob", F.explode("kinds").alias("kind")).select("blob", "kind", version[F.col("kind")].alias("rule_version"))
    return findings.dropDuplicates(["blob"]), done


def current(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, spans`` with one row per blob: the findings of all passes under the versions that ``rules`` have now.

    A rule that was scanned again under a raised version replaces what it found before;
    kinds that ``rules`` lack are left out. Spans are in order of their start, then as
    the kinds are listed. A blob has a row per pass that found something in it, so at
    most one per rule version.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    now = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    valid = F.filter("spans", lambda x: F.coalesce(now[x["kind"]] == x["rule_version"], F.lit(False)))
    keyed = F.transform(valid, lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("at"), x["end"].alias("end"),
                                                  x["kind"].alias("kind"), x["rule_version"].alias("rule_version")))
    rows = findings.select("blob", keyed.alias("keyed")).groupBy("blob").agg(F.flatten(F.collect_list("keyed")).alias("keyed"))
    spans = F.transform(F.array_sort(F.array_distinct("keyed")), lambda x: F.struct(
        x["kind"].alias("kind"), x["rule_version"].alias("rule_version"), x["start"].alias("start"), x["end"].alias("end")))
    return rows.select("blob", spans.alias("spans")).where(F.size("spans") > 0)


def joined_back(history: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``path, blob, spans`` of every version, once; ``spans`` is empty where nothing is found by the rules as they are now."""
    found = current(findings, rules)
    out = history.select("path", "blob").join(found, "blob", "left")
    empty = F.array().cast(found.schema["spans"].dataType)
    return out.select("path", "blob", F.coalesce("spans", empty).alias("spans"))


def scanned(deliveries: list[DataFrame], rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings, ledger) of histories that come in one after the other, both written tables.

    Each pass reads the ledger that the passes before it have written and scans what is
    not in it. Its findings are stored before its increment.
    """
    findings, ledger = None, empty_ledger(deliveries[0].sparkSession)
    for history in deliveries:
        found, done = scan(history, ledger, rules)
        found, _ = saved(found, "findings")
        done, _ = saved(done, "ledger")
        findings = found if findings is None else findings.unionByName(found)
        ledger = ledger.unionByName(done)
    return findings, ledger


def delivered(history: DataFrame, n: int = 2) -> list[DataFrame]:
    """The versions in ``n`` deliveries, by path."""
    part = F.pmod(F.xxhash64("path"), F.lit(n))
    return [history.where(part == i) for i in range(n)]


def digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, sha-256 of the base spans, all spans as text.

    The rows are scanned as two deliveries: a content of the second that the first held
    too is not scanned again.
    """
    history = versions(docs)
    found, _ = scanned(delivered(history))
    rows = joined_back(history, found)
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin([r.kind for r in BASE]))
    return rows.select(
        F.col("path").alias("doc_id"), of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(F.encode(text(base), "UTF-8"), 256).alias("base_sha256"), text("spans").alias("spans"), "blob")
