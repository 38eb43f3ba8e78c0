"""What the review of the second round found."""

import itertools
import random

from llm_fixtures import SF_SMALL
from tabulon.llm import blob_ledger, decontam, surrogates


# -- 10 ----------------------------------------------------------------------------------
def test_surrogates_move_every_letter():
    """No letter of any script is outside the alphabets, and none is in two."""
    letters = [c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isdecimal()]
    assert all(surrogates.placed(c) and surrogates.placed(c)[0][surrogates.placed(c)[1]] == c for c in letters)
    assert all(len(surrogates.placed(c)[0]) > 1 for c in letters)
    assert sum(map(len, surrogates.ALPHABETS)) == len(set("".join(surrogates.ALPHABETS)))


def test_surrogates_are_one_cycle():
    """All entities of a small shape are permuted, none stays."""
    s = surrogates.Surrogates(b"k")
    shapes = [("name", [a + b for a in "BCDFGHJKLMNPQRSTVWXYZ" for b in "aeiou"]), ("name", list("àèìòù")), ("name", ["çç", "çñ", "ñç", "ññ"]),
              ("email", [f"{c}@-.com" for c in surrogates.MARKS]), ("ip", [f"192.168.{i}.0{j}" for i in range(256) for j in range(10)]),
              ("ip", [f"172.{a}.0{b}.0{c}" for a in range(16, 32) for b in range(10) for c in range(10)]),
              ("iban", [f"GB{i:02d}WEST1234569876543{j}" for i in range(100) for j in range(2)])]
    for kind, all_of in shapes:
        new = [s.of(kind, x) for x in all_of]
        assert len(set(new)) == len(new) and all(a != b for a, b in zip(new, all_of, strict=True)), kind
        if kind in ("name", "ip"):
            assert sorted(new) == sorted(all_of)
    hosts = ["".join(x) + ".example" for x in itertools.product("bcd", "ae")]
    domains = [h + ".com" for h in hosts] + ["".join(x) + ".com" for x in itertools.product("bcd", "ae")]
    assert len({s.of("email", "a@" + d) for d in domains}) == len(domains)
    assert s.of("ip", "1.2.3.4") != s.of("ip", "01.2.3.4")


def test_surrogates_of_other_scripts(spark):
    rows = [(1, "Dr 李伟 came"), (2, "Dr 王芳 came"), (3, "Mr Łß left"), (4, "Mr ש"), (5, "ip 01.2.3.4 1.2.3.4"), (6, "_@-.com")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    new = dict(surrogates.masked(docs, b"k").select("doc_id", "text").collect())
    assert all(new[i] != t for i, t in rows) and len(set(new.values())) == len(rows)


# -- 7 -----------------------------------------------------------------------------------
def test_hints_miss_nothing():
    """A hint never hides what its pattern finds, in any case of letters."""
    scanner = blob_ledger.Scanner(blob_ledger.RULES)
    for text in ("BEARER abcdefghijklmnopqrstuvwx", "bEaReR abcdefghijklmnopqrstuvwx", "HTTPS a://b:c@d -----BEGIN PRIVATE KEY----- AKIA" + "B" * 16):
        for rule, pattern in scanner.rules:
            found = [m.span() for m in pattern.finditer(text) if len(m[rule.group]) >= rule.least]
            assert [(s, e) for s, e, k in scanner.spans(text) if k == rule.kind] == found, (rule.kind, text)
    assert [k for _, _, k in scanner.spans("BEARER abcdefghijklmnopqrstuvwx")] == ["bearer"]


def test_query_reads_its_ledger_back(spark, monkeypatch):
    """The query's second pass gets the first one's written increment and scans only what is not in it."""
    rows = [(i, f"token=secret-value-{i % 7} BEARER abcdefghijklmnopqrstuvwx") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    passes, scan = [], blob_ledger.scan

    def watched(history, ledger=None, rules=blob_ledger.RULES):
        out = scan(history, ledger, rules)
        passes.append((0 if ledger is None else ledger.count(), out[1].count()))
        return out

    monkeypatch.setattr(blob_ledger, "scan", watched)
    got = blob_ledger.digest(docs).collect()
    assert passes == [(0, 7 * len(blob_ledger.RULES)), (7 * len(blob_ledger.RULES), 0)]
    assert len(got) == 60 and all(r["n_assign"] == 1 and r["spans"].count("bearer") == 1 for r in got)


# -- 2 -----------------------------------------------------------------------------------
def near_by_hand(doc, item, slop, window=13):
    """Whether every word of some window has a place of its own, places running ahead by amounts within ``slop``."""
    w, b = doc.split(), item.split()

    def fits(terms, base, j=0, used=()):
        return j == len(terms) or any(
            k not in used and 0 <= k < len(w) and w[k] == terms[j] and fits(terms, base, j + 1, (*used, k)) for k in range(base + j, base + j + slop + 1))

    cuts = [b[i:i + window] for i in range(max(1, len(b) - window + 1))]
    return any(fits(t, base) for t in cuts for base in range(-len(t), len(w)))


def test_proximity_is_confirmed_on_the_words(spark):
    r = random.Random(6)
    item = [f"r{i}" for i in range(13)]
    texts = [[*item[:1], "gap", "gap", *item[1:]], [*item[:3], "gap", *item[3:8], "gap", *item[8:]], [*item[:4], item[5], item[4], *item[6:]],
             [item[0], *["odd"] * 5, item[6], *["odd"] * 5, item[12]], [*item[:1], *["gap"] * 4, *item[1:]], item[:12]]
    for _ in range(40):
        t = list(item)
        for _ in range(r.randrange(1, 5)):
            i = r.randrange(len(t))
            t[i:i + r.randrange(2)] = r.choice([["gap"], [t[i], t[i]], [r.choice(item)]])
        texts.append(t)
    docs = [(i, "x y " + " ".join(t) + " z") for i, t in enumerate(texts)]
    bench = [(1, " ".join(item)), (2, "gap gap gap r3"), (3, "odd")]
    for slop in (1, 3):
        found = decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"), slop=slop)
        got = {(x["k1"], x["item_id"]) for x in found.collect()}
        assert got == {(i, b) for i, t in docs for b, s in bench if near_by_hand(t, s, slop)}, slop
    assert {(0, 1), (1, 1), (2, 1)} <= got and not got & {(3, 1), (4, 1), (5, 1)}


def test_proximity_runs_in_a_query(spark):
    import __spark_entry__
    queries = __spark_entry__.queries()
    exact, close = queries["op2_decontam"](spark, SF_SMALL), queries["decontam_proximity"](spark, SF_SMALL)
    assert close.columns == [*exact.columns, "n_near_items"]
    assert sorted(map(tuple, close.drop("n_near_items").collect())) == sorted(map(tuple, exact.collect()))
