"""Operators 11 to 13 against brute force, on hostile and on empty tables; the packing of special words, null items."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from brute import low, split
from llm_fixtures import SF_SMALL, empty, hostile  # noqa: F401
from tabulon.llm import collocations, decontam, exact_packing, jaccard_groups, source_audit
from tabulon.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string"


# ---------------------------------------------------------------- 11
def linked(rows, num=80, den=100):
    sets = {}
    for i, t in rows:
        w = split(low(t))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    edges = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if (n := len(sets[a] & sets[b])) and den * n >= num * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(comp[a], comp[b])
            if comp[a] != m or comp[b] != m:
                comp[a] = comp[b] = m
                changed = True
    return {i: (len(sets[i]), comp[i]) for i in sets}


def copies(seed, bases, each, words=60, vocabulary=500):
    """Texts with copies in which a few words changed: many pairs near the threshold, a shared passage, exact copies."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(vocabulary)}"
    passage = [word() for _ in range(12)]
    texts = []
    for _ in range(bases):
        base = [word() for _ in range(words)]
        if r.random() < 0.5:
            base[5:17] = passage
        for _ in range(each):
            t = list(base)
            for _ in range(r.randrange(4)):
                t[r.randrange(len(t))] = word()
            texts.append(" ".join(t))
    texts += texts[:5] + ["", " ", "one two", "one two", "one two three four five six"]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("members", [256, 60])
def test_join_against_brute_force(spark, monkeypatch, members):
    """Also with groups of a few members, so that crowds lie in many groups."""
    monkeypatch.setattr(jaccard_groups, "MEMBERS", members)
    rows = copies(1, 6, 25) + [(1000 + i, t) for i, t in copies(2, 30, 3, words=25)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == linked(rows)


def test_small_sets_link_outside_the_sample(spark):
    """Sets of four to six shingles, of which often none that both hold lies in the sample."""
    r = random.Random(8)
    rows = []
    for i in range(150):
        words = [f"v{r.randrange(10**6)}" for _ in range(9)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-1]))]
    assert sum(c != i for i, (_, c) in linked(rows).items()) == 150
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == linked(rows)


def test_bound_opens_every_group_it_must():
    r = np.random.default_rng(3)
    members = [{"node": i, "n": 40, "set": sorted(r.choice(90, 40, replace=False).tolist())} for i in range(30)]
    members += [{"node": 100 + i, "n": 40, "set": sorted({*m["set"][:37], 200 + i, 300 + i, 400 + i})} for i, m in enumerate(members)]
    one, two = jaccard_groups.Group(members[:30], None), jaccard_groups.Group(members[30:], None)
    q, m = one.links(two)
    want = {(i, j) for i, a in enumerate(members[30:]) for j, b in enumerate(members[:30])
            if 100 * len(n := set(a["set"]) & set(b["set"])) >= 80 * (80 - len(n))}
    assert set(zip(q.tolist(), m.tolist())) == want and len(want) >= 30


# ---------------------------------------------------------------- 12
def audit(rows, ranks=10, least=10):
    import re
    term = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t or ""))
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, t, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        docs[lang].update(set(term(t)))
        count[lang, source].update(term(t))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        every = Counter()
        for s in sources:
            every.update(count[lang, s])
        total = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (count[lang, s][t] + 2) // (total[s] + 2 * len(kept)) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (every[t] + 2) // (sum(total.values()) + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k) for k, (v, i) in enumerate(ordered, 1) if part == "pair" or k <= ranks]
    return sorted(out)


def sourced(seed, n=150):
    r = random.Random(seed)
    words = ["river", "Stone", "naïve", "été", "дом", "x1y", "door", "of", "light", "a", "b", "c", "ΑΒ", "zeta"] + [f"t{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(r.choice(words[:r.choice([6, 14, 34])]) for _ in range(r.choice([0, 4, 25]))), r.choice(["en", "fr", None, ""]), r.choice(["s1", "s2", "s3", None, "é"]))
            for i in range(n)]
    return [*rows, rows[0], rows[1], (None, None, "en", "s9"), (None, "only here", "xx", "s1"), (1, "", "xx", "s2"), (5, "river " * 500, "fr", "s1")]


def test_audit_against_brute_force(spark, monkeypatch):
    rows = sourced(4)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = lambda: sorted(tuple(r) for r in source_audit.divergence(docs.repartition(5)).collect())
    want = audit(rows)
    assert got() == want
    monkeypatch.setattr(source_audit, "SOURCES", 2)  # several blocks of sources, chunks of terms and flushes
    monkeypatch.setattr(source_audit, "TERMS", 4)
    monkeypatch.setattr(source_audit, "HELD", 20)
    monkeypatch.setattr(source_audit, "BUFFERED", 30)
    assert got() == want


def test_skyband_keeps_the_leading_terms():
    r = np.random.default_rng(6)
    for _ in range(20):
        n, other = r.integers(1, 12, 400), r.integers(1, 12, 400)
        term = np.array([f"{x:04d}" for x in r.permutation(400)], dtype=object)
        band = set(source_audit._band(n, other, term, 3).tolist())
        dominated = [sum(n[j] >= n[i] and other[j] <= other[i] and term[j] < term[i] for j in range(400)) for i in range(400)]
        assert band == {i for i in range(400) if dominated[i] < 3}


def test_weights_are_exact():
    n = np.array([0, 1, 12345678901, 8_999_999_999_999_000], dtype=np.int64)
    total = np.full(4, 9_000_000_000_000_000, dtype=np.int64)
    assert source_audit._weights(n, total).tolist() == [1 + 10**9 * (int(x) + 2) // 9_000_000_000_000_000 for x in n]
    with pytest.raises(ValueError):
        source_audit._weights(n, total + 1)


# ---------------------------------------------------------------- 13
def mined(rows, least=30, top=2000):
    import re
    f, n, starts, ends = defaultdict(Counter), Counter(), defaultdict(Counter), defaultdict(Counter)
    for _, t, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(t or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    p = tuple(w[i:i + k])
                    f[lang][p] += 1
                    starts[lang][p] += i == 0
                    ends[lang][p] += i + k == len(w)
    out = []
    for lang in f:
        c = {p: a for p, a in f[lang].items() if a >= least and len(p) > 1}
        inside = lambda p, x: len(x) > len(p) and any(x[i:i + len(p)] == p for i in range(len(x) - len(p) + 1))
        found = []
        for p, a in c.items():
            if any(inside(p, x) and 100 * c[x] >= 80 * a for x in c):
                continue
            cuts = [(2_000_000 * a // (f[lang][p[:k]] + f[lang][p[k:]]), k, f[lang][p[:k]], f[lang][p[k:]]) for k in range(1, len(p))]
            s, _, left, right = min(cuts)
            found.append((-s, -a, " ".join(p).encode(), left, right, starts[lang][p], ends[lang][p]))
        out += [(lang, k, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0], x[5], x[6]) for k, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def spoken(seed, n=200):
    r = random.Random(seed)
    fixed = ["the old river", "of the stone door", "naïve light", "a b c d"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randrange(12)):
            parts.append(r.choice(fixed) if r.random() < 0.6 else " ".join(r.choice(["the", "Of", "stone", "x", "y", "дом"]) for _ in range(r.randrange(1, 6))))
            parts.append(r.choice([" ", "  ", "\t", ", ", ".\n", "!?", "\r\n"]))
        rows.append((i, "".join(parts), r.choice(["en", "fr", None, ""]), "s"))
    return [*rows, rows[3], (None, None, "en", None), (None, "the old river. the old river", None, None), (7, "a b c d " * 700, "fr", None)]


@pytest.mark.parametrize("shard", [1 << 20, 300])
def test_collocations_against_brute_force(spark, monkeypatch, shard):
    if shard == 300:  # also with the extensions of frequent phrases dealt out
        monkeypatch.setattr(collocations, "SALTED", 50)
    rows = spoken(9)
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(4), shard=shard, top=40)
    assert sorted(tuple(r) for r in got.collect()) == mined(rows, top=40)


def test_index_steps_against_counting():
    r = np.random.default_rng(2)
    s = np.append(r.integers(0, 5, 400), 0).astype(np.int32)
    shard = collocations.Shard(collocations.transform(s).astype(np.int64), collocations.transform(s[::-1]).astype(np.int64))
    n = np.bincount(s, minlength=5)
    level = {(w,): (int(n[:w].sum()), int(n[:w].sum()), int(n[w])) for w in range(1, 5)}
    for d in range(2, 5):
        keys = list(level)
        lo, r_lo, many = (np.array([level[k][i] for k in keys]) for i in range(3))
        node, word, new, r_new, c = shard.left(lo, r_lo, many)
        level = {(int(w), *keys[i]): (int(a), int(b), int(m)) for i, w, a, b, m in zip(node, word, new, r_new, c)}
        want = Counter(p for i in range(len(s) - d + 1) if 0 not in (p := tuple(s[i:i + d].tolist())))
        assert {k: v[2] for k, v in level.items()} == want
        starts, ends = shard.edges(*(np.array([v[i] for v in level.values()]) for i in range(3)))
        t = s.tolist()
        for p, a, b in zip(level, starts.tolist(), ends.tolist()):
            at = [i for i in range(len(t) - d + 1) if tuple(t[i:i + d]) == p]
            assert a == sum(i == 0 or t[i - 1] == 0 for i in at) and b == sum(t[i + d] == 0 for i in at)


def test_blocks_round_trip():
    r = np.random.default_rng(1)
    c = {k: np.sort(r.integers(0, 1 << (60 if t is np.int64 else 30), 1000)).astype(t) for k, t in collocations._FIELDS}
    back = collocations._unblocked(collocations._block(c))
    assert all((back[k] == v).all() for k, v in c.items())


# ---------------------------------------------------------------- all
MORE = {"join": jaccard_groups.joined, "audit": source_audit.divergence, "collocations": collocations.collocations}


@pytest.mark.parametrize("name", MORE)
def test_hostile_and_empty(spark, hostile, empty, name):
    got = MORE[name](hostile).collect()
    if name == "join":
        assert len(got) == hostile.count()
        assert all(r.component_id is None for r in got if r.doc_id is None)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got}[104][1] == 103
        assert {(r.n_shingles, r.component_id) for r in got if r.doc_id in (100, 101, 102)} == {(0, i) for i in (100, 101, 102)}
    else:
        rows = [(r.doc_id, r.text, r.lang, r.source) for r in hostile.collect()]
        assert sorted(tuple(r) for r in got) == (audit(rows) if name == "audit" else mined(rows))
    assert MORE[name](empty).collect() == []


def test_special_words_are_packed_as_the_tokenizer_reads_them(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_file())
    rows = [(1, "a <|endoftext|> b"), (2, "abc<|endoftext|>def\n<|startoftext|>hi"), (3, "plain words here")]
    got = {r.doc_id: r.length for r in exact_packing.tokenised(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_file()).collect()}
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}


def test_a_full_word_cache_changes_nothing():
    small, r = exact_packing.WordTokens(tokenizer_file(), 500), random.Random(4)
    texts = [" ".join(f"word{r.randrange(200)}" for _ in range(40)) for _ in range(30)]
    got = [small.ids(t) for t in texts]
    small.forget()
    assert len(small.known) < 40 and got == [exact_packing.WordTokens(tokenizer_file()).ids(t) for t in texts]


def test_null_item_is_counted_and_not_named(spark):
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "two three"), (7, "three four"), (8, "absent words")], "item_id long, text string")
    r = decontam.judged(docs, bench, near=False).first()
    import hashlib
    assert (r.n_hit, r.n_items, r.items_sha256) == (3, 2, hashlib.sha256(b"7").hexdigest())
