"""Operators against brute force, round trips and held-out accuracy on small tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llm_fixtures import SF_SMALL
from tabulon.llm import (ann_collision, blob_ledger, decontam, exact_packing, langid, lm_mixing, mil_quality, minhash_dedup,
                         suffix_dedup, surrogates)
from tabulon.llm.common import read_table
from tabulon.llm.queries import QUERIES, tokenizer_file


@pytest.fixture(scope="module")
def documents(spark):
    docs = read_table(spark, SF_SMALL, "documents").cache()
    yield docs
    docs.unpersist()  # plans of other tests must not find it


@pytest.fixture(scope="module")
def rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# -- 1 -----------------------------------------------------------------------------------
def test_lm_base_scores(spark, documents, rows):
    got, want = by_id(lm_mixing.scored(documents)), brute.base_scores(rows)
    for i, (n, known, total, base) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, brute.fold(i) == 1)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0


def test_lm_is_a_distribution():
    """Over all outcomes of a few decisions the probabilities sum to one."""
    rng, state, total = np.random.default_rng(0), lm_mixing.start_state(), 0.0
    q = rng.integers(-2000, 2000, (1, 6, lm_mixing.INPUTS)).astype(np.int16)
    for x in range(64):
        q[0, :, 0] = (q[0, :, 0] & ~np.int16(3)) | np.array([x >> k & 1 for k in range(6)])
        total += 10 ** lm_mixing.coded(np.array([6]), q, state)[0]
    assert total == pytest.approx(1 / 64, rel=1e-3)  # the style is coded first, as one of 64


def test_lm_fits_on_every_training_text(spark):
    """Code lengths and starting state count the bytes and decisions of all texts, with a group's own counts taken out."""
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(["stone", "river", "Door"]) for _ in range(9))) for i in range(400)]
    train = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen, n = lm_mixing.byte_counts(train)
    messages = [lm_mixing.tokens(t) for _, t in rows]
    want = np.bincount(np.frombuffer(b" ".join(b" ".join(m) for m in messages) + b" ", np.uint8), minlength=256)
    assert n == 400 and seen.tolist() == want.tolist()
    code = lm_mixing.Code(seen + 0.01)
    tables = lm_mixing.summed_tables(lm_mixing.gathered(train, seen + 0.01).where("kind > 0"))
    total = lm_mixing.summed_evidence(lm_mixing.evidenced(train, seen + 0.01, spark.sparkContext.broadcast(tables), n))
    steps = [lm_mixing.decisions(lm_mixing.styled(m), code) for m in messages]
    assert total.sum() == sum(int(k.sum()) for k, _, _ in steps) == tables[0].sum()
    assert total.reshape(-1, 2)[:, 1].sum() == sum(int(y.sum()) for _, y, _ in steps)
    state = lm_mixing.fitted_state(total)
    assert np.isfinite(state["weights"]).all() and (state["weights"] != lm_mixing.start_state()["weights"]).any()


def test_lm_learns_and_batches_agree():
    code = lm_mixing.Code(np.ones(256))
    words = [b"stone", b"river", b"door"]
    message = [*random.Random(1).choices(words, k=400), lm_mixing.END]
    tables = [np.zeros(1 << b, np.int16) for b in lm_mixing.SLOT_BITS]
    n, y, slots = lm_mixing.decisions(lm_mixing.numbered([message])[0], code)
    blank = lm_mixing.Scorer(code, tables, lm_mixing.start_state())
    for table, s, b in zip(tables, slots, lm_mixing.SLOT_BITS, strict=True):
        table[:] = lm_mixing.quantised(np.bincount(s, weights=1 - y, minlength=1 << b), np.bincount(s, weights=y, minlength=1 << b))
    taught = lm_mixing.Scorer(code, tables, lm_mixing.start_state())
    other = [*random.Random(2).choices([b"window", b"wall"], k=90), lm_mixing.END]
    both, alone = taught.scores(*lm_mixing.numbered([message, other])), taught.scores(*lm_mixing.numbered([message]))
    assert both[0] == pytest.approx(alone[0], rel=1e-4)
    assert alone[0] > 2 * lm_mixing.Scorer(code, [np.zeros(1 << b, np.int16) for b in lm_mixing.SLOT_BITS], lm_mixing.start_state()).scores(*lm_mixing.numbered([message]))[0]
    assert blank is not None


def test_lm_contexts_cross_word_ends():
    """Inputs of a word: the last 2, 3 and 5 bytes of the message, the word so far, and that with the word before it."""
    code = lm_mixing.Code(np.ones(256))
    assert set(code.length.tolist()) == {8}
    seen = {}
    for before in (b"stone", b"atone", b"of", b"an of"):
        message = [b"x", b"x", b"x", *before.split(), b"river", lm_mixing.END]
        items = lm_mixing.styled(message)
        assert [lm_mixing.bare(t) for t in items] == message
        n, _, slots = lm_mixing.decisions(items, code)
        assert n.tolist() == [8 * (len(t) + 1) for t in message[:-1]] + [8]
        at = int(n[:-2].sum())
        seen[before] = [s[at:at + n[-2]].reshape(-1, 8) for s in slots]

    def same(a, b):  # by input: which of the word's bytes meet the same slots
        return ["".join("=" if (p == q).all() else "." for p, q in zip(x, y, strict=True)) for x, y in zip(seen[a], seen[b], strict=True)]

    assert same(b"stone", b"atone") == ["======", "======", "======", "======", "......"]
    assert same(b"stone", b"of") == [".=====", "..====", "....==", "======", "......"]
    assert same(b"of", b"an of") == ["======", "======", ".=====", "======", "======"]


def test_lm_word_order_counts():
    """Words in the order that was learnt score above the same words turned round, before any update inside the text."""
    code = lm_mixing.Code(np.ones(256))
    words = [b"stone", b"river", b"door", b"wall"]
    learnt = [lm_mixing.tokens(b" ".join(words * 2).decode())] * 50
    tables = [np.zeros(2 << b, np.int32) for b in lm_mixing.SLOT_BITS]
    seen = {}
    for m in learnt:
        lm_mixing.count_styled(m, seen)
    n, y, slots = lm_mixing.decisions(list(seen), code)
    for table, s in zip(tables, slots, strict=True):
        np.add.at(table, s.astype(np.int64) * 2 + y, np.repeat(list(seen.values()), n).astype(np.int32))
    scorer = lm_mixing.Scorer(code, [lm_mixing.quantised(t[0::2], t[1::2]) for t in tables], lm_mixing.start_state())
    order, turned = [*words, lm_mixing.END], [words[0], *words[:0:-1], lm_mixing.END]
    assert lm_mixing.style(order) == lm_mixing.style(turned) == lm_mixing.style(learnt[0])
    a, b = scorer.scores(*lm_mixing.numbered([order, turned]))
    assert a > b + 1


# -- 2 -----------------------------------------------------------------------------------
def test_contamination(spark):
    item = " ".join(f"w{i}" for i in range(30))
    bench = [(1, item), (2, "tiny Item"), (3, "the the the the"), (4, None), (5, ""), (6, item), (7, "w3 w4 w5 " + " ".join(f"x{i}" for i in range(12)))]
    docs = [(1, "a b " + item.upper().replace(" ", "--") + " c"), (2, " ".join(item.split()[:12])), (3, "x tiny, item y" + " z" * 100), (4, "the " * 9),
            (5, None), (6, ""), (7, "tiny item"), (8, " ".join(item.split()[5:25]) + " ü " + item), (9, item.replace("w9 ", "w9 odd "))]
    b = spark.createDataFrame(bench, "item_id long, text string")
    d = spark.createDataFrame(docs, "doc_id long, text string")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, decontam.judged(d, b).select(*cols).collect())) == sorted(brute.contamination(docs, bench))


def test_proximity(spark):
    """Anchors one place off their distance are a proximity match, further ones are none."""
    rare = [f"r{i}" for i in range(13)]
    bench = spark.createDataFrame([(1, " ".join(rare))], "item_id long, text string")
    shifted = " ".join([*rare[:1], "gap", *rare[1:]])
    far = " ".join([*rare[:1], "gap", "gap", "gap", *rare[1:]])
    docs = spark.createDataFrame([(1, " ".join(rare)), (2, shifted), (3, far)], "doc_id long, text string")
    got = {(r["k1"], r["kind"]) for r in decontam.matches(docs, bench, slop=1).collect()}
    assert got == {(1, "exact"), (2, "near")}


# -- 3 and 9 -----------------------------------------------------------------------------
def test_quality_held_out(spark):
    docs, labels = read_table(spark, "/root/testdata/sf0.01", "documents"), read_table(spark, "/root/testdata/sf0.01", "labels")
    got = mil_quality.scored(docs, mil_quality.fitted(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.85
    assert got.score[got.quality == 1].mean() > got.score[got.quality == 0].mean() + 0.3


def test_quality_gradient():
    """Hand-written gradients against differences: one step on one document lowers its loss."""
    text = "A plain passage of words. " * 40 + "!!! ### $$$ " * 30
    m = mil_quality.fit([(text, 0), ("calm words of a letter " * 30, 1)] * 8, epochs=12)
    assert mil_quality.score(m, text) < 0.3 < mil_quality.score(m, "calm words of a letter " * 20)


def test_language_held_out(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    got = langid.identified(docs, langid.fitted(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97
    assert not got.rejected[got.score > 0.5].any()


def test_language_rejects():
    m = langid.fit([("der die das und nicht ist " * 5, "de"), ("the of and that which is " * 5, "en")] * 10)
    assert langid.predict(m, "the and which of")[0] == "en" and langid.predict(m, "nicht und das")[0] == "de"
    assert langid.predict(m, "12 -- !") == ("und", 0.0) == langid.predict(m, None)
    assert not langid.judged(m, "the and which of")[2] and langid.judged(m, "12 -- !")[2]
    assert langid.judged(m, "это совсем другая письменность")[2] and langid._from_bytes(langid._to_bytes(m))["familiar"] == m["familiar"]


# -- 4 -----------------------------------------------------------------------------------
def test_near_duplicates(spark, documents, rows):
    got = by_id(minhash_dedup.near_duplicates(documents))
    for i, (n, c) in brute.near_components(rows).items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, c, i == c), i


def test_chains_and_crowds(spark):
    """A chain of edits is one component although its ends differ; a crowd of near copies needs no pair of each."""
    r = random.Random(9)
    word = lambda: "".join(r.choices("abcdefgh", k=6))
    text, docs = [word() for _ in range(120)], []
    for i in range(20):
        docs.append((i, " ".join(text)))
        for _ in range(2):
            text[r.randrange(len(text))] = word()
    crowd = [word() for _ in range(150)]
    for i in range(100, 180):
        mine = list(crowd)
        mine[r.randrange(len(mine))] = word()
        docs.append((i, " ".join(mine)))
    docs += [(500, docs[3][1]), (501, "few words"), (502, "Few  WORDS"), (503, "")]
    got = by_id(minhash_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {i: (got[i]["n_shingles"], got[i]["component_id"]) for i in got} == brute.near_components(docs)


def test_b_bit_estimate(spark):
    r = np.random.default_rng(1)
    base = [f"w{i}" for i in r.integers(0, 10**6, 2000)]
    docs = [(0, " ".join(base)), (1, " ".join(base[:1800] + [f"v{i}" for i in range(200)])), (2, " ".join(f"u{i}" for i in range(2000)))]
    s = minhash_dedup.sketch(spark.createDataFrame(docs, "doc_id long, text string"))
    got = s.alias("x").crossJoin(s.alias("y")).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), minhash_dedup.estimate("x", "y").alias("e")).collect()
    e = {(x["a"], x["b"]): x["e"] for x in got}
    assert e[0, 0] == 1 and abs(e[0, 1] - 0.81) < 0.2 and abs(e[0, 2]) < 0.2


# -- 5 -----------------------------------------------------------------------------------
def test_substrings(spark, documents, rows):
    got = by_id(suffix_dedup.deduplicated(documents))
    for i, want in brute.substring_dedup(rows).items():
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == want, i


def test_substrings_with_frequent_prefixes(spark, monkeypatch):
    """The dealt-out path gives the same: every prefix counts as frequent."""
    r = random.Random(4)
    passage = [f"p{i}" for i in range(70)]
    docs = []
    for i in range(60):
        own = [f"o{r.randrange(10**6)}" for _ in range(60)]
        docs.append((i, " ".join(own[:30] + passage[r.randrange(15):] + own[30:] + ["x"] * r.choice([0, 120]))))
    docs += [(100 + i, docs[7][1]) for i in range(20)]
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 2)
    got = by_id(suffix_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {i: (x["n_words"], x["n_removed"], x["kept_sha256"]) for i, x in got.items()} == brute.substring_dedup(docs)


# -- 6 -----------------------------------------------------------------------------------
def test_neighbours(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(900, 24))
    x[100:140] = x[100]  # ties
    rows = [(i, [float(v) for v in x[i]]) for i in range(900)]
    odd = [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] * 24), (2060, [None] * 24), (2080, [1.0, 2.0]), (2100, []), (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = ann_collision.nearest(df, F.col("vec_id") % 20 == 0).collect()
    want = brute.nearest(rows, range(0, 900, 20), 20)
    assert {g["query_id"] for g in got} == set(want)
    hits = 0
    for q, best in want.items():
        mine = sorted((g["rank"], g["vec_id"], g["score"]) for g in got if g["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21))
        assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
        assert all(m[2] == pytest.approx(float(x[m[1]] @ x[q]), rel=1e-12) for m in mine)
        hits += len({m[1] for m in mine} & {b for b, _ in best})
    assert hits >= 0.9 * 20 * len(want)
    tied = [g["vec_id"] for g in sorted(got, key=lambda g: g["rank"]) if g["query_id"] == 100]
    assert tied == [i for i in range(101, 121)]


def test_neighbours_recall_on_table(spark):
    e = read_table(spark, "/root/testdata/sf0.01", "embeddings")
    got = ann_collision.nearest(e, F.col("vec_id") % 20 == 0).collect()
    want = brute.nearest([(r["vec_id"], r["embedding"]) for r in e.collect()], sorted({g["query_id"] for g in got}), 20)
    found = sum((g["vec_id"] in {i for i, _ in want[g["query_id"]]}) for g in got)
    assert found >= 0.9 * sum(map(len, want.values()))


# -- 7 -----------------------------------------------------------------------------------
SECRETS = ["token = 'abcdef12'", "PASSWORD: x1 secret=longer-value", "api_key: token : abcdefgh", "AKIA" + "B" * 16 + " AKIAB", "0123456789abcdef01234567 " * 2,
           "ſecret=abcdefgh toKen=abcdefgh", "see https://me:pw1234@host/x and Bearer abcdefghijklmnopqrstuvwx", "", "-----BEGIN RSA PRIVATE KEY-----"]


def test_secret_spans():
    scanner = blob_ledger.Scanner(blob_ledger.RULES)
    for t in SECRETS:
        base = [(k, s, e) for s, e, k in scanner.spans(t) if k in {r.kind for r in blob_ledger.BASE}]
        assert base == brute.base_spans(t), t
    kinds = {k for t in SECRETS for _, _, k in scanner.spans(t)}
    assert kinds == {r.kind for r in blob_ledger.RULES}


def test_ledger_is_incremental(spark):
    docs = spark.createDataFrame([(i, SECRETS[i % len(SECRETS)]) for i in range(30)] + [(50, None)], "doc_id long, text string")
    history = blob_ledger.versions(docs)
    found, done = blob_ledger.scan(history)
    back = blob_ledger.joined_back(history, found).collect()
    assert len(back) == 31 and {r["path"] for r in back if r["blob"] == back[0]["blob"]} >= {back[0]["path"]}
    want = {i: len(brute.base_spans(SECRETS[i % len(SECRETS)])) for i in range(30)}
    assert all(sum(s["kind"] in {"assign", "access", "hex"} for s in r["spans"]) == want.get(r["path"], 0) for r in back)
    assert done.count() == len(SECRETS) * len(blob_ledger.RULES)
    ledger = spark.createDataFrame(done.collect(), done.schema)
    again, more = blob_ledger.scan(history, ledger)
    assert again.isEmpty() and more.isEmpty()
    new = history.unionByName(blob_ledger.versions(spark.createDataFrame([(3, "token=fresh-value-1")], "doc_id long, text string")))
    assert blob_ledger.scan(new, ledger)[1].select("blob").distinct().count() == 1
    raised = tuple(blob_ledger.Rule(r.kind, r.pattern, 2, r.group, r.least, r.hint) if r.kind == "hex" else r for r in blob_ledger.RULES)
    newer, increment = blob_ledger.scan(history, ledger, raised)
    assert {r["kind"] for r in increment.collect()} == {"hex"}
    # both passes' findings: every version of a path once, each span once and under the rules as they are now
    both = blob_ledger.joined_back(history, found.unionByName(newer), raised).collect()
    spans = lambda rows: sorted((r["path"], [(s["kind"], s["start"], s["end"]) for s in r["spans"]]) for r in rows)
    assert spans(both) == spans(back) and {s["rule_version"] for r in both for s in r["spans"] if s["kind"] == "hex"} == {2}
    # a raised rule that finds nothing any more takes its old findings away
    none = tuple(blob_ledger.Rule(r.kind, "never here", 3) if r.kind == "hex" else r for r in blob_ledger.RULES)
    later, _ = blob_ledger.scan(history, ledger, none)
    left = blob_ledger.joined_back(history, found.unionByName(later), none).collect()
    assert spans(left) == [(p, [s for s in f if s[0] != "hex"]) for p, f in spans(back)]


# -- 8 -----------------------------------------------------------------------------------
def test_packing_round_trip(documents, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_file())
    ids = {i: np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in rows}
    got = sorted(map(tuple, exact_packing.packed(documents, tokenizer_file()).collect()))
    want = [(i, p, a, len(x[a:a + 2048]), zlib.crc32(x[a:a + 2048].tobytes())) for i, x in sorted(ids.items()) for p, a in enumerate(range(0, len(x), 2048))]
    assert [g[:5] for g in got] == want
    check_places([(g[5], g[6], g[3]) for g in got], 2048)
    assert len({g[5] for g in got}) <= 1.02 * sum(map(len, ids.values())) / 2048 + 1


def check_places(places, capacity):
    at = {}
    for seq, offset, length in sorted(places):
        assert offset == at.get(seq, 0)
        at[seq] = offset + length
    assert all(x <= capacity for x in at.values())


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    r = random.Random(seed)
    counts = {length: r.randrange(1, 400) for length in r.sample(range(1, 101), r.choice([1, 3, 20, 100]))}
    plan = exact_packing.plan(counts, 100)
    used = {}
    for parts, times in plan:
        assert sum(parts) <= 100 and times > 0
        for p in parts:
            used[p] = used.get(p, 0) + times
    assert used == counts


def test_exact_complements():
    assert sum(t for _, t in exact_packing.plan({60: 5, 40: 5, 50: 4, 30: 2, 45: 2, 25: 2}, 100)) == 9


# -- 10 ----------------------------------------------------------------------------------
def test_surrogates_keep_type():
    s = surrogates.Surrogates(b"k")
    cases = {"ip": "192.168.3.7", "card": "4111 1111 1111 1111", "ssn": "123-45-6789", "phone": "+1 (017) 555-7713", "iban": "GB82WEST12345698765432",
             "email": "Ana.Lee@mail.example.com"}
    for kind, value in cases.items():
        assert s.spans(f"x {value} y") == [(2, 2 + len(value), kind)], kind
        new = s.of(kind, value)
        assert new != value and s.spans(f"x {new} y")[0][2] == kind
    assert s.of("ip", "192.168.3.7").startswith("192.168.")
    card = s.of("card", "4111 1111 1111 1111")
    assert s._luhn(card.replace(" ", "")[:-1]) == int(card[-1]) and card[0] == "4"
    iban = s.of("iban", "GB82WEST12345698765432")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert s.of("email", "ana@mail.example.com").split("@")[1] == s.of("email", "bob@mail.example.com").split("@")[1]


def test_surrogate_names_keep_gender_and_script():
    s = surrogates.Surrogates(b"k")
    for names in surrogates.GIVEN:
        new = [s.of("name", n) for n in names]
        assert sorted(new) == sorted(names) and all(a != b for a, b in zip(names, new, strict=True))
    text, found = s.replaced("Mrs Anna Miller met Mr. Peter Stone; Mrs Anna Miller left. Госпожа Анна Кузнецова тоже. Dr who")
    assert [k for _, _, k in found] == ["name"] * 4
    assert text.count(s.of("name", "Anna Miller")) == 2 and "Miller" not in text
    assert all("а" <= c.lower() <= "я" or c in " ё" for c in s.of("name", "Анна Кузнецова"))


def test_surrogates_are_distinct(spark):
    r = random.Random(5)
    rows = [(i, f"call +1 (555) 555-{r.randrange(10**4):04d} or a{i}@b.org, {r.randrange(1, 223)}.{i % 250}.3.{i // 250}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = surrogates.entities(docs, b"k")
    assert surrogates.collisions(found).isEmpty()
    new = dict(surrogates.masked(docs, b"k").select("doc_id", "text").collect())
    assert all(new[i] != t and len(new[i]) >= len(t) - 12 for i, t in rows)
    clash = spark.createDataFrame([("ssn", "a", "z"), ("ssn", "b", "z"), ("ip", "c", "c")], "kind string, entity string, surrogate string")
    assert surrogates.collisions(clash).count() == 2


def test_clean_texts_stay(documents):
    out = surrogates.masked(documents, b"k").join(documents.select("doc_id", F.col("text").alias("old")), "doc_id")
    assert out.where("size(pii_kinds) = 0 and text <> old").isEmpty()


# -- queries -----------------------------------------------------------------------------
def test_ten_queries():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 11))
