"""Section attribution from a word table, against a plain state machine."""

import random

from tabulon.operators import section_lines as S

KNOWN = {"fin24": "fin24", "fin24c": "fin24c", "internet": "internet_use", "internet_use": "internet_use", "y": "y", "weight": "weight"}


def _machine(lines):
    """[(line, variable)] of (key, …) lines in order."""
    starts = {k[:i] for k in KNOWN for i in range(1, len(k) + 1)}
    current, held, parts, out = None, "", [], []
    for i, key in enumerate(lines):
        name = key.lower()
        if name in KNOWN:
            current, held, parts = KNOWN[name], "", []
            out.append((i, current))
        elif held and name and held + name in starts:
            held += name
            parts.append(i)
            if held in KNOWN:
                current = KNOWN[held]
                out += [(j, current) for j in parts]
                held, parts = "", []
        elif name in starts:
            held, parts = name, [i]
        elif current:
            out.append((i, current))
    return out


def test_against_the_state_machine(spark):
    r = random.Random(8)
    docs = {d: [r.choice(["", "", "fin24", "FIN", "24c", "24", "c", "inter", "net", "_use", "wei", "ght", "zzz", "Y", "internet", "fi", "n"]) for _ in range(60)] for d in range(40)}
    docs[100] = []
    rows = [(d, 1 + i // 25, float(i % 25), k, f"l{i}", "") for d, ks in docs.items() for i, k in enumerate(ks)]
    lines = spark.createDataFrame(rows, "doc_id int, page int, top double, key string, label string, definition string")
    got = sorted((x.doc_id, int(x.label[1:]), x.variable) for x in S.credited_lines(lines, KNOWN).collect())
    assert got == sorted((d, i, v) for d, ks in docs.items() for i, v in _machine(ks))


def test_words_to_entries(spark):
    words = [(2, 10.04, 70.0, "fin24"), (2, 10.02, 160.0, "Saved"), (2, 9.98, 200.0, "money"), (2, 10.0, 300.0, "Past"), (2, 20.0, 71.0, "c"), (2, 20.0, 300.0, "year"),
             (2, 30.0, 160.0, "Note"), (2, 30.0, 170.0, "this"), (2, 740.0, 160.0, "footer"), (3, 5.0, 70.0, "INTER"), (3, 5.0, 300.0, "Uses"), (3, 6.0, 80.0, "net"),
             (3, 6.0, 160.0, "Net"), (3, 7.0, 160.0, "“Quoted”  text")]
    table = spark.createDataFrame([(1, *w) for w in words], "doc_id int, page int, top double, x0 double, text string")
    out = {r.variable: r for r in S.entries(S.credited_lines(S.word_lines(table, headings=("Note",)), KNOWN)).collect()}
    assert (out["fin24"].printed, out["fin24"].label, out["fin24"].definition, out["fin24"].pages) == ("fin24", "Saved money", "Past year", "2")
    assert (out["internet_use"].printed, out["internet_use"].label, out["internet_use"].definition) == ("INTERnet", 'Net "Quoted" text', "Uses")
    empty = S.entries(S.credited_lines(S.word_lines(table.limit(0)), KNOWN))
    assert empty.collect() == []


def test_words_are_not_shuffled(spark, tmp_path):
    """Texts are dealt out by document, before they become words; lines and sections need no further exchange."""
    from tabulon.plans import q_sections
    spark.createDataFrame([(1, "one two three four five six seven"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    plan = q_sections.q_credited(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.index("Generate") < plan.index("Exchange ")
    assert "Generate" not in plan[plan.index("Exchange "):]
