"""C2 — codebook sections from a word table: words to lines, lines to x-bands, lines to the keys they belong to.

Words (page, top, x) on one line share the page and the rounded top; a line splits by x into
a key, a label and a definition. Headings and footers are dropped. A document's lines are
then folded in order by a small state machine: a known key takes over; a text that only starts
a known key is held back, grows with the key texts of the next lines while it still starts
one, and once it is whole its held lines are credited to it; every other line goes to the
last key seen. Keys match without regard to case and may have aliases.

Lines are grouped per document and the fold is one ``aggregate`` over its array, so nothing
but a document's own lines ever meets in a row; the key set is the codebook's, a parameter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.operators.codebook import normalise_text

BANDS = ((65.0, 150.0), (150.0, 260.0), (260.0, float("inf")))  # key, label, definition
FOOTER = 735.0

_STATE = "struct<current:string,held_key:string,held_text:string,held:array<int>,credits:array<struct<line:int,variable:string,printed:string>>>"


def word_lines(words: DataFrame, doc: str = "doc_id", bands: Sequence[tuple[float, float]] = BANDS, footer: float = FOOTER,
               headings: Sequence[str] = ()) -> DataFrame:
    """``doc, page, top, key, label, definition``: one row per line of (doc, page, top, x0, text) that is no heading or footer."""
    line = words.groupBy(doc, "page", F.round("top", 1).alias("top")).agg(F.array_sort(F.collect_list(F.struct("x0", "text"))).alias("__w"))

    def band(lo: float, hi: float, by: str) -> Column:
        return normalise_text(F.array_join(F.transform(F.filter("__w", lambda w: (w["x0"] >= lo) & (w["x0"] < hi)), lambda w: w["text"]), by))

    full = normalise_text(F.array_join(F.transform("__w", lambda w: w["text"]), " "))
    dropped = F.lit(False)
    for h in headings:
        dropped = dropped | F.col("__full").startswith(h)
    (k0, k1), (l0, l1), (d0, d1) = bands
    return line.where(F.col("top") <= footer).withColumn("__full", full).where(~dropped).select(
        doc, "page", "top", F.replace(band(k0, k1, " "), F.lit(" "), F.lit("")).alias("key"), band(l0, l1, " ").alias("label"), band(d0, d1, " ").alias("definition"))


def credited_lines(lines: DataFrame, known: Mapping[str, str], doc: str = "doc_id") -> DataFrame:
    """``doc, variable, printed, page, top, label, definition``: every line with the variable it belongs to.

    ``known`` maps lower-case keys and aliases to variables; ``printed`` is the key as a
    document prints it, on the line that completes it.
    """
    variables = F.create_map(*[x for k, v in known.items() for x in (F.lit(k), F.lit(v))])
    starts = F.array(*[F.lit(p) for p in sorted({k[:i] for k in known for i in range(1, len(k) + 1)})])

    def resolve(text: Column) -> Column:
        return F.try_element_at(variables, text)

    def credit(lines: Column, variable: Column, printed: Column) -> Column:
        last = F.element_at(lines, -1)
        return F.transform(lines, lambda i: F.struct(i.alias("line"), variable.alias("variable"), F.when(i == last, printed).alias("printed")))

    def step(s: Column, x: Column) -> Column:
        name = F.lower(x["key"])
        grown, text = F.concat(s["held_key"], name), F.concat(s["held_text"], x["key"])
        whole, longer = resolve(name), resolve(grown)
        grows = (s["held_key"] != "") & (name != "") & F.array_contains(starts, grown)
        held = F.array_append(s["held"], x["line"])
        none, no_text = F.expr("cast(array() as array<int>)"), F.lit(None).cast("string")

        def state(current: Column, key: Column, shown: Column, lines: Column, more: Column) -> Column:
            return F.struct(current.alias("current"), key.alias("held_key"), shown.alias("held_text"), lines.alias("held"),
                            F.concat(s["credits"], more).alias("credits"))

        empty, nothing = F.lit(""), credit(none, no_text, no_text)
        return F.when(whole.isNotNull(), state(whole, empty, empty, none, credit(F.array(x["line"]), whole, x["key"]))) \
            .when(grows & longer.isNotNull(), state(longer, empty, empty, none, credit(held, longer, text))) \
            .when(grows, state(s["current"], grown, text, held, nothing)) \
            .when((name != "") & F.array_contains(starts, name), state(s["current"], name, x["key"], F.array(x["line"]), nothing)) \
            .when(s["current"].isNull(), s) \
            .otherwise(state(s["current"], s["held_key"], s["held_text"], s["held"], credit(F.array(x["line"]), s["current"], no_text)))

    ordered = lines.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("page", "top", "key", "label", "definition"))).alias("__l"))
    numbered = ordered.withColumn("__n", F.transform("__l", lambda x, i: F.struct(i.cast("int").alias("line"), x["key"].alias("key"))))
    start = F.expr(f"cast(named_struct('current', null, 'held_key', '', 'held_text', '', 'held', array(), 'credits', array()) as {_STATE})")
    folded = numbered.select(doc, "__l", F.aggregate("__n", start, lambda s, x: step(s, x).cast(_STATE))["credits"].alias("__c"))
    each = folded.select(doc, F.explode(F.transform("__c", lambda c: F.struct(c.alias("c"), F.get("__l", c["line"]).alias("l")))).alias("e"))
    return each.select(doc, "e.c.variable", "e.c.printed", "e.l.page", "e.l.top", "e.l.label", "e.l.definition")


def entries(credited: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, variable, printed, label, definition, pages``: the parts of every variable joined in reading order."""
    row = credited.groupBy(doc, "variable").agg(F.array_sort(F.collect_list(F.struct("page", "top", "printed", "label", "definition"))).alias("__p"))

    def joined(field: str) -> Column:
        return F.array_join(F.filter(F.transform("__p", lambda p: p[field]), lambda t: t != ""), " ")

    printed = F.filter(F.transform("__p", lambda p: p["printed"]), lambda t: t.isNotNull())
    pages = F.array_join(F.transform(F.array_sort(F.array_distinct(F.transform("__p", lambda p: p["page"]))), lambda p: p.cast("string")), ";")
    return row.select(doc, "variable", F.try_element_at(printed, F.lit(-1)).alias("printed"), joined("label").alias("label"),
                      joined("definition").alias("definition"), pages.alias("pages"))
