"""C — codebook text, rule-based classification and eligibility over a catalogue table.

Rules are DATA: an ordered list of ``(condition, result)`` pairs compiled into
ONE ``CASE WHEN`` chain (first match wins). The same compiler classifies a
16-row catalogue or a billion-row table; there is no per-row Python.

Condition vocabulary (all keys of one dict must hold):
  ``name_in``: [..]          ``name_prefix``: "con"      ``name_eq_col``: "outcome"
  ``col_eq``: {col: value}   ``col_in``: {col: [..]}     ``col_ge`` / ``col_lt`` / ``col_le``: {col: number}
  ``name_in_by``: {"col": "outcome", "sets": {outcome: [..]}}   ``any``: [conditions]   ``not``: condition
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.exprs import all_of, any_of

Rule = tuple[Mapping, object]


def compile_condition(spec: Mapping, name: str = "variable") -> Column:
    n = F.col(name)
    parts: list[Column] = []
    for key, arg in spec.items():
        if key == "name_in":
            parts.append(n.isin(*arg) if arg else F.lit(False))
        elif key == "name_prefix":
            parts.append(n.startswith(arg))
        elif key == "name_eq_col":
            parts.append(n == F.col(arg))
        elif key == "col_eq":
            parts += [F.col(c) == F.lit(v) for c, v in arg.items()]
        elif key == "col_in":
            parts += [F.col(c).isin(*v) for c, v in arg.items()]
        elif key == "col_ge":
            parts += [F.col(c) >= v for c, v in arg.items()]
        elif key == "col_lt":
            parts += [F.col(c) < v for c, v in arg.items()]
        elif key == "col_le":
            parts += [F.col(c) <= v for c, v in arg.items()]
        elif key == "name_in_by":
            col, sets = arg["col"], arg["sets"]
            parts.append(any_of([(F.col(col) == F.lit(k)) & (n.isin(*v) if v else F.lit(False))
                                 for k, v in sets.items()]))
        elif key == "any":
            parts.append(any_of([compile_condition(c, name) for c in arg]))
        elif key == "not":
            parts.append(~compile_condition(arg, name))
        else:
            raise ValueError(f"unknown rule condition {key!r}")
    return all_of(parts)


def _value(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, tuple):
        return F.struct(*[_value(x).alias(f"_{i}") for i, x in enumerate(v)])
    return F.lit(v)


def compile_rules(rules: Sequence[Rule], default=None, name: str = "variable") -> Column:
    """Ordered rule table → one CASE chain; tuple results become structs (_0, _1, ...)."""
    expr = None
    for spec, result in rules:
        cond = compile_condition(spec, name)
        expr = F.when(cond, _value(result)) if expr is None else expr.when(cond, _value(result))
    if default is None:
        return expr
    return expr.otherwise(_value(default))


def classify(df: DataFrame, outputs: Mapping[str, tuple[Sequence[Rule], object]], name: str = "variable",
             per: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Add one column per rule set, in order (later rule sets may read earlier outputs).

    ``per`` expands each row over a small parameter list (e.g. outcomes) with
    ``explode`` — a bounded fan-out, no join.
    """
    out = df
    for col, values in (per or {}).items():
        out = out.withColumn(col, F.explode(F.array(*[F.lit(v) for v in values])))
    for col, (rules, default) in outputs.items():
        out = out.withColumn(col, compile_rules(rules, default, name))
    return out


# ---------------------------------------------------------------------------
# Text normalisation and section attribution
# ---------------------------------------------------------------------------
# Typographic characters mapped to ASCII
TYPOGRAPHIC = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-"}
WS_CLASS = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}]+"


def normalise_text(c: str | Column) -> Column:
    """Typographic quotes/dashes → ASCII, whitespace runs → one space, trimmed."""
    col = F.col(c) if isinstance(c, str) else c
    mapped = F.translate(F.coalesce(col, F.lit("")), "".join(TYPOGRAPHIC), "".join(TYPOGRAPHIC.values()))
    return F.trim(F.regexp_replace(mapped, WS_CLASS, " "))


def split_lines(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, line_no 1-based, line) — one row per line of every whole text."""
    return df.select(F.col(doc), F.posexplode(F.split(F.col(text), "\n")).alias("__pos", "line")) \
        .select(doc, (F.col("__pos") + 1).alias("line_no"), "line")


def carry_forward_sections(lines: DataFrame, doc: str, is_key: Column, key: Column) -> DataFrame:
    """Credit every line to the last key line seen before it in the same document.

    The window is per document (a document is bounded), ordered by line number.
    """
    w = Window.partitionBy(doc).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("__key", F.when(is_key, key)) \
        .withColumn("section", F.last("__key", ignorenulls=True).over(w)).drop("__key")


# ---------------------------------------------------------------------------
# C8 – C12
# ---------------------------------------------------------------------------
def repair_documented_codes(codes: Column, observed_zero: Column, blank_label: str = "No/DK/Ref") -> Column:
    """A code with empty value and the combined no/don't-know label becomes '0' when '0' is observed."""
    return F.transform(codes, lambda c: F.struct(
        F.when((c["value"] == "") & (c["label"] == blank_label) & observed_zero, F.lit("0"))
        .otherwise(c["value"]).alias("value"), c["label"].alias("label")))


def status_counts(df: DataFrame, field: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts of any status field (optionally per group)."""
    return df.groupBy(*by, field).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def candidates(df: DataFrame, status: str = "status", prefix: str = "CANDIDATE",
               columns: Sequence[str] | None = None) -> DataFrame:
    """C11: rows whose status starts with ``prefix``, projected to the review columns."""
    out = df.filter(F.col(status).startswith(prefix))
    return out.select(*columns) if columns else out


def contract_drift(approved: DataFrame, configured: DataFrame, name: str = "feature") -> DataFrame:
    """Set difference both ways (full outer join on the name); any row is drift."""
    a = approved.select(F.col(name).alias("__a")).distinct()
    c = configured.select(F.col(name).alias("__c")).distinct()
    j = a.join(c, F.col("__a") == F.col("__c"), "full_outer")
    return j.filter(F.col("__a").isNull() | F.col("__c").isNull()).select(
        F.coalesce("__a", "__c").alias(name),
        F.when(F.col("__c").isNull(), "approved_not_configured").otherwise("configured_not_approved").alias("drift"))


def stitch_keys(lines: DataFrame, doc: str, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """C2 multi-line keys: a key printed across two lines (e.g. ``fin24`` / ``c``) is recognised when the
    line alone is not a key but the line joined with the next one is. Adds ``key`` (exact or stitched)
    and ``continuation`` (the consumed second line). The key set is bounded by the codebook (broadcast)."""
    w = Window.partitionBy(doc).orderBy("line_no")
    k = F.broadcast(keys.select(F.col(key_col).alias("__k")).distinct())
    cur = F.trim(F.col("line"))
    tagged = lines.withColumn("__cur", cur).withColumn("__joined", F.concat(cur, F.trim(F.lead("line").over(w))))
    exact = tagged.join(k, tagged["__cur"] == k["__k"], "left").withColumnRenamed("__k", "__exact")
    k2 = F.broadcast(keys.select(F.col(key_col).alias("__k2")).distinct())
    both = exact.join(k2, exact["__joined"] == k2["__k2"], "left")
    stitched = F.when(F.col("__exact").isNull(), F.col("__k2"))
    out = both.withColumn("key", F.coalesce(F.col("__exact"), stitched)) \
        .withColumn("__stitched", stitched.isNotNull())
    out = out.withColumn("continuation", F.coalesce(F.lag("__stitched").over(w), F.lit(False)))
    return out.drop("__cur", "__joined", "__exact", "__k2", "__stitched")
