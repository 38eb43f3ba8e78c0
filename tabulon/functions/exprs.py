"""Column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The whitespace set stripped like Python's str.strip() (ASCII + common Unicode spaces)
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005" \
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def trim_ws(c: str | Column) -> Column:
    """Python ``str.strip()`` semantics: strip leading/trailing whitespace (character set, no regex)."""
    return F.btrim(col_(c), F.lit(WHITESPACE))


def blank_to_empty(c: str | Column) -> Column:
    """Canonical blank: NULL and whitespace-only both become ''."""
    return F.coalesce(trim_ws(c), F.lit(""))


def h8(c: str | Column) -> Column:
    """First 32 bits of md5 as a non-negative bigint (same in DuckDB)."""
    return F.conv(F.substring(F.md5(col_(c).cast("string")), 1, 8), 16, 10).cast("bigint")


def safe_div(num: Column, den: Column, default=None) -> Column:
    """Division that yields ``default`` (NULL unless given) on a zero/NULL denominator."""
    out = F.try_divide(num, den)
    return out if default is None else F.coalesce(out, F.lit(default))


def case_map(c: str | Column, mapping: Mapping[str, object], default=None) -> Column:
    """Map values through a small literal lookup; unmatched → ``default``."""
    src = col_(c)
    expr = None
    for key, value in mapping.items():
        cond = src == F.lit(key)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def first_match(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """Ordered rule table → one ``CASE WHEN`` chain (first matching rule wins)."""
    expr = None
    for cond, value in rules:
        val = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    if expr is None:
        return default if isinstance(default, Column) else F.lit(default)
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def any_of(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def all_of(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def round_doubles(df, digits: int = 6):
    """Round every double/float column (query edge only, for stable comparison)."""
    out = []
    for field in df.schema.fields:
        name = field.name
        if field.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f"`{name}`"), digits).cast("double").alias(name))
        else:
            out.append(F.col(f"`{name}`"))
    return df.select(*out)


def sql_str(value: str) -> str:
    """ANSI SQL string literal (both engines accept doubled quotes)."""
    return "'" + str(value).replace("'", "''") + "'"


def sql_case_map(column: str, mapping: Mapping[str, object], default=None) -> str:
    """SQL text twin of :func:`case_map` for oracle queries."""
    parts = [f"when {column} = {sql_str(k)} then {sql_str(v) if isinstance(v, str) else v}"
             for k, v in mapping.items()]
    tail = "" if default is None else f" else {sql_str(default) if isinstance(default, str) else default}"
    return "case " + " ".join(parts) + tail + " end"
