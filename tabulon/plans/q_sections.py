"""C2 queries: a word table laid out from ``documents``, its lines, their keys and the entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions.exprs import h8, sql_str
from tabulon.operators import section_lines as S
from tabulon.plans.base import Query
from tabulon.session import materialize
from tabulon.sources.tables import table

# The key set of the laid-out codebook (key or alias → variable) and its headings
KNOWN = {"0": "v0", "1a": "v1a", "2b3": "v2b3", "c": "vc", "d4": "vd4", "d45": "vd45", "e": "echo", "9f": "v9f"}
HEADINGS = ("The ", "En ", "C ")
WORDS, LINES = 6, 30  # words on a line, lines on a page


def word_table(spark, d):
    """``doc_id, page, top, x0, text``: six words a line, thirty lines a page; every fourth line or so starts with a key text.

    Texts are dealt out by document before they become words, so no later step shuffles words or lines.
    """
    w = table(spark, d, "documents").select("doc_id", "text").repartition("doc_id").select("doc_id", F.posexplode(F.expr("regexp_extract_all(text, '[A-Za-z]+', 0)")).alias("i", "word"))
    line, place = F.floor(F.col("i") / WORDS), F.col("i") % WORDS
    code = h8(F.concat(F.lit("key|"), F.col("word")))
    text = F.substring(F.md5("word"), 1, 1)
    text = F.when(F.length("word") % 2 == 0, F.upper(text)).otherwise(text)
    is_key = (place == 0) & (code % 4 == 0)
    x0 = F.when(is_key, 70.0).when(place == 0, 300.0).when(place <= 2, 155.0 + 40.0 * place).otherwise(260.0 + 40.0 * place)
    return w.select("doc_id", F.floor(line / LINES).cast("int").alias("page"), (20.04 + 25.0 * (line % LINES) + 0.02 * (place % 2)).alias("top"),
                    x0.alias("x0"), F.when(is_key, text).otherwise(F.col("word")).alias("text"))


def _credited(spark, d):
    return S.credited_lines(S.word_lines(word_table(spark, d), headings=HEADINGS), KNOWN)


def q_lines(spark, d):
    return S.word_lines(word_table(spark, d), headings=HEADINGS)


def q_credited(spark, d):
    return _credited(spark, d)


def q_entries(spark, d):
    return S.entries(materialize(_credited(spark, d)))


_STARTS = "[" + ", ".join(sql_str(p) for p in sorted({k[:i] for k in KNOWN for i in range(1, len(k) + 1)})) + "]"
_KEYS = "map {" + ", ".join(f"{sql_str(k)}: {sql_str(v)}" for k, v in KNOWN.items()) + "}"
CTES = (
    "recursive wd as (select doc_id, unnest(w) as word, unnest(range(0, len(w))) as i from (select doc_id, regexp_extract_all(text, '[A-Za-z]+') as w from documents)), "
    f"wp as (select doc_id, word, i // {WORDS} as line, i % {WORDS} as place, "
    "cast(('0x' || substr(md5(concat('key|', word)), 1, 8)) as bigint) % 4 = 0 and i % 6 = 0 as is_key from wd), "
    f"wt as (select doc_id, cast(line // {LINES} as integer) as page, round(20.04::double + 25.0::double * (line % {LINES}) + 0.02::double * (place % 2), 1) as top, place, "
    "case when is_key then 0 when place = 0 then 2 when place <= 2 then 1 else 2 end as band, "
    "case when is_key then 70.0 when place = 0 then 300.0 when place <= 2 then 155.0 + 40.0 * place else 260.0 + 40.0 * place end as x0, "
    "case when is_key and length(word) % 2 = 0 then upper(substr(md5(word), 1, 1)) when is_key then substr(md5(word), 1, 1) else word end as t from wp), "
    "wl as (select doc_id, page, top, string_agg(t, ' ' order by x0) as full_line, coalesce(string_agg(t, '' order by x0) filter (where band = 0), '') as key, "
    "coalesce(string_agg(t, ' ' order by x0) filter (where band = 1), '') as label, coalesce(string_agg(t, ' ' order by x0) filter (where band = 2), '') as definition "
    "from wt where top <= 735 group by all), "
    "ln as (select doc_id, page, top, key, label, definition, cast(row_number() over (partition by doc_id order by page, top) as integer) as i from wl where "
    + " and ".join(f"not starts_with(full_line, {sql_str(h)})" for h in HEADINGS) + "), "
    "st as (select distinct doc_id, 0 as i, null::varchar as cur, ''::varchar as hk, ''::varchar as ht, []::integer[] as held, []::integer[] as cr, null::varchar as printed from ln "
    f"union all select doc_id, i, case a when 1 then whole when 2 then longer else cur end, case a when 3 then grown when 4 then name when 1 then '' when 2 then '' else hk end, "
    "case a when 3 then ht || key when 4 then key when 1 then '' when 2 then '' else ht end, "
    "case a when 3 then list_append(held, i) when 4 then [i] when 1 then [] when 2 then [] else held end, "
    "case a when 1 then [i] when 2 then list_append(held, i) when 5 then (case when cur is null then [] else [i] end) else [] end, "
    "case a when 1 then key when 2 then ht || key end from (select *, case when whole is not null then 1 when hk <> '' and name <> '' and list_contains("
    f"{_STARTS}, grown) then (case when longer is not null then 2 else 3 end) when name <> '' and list_contains({_STARTS}, name) then 4 else 5 end as a from "
    f"(select l.doc_id, l.i, l.key, lower(l.key) as name, s.cur, s.hk, s.ht, s.held, s.hk || lower(l.key) as grown, {_KEYS}[lower(l.key)] as whole, "
    f"{_KEYS}[s.hk || lower(l.key)] as longer from st s join ln l on l.doc_id = s.doc_id and l.i = s.i + 1))), "
    "cr as (select doc_id, cur as variable, i as at, printed, unnest(cr) as line from st), "
    "cl as (select c.doc_id, c.variable, case when c.line = c.at then c.printed end as printed, l.page, l.top, l.label, l.definition from cr c join ln l on l.doc_id = c.doc_id and l.i = c.line)")
ENTRY_SQL = ("select doc_id, variable, last(printed order by page, top) filter (where printed is not null) as printed, "
             "coalesce(string_agg(label, ' ' order by page, top) filter (where label <> ''), '') as label, "
             "coalesce(string_agg(definition, ' ' order by page, top) filter (where definition <> ''), '') as definition, "
             "array_to_string(list_transform(list_sort(list(distinct page)), lambda p: cast(p as varchar)), ';') as pages from cl group by all")

QUERIES = [
    Query("codebook_lines", "C2", q_lines, "select doc_id, page, top, key, label, definition from ln", ("top",), survey=False, ctes=CTES),
    Query("codebook_sections", "C2", q_credited, "select * from cl", ("top",), survey=False, ctes=CTES),
    Query("codebook_entries", "C2", q_entries, ENTRY_SQL, survey=False, ctes=CTES),
]
