"""The numbered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.common import read_table


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: A key for the examples; whoever runs the operator passes their own.
EXAMPLE_KEY = b"an example key"


def op1_lm_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import lm_mixing
    return lm_mixing.scored(read_table(spark, sf_dir, "documents"))


def op2_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import decontam
    return decontam.judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), near=False).drop("k1", "k2")


def decontam_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op2_decontam`` with proximity matches: its columns and ``n_near_items``."""
    from tabulon.llm import decontam
    return decontam.judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("k1", "k2")


def op3_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import mil_quality
    docs = read_table(spark, sf_dir, "documents")
    return mil_quality.scored(docs, mil_quality.fitted(docs, read_table(spark, sf_dir, "labels")))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import minhash_dedup
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import suffix_dedup
    return suffix_dedup.deduplicated(read_table(spark, sf_dir, "documents"), with_text=False).drop("text_kept")


def op6_ann_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import ann_collision
    return ann_collision.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import blob_ledger
    return blob_ledger.digest(read_table(spark, sf_dir, "documents"))


def op8_exact_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import exact_packing
    out = exact_packing.packed(read_table(spark, sf_dir, "documents"), tokenizer_file())
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import langid
    docs = read_table(spark, sf_dir, "documents")
    return langid.identified(docs, langid.fitted(docs))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import surrogates
    out = surrogates.masked(read_table(spark, sf_dir, "documents").select("doc_id", "text"), EXAMPLE_KEY)
    return out.select("doc_id", "text", F.size("pii_kinds").cast("long").alias("n_entities"), F.concat_ws(",", "pii_kinds").alias("kinds"))


def op11_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import jaccard_groups
    return jaccard_groups.joined(read_table(spark, sf_dir, "documents"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import source_audit
    return source_audit.divergence(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.llm import collocations
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_lm_mixing, op2_decontam, op3_mil_quality, op4_minhash, op5_suffix_dedup, op6_ann_collision, op7_blob_ledger,
    op8_exact_packing, op9_langid, op10_surrogates)}

#: Numbered ones that came later, and further forms with more columns than the contracts have.
MORE = {f.__name__: f for f in (op11_jaccard_groups, op12_source_audit, op13_collocations, decontam_proximity)}

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: DuckDB SQL of the operators that SQL can express.
SQL: dict[str, str] = {
    "op2_decontam": rf"""
with d as (select doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select distinct item_id, array_to_string(w[i:i + 12], ' ') as s, least(13, len(w)) as l
       from (select item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) as i from b where len(w) > 0)),
dw as (select doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') as s
       from (select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as i from d, (select distinct l from bw) where len(w) >= l)),
m as (select doc_id, i, l, item_id from dw join bw using (s, l)),
h as (select doc_id, count(distinct p) as n from (select distinct doc_id, unnest(range(i, i + l)) as p from m) group by doc_id),
t as (select doc_id, count(*) as n, string_agg(v, ',' order by v) as ids
      from (select distinct doc_id, cast(item_id as varchar) as v from m) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(h.n, 0) as n_hit, coalesce(t.n, 0) as n_items,
       sha256(coalesce(t.ids, '')) as items_sha256, coalesce(h.n, 0) > 0 and 20 * coalesce(h.n, 0) >= len(w) as contaminated
from d left join h using (doc_id) left join t using (doc_id)""",
    "op4_minhash": rf"""
with recursive d as (select doc_id, {_SPLIT.format(_LOW)} as w from documents),
s as (select distinct doc_id, md5(array_to_string(w[i:i + 4], ' ')) as g
      from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
l as (select p.a, p.b from (select x.doc_id as a, y.doc_id as b, count(*) as k from s x join s y using (g) where x.doc_id <> y.doc_id group by all) p
      join n na on na.doc_id = p.a join n nb on nb.doc_id = p.b where 100 * p.k >= 75 * (na.n + nb.n - p.k)),
r(doc_id, c) as (select doc_id, doc_id from d union select l.b, r.c from r join l on r.doc_id = l.a),
c as (select doc_id, min(c) as c from r group by doc_id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.c as component_id, d.doc_id = c.c as kept
from d join c using (doc_id) left join n using (doc_id)""",
    "op5_suffix_dedup": rf"""
with d as (select doc_id, {_SPLIT.format("coalesce(text, '')")} as w from documents),
s as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as g
      from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50)),
m as (select g, min(doc_id) as f from s group by g),
x as (select distinct doc_id, unnest(range(i, i + 50)) as p from s join m using (g) where f < doc_id),
u as (select doc_id, unnest(w) as t, unnest(range(1, len(w) + 1)) as p from d),
k as (select u.doc_id, string_agg(t, ' ' order by u.p) as t, count(*) as n from u anti join x on u.doc_id = x.doc_id and u.p = x.p group by u.doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(k.n, 0) as bigint) as n_removed, sha256(coalesce(k.t, '')) as kept_sha256
from d left join k using (doc_id)""",
    "op12_source_audit": rf"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as row,
                  regexp_extract_all({_LOW}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
c as (select lang, source, term, count(*) as n, count(distinct row) as df from (select lang, source, row, unnest(w) as term from d) group by all),
k as (select lang, term, sum(n) as n from c group by lang, term having sum(df) >= 10),
g as (select distinct lang, source from d),
e as (select g.lang, g.source, k.term, cast(coalesce(c.n, 0) as hugeint) as n, cast(k.n as hugeint) as lang_n
      from g join k using (lang) left join c using (lang, source, term)),
s as (select *, 1 + (1000000000 * (n + 2)) // (sum(n) over (partition by lang, source)::hugeint + 2 * count(*) over (partition by lang, source)) as p,
             1 + (1000000000 * (lang_n + 2)) // (sum(lang_n) over (partition by lang, source)::hugeint + 2 * count(*) over (partition by lang, source)) as q from e),
v as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum(f.value), 0) as value
      from g a join g b on a.lang = b.lang and a.source <> b.source
      left join (select x.lang, x.source, y.source as other, ((x.p - y.p) * (x.p - y.p)) // (x.p + y.p) as value
                 from s x join s y on x.lang = y.lang and x.term = y.term and x.source <> y.source) f
        on f.lang = a.lang and f.source = a.source and f.other = b.source
      group by all
      union all
      select lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) from s where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from v)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from r where part = 'pair' or rank <= 10""",
    "op13_collocations": rf"""
with p as (select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOW}, '[.,;:!?\x0A-\x0D]')) as t from documents),
w as (select lang, regexp_extract_all(t, '[^\x20\x09]+') as w from p),
g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as a, count(*) filter (i = 1) as starts, count(*) filter (i + k - 1 = len(w)) as ends
      from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k) group by all),
n as (select lang, sum(a) as n from g where k = 1 group by lang),
c as (select * from g where k > 1 and a >= 30),
x as (select *, unnest(range(1, k)) as j from c),
y as (select x.*, f.a as l, r.a as r, (cast(2000000 as hugeint) * x.a) // (f.a + r.a) as score from x
      join g f on f.lang = x.lang and f.phrase = array_to_string(string_split(x.phrase, ' ')[1:x.j], ' ')
      join g r on r.lang = x.lang and r.phrase = array_to_string(string_split(x.phrase, ' ')[x.j + 1:], ' ')),
z as (select * from y qualify row_number() over (partition by lang, phrase order by score, j) = 1),
o as (select * from z where not exists (select 1 from c m where m.lang = z.lang and m.k > z.k and 100 * m.a >= 80 * z.a
                                        and contains(' ' || m.phrase || ' ', ' ' || z.phrase || ' '))),
q as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from o)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score, starts, ends from q join n using (lang) where rank <= 2000""",
}

#: The join links like the near-duplicates, at its own similarity.
SQL["op11_jaccard_groups"] = SQL["op4_minhash"].replace("100 * p.k >= 75", "100 * p.k >= 80").replace(", d.doc_id = c.c as kept", "")
