"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from .licenses import FULL_TEXTS, TEMPLATES, THRESHOLD
from .quality_rules import MEASURES

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_TEMPLATE_ROWS = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))
_NORMAL = r"string_split(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
_GRAMS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
LICENSE_LINES = rf"""
with templates as (
  select place, license, {_GRAMS} as g from (select place, license, {_NORMAL.format("notice")} as w from (values {_TEMPLATE_ROWS}) v(place, license, notice))
), units as (
  select distinct doc_id, unnest(list_concat(string_split(text, chr(10)), string_split(regexp_replace(text, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)))) as unit
  from documents
), own as (
  select doc_id, unit, {_GRAMS} as g from (select doc_id, unit, {_NORMAL.format("unit")} as w from units) where len(w) > 1
), scored as (
  select doc_id, unit, place, license, 2.0::double * len(list_intersect(own.g, templates.g)) / (len(own.g) + len(templates.g)) as dice
  from own join templates on len(own.g) between 0.5 * len(templates.g) and 2 * len(templates.g)
), best as (
  select * from scored where dice >= {THRESHOLD} qualify row_number() over (partition by doc_id, unit order by dice desc, place) = 1
), by_doc as (
  select doc_id, count(*) as n_matches, arg_max(license, (dice, -place)) as license, max(dice) as dice, string_agg(distinct license, ',' order by license) as licenses
  from best group by doc_id
)
select doc_id, coalesce(n_matches, 0) as n_matches, b.license, b.dice, coalesce(licenses, '') as licenses from documents left join by_doc b using (doc_id)
"""

_ALL_ROWS = ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(TEMPLATES + FULL_TEXTS))
LICENSES = rf"""
with templates as (
  select place, license, {_GRAMS} as g from (select place, license, {_NORMAL.format("notice")} as w from (values {_ALL_ROWS}) v(place, license, notice))
), bounds as (
  select place, license, len(g) as b, cast(ceil(len(g) * {THRESHOLD}::double / (2 - {THRESHOLD}::double) - 1e-9) as int) as need, cast(floor(len(g) * (2 - {THRESHOLD}::double) / {THRESHOLD}::double + 1e-9) as int) as span from templates
), grams as (
  select rid, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as gram, unnest(range(1, len(w))) as pos
  from (select row_number() over () as rid, {_NORMAL.format("coalesce(text, '')")} as w from documents)
), placed as (
  select rid, gram, pos, coalesce(lag(pos) over (partition by rid, gram order by pos), 0) as before from grams
), hits as (
  select rid, place, pos from grams join (select place, unnest(g) as gram from templates) using (gram)
), starts as (
  select rid, place, pos as first from (select h.*, lead(pos, need - 1) over (partition by rid, h.place order by pos) - pos < span as enough from hits h join bounds using (place)) where enough
), passes as (
  select s.rid, s.place, s.first, h.pos is not null as held,
    sum(case when p.before < s.first then 1 else 0 end) over w as own, sum(case when p.before < s.first and h.pos is not null then 1 else 0 end) over w as shared
  from starts s join bounds using (place) join placed p on p.rid = s.rid and p.pos >= s.first and p.pos < s.first + span
  left join hits h on h.rid = s.rid and h.place = s.place and h.pos = p.pos
  window w as (partition by s.rid, s.place, s.first order by p.pos)
), best as (
  select rid, place, license, max(2.0::double * shared / (own + b)) as dice from passes join bounds using (place) where held group by all
), by_doc as (
  select rid, count(*) as n_matches, arg_max(license, (dice, -place)) as license, max(dice) as dice, string_agg(distinct license, ',' order by license) as licenses
  from best where dice >= {THRESHOLD} group by rid
)
select doc_id, coalesce(n_matches, 0) as n_matches, b.license, b.dice, coalesce(licenses, '') as licenses
from (select row_number() over () as rid, doc_id from documents) left join by_doc b using (rid)
"""

_VALUE = {
    "symbols": "case when word_chars > 0 then 1000 * n_symbols // word_chars else 0 end",
    "marks": "case when word_chars > 0 then 1000 * n_marks // word_chars else 0 end",
    "repeats": "case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end",
    "word_length": "case when n_words > 0 then 1000 * word_chars // n_words else 0 end",
}


def _limits(level: str, by: str) -> str:
    keys = f"{by}, measure" if by else "measure"
    margin = "case measure " + " ".join(f"when '{m}' then {least}" for m, (least, _) in MEASURES.items()) + " end"
    both = ", ".join(f"'{m}'" for m, (_, two) in MEASURES.items() if two)
    return f"""
{level}_sums as (select {keys}, bucket, count(*) as n from buckets group by {keys}, bucket),
{level}_upto as (select *, sum(n) over (partition by {keys}) as docs, sum(n) over (partition by {keys} order by bucket) as upto from {level}_sums),
{level}_q as (select {keys}, max(docs) as docs, min(bucket) filter (upto * 4 >= docs) as q25, min(bucket) filter (upto * 4 >= docs * 3) as q75 from {level}_upto group by {keys}),
{level} as (select *, case when measure in ({both}) then q25 - greatest(3 * (q75 - q25), {margin}) else -1 end as low, q75 + greatest(3 * (q75 - q25), {margin}) as high from {level}_q)"""


RULES = rf"""
with words as (
  select doc_id, lang, source, coalesce(text, '') as text, {_WORDS} as w from documents
), lines as (
  select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from words
), places as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) as g from words
), twice as (
  select doc_id, i from places qualify count(*) over (partition by doc_id, g) > 1
), covered as (
  select doc_id, count(distinct i + d) as n_repeat_words from twice, (values (0), (1), (2)) v(d) group by doc_id
), measured as (
  select words.doc_id, lang, source, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols, length(text) - length(regexp_replace(text, '[!?]', '', 'g')) as n_marks,
    len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from words join lines using (doc_id) left join covered using (doc_id)
), valued as (
  select *, {", ".join(f"{v} as v_{m}" for m, v in _VALUE.items())} from measured
), rows as (
  {" union all ".join(f"select doc_id, lang, source, '{m}' as measure, v_{m}::bigint as v from valued" for m in MEASURES)}
), buckets as (
  select *, case when v < 64 then v else v - v % (1::bigint << (length(bin(v)) - 6)) end as bucket from rows
), {_limits("own", "lang, source")}, {_limits("mid", "lang")}, {_limits("every", "")},
limits as (
  select own.lang, own.source, own.measure,
    case when own.docs >= 100 then own.low when mid.docs >= 100 then mid.low else every.low end as low,
    case when own.docs >= 100 then own.high when mid.docs >= 100 then mid.high else every.high end as high
  from own join mid on own.measure = mid.measure and own.lang is not distinct from mid.lang join every on own.measure = every.measure
), judged as (
  select rows.doc_id, bool_and(v between low and high) as within
  from rows join limits on rows.measure = limits.measure and rows.lang is not distinct from limits.lang and rows.source is not distinct from limits.source group by rows.doc_id
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and within as kept
from measured join judged using (doc_id)
"""

TOP_K = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * 256)) as v from embeddings
  where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score from vectors q join vectors c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
)
select query_id, rank::int as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5
"""

JACCARD = f"""
with recursive words as (
  select doc_id, {_WORDS} as w from documents
), shingles as (
  select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) when len(w) > 0 then [w] else [] end) as s from words
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 10 * shared.n >= 8 * (x.n + y.n - shared.n)
), reach as (
  select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a
)
select doc_id, min(doc_id) over (partition by case when len(w) = 0 then [doc_id::varchar, ''] else w end) as text_id,
  least(doc_id, coalesce((select min(b) from reach where a = doc_id), doc_id)) as class_id, (select count(*) from links where a = doc_id) as n_links
from words
"""

#: crc32 of texts t(s): a byte's share depends only on its value and its distance from the end.
_CRC = """single as (
  select b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: xor(a >> 1, 3988292384 * (a & 1)) + x) as v from (select b::bigint as b from range(256) r(b))
), shares as (
  select b, 0::bigint as far, v from single
  union all
  select shares.b, far + 1, xor(shares.v >> 8, single.v) from shares join single on single.b = (shares.v & 255) where far < (select max(strlen(s)) from t)
), starts as (
  select 0::bigint as n, 4294967295::bigint as v
  union all
  select n + 1, xor(starts.v >> 8, single.v) from starts join single on single.b = (starts.v & 255) where n < (select max(strlen(s)) from t)
), spelt as (
  select s, strlen(s) as n, hex(encode(s)) as x from t
), parts as (
  select s, n, x, unnest(range(n)) as i from spelt
), crcs as (
  select s, xor(xor(any_value(starts.v), bit_xor(shares.v)), 4294967295) as crc
  from parts join shares on shares.far = parts.n - 1 - i and shares.b = ('0x' || substr(x, 2 * i + 1, 2))::bigint join starts on starts.n = parts.n group by s
)"""

VARIANTS = rf"""
with recursive runs as (
  select coalesce(doc_id::varchar, '') as id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents
), counted as (
  select id, run, id || ':' || run as s, count(*) as n from runs group by all
), t as (
  select distinct s from counted
), {_CRC}, spelled as (
  select case when crc % 199 = 0 then substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) else run end as word, n from counted join crcs using (s)
), words as (
  select word, sum(n)::bigint as n from spelled where length(word) >= 6 group by word having sum(n) >= 5
), cut as (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, unnest(range(1, length(word) + 1)) as i from words)
), near as (
  select a.word as word, b.word as other from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, w.word from cut a join words w on a.rest = w.word
  union select w.word, a.word from cut a join words w on a.rest = w.word
), best as (
  select near.word, count(*) as n_near, arg_min(other, (-w.n, other)) as best, max(w.n) as best_n from near join words w on w.word = near.other group by near.word
), formed as (
  select words.word, case when best_n >= 5 * n then best end as form, n, coalesce(n_near, 0) as n_near, case when best_n >= 5 * n then best_n end as form_n from words left join best using (word)
), steps as (
  select word, word as root from formed union select steps.word, formed.form from steps join formed on formed.word = steps.root where formed.form is not null
)
select word, form, root, n, n_near, form_n from formed join steps using (word) where root not in (select word from formed where form is not null)
"""

NEAR_VECTORS = """
with recursive v as (
  select vec_id, label, case when len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0 then embedding::double[] end as x
  from embeddings where vec_id is not null
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and len(a.x) = len(b.x) and a.vec_id <> b.vec_id where list_cosine_similarity(a.x, b.x) >= 0.98
), reach as (
  select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a
), low as (
  select vec_id, least(vec_id, coalesce((select min(b) from reach where a = vec_id), vec_id)) as component_id from v
)
select vec_id, (select count(*) from links where a = vec_id) as n_links, component_id, vec_id = component_id as kept from low
"""

TRIE = f"""
with recursive turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, role, text) as k from conversations where conv_id is not null
), t as (
  select distinct conv_id::varchar as s from turns
), {_CRC}, ids as (
  select s::bigint as conv_id, crc % 6 as h from crcs
), made as (
  select i.conv_id, role, text, k from ids i join turns on turns.conv_id = i.conv_id - i.conv_id % 100 and k <= h
  union all
  select i.conv_id, role, text, h + k from ids i join turns on turns.conv_id = i.conv_id and k > h
), listed as (
  select conv_id, list(length(role)::varchar || ':' || role || text order by k) as p, list(length(text) order by k) as sizes from made group by conv_id
), full_ as (
  select i.conv_id, coalesce(p, []) as p, coalesce(sizes, []) as sizes from ids i left join listed using (conv_id)
), prefixes as (
  select conv_id, len(p) as n, d, p[1:d] as p, case when d = 0 then 0 else sizes[d] end as size from (select *, unnest(range(len(p) + 1)) as d from full_)
), nodes as (
  select p, d, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(size) as saved,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d), '')) as ends_sha256
  from prefixes group by p, d
), children as (
  select p[1:d - 1] as p, count(*) as n_children from nodes where d > 0 group by 1
), own as (
  select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children using (p)
), upward as (
  select p[1:u] as p, n_children, saved from (select *, unnest(range(d + 1)) as u from own)
), sums as (
  select p, count(*) filter (n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens from upward group by p
)
select own.conv_id, own.d as depth, up.conv_id as parent_conv_id, own.n_convs, own.n_children, n_leaves, saved_tokens, own.ends_sha256
from own join sums using (p) left join own up on own.d > 0 and up.d = own.d - 1 and up.p = own.p[1:own.d - 1]
"""

SQL: dict[str, str] = {
    "op1_license_scan": LICENSES,
    "op1_license_texts": f"select doc_id, license, dice, licenses from ({LICENSES})",
    "op1_license_lines": LICENSE_LINES,
    "op3_quality_rules": RULES,
    "op4_exact_top_k": TOP_K,
    "op7_ngram_jaccard": JACCARD,
    "op11_spelling_variants": VARIANTS,
    "op12_embedding_near_dedup": NEAR_VECTORS,
    "op13_conversation_trie": TRIE,
}
