"""Near-duplicate sections: within a text (greedy, best first) and across all documents."""

from __future__ import annotations

from campusloom import rules
from registry.base import query

_SCORE = " + ".join(f"case when regexp_matches(t, '(?i){p}') then {w} else 0 end" for p, w in rules.SECTION_SCORES)
_WORDS = r"list_distinct(regexp_split_to_array(lower(t), '\s+'))"

#: Greedy pass: the n-th best section of a text joins those kept unless it is too similar to one of them.
RANKED_SQL = rf"""
with recursive raw as (
  select doc_id, text, regexp_split_to_array(replace(text, chr(10), '[PAGE 1]'), '{rules.SECTION_MARK}') as parts from documents
), trimmed as (
  select doc_id, generate_subscripts(parts, 1) as pos, regexp_replace(unnest(parts), '^\s+|\s+$', '', 'g') as t from raw
), ranked as (
  select doc_id, t, {_WORDS} as w, row_number() over (partition by doc_id order by {_SCORE} desc, pos) as place from trimmed where length(t) >= 40
), walk as (
  select doc_id, 0::bigint as place, []::struct(t varchar, w varchar[])[] as kept from documents
  union all
  select walk.doc_id, ranked.place,
    case when len(list_filter(kept, lambda k: len(list_intersect(k.w, ranked.w))::double / greatest(len(k.w), len(ranked.w)) > 0.65)) > 0 then kept
      else list_append(kept, {{'t': ranked.t, 'w': ranked.w}}) end
  from walk join ranked on ranked.doc_id = walk.doc_id and ranked.place = walk.place + 1
), best as (
  select doc_id, arg_max(kept, place) as kept from walk group by doc_id
)
select doc_id, case when length(coalesce(replace(text, chr(10), '[PAGE 1]'), '')) < 50 then coalesce(replace(text, chr(10), '[PAGE 1]'), '')
  else array_to_string(list_transform(kept, lambda k, i: '[SECTION ' || i || ']' || chr(10) || k.t), chr(10) || chr(10) || '---' || chr(10) || chr(10)) end as content
from documents join best using (doc_id)
"""

#: The same join with prefix words by rising frequency; pairs are listed here, which the operator never does.
_SIMILAR_SQL = rf"""
with parts as (
  select doc_id, string_split(text, chr(10)) as parts from documents
), trimmed as (
  select doc_id, generate_subscripts(parts, 1) - 1 as section, regexp_replace(unnest(parts), '^\s+|\s+$', '', 'g') as t from parts
), sec as (
  select row_number() over (order by doc_id, section) as id, doc_id, section, {_WORDS} as w from trimmed where length(t) >= 40
), word as (
  select id, len(w) as n, unnest(w) as x from sec
), placed as (
  select id, n, x, row_number() over (partition by id order by df, x) as place from (select *, count(*) over (partition by x) as df from word)
), prefix as (
  select id, n, x from placed where place <= n - floor(0.65 * n)
), pairs as (
  select distinct a.id as a, b.id as b from prefix a join prefix b on a.x = b.x and a.id < b.id and least(a.n, b.n) > 0.65 * greatest(a.n, b.n)
), near as (
  select a, b from pairs join sec x on x.id = a join sec y on y.id = b where len(list_intersect(x.w, y.w))::double / greatest(len(x.w), len(y.w)) > 0.65
), both_ways as (
  select a, b from near union all select b, a from near
), partners as (
  select a as id, count(*) as n_similar, min(b) as low from both_ways group by a
)
select sec.doc_id, sec.section, coalesce(n_similar, 0) as n_similar, f.doc_id as first_doc_id, f.section as first_section
from sec left join partners using (id) join sec f on f.id = least(sec.id, coalesce(low, sec.id))
"""


@query("J14 U4", _SIMILAR_SQL)
def similar_sections(t):
    from campusloom.operators.similar import similar_sections as similar

    return similar(t.documents, "doc_id", "text")
