"""The queries that SQL can express, written independently for DuckDB."""

from __future__ import annotations

import string

from tallyline.llm.decontaminate import UNITS

_SPLIT = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SUBSTRING_DEDUP = f"""
with w as (select doc_id, {_SPLIT.format(text="coalesce(text, '')")} as ws from documents),
starts as (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w),
windows as (select doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) as k from starts),
firsts as (select k, min(doc_id) as first from windows group by k),
gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as j
  from windows join firsts using (k) where first < doc_id),
words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as j from w),
kept as (
  select doc_id, string_agg(word, ' ' order by j) as text, count(*) as n
  from words anti join gone using (doc_id, j) group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(text, '')) as kept_sha256
from w left join kept using (doc_id)
"""

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

NGRAM_JACCARD = f"""
with recursive w as (select doc_id, {_SPLIT.format(text=_LOWER)} as ws from documents),
s as (
  select distinct doc_id, array_to_string(ws[i:i+3], ' ') as k
  from (select doc_id, ws, unnest(range(1, len(ws) - 2)) as i from w)
  union all select doc_id, array_to_string(ws, ' ') from w where len(ws) between 1 and 3),
n as (select doc_id, count(*) as n from s group by doc_id),
linked as (
  select a.doc_id as a, b.doc_id as b
  from s a join s b on a.k = b.k and a.doc_id < b.doc_id
  join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id
  having 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
edges as (select a, b from linked union all select b, a from linked),
reach(doc_id, c) as (
  select doc_id, doc_id from w
  union select e.b, r.c from reach r join edges e on r.doc_id = e.a)
select doc_id, cast(coalesce(any_value(n.n), 0) as bigint) as n_shingles, min(c) as component_id
from reach left join n using (doc_id) group by doc_id
"""

_JOINED = r"regexp_replace({x}, '([0-9])[.,]([0-9])', '\1\2', 'g')"
_WORDS = (
    r"list_filter(string_split_regex("
    + _JOINED.format(x=_JOINED.format(x="coalesce(text, '')"))
    + r", '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '')"
)
_UNITS = ", ".join(f"'{u}'" for u in UNITS)
_TYPE = f"""case
  when regexp_matches(ws[i], '^[0-9]') then 'n'
  when ws[i] <> lower(ws[i]) and (regexp_matches(ws[i], '^[A-Z]') or unicode(ws[i]) >= 128)
       and ws[i][2:] <> '' and ws[i][2:] = lower(ws[i][2:]) then 'a'
  when i > 1 and regexp_matches(ws[i - 1], '^[0-9]') and lower(ws[i]) in ({_UNITS}) then 'u' end"""


def _windows(name: str, source: str, key: str, wanted: str, slotted: str) -> str:
    """CTEs: ``name``, both keys of every window of the wanted sizes, and ``{name}_slots``, the
    slots of the windows in ``slotted``."""
    return f"""
{name}_words as (select {key}, {_WORDS} as ws from {source}),
{name}_typed as (
  select {key}, ws, list_transform(range(1, len(ws) + 1), lambda i: {_TYPE}) as kinds from {name}_words),
{name}_series as (
  select {key}, ws, kinds, list_transform(range(1, len(ws) + 1), lambda i: case
    when kinds[i] = 'a' or (kinds[i] = 'n' and i > 1 and kinds[i - 1] = 'n' and kinds[i + 1] = 'n') then null
    else kinds[i] end) as fewer from {name}_typed),
{name}_coded as (
  select {key}, len(ws) as n,
         list_transform(range(1, len(ws) + 1), lambda i: coalesce('#' || kinds[i], lower(ws[i]))) as codes,
         list_transform(range(1, len(ws) + 1), lambda i: coalesce('#' || fewer[i], lower(ws[i]))) as folded,
         list_transform(range(1, len(ws) + 1), lambda i: kinds[i] || ':' || lower(ws[i])) as held
  from {name}_series),
{name}_starts as (
  select {key}, n, codes, folded, size, unnest(range(1, n - size + 2)) as i
  from {name}_coded, sizes where size <= n and {wanted}),
{name} as (
  select {key}, n, size, i, array_to_string(codes[i:i+size-1], ' ') as k,
         array_to_string(folded[i:i+size-1], ' ') as fk
  from {name}_starts),
{name}_slots as (
  select *, list_filter(held[i:i+size-1], lambda x: x is not null) as sl,
         list_filter(held[i:i+size-1], lambda x: x is not null and x[1] <> 'a') as fsl,
         len(list_filter(folded[i:i+size-1], lambda x: x[1] = '#')) as placed
  from {slotted} join {name}_coded using ({key}))"""


_PLACES = "list_transform({t}, lambda x: list_position({t}, x))"

_OWN = "(select * exclude (n) from b)"
_MET = "(select distinct doc_id, size, i, item_id, fold, places from either join wanted using (size, k))"
_EITHER = """
either as (
  select doc_id, size, i, k from d union all select doc_id, size, i, fk from d where fk <> k),
d_slots as ("""

DECONTAMINATION = f"""
with sizes as (select unnest(range(6, 13)) as size),
{_windows('b', '(select * from benchmark where text is not null)', 'item_id', '(size = 12 or size = n)', _OWN)},
wanted as (
  select distinct item_id, size, false as fold, k, {_PLACES.format(t='sl')} as places from b_slots
  where size = 12 and size - len(sl) >= 6
  union
  select distinct item_id, size, true, fk, {_PLACES.format(t='fsl')} from b_slots
  where size - placed >= ceil(size * 0.5)),
{_windows('d', '(select * from documents where text is not null)', 'doc_id',
          'size in (select size from wanted)', _MET).replace("d_slots as (", _EITHER.strip())}
select doc_id, item_id, count(distinct i) as n_windows, cast(min(i) - 1 as integer) as first_word
from d_slots
where places = case when fold then {_PLACES.format(t='fsl')} else {_PLACES.format(t='sl')} end
group by doc_id, item_id
"""

EXACT_TOP_K = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
p as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.e, c.e), lambda t: t[1] * t[2])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
),
r as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score
  from p
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""

EXACT_DEDUP = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       row_number() over (partition by t order by doc_id desc) = 1 as kept, sha256(t) as text_sha256
from (select doc_id, coalesce(text, '') as t from documents)
window same as (partition by t)
"""

COLLOCATIONS = f"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from p),
starts as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from w),
cut as (select lang, ws[i:i+4] as g from starts),
sized as (select lang, g, unnest(range(1, len(g) + 1)) as size from cut),
grams as (select lang, size, g[1:size] as g, count(*) as f from sized group by all),
totals as (select lang, sum(f) as n from grams where size = 1 group by lang),
candidates as (select * from grams where size > 1 and f >= 100),
places as (select lang, f, g, size, unnest(range(2, size)) as s from candidates),
inner_places as (select lang, f, g, s, unnest(range(1, size - s + 2)) as j from places),
inner_parts as (select lang, f, g[j:j+s-1] as g from inner_places),
covered as (
  select distinct c.lang, c.g from candidates c
  join inner_parts q on q.lang = c.lang and q.g = c.g and 100 * q.f >= 100 * c.f),
whole as (
  select c.lang, c.g, c.f as a, n, unnest(range(1, c.size)) as k
  from candidates c anti join covered v on v.lang = c.lang and v.g = c.g
  join totals on totals.lang = c.lang),
parts as (select lang, g, a, n, k, g[1:k] as first_part, g[k+1:] as rest from whole),
cuts as (
  select p.lang, p.g, a, l.f as l, r.f as r, n, k,
         (1000::hugeint * a * n) // (l.f::hugeint * r.f) as score
  from parts p
  join grams l on l.lang = p.lang and l.g = p.first_part
  join grams r on r.lang = p.lang and r.g = p.rest),
best as (
  select *, row_number() over (partition by lang, g order by score, k) as choice,
         array_to_string(g, ' ') as phrase from cuts),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from best where choice = 1)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked where rank <= 2000
"""
