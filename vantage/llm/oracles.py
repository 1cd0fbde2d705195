"""DuckDB twins of the llm queries that SQL can express (brute force, for small scale factors)."""

SQL: dict[str, str] = {}

SQL["op10_minhash_near_dedup"] = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as ws
  from documents),
sh as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as s
  from w),
n as (select doc_id, count(*) as n from sh group by doc_id),
link as materialized (
  select a.doc_id as u, b.doc_id as v
  from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id
  join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, na.n, nb.n
  having 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach(u, v) as (
  select u, v from link union select r.u, l.v from reach r join link l on r.v = l.u),
comp as (select u as doc_id, least(u, min(v)) as c from reach group by u)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(c.c, d.doc_id) as component_id,
       d.doc_id = coalesce(c.c, d.doc_id) as kept
from documents d left join n using (doc_id) left join comp c using (doc_id)
"""

SQL["op8_fm_index_dedup"] = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (
  select doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) as h
  from (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from w where len(ws) >= 35)),
rep as (select doc_id, i from win where h in (select h from win group by h having count(*) > 1)),
cut as (select distinct doc_id, unnest(range(i, i + 35)) as j from rep),
word as (select doc_id, unnest(range(1, len(ws) + 1)) as j, unnest(ws) as x from w),
kept as (
  select word.doc_id, string_agg(x, ' ' order by word.j) as t, count(*) as n
  from word left join cut on cut.doc_id = word.doc_id and cut.j = word.j where cut.j is null group by word.doc_id)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(kept.n, 0))::bigint as n_removed,
       sha256(coalesce(kept.t, '')) as kept_sha256
from w left join kept using (doc_id)
"""

SQL["op11_decontamination"] = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
win as (
  select distinct item_id, least(10, len(ws)) as m, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') as s
  from (select item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as i from b where len(ws) > 0)),
gram as (
  select doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') as s
  from (select doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) as i from d, (select distinct m from win) where len(ws) >= m)),
hit as (select gram.doc_id, gram.m, gram.i, win.item_id from gram join win using (m, s)),
cover as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + m)) as j from hit) group by doc_id),
named as (
  select doc_id, count(*) as n, string_agg(x, ',' order by x) as t
  from (select distinct doc_id, item_id::varchar as x from hit) group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(cover.n, 0)::bigint as n_hit, coalesce(named.n, 0)::bigint as n_items,
       sha256(coalesce(named.t, '')) as items_sha256, cover.n is not null as contaminated
from d left join cover using (doc_id) left join named using (doc_id)
"""
