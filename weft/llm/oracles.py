"""SQL that gives the results of operators whose definitions SQL can express, for tables of a size that it can hold."""

from __future__ import annotations

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Windows of items are joined to the windows of the same lengths of documents.
DECONTAMINATION = f"""
with items as (select distinct item_id::varchar as item_id, {_WORDS.format("text")} as ws from benchmark),
parts as (select distinct item_id, least(len(ws), 10) as size, array_to_string(ws[k : k + least(len(ws), 10) - 1], ' ') as win
  from (select *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as k from items where len(ws) > 0)),
docs as (select row_number() over () as r, doc_id, {_WORDS.format("text")} as ws from documents),
sizes as (select distinct size from parts),
windows as (select r, k, size, array_to_string(ws[k : k + size - 1], ' ') as win from (select r, ws, size, unnest(range(1, len(ws) - size + 2)) as k from docs, sizes where len(ws) >= size)),
met as (select r, k, size, item_id from windows join parts using (size, win)),
hit as (select r, count(distinct p) as n from (select r, unnest(range(k, k + size)) as p from met) group by r),
named as (select r, list_sort(list(distinct item_id)) as ids from met where item_id is not null group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_hit, coalesce(len(ids), 0)::bigint as n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, coalesce(n, 0) > 0 as contaminated
from docs left join hit using (r) left join named using (r)"""

#: Similarities by counting the runs of five words that two different sets share; classes by following links.
JACCARD_JOIN = f"""
with recursive docs as (select doc_id, {_WORDS.format("text")} as ws from documents),
texts as (select doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda k: array_to_string(ws[k : k + 4], ' ')))) as grams from docs where len(ws) > 0),
sets as (select md5(array_to_string(grams, chr(10))) as s, any_value(grams) as grams, count(*) as copies, min(doc_id) as least_id from texts group by 1),
grams as (select s, len(grams) as n, unnest(grams) as g from sets),
links as (select a.s as x, b.s as y from grams a join grams b on a.g = b.g and a.s <> b.s group by a.s, b.s, a.n, b.n having 5 * count(*) >= 4 * (a.n + b.n - count(*))),
reached as (select s as x, s as y from sets union select r.x, l.y from reached r join links l on r.y = l.x),
classes as (select r.x, min(t.least_id) as class_id from reached r join sets t on r.y = t.s group by r.x),
degrees as (select l.x, sum(t.copies)::bigint as n from links l join sets t on l.y = t.s group by l.x)
select t.doc_id, c.class_id, (s.copies - 1 + coalesce(d.n, 0))::bigint as n_links
from (select doc_id, md5(array_to_string(grams, chr(10))) as s from texts) t join sets s using (s) join classes c on c.x = t.s left join degrees d on d.x = t.s
union all select doc_id, doc_id, 0 from docs where len(ws) = 0"""

#: All strings of 100 bytes, by the hash of their hexadecimal digits; ids are unique.
REPEATS = """
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as h, (octet_length(encode(coalesce(text, ''))))::bigint as n from documents),
starts as (select doc_id, k, md5(substr(h, 2 * k + 1, 200)) as s from (select doc_id, h, unnest(range(0, n - 99)) as k from docs where n >= 100)),
later as (select doc_id, k from (select doc_id, k, row_number() over (partition by s order by doc_id, k) as r from starts) where r > 1),
marked as (select doc_id, k, case when k <= lag(k) over (partition by doc_id order by k) + 100 then 0 else 1 end as first from later),
spans as (select doc_id, i, min(k) as a, max(k) + 100 as b from (select *, sum(first) over (partition by doc_id order by k) as i from marked) group by doc_id, i),
kept as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as p, a as q from spans union all select doc_id, max(b), null from spans group by doc_id),
pieces as (select k.doc_id, string_agg(substr(h, (2 * p + 1)::bigint, (2 * (coalesce(q, n) - p))::bigint), '' order by p) as h from kept k join docs d using (doc_id) group by k.doc_id),
sums as (select doc_id, sum(b - a)::bigint as n_removed, count(*)::bigint as n_spans from spans group by doc_id)
select d.doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(p.h, d.h))) as kept_sha256
from docs d left join sums s using (doc_id) left join pieces p using (doc_id)"""
