"""DuckDB SQL of the queries that SQL can express over whole tables."""

#: Splits tags at their brackets and addresses at their separators; shares no pattern with the DataFrame code.
OP9 = r"""
with recursive cut as (select page_id, html, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
ends as (select *, least(length(rest) + 1, coalesce(nullif(strpos(rest, '/'), 0), 1000000000), coalesce(nullif(strpos(rest, '?'), 0), 1000000000),
  coalesce(nullif(strpos(rest, '#'), 0), 1000000000)) as e from cut),
hp as (select page_id, html, array_to_string(list_transform(string_split(substr(rest, 1, e - 1), ''), lambda c: case when c between 'A' and 'Z' and length(c) = 1
  and ascii(c) between 65 and 90 then chr(ascii(c) + 32) else c end), '') as host, string_split(string_split(substr(rest, e), '?')[1], '#')[1] as path from ends),
tag as (select host, path, unnest(list_transform(string_split(html, '<')[2:], lambda t: string_split(t, '>')[1])) as t from hp
  where contains(lower(html), 'canonical') or contains(lower(html), 'refresh')),
attr as (select host, path, lower(regexp_extract(t, '^[A-Za-z]+')) as name, regexp_extract_all(t, '[\s]([A-Za-z-]+)[\s]*=[\s]*("[^"]*"|''[^'']*''|[^\s"'']+)', 1) as k,
  regexp_extract_all(t, '[\s]([A-Za-z-]+)[\s]*=[\s]*("[^"]*"|''[^'']*''|[^\s"'']+)', 2) as v from tag),
kv as (select host, path, name, list_transform(k, lambda x: lower(x)) as k, list_transform(v, lambda x: case when x[1] in ('"', '''') then x[2:length(x) - 1] else x end) as v from attr),
raw as (select host, path, v[list_position(k, 'href')] as u from kv where name = 'link' and list_contains(string_split(lower(v[list_position(k, 'rel')]), ' '), 'canonical')
 union all select host, path, case when least(coalesce(nullif(strpos(c, ';'), 0), 1000000000), coalesce(nullif(strpos(c, ','), 0), 1000000000)) < 1000000000 then
  ltrim(substr(c, least(coalesce(nullif(strpos(c, ';'), 0), 1000000000), coalesce(nullif(strpos(c, ','), 0), 1000000000)) + 1)) end
  from (select host, path, v[list_position(k, 'content')] as c from kv where name = 'meta' and starts_with(trim(lower(v[list_position(k, 'http-equiv')])), 'refresh'))),
bare as (select host, path, case when lower(u[1:3]) = 'url' and ltrim(u[4:])[1] = '=' then ltrim(ltrim(u[4:])[2:]) else u end as u from raw where u is not null),
clean as (select host, path, replace(replace(trim(replace(replace(u, '"', ''), '''', '')), '&#47;', '/'), '&amp;', '&') as u from bare),
kind as (select host, path, u, case when starts_with(u, '//') then u[3:] when strpos(u, '://') > 0 then u[strpos(u, '://') + 3:] end as r from clean where u <> ''),
named as (select host, path, case when r is not null then lower(string_split(string_split(string_split(r, '/')[1], '?')[1], '#')[1]) else host end as h,
 case when r is not null then string_split(string_split(case when strpos(r, '/') > 0 then substr(r, strpos(r, '/')) else '' end, '?')[1], '#')[1] when u[1] in ('?', '#') then path
 when u[1] = '/' then string_split(string_split(u, '?')[1], '#')[1]
 else coalesce(nullif(array_to_string(string_split(path, '/')[:-2], '/'), '') || '/', '/') || string_split(string_split(u, '?')[1], '#')[1] end as q
 from kind where r is not null or strpos(string_split(string_split(u, '/')[1], '?')[1], ':') = 0),
edges as (select host || path as a, h || case when q = '' then q else list_reduce(list_concat([''], string_split(q, '/')[2:], case when string_split(q, '/')[-1] in ('.', '..') then [''] else [] end),
 lambda acc, s: case s when '.' then acc when '..' then case when contains(acc, '/') then substr(acc, 1, length(acc) - length(string_split(acc, '/')[-1]) - 1) else '' end
 else acc || '/' || s end) end as b from named),
good as (select a, b from edges where a <> '' and b <> '' and a <> b union select b, a from edges where a <> '' and b <> '' and a <> b),
reach as (select a, b from good union select r.a, g.b from reach r join good g on r.b = g.a),
nodes as (select host || path as node, host, path from hp union select b, string_split(b, '/')[1], substr(b, length(string_split(b, '/')[1]) + 1) from good),
rules as (select * from (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) as r (h, p, v)),
own as (select node, host, path, max_by(h || p, length(h || p)) as rule, max_by(v, length(h || p)) as v
 from nodes left join rules on ends_with('.' || host, '.' || h) and starts_with(path, p) group by all)
select page_id, hp.host, hp.path, own.rule,
 coalesce(own.v, case when exists (select 1 from reach r join own o on o.node = r.b where r.a = own.node and o.v = 'block') then 'block' else 'allow' end) as verdict
from hp join (select distinct node, rule, v from own) own on own.node = hp.host || hp.path
"""

OP10 = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, unnest(list_transform(range(1, len(w) - 18), lambda s: array_to_string(list_slice(w, s, s + 19), ' '))) as t, unnest(range(1, len(w) - 18)) as s from d where len(w) >= 20),
again as (select doc_id, s from win qualify row_number() over (partition by t order by doc_id, s) > 1),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as p from again),
word as (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as p from d),
kept as (select doc_id, count(*) as n, string_agg(x, ' ' order by p) as t from word anti join gone using (doc_id, p) group by doc_id)
select d.doc_id, len(d.w) as n_words, len(d.w) - coalesce(kept.n, 0) as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256 from d left join kept using (doc_id)
"""

OP13 = r"""
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
best as (select doc_id, t, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from d)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(t) as text_sha256 from best
"""
