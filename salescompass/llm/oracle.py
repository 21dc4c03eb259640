"""The same queries as SQL, for checking only."""

from __future__ import annotations

_BLANKS = r"[\x20\x09-\x0D]+"

OP1 = rf"""
with w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_BLANKS}'), lambda x: x <> '') as ws from documents),
pos as (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from w where len(ws) >= 13),
win as (select doc_id, i, array_to_string(ws[i : i + 12], ' ') as s from pos),
least as (select s, min(doc_id) as m from win group by s),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as k from win join least using (s) where m < doc_id),
each as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as k from w),
kept as (select doc_id, string_agg(word, ' ' order by k) as t, count(*) as n from each anti join gone using (doc_id, k) group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from w left join kept using (doc_id)
"""

OP3 = rf"""
with l as (select doc_id, case when coalesce(text, '') = '' then [] else string_split(text, chr(10)) end as ls from documents),
pos as (select doc_id, ls, 'run' as kind, 3 as m, unnest(range(1, len(ls) - 1)) as i from l where len(ls) >= 3
  union all select doc_id, ls, 'document', len(ls), 1 from l where len(ls) between 1 and 2
  union all select * from (select doc_id, ls, 'line', 1, unnest(range(1, len(ls) + 1)) as i from l)
    where len(list_filter(string_split_regex(ls[i], '{_BLANKS}'), lambda x: x <> '')) >= 8),
win as (select doc_id, kind, m, i, array_to_string(ls[i : i + m - 1], chr(10)) as s from pos),
least as (select kind, s, min(struct_pack(d := doc_id, i := i)) as e from win group by kind, s),
gone as (select distinct doc_id, unnest(range(i, i + m)) as k from win join least using (kind, s) where e <> struct_pack(d := doc_id, i := i)),
each as (select doc_id, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as k from l),
kept as (select doc_id, string_agg(line, chr(10) order by k) as t, count(*) as n from each anti join gone using (doc_id, k) group by doc_id)
select l.doc_id, len(ls)::bigint as n_lines, (len(ls) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from l left join kept using (doc_id)
"""

OP4 = r"""
with u as (select page_id, coalesce(substr(url, nullif(strpos(url, '://'), 0) + 3), '') as rest from pages),
h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
rules(rule, r_host, r_path, r_verdict) as (values ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fit as (select page_id, arg_max(rule, length(rule)) as rule, arg_max(r_verdict, length(rule)) as verdict
  from h join rules on ends_with('.' || host, '.' || r_host) and starts_with(path, r_path) group by page_id)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from h left join fit using (page_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP6 = rf"""
with d as (select doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as ws from documents),
b as (select item_id::varchar as item, regexp_extract_all({_LOWER}, '{_WORD}') as ws from benchmark),
bw as (select item, least(10, len(ws)) as m, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as i from b where len(ws) > 0),
bs as (select distinct item, m, array_to_string(ws[i : i + m - 1], ' ') as s from bw),
sizes as (select distinct m from bs),
dw as (select doc_id, m, ws, unnest(range(1, len(ws) - m + 2)) as i from d join sizes on len(ws) >= m),
hits as (select doc_id, item, m, i from dw join bs using (m) where array_to_string(ws[i : i + m - 1], ' ') = s),
words as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(i, i + m)) as k from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""

# crc32 from its table of 256 steps; DuckDB has no such function
OP13 = r"""
with recursive bits(i, c, k) as (select range, range::bigint, 0 from range(256) union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
tbl as (select list(c order by i) as t from bits where k = 8),
r as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[a-z\x{00C0}-\x{00FF}]+')) as w from documents),
d as (select doc_id, w, count(*) as n, hex(encode(doc_id::varchar || ':' || w)) as x from r group by doc_id, w),
h as (select w, n, xor(list_reduce(list_prepend(4294967295::bigint, [('0x' || substr(x, 2 * i + 1, 2))::bigint for i in range(length(x) // 2)]),
  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) as h from d, tbl),
e as (select case when h % 199 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, n from h),
words as (select word, sum(n)::bigint as n from e where length(word) >= 6 group by word having sum(n) >= 5),
places as (select word, n, unnest(range(length(word))) as i from words),
holes as (select word, n, i, substr(word, 1, i) || '*' || substr(word, i + 2) as hole from places),
cuts as (select distinct word, n, substr(word, 1, i) || substr(word, i + 2) as cut from places),
near as (select a.word, b.word as near, b.n as near_n from holes a join holes b using (hole) where a.word <> b.word
  union all select cuts.word, words.word, words.n from cuts join words on cut = words.word
  union all select words.word, cuts.word, cuts.n from cuts join words on cut = words.word),
best as (select word, count(*) as n_near, min(struct_pack(less := -near_n, near := near)) as b from near group by word),
forms as (select words.word, n, coalesce(n_near, 0)::bigint as n_near, case when -b.less >= 5 * n then b.near end as form,
  case when -b.less >= 5 * n then -b.less end as form_n from words left join best using (word)),
chain as (select word, coalesce(form, word) as root, form is not null as on_way from forms
  union all select c.word, coalesce(f.form, f.word), f.form is not null from chain c join forms f on f.word = c.root where c.on_way)
select word, form, root, n, n_near, form_n from forms join (select word, root from chain where not on_way) using (word)
"""

ORACLE: dict[str, str] = {"op1_substring_dedup": OP1, "op3_line_dedup": OP3, "op4_url_filter": OP4, "op6_decontamination": OP6, "op13_spelling_variants": OP13}
