"""DuckDB SQL for the registered queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"

SQL: dict[str, str] = {}

SQL["op6_minhash_near_dedup"] = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(coalesce({_LOWER}, ''), {_WORD}) as ws from documents),
s as (
  select doc_id, unnest(case when len(ws) = 0 then []
      when len(ws) < 5 then [array_to_string(ws, ' ')]
      else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) end) as g
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
inter as (select x.doc_id as a, y.doc_id as b, count(*) as k from s x join s y on x.g = y.g and x.doc_id <> y.doc_id
          group by 1, 2),
link as (select a, b from inter join n na on na.doc_id = a join n nb on nb.doc_id = b
         where 100 * k >= 75 * (na.n + nb.n - k)),
reach as (select a as d, b as r from link union select reach.d, link.b from reach join link on reach.r = link.a),
comp as (select d, min(r) as lo from reach group by d)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(w.doc_id, coalesce(lo, w.doc_id)) as component_id,
       w.doc_id = least(w.doc_id, coalesce(lo, w.doc_id)) as kept
from w left join n on n.doc_id = w.doc_id left join comp on comp.d = w.doc_id
"""

_BLOCK_TAG = r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|nav|header|footer|article|section|title)(?:\s[^>]*)?/?>"
_PAGE_TEXT = rf"""replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '(?is)<!--.*?-->|<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g'), '[\r\n]+', ' ', 'g'),
  '{_BLOCK_TAG}', chr(10), 'g'), '<[^>]*>', '', 'g'),
  '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&')"""
_TRIM = "trim({}, ' ' || chr(9) || chr(13) || chr(11) || chr(12))"

SQL["op9_line_dedup"] = rf"""
with p as (
  select page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as host,
         {_PAGE_TEXT} as t from pages),
l as (select page_id, host, unnest(list_distinct(list_filter(list_transform(string_split(t, chr(10)),
        lambda x: {_TRIM.format('x')}), lambda x: x <> ''))) as line from p),
total as (select host, count(*) as pages from p group by host),
bad as (select l.host, line from l join total on l.host is not distinct from total.host
        group by l.host, line, pages having count(*) >= 2 and count(*) > 0.1 * pages),
badly as (select host, list(line) as ls from bad group by host),
q as (select p.*, string_split(t, chr(10)) as a, coalesce(ls, []) as ls
      from p left join badly on p.host is not distinct from badly.host)
select page_id, host, coalesce(len(list_filter(a, lambda x: {_TRIM.format('x')} <> '')), 0) as n_lines,
       coalesce(len(list_filter(a, lambda x: list_contains(ls, {_TRIM.format('x')}))), 0) as n_removed,
       sha256(coalesce(array_to_string(list_filter(a, lambda x: not list_contains(ls, {_TRIM.format('x')})), chr(10)), '')) as kept_sha256
from q
"""

_N = rf"len(regexp_extract_all({{}}, {_WORD}))"
_NAV = (r"(?i)^\s*(?:home|menu|login|log in|sign in|sign up|next|previous|back to top|contact|about us|search|share)"
        r"(?:\s*[|>»·/-]\s*\S.*)?\s*$")
_BOILER = (r"(?i)(?:cookie policy|terms of (?:use|service)|privacy policy|subscribe to our|javascript is (?:disabled|required)"
           r"|lorem ipsum)")

SQL["op4_line_first_rules"] = rf"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, {_WORD}) as ws, string_split(t, chr(10)) as ls from d),
l as (
  select *, list_filter(ls, lambda x: {_N.format('x')} > 0) as lw,
    list_transform(ls, lambda x: struct_pack(n := {_N.format('x')},
      s := len(regexp_extract_all(x, '[#*$%&|<>]')), e := len(regexp_extract_all(x, '!!+(?:[\x20\x09-\x0D]|$)')),
      b := regexp_matches(x, '{_NAV}') or regexp_matches(x, '{_BOILER}'))) as js,
    list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' ')) as win
  from w),
m as (
  select *, coalesce(list_sum(list_transform(list_filter(js, lambda j: j.n > 0 and (j.s * 100 > j.n * 20 or j.e * 100 > j.n * 50
      or (j.n <= 30 and j.b))), lambda j: j.n)), 0) as lost from l),
g as (select doc_id, unnest(win) as g, generate_subscripts(win, 1) as i from l),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from g) where c > 1),
rep as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from twice) group by doc_id),
r as (
  select m.doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(lw) - len(list_distinct(lw)) as n_dup_lines,
    coalesce(rep.n, 0) as n_repeat_words, cast(lost as bigint) as n_lost_words
  from m left join rep on rep.doc_id = m.doc_id)
select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and n_lost_words * 100 <= n_words * 50
  and n_words - n_lost_words >= 20 as kept
from r
"""

SQL["op2_substring_dedup"] = rf"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) as ws from documents),
v as (select doc_id, unnest(list_transform(range(1, len(ws) - 33), lambda i: array_to_string(ws[i:i + 34], ' '))) as g,
             unnest(range(1, len(ws) - 33)) as i from w where len(ws) >= 35),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by g) as c from v) where c > 1),
gone as (select doc_id, list(distinct p) as ps from (select doc_id, unnest(range(i, i + 35)) as p from twice) group by doc_id)
select w.doc_id, len(ws) as n_words, coalesce(len(ps), 0) as n_removed,
       sha256(array_to_string(case when ps is null then ws else list_filter(ws, lambda x, k: not list_contains(ps, k)) end, ' '))
         as kept_sha256
from w left join gone on gone.doc_id = w.doc_id
"""

SQL["op12_prefix_trie"] = """
with recursive bits(i, k, v) as (
  select cast(i as bigint), 0, cast(i as bigint) from range(256) t(i)
  union all select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
tab as (select list(v order by i) as tb from bits where k = 8),
turns as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
            row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place
          from conversations where conv_id is not null),
convs as (select c, c - c % 5 as b, xor(list_reduce(list_prepend(cast(4294967295 as bigint),
              list_transform(string_split(cast(c as varchar), ''), lambda x: cast(ascii(x) as bigint))),
              lambda a, x: xor(a >> 8, tb[1 + (xor(a, x) & 255)])), 4294967295) % 9 as h
          from (select distinct c from turns), tab),
parts as (select convs.c, place, role, text from convs join turns on turns.c = convs.b and place < h
          union all select convs.c, place, role, text from convs join turns on turns.c = convs.c and place >= h),
seqs as (select convs.c, coalesce(s, []) as s from convs left join (
           select c, list([role, text] order by place) as s from parts group by c) l on l.c = convs.c),
prefixes as (select c, s, d, s[1:d] as k from (select c, s, unnest(range(0, len(s) + 1)) as d from seqs)),
nodes as (select k, d, min(c) as conv_id, count(*) as n_convs,
            sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (len(s) = d), '')) as ends_sha256
          from prefixes group by k, d),
kids as (select k[1:d - 1] as k, d - 1 as d, count(*) as n_children from nodes where d > 0 group by 1, 2),
own as (select nodes.*, coalesce(n_children, 0) as n_children, case when d = 0 then 0 else (n_convs - 1) * strlen(k[d][2]) end as saved
        from nodes left join kids using (k, d)),
up as (select k[1:e] as k, e as d, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(saved) as saved_tokens
       from (select *, unnest(range(0, d + 1)) as e from own) group by 1, 2)
select own.conv_id, own.d as depth, top.conv_id as parent_conv_id, own.n_convs, own.n_children,
       cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, own.ends_sha256
from own join up using (k, d) left join nodes top on top.d = own.d - 1 and top.k = own.k[1:own.d - 1]
"""

SQL["op13_source_divergence"] = r"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as id, coalesce(text, '') as text
           from documents),
t as (select lang, source, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term from t group by lang, term having count(distinct id) >= 10),
c as (select lang, source, term, count(*) as n from t join kept using (lang, term) group by all),
v as (select lang, count(*) as v from kept group by lang),
g as (select distinct lang, source from d),
gn as (select g.lang, g.source, cast(coalesce(sum(n), 0) as hugeint) as n from g left join c using (lang, source) group by all),
ln as (select lang, sum(n) as n from gn group by lang),
p as (select gn.lang, gn.source, kept.term, coalesce(c.n, 0) as cnt,
        1 + cast(1000000000 as hugeint) * (coalesce(c.n, 0) + 2) // (gn.n + 2 * v.v) as p
      from gn join kept on gn.lang = kept.lang join v on v.lang = gn.lang
      left join c on c.lang = gn.lang and c.source = gn.source and c.term = kept.term),
lp as (select kept.lang, kept.term, 1 + cast(1000000000 as hugeint) * (sum(c.n) + 2) // (any_value(ln.n) + 2 * any_value(v.v)) as q
       from kept join c using (lang, term) join ln on ln.lang = kept.lang join v on v.lang = kept.lang group by all),
pair as (select a.lang, a.source, b.source as item from g a join g b on a.lang = b.lang and a.source <> b.source),
pv as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
       from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
r as (select lang, source, 'pair' as part, item, cast(coalesce(value, 0) as bigint) as value from pair left join pv using (lang, source, item)
      union all
      select p.lang, p.source, 'term', term, cast((p - q) * (p - q) // (p + q) as bigint)
      from p join lp using (lang, term) where cnt > 0 and p > q),
k as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from r)
select lang, source, part, item, value, rank from k where part = 'pair' or rank <= 10
"""
