"""SQL (DuckDB) for the queries that SQL can express; the others are tested against plain versions."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op4_url_lists"] = r"""
with captures as (
  select page_id, url, date '2021-01-01' + cast(page_id % 1000 as int) as fetched_on,
    nullif(regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.+$', ''), '') as host
  from pages),
hosts as (select distinct host from captures where host is not null),
digits as (
  select host, md5(host) as h, regexp_extract(host, '([^.]+\.[^.]+)$', 1) as parent, md5(regexp_extract(host, '([^.]+\.[^.]+)$', 1)) as p from hosts),
n as (
  select *, cast('0x' || substr(h, 1, 4) as int) as h1, cast('0x' || substr(h, 5, 4) as int) as h5, cast('0x' || substr(h, 9, 4) as int) as h9,
    cast('0x' || substr(h, 13, 4) as int) as h13, cast('0x' || substr(p, 1, 4) as int) as p1 from digits),
entries as (
  select host as key, date '2020-06-01' + h1 % 1200 as since, 'block' as action from n where h9 % 3 > 0
  union all select host, date '2020-06-01' + (h1 % 1200 + h5 % 500), case when h13 % 2 = 0 then 'remove' else 'allow' end from n where h9 % 3 > 0
  union all select distinct parent, date '2020-06-01' + p1 % 1200, 'block' from n where parent <> ''),
asked as (
  select host, fetched_on, unnest(range(1, len(string_split(host, '.')) + 1)) as labels from (select distinct host, fetched_on from captures where host is not null)),
keyed as (select *, array_to_string(list_slice(string_split(host, '.'), -labels, -1), '.') as key from asked),
latest as (
  select host, fetched_on, labels, key, max((since, action)) as e from keyed join entries using (key) where since <= fetched_on group by all),
best as (
  select host, fetched_on, max((labels, key, e[2])) as b from latest where e[2] <> 'remove' group by all)
select page_id, url, fetched_on, host, b[2] as rule, b[3] as action, coalesce(b[3], '') <> 'block' as kept
from captures left join best using (host, fetched_on)
"""

SQL["op6_mixing"] = r"""
with docs as (
  select doc_id, lang, source, 'd' || cast('0x' || substr(md5(source), 1, 4) as int) % 3 as domain,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as n_tokens from documents),
leaf as (
  select domain, lang, source, sum(n_tokens) as tokens, 4.0::double * sum(n_tokens) as capacity,
    (case when lang = 'en' then 5 when lang in ('de', 'fr') then 2 else 1 end * (1 + cast('0x' || substr(md5(source), 5, 4) as int) % 5))::double as weight
  from docs group by all),
l1 as (select domain, sum(weight) as weight, sum(capacity) as capacity, (select sum(tokens) * 0.8::double from leaf) as up from leaf group by all),
f1 as (
  select *, greatest(0, up - coalesce(sum(capacity) over (order by capacity / weight, domain rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by capacity / weight, domain rows between current row and unbounded following) as level from l1),
b1 as (select domain, least(capacity, coalesce(max(case when level * weight < capacity then level end) over () * weight, capacity)) as budget from f1),
l2 as (select domain, lang, sum(weight) as weight, sum(capacity) as capacity, any_value(budget) as up from leaf join b1 using (domain) group by all),
f2 as (
  select *, greatest(0, up - coalesce(sum(capacity) over (partition by domain order by capacity / weight, lang rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (partition by domain order by capacity / weight, lang rows between current row and unbounded following) as level from l2),
b2 as (
  select domain, lang, least(capacity, coalesce(max(case when level * weight < capacity then level end) over (partition by domain) * weight, capacity)) as budget from f2),
f3 as (
  select *, greatest(0, b2.budget - coalesce(sum(capacity) over (partition by domain, lang order by capacity / weight, source rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (partition by domain, lang order by capacity / weight, source rows between current row and unbounded following) as level
  from leaf join b2 using (domain, lang)),
b3 as (
  select domain, lang, source, tokens,
    least(capacity, coalesce(max(case when level * weight < capacity then level end) over (partition by domain, lang) * weight, capacity)) as budget from f3),
plan as (select *, case when tokens > 0 then floor(budget / tokens) else 0 end::int as whole from b3),
drawn as (
  select docs.*, whole, greatest(0, budget - whole * tokens) as rest, substr(md5('17:' || whole || ':' || doc_id), 1, 16) as draw
  from docs join plan using (domain, lang, source)),
run as (
  select *, coalesce(sum(n_tokens) over (partition by domain, lang, source order by draw, doc_id rows between unbounded preceding and 1 preceding), 0) as before from drawn)
select doc_id, domain, lang, source, n_tokens, (whole + (before < rest)::int)::int as copies from run
"""

_LOOKS_DRAWN = r"""(length(value) >= 16 and length(value) - length(regexp_replace(value, '[A-Za-z]', '', 'g')) >= 4
  and length(value) - length(regexp_replace(value, '[0-9]', '', 'g')) >= 4 and len(list_distinct(string_split(value, ''))) >= 10)"""

_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

SQL["op7_secret_scan"] = rf"""
with kinds(kind, rank, pattern, least) as (values
  ('assign', 1, '{_ASSIGN}', 6), ('access', 2, 'AKIA[A-Z0-9]+', 20), ('hex', 3, '[0-9a-f]+', 24), ('loose', 4, '[A-Za-z0-9+/_=-]+', 20)),
texts as (select doc_id, source, coalesce(text, '') as text from documents),
lists as (
  select doc_id, source, 'assign' as kind, string_split_regex(text, '{_ASSIGN}') as gaps, regexp_extract_all(text, '{_ASSIGN}') as hits from texts
  union all select doc_id, source, 'access', string_split_regex(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+') from texts
  union all select doc_id, source, 'hex', string_split_regex(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+') from texts
  union all select doc_id, source, 'loose', string_split_regex(text, '[A-Za-z0-9+/_=-]+'), regexp_extract_all(text, '[A-Za-z0-9+/_=-]+') from texts),
hits as (
  select doc_id, source, kind, unnest(hits) as hit, unnest(list_slice(gaps, 1, len(hits))) as gap, unnest(range(len(hits))) as i from lists),
placed as (
  select *, sum(length(gap) + length(hit)) over (partition by doc_id, kind order by i) as stop from hits),
valued as (
  select p.*, rank, stop - length(hit) as start, case when kind = 'assign' then regexp_extract(hit, '{_ASSIGN}', 2) else hit end as value
  from placed p join kinds using (kind) where length(case when kind = 'assign' then regexp_extract(hit, '{_ASSIGN}', 2) else hit end) >= least),
base as (select * from valued where kind <> 'loose'),
loose as (
  select * from valued v where kind = 'loose' and {_LOOKS_DRAWN}
    and not exists (select 1 from base b where b.doc_id = v.doc_id and b.start < v.stop and b.stop > v.start)),
found as (select * from base union all select * from loose),
owners as (select value, count(distinct source) as owners, count(distinct doc_id) as repositories from found group by all),
spans as (select f.* from found f join owners using (value) where kind <> 'loose' or (owners < 5 and repositories < 50)),
lines as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by start, rank) filter (kind <> 'loose') as base,
    string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by start, rank) as spans
  from spans group by all)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join lines using (doc_id)
"""

SQL["op8_host_rules"] = r"""
with texts as (
  select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as filled from documents),
grams as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) as g from texts),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) as n from grams) where n > 1),
covered as (select doc_id, count(distinct i + k) as n from twice, (select unnest([0, 1, 2]) as k) group by all),
rules as (
  select doc_id, source, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols, len(filled) - len(list_distinct(filled)) as n_dup_lines,
    len(string_split(text, chr(10))) as n_lines, coalesce(n, 0) as n_repeat_words
  from texts left join covered using (doc_id)),
failed as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as f1, 10 * n_symbols > n_words as f2, 10 * n_dup_lines > 3 * n_lines as f3 from rules),
long as (select source, unnest([1, 2, 3]) as rule, unnest([f1, f2, f3])::int as f from failed where source is not null),
hosts as (select source, rule, count(*) as n, sum(f) as k from long group by all),
moments as (
  select rule, sum(k) / sum(n)::double as m, sum(k * k / n::double) / sum(n) - (sum(k) / sum(n)::double) ** 2 as spread, count(*) / sum(n)::double as share
  from hosts group by all),
priors as (
  select rule, m, case when spread - m * (1 - m) * share > 0 then least(1e6, greatest(1.0, m * (1 - m) / (spread - m * (1 - m) * share) - 1)) else 1e6 end as weight
  from moments),
verdicts as (select source, max((k + m * weight) / (n + weight)) > 0.5 as host_failed from hosts join priors using (rule) group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 as base_failed, coalesce(host_failed, false) as host_failed,
  not f1 and not coalesce(host_failed, false) as kept
from failed left join verdicts using (source)
"""

SQL["op10_chat_format"] = r"""
with turns as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
convs as (
  select conv_id, list({'role': role, 'text': text} order by turn nulls first, role, text) as t
  from turns group by conv_id, case when conv_id is null then {'turn': turn, 'role': role, 'text': text} end),
prefixes as (select distinct list_slice(t, 1, k) as t from (select t, unnest(range(1, len(t))) as k from convs)),
whole as (select t, min(conv_id) as conv_id, count(*) as n_copies from convs group by all)
select conv_id, len(t) as n_turns, n_copies,
  array_to_string(list_transform(t, lambda p: '<|im_start|>' || p.role || chr(10) || p.text || '<|im_end|>' || chr(10)), '') as text
from whole where t not in (select t from prefixes)
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op11_lexical_search"] = rf"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents),
asked as (
  select distinct item_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
corpus as (select count(*) filter (len(t) > 0) as big_n, coalesce(sum(len(t)), 0)::bigint as big_l from docs),
lengths as (select r, doc_id, 100 - 90 + (90 * len(t) * big_n) // greatest(big_l, 1) as m from docs, corpus),
tf as (select r, term, count(*) as tf from (select r, unnest(t) as term from docs) group by all),
df as (select term, count(*) as df from tf group by all),
w as (select term, floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1)::double))::bigint as w from df, corpus),
scores as (
  select item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join w using (term) join tf using (term) join lengths using (r) group by all),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
  from scores join lengths using (r) where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

SQL["op12_collocations"] = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
lists as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, k, w[i:i + k - 1] as p from (select lang, w, unnest(range(1, len(w) + 1)) as i from lists), (select unnest([1, 2, 3]) as k)
  where i + k - 1 <= len(w)),
f as (select lang, p, k, count(*) as a from grams group by all),
totals as (select lang, sum(a)::bigint as n from f where k = 1 group by all),
candidates as (select * from f where k > 1 and a >= 10),
cuts as (
  select c.lang, c.p, c.a, cut, l.a as l, r.a as r, ((1000000::hugeint * c.a * c.a) // (l.a::hugeint * r.a))::bigint as score
  from (select *, unnest(range(1, k)) as cut from candidates) c
  join f l on l.lang = c.lang and l.p = c.p[1:cut] join f r on r.lang = c.lang and r.p = c.p[cut + 1:]),
weakest as (select lang, p, a, min((score, cut, l, r)) as m from cuts group by all),
inside as (
  select lang, p, max(a) as longer from (select lang, unnest([p[1:2], p[2:3]]) as p, a from candidates where k = 3) group by all),
ranked as (
  select lang, array_to_string(p, ' ') as phrase, weakest.a, m[3] as l, m[4] as r, m[1] as score
  from weakest left join inside using (lang, p) where longer is null or 100 * longer < 50 * weakest.a),
placed as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from ranked)
select lang, rank, phrase, a, l, r, n, score from placed join totals using (lang) where rank <= 2000
"""
