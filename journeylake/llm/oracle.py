"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from .mixing import STEPS

OP2 = """
with docs as (
  select distinct doc_id, coalesce(text, '') as text, md5(coalesce(text, '')) as text_md5,
         string_split(coalesce(text, ''), chr(10)) as lines
  from documents),
numbered as (
  select doc_id, text_md5, unnest(lines) as line, unnest(range(0, len(lines))) as i from docs),
hashed as (
  select doc_id, text_md5, i, ('0x' || substr(md5(line), 1, 8))::bigint as h from numbered where regexp_matches(line, '[^ \\t\\r\\f\\x0B]')),
windows as (
  select doc_id, text_md5, i, lag(i) over w as before, h, h + 31 * lag(h) over w as h2
  from hashed window w as (partition by doc_id, text_md5 order by i)),
classes as (
  select doc_id, text_md5, i as b, i as e, bit as rule, (h >> bit) & 1 as kind from windows, range(0, 3) r(bit)
  union all
  select doc_id, text_md5, before, i, 3, h2 & 1 from windows where before is not null),
spans as (
  select doc_id, text_md5, lag(b) over (partition by doc_id, text_md5, rule, kind order by e) as start, e from classes),
chunks as (
  select distinct doc_id, text_md5, start, e - start + 1 as n_lines, array_to_string(lines[start + 1 : e + 1], chr(10)) as chunk
  from spans join docs using (doc_id, text_md5) where start is not null),
firsts as (
  select *, first_value(doc_id) over w as d0, first_value(text_md5) over w as m0, first_value(start) over w as s0
  from chunks window w as (partition by chunk order by doc_id, text_md5, start)),
cut as (
  select doc_id, text_md5, start, n_lines from firsts where not (doc_id = d0 and text_md5 = m0 and start - s0 < n_lines)),
gone as (
  select distinct doc_id, text_md5, unnest(range(start, start + n_lines)) as i from cut),
counts as (
  select doc_id, text_md5, count(*) as n_chunks from cut group by all),
lost as (
  select doc_id, text_md5, count(*) as n_gone from gone group by all),
kept as (
  select n.doc_id, n.text_md5, string_agg(n.line, chr(10) order by n.i) as text
  from numbered n anti join gone g on n.doc_id = g.doc_id and n.text_md5 = g.text_md5 and n.i = g.i
  group by all)
select d.doc_id, len(string_split(coalesce(d.text, ''), chr(10))) as n_lines, coalesce(c.n_chunks, 0) as n_removed_chunks,
       coalesce(l.n_gone, 0) as n_removed_lines, md5(coalesce(k.text, '')) as kept_md5
from (select *, md5(coalesce(text, '')) as text_md5 from documents) d left join counts c using (doc_id, text_md5)
left join lost l using (doc_id, text_md5) left join kept k using (doc_id, text_md5)
"""

OP3 = """
with n as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n
"""


def mixture(documents: str, columns: str) -> str:
    """The mixture of the rows of ``documents``; every source gets the same share."""
    return f"""
rates as (
  select coalesce(source, '') as s,
         (1.0::double / (sum(1.0::double) over ())) * sum(count(*)) over () / count(*) as rate
  from {documents} group by 1),
parts as (
  select s, rate, greatest(1, ceil(rate / 16))::int as n_parts from rates),
terms as (
  select s, rate, n_parts, k, sum(ln(rate / n_parts)) over w - sum(case when k = 0 then 0 else ln(k) end) over w as log_p
  from parts, range(0, {STEPS + 1}) r(k) window w as (partition by s order by k)),
steps as (
  select s, rate, n_parts, k,
         sum(exp(-rate / n_parts + case when k = 0 then 0 else log_p - ln(rate / n_parts) end)) over (partition by s order by k) as c
  from terms),
tables as (
  select s, rate, n_parts, list(c order by k) as cdf from steps group by all),
draws as (
  select d.*, t.rate,
         list_sum(list_transform(range(1, t.n_parts + 1), lambda i: len(list_filter(t.cdf, lambda c:
           c <= ('0x' || substr(md5('mix|' || d.doc_id || '|' || i), 1, 13))::bigint / 4503599627370496.0::double)))) as copies
  from {documents} d join tables t on t.s = coalesce(d.source, '')),
mixed as (
  select {columns}, rate, unnest(range(1, copies::bigint + 1)) as copy_no from draws where copies > 0)"""


OP6 = f"""
with {mixture("documents", "doc_id, source, text")}
select doc_id, source, copy_no, round(rate, 9) as mix_rate,
       md5('mix.order|' || doc_id || '|' || copy_no) as mix_order, text from mixed
"""

OP12 = """
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as words
  from documents),
occurring as (select r, lang, source, unnest(words) as term from d),
per_doc as (select lang, source, term, r, count(*) as n from occurring group by all),
kept as (select lang, term from per_doc group by all having count(*) >= 30),
counts as (select lang, source, term, sum(n) as n from per_doc semi join kept using (lang, term) group by all),
sizes as (select lang, count(*) as v from kept group by all),
groups as (select distinct lang, source from d),
totals as (
  select g.lang, g.source, coalesce(sum(c.n), 0) as total from groups g left join counts c using (lang, source) group by all),
spread as (
  select t.lang, t.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (t.total + 5 * s.v) as p
  from totals t join kept k using (lang) join sizes s using (lang) left join counts c using (lang, source, term)),
whole as (
  select w.lang, w.term, 1 + (1000000000::hugeint * (w.n + 5)) // (t.total + 5 * s.v) as q
  from (select lang, term, sum(n) as n from counts group by all) w
  join (select lang, sum(total) as total from totals group by all) t using (lang) join sizes s using (lang)),
pairs as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from spread a join spread b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
all_pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source),
terms as (
  select s.lang, s.source, 'term' as part, s.term as item, s.p - w.q as value
  from spread s join whole w using (lang, term) where s.n > 0 and s.p > w.q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from all_pairs union all select * from terms))
select lang, source, part, item, value::bigint as value, rank from ranked where part = 'pair' or rank <= 50
"""

OP13 = """
with crc_table as (
  select list(list_reduce(range(1, 9), lambda c, i: case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n::bigint)
              order by n) as t
  from range(0, 256) r(n)),
turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
         {'r': coalesce(role, ''), 't': coalesce(text, '')} as step
  from conversations where conv_id is not null),
convs as (select conv_id, list(step order by pos) as steps from turns group by conv_id),
hashed as (
  select conv_id, steps,
         xor(list_reduce(list_transform(range(1, len(conv_id::varchar) + 1), lambda i: ascii(substr(conv_id::varchar, i, 1))::bigint),
                         lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::bigint), 4294967295) % 6 as h
  from convs, crc_table),
rebuilt as (
  select c.conv_id, list_concat(coalesce(b.steps[1 : c.h], []), c.steps[c.h + 1 :]) as steps
  from hashed c left join convs b on b.conv_id = c.conv_id - c.conv_id % 100),
prefixes as (
  select conv_id, steps[1 : d] as node, d as depth, d = len(steps) as ends
  from (select conv_id, steps, unnest(range(0, len(steps) + 1)) as d from rebuilt)),
nodes as (
  select node, depth, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from prefixes group by node, depth),
kids as (select node[1 : depth - 1] as node, count(*) as n_children from nodes where depth > 0 group by 1),
own as (
  select n.*, coalesce(k.n_children, 0) as n_children,
         case when depth = 0 then 0 else (n_convs - 1) * length(node[depth].t) end as saved
  from nodes n left join kids k using (node)),
totals as (
  select above as node, sum(saved) as saved_tokens, count(*) filter (where n_children = 0) as n_leaves
  from (select saved, n_children, node[1 : unnest(range(0, depth + 1))] as above from own) group by 1)
select o.conv_id, o.depth, p.conv_id as parent_conv_id, o.n_convs, o.n_children, t.n_leaves, t.saved_tokens::bigint as saved_tokens, o.ends_sha256
from own o join totals t using (node) left join nodes p on o.depth > 0 and p.node = o.node[1 : o.depth - 1]
"""

SQL = {"op2_line_dedup": OP2, "op3_exact_dedup": OP3, "op6_mixing": OP6, "op12_source_audit": OP12,
       "op13_prefix_trie": OP13}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
