"""DuckDB SQL that gives the rows of the queries beside it, by other means."""

from __future__ import annotations


def sharding(limit: int) -> str:
    """Every depth of every document's hash path; the first that fits its bucket counts."""
    return f"""
with d as (
  select doc_id, coalesce(octet_length(encode(text)), 0) as size, octet_length(encode(text)) as n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as h
  from documents),
e as (select doc_id, size, n_bytes, k as depth, h >> (60 - k) as prefix from d, range(0, 61) r(k)),
b as (select depth, prefix, sum(size) as bytes, count(*) as n from e group by all),
f as (select * from b where bytes <= {limit} or n = 1),
m as (select e.doc_id, any_value(n_bytes) as n_bytes, min(depth) as depth,
             arg_min(prefix, depth) as prefix, arg_min(f.bytes, depth) as bytes, arg_min(f.n, depth) as n
      from e join f using (depth, prefix) group by e.doc_id)
select doc_id, n_bytes, case when depth = 0 then '' else lpad(bin(prefix), depth::int, '0') end as shard,
       bytes::bigint as shard_bytes, n as shard_rows
from m"""


def decontaminate(window: int = 10) -> str:
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
with d as (select doc_id, {words} as w from documents),
i as (select item_id, {words} as w from benchmark),
g as (select distinct item_id, n, array_to_string(w[k + 1 : k + n], ' ') as gram
      from (select item_id, w, least(len(w), {window}) as n from i where len(w) > 0) t, range(0, len(w) - n + 1) r(k)),
lengths as (select distinct n from g),
p as (select doc_id, n, k, array_to_string(w[k + 1 : k + n], ' ') as gram
      from d, lengths, range(0, len(w) - n + 1) r(k)),
h as (select p.doc_id, p.k, p.n, g.item_id from p join g using (n, gram)),
s as (select doc_id, count(distinct pos) as n_hit
      from (select doc_id, unnest(range(k, k + n)) as pos from h) group by 1),
t as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
      from (select distinct doc_id, item_id::varchar as item from h) group by 1)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(s.n_hit, 0)::bigint as n_hit, coalesce(t.n_items, 0)::bigint as n_items,
       sha256(coalesce(t.items, '')) as items_sha256, coalesce(s.n_hit, 0) > 0 as contaminated
from d left join s using (doc_id) left join t using (doc_id)"""


def chat() -> str:
    """formatted_chars adds up the prefixes of the conversation that end in an assistant turn or in its last."""
    esc = "replace(replace({}, '\\', '\\\\'), '<|', '<\\|')"
    role = "replace(replace(replace(role, '\\', '\\\\'), chr(10), '<\\n>'), '<|', '<\\|')"
    return f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
n as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as k,
         count(*) over (partition by conv_id) as last,
         length({role}) + length({esc.format("text")}) + length('<|im_start|>' || '<|im_end|>') + 2 as chars
  from c),
p as (select *, sum(chars) over (partition by conv_id order by k) as prefix from n)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
       sum(prefix) filter (role = 'assistant' or k = last)::bigint as formatted_chars
from p group by conv_id"""


def mixing(topics, dimensions, alpha: float, cycles: int = 40) -> str:
    cases = " ".join(f"when {' or '.join(f"contains(text, '{m}')" for m in marks)} then '{name}'" for name, marks in topics)
    parts = [
        f"""d as (select doc_id, source, lang, case {cases} else 'prose' end as topic,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> ''))::bigint as n from documents)""",
        "cells as materialized (select coalesce(source, '') as source, coalesce(lang, '') as lang, topic, greatest(sum(n), 1)::double as w from d group by all)",
    ]
    for dim in dimensions:
        parts.append(f"t_{dim} as materialized (select {dim}, pow(sum(w), {alpha}) / sum(pow(sum(w), {alpha})) over () as share from cells group by {dim})")
        parts.append(f"m_{dim}_0 as (select {dim}, 1.0::double as m from t_{dim})")
    at = {dim: f"m_{dim}_0" for dim in dimensions}
    for cycle in range(1, cycles + 1):
        for dim in dimensions:
            others = [x for x in dimensions if x != dim]
            joins = " ".join(f"join {at[x]} on cells.{x} = {at[x]}.{x}" for x in others)
            product = " * ".join(["w", *(f"{at[x]}.m" for x in others)])
            parts.append(
                f"m_{dim}_{cycle} as materialized (select cells.{dim}, any_value(share) / sum({product}) as m"
                f" from cells {joins} join t_{dim} on cells.{dim} = t_{dim}.{dim} group by cells.{dim})"
            )
            at[dim] = f"m_{dim}_{cycle}"
    joins = " ".join(f"join {at[x]} on cells.{x} = {at[x]}.{x}" for x in dimensions)
    product = " * ".join(f"{at[x]}.m" for x in dimensions)
    parts.append(f"f as materialized (select {', '.join(f'cells.{x}' for x in dimensions)}, {product} as f from cells {joins})")
    parts.append("p as (select *, f / max(f) over () as p from f)")
    on = " and ".join(f"coalesce(d.{x}, '') = p.{x}" for x in dimensions)
    uniform = "('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':mix'), 1, 13))::bigint / pow(2, 52)"
    return f"with {', '.join(parts)} select doc_id, d.source, d.lang, d.topic, n as n_tokens, round(p, 4) as probability, {uniform} < p as kept from d join p on {on}"


def jaccard(shingle: int = 4, a: int = 85, b: int = 100) -> str:
    """Intersections by an inverted index, components by walking all links."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array({lower}, '[ \\t-\\r]+'), lambda x: x <> '') as w from documents),
s as (
  select doc_id, case when len(w) = 0 then [] when len(w) < {shingle} then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(0, len(w) - {shingle - 1}), lambda k: array_to_string(w[k + 1 : k + {shingle}], ' '))) end as s
  from w),
e as (select doc_id, len(s) as n, unnest(s) as g from s),
p as (select x.doc_id as u, y.doc_id as v, any_value(x.n) + any_value(y.n) as total, count(*) as common
      from e x join e y on x.g = y.g and x.doc_id <> y.doc_id group by x.doc_id, y.doc_id),
links as (select u, v from p where {b} * common >= {a} * (total - common)),
reach(doc_id, other) as (select doc_id, doc_id from s union select r.doc_id, l.v from reach r join links l on r.other = l.u)
select s.doc_id, len(s.s)::bigint as n_shingles, c.component_id,
       case when len(s.s) = 0 then s.doc_id else min(s.doc_id) over (partition by list_sort(s.s)) end as class_id
from s join (select doc_id, min(other) as component_id from reach group by doc_id) c using (doc_id)"""


def source_audit(least_docs: int = 3, top: int = 200) -> str:
    """Every kept term in every group, and every pair of groups on every kept term."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    p = "(1 + 1000000000::hugeint * ({n} + 1) // ({total} + terms))"
    return f"""
with d as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all({lower}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
  from documents),
g as (select distinct lang, source from d),
o as (select lang, source, term, count(*) as n from (select lang, source, unnest(w) as term from d) group by all),
k as (select lang, term from (select lang, unnest(list_distinct(w)) as term from d) group by all having count(*) >= {least_docs}),
v as (select lang, count(*) as terms from k group by lang),
c as materialized (select g.lang, g.source, k.term, coalesce(o.n, 0) as n from g join k using (lang) left join o using (lang, source, term)),
t as (select *, sum(n) over (partition by lang, source) as total,
             sum(n) over (partition by lang, term) as all_n, sum(n) over (partition by lang) as all_total from c),
p as materialized (select lang, source, term, n, {p.format(n="n", total="total")} as p, {p.format(n="all_n", total="all_total")} as q from t join v using (lang)),
pairs as (
  select x.lang, x.source, y.source as item, sum((x.p - y.p) * (x.p - y.p) // y.p) as value
  from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all),
rows as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from p where n > 0 and p > q)
select lang, source, part, item, value, rank
from (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from rows)
where part = 'pair' or rank <= {top}"""
