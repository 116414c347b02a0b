"""Queries of the text operators in SQL, written from their definitions."""

DECONTAMINATE = r"""
with d as materialized (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from documents),
b as materialized (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from benchmark),
g as materialized (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as gram from (
    select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i
    from b where len(w) > 0)),
lengths as (select distinct n from g),
p as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as gram from (
    select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lengths where len(w) >= n)),
h as materialized (select doc_id, item_id, p.n, i from p join g on p.gram = g.gram and p.n = g.n),
hit as (select doc_id, count(distinct k) as n_hit from (
  select doc_id, unnest(range(i, i + n)) as k from h) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (
  select distinct doc_id, item_id::varchar as item from h) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join its using (doc_id)"""

MIX = r"""
with d as materialized (
  select doc_id, source, md5(doc_id::varchar || ':mix') as k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
s as (
  select source, sum(size)::bigint as n, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w
  from d group by source),
o as materialized (
  select *, 3 * n as cap, row_number() over (order by 3.0::double * n / w, source nulls last) as r, sum(n) over () as total from s),
c as materialized (
  select *, coalesce(sum(cap) over (order by r rows between unbounded preceding and 1 preceding), 0)::bigint as capped,
    sum(w) over (order by r rows between current row and unbounded following)::bigint as rest from o),
l as (select (total - capped)::double / rest as share from c where (total - capped)::double / rest * w <= cap order by r limit 1),
t as (select source, n, case when share * w > cap then cap::double else share * w end as target from o, l),
p as (
  select d.*, t.n, t.target, coalesce(sum(size) over (
    partition by d.source order by k, doc_id rows between unbounded preceding and 1 preceding), 0) as start
  from d join t on d.source is not distinct from t.source)
select doc_id, size, n as source_size, target, (
  greatest(0, least(size, floor(target) - start)) + greatest(0, least(size, floor(target) - n - start))
  + greatest(0, least(size, floor(target) - 2 * n - start)))::bigint as taken
from p"""

_ESCAPED = "replace({}, '\\', '\\\\')"
for _control in ("[INST]", "[/INST]", "<s>", "</s>", "<|", "<<SYS>>", "<</SYS>>"):
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '{_control[0]}\\{_control[1:]}')"

FORMAT_CHAT = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(17 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}))::bigint as formatted_chars
from t group by conv_id"""

LINE_DEDUP = r"""
with l as materialized (
  select doc_id, unnest(generate_series(1, len(ls))) as i, unnest(ls) as line
  from (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null)),
c as materialized (
  select *, len(regexp_extract_all(line, '\S+')) as n, count(*) filter (where regexp_matches(line, '\S'))
    over (partition by doc_id order by i) as u from l),
u as materialized (
  select doc_id, u, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line,
    sum(n) over (partition by doc_id order by u) as upto,
    sum(n) over (partition by doc_id order by u) - n as before from c where n > 0),
w as (
  select a.doc_id, a.u as a, min(b.u) as b from u a join u b on a.doc_id = b.doc_id and b.upto >= a.before + 50 and b.u >= a.u
  group by all
  union
  select b.doc_id, max(a.u), b.u from u a join u b on a.doc_id = b.doc_id and b.upto >= a.before + 50 and b.u >= a.u
  group by b.doc_id, b.u),
r as materialized (
  select w.doc_id, w.a, w.b, string_agg(u.line, chr(10) order by u.u) as run
  from w join u on u.doc_id = w.doc_id and u.u between w.a and w.b group by all),
k as (select *, row_number() over (partition by run order by doc_id, a) as copy from r),
g as (select distinct doc_id, unnest(generate_series(a, b)) as u from k where copy > 1),
t as (
  select c.doc_id, string_agg(line, chr(10) order by i) filter (where g.u is null) as text, count(g.u) as n_deleted
  from c left join g on g.doc_id = c.doc_id and g.u = c.u group by c.doc_id)
select doc_id, case when d.text is not null then coalesce(t.text, '') end as text, coalesce(n_deleted, 0)::bigint as n_deleted
from documents d left join t using (doc_id)"""

VECTORS = """
with recursive e as materialized (
  select vec_id, embedding::double[] as x, label from embeddings where label is not null and embedding is not null
    and len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
    and len(list_filter(embedding, lambda c: c <> 0)) > 0),
s as materialized (
  select a.vec_id as a, b.vec_id as b from e a join e b on a.label = b.label and len(a.x) = len(b.x) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.x, b.x) >= 0.93),
r(id, label) using key (id) as (
  select vec_id, vec_id from embeddings
  union
  select s.b, min(r.label) from r join s on r.id = s.a join recurring.r k on k.id = s.b
  group by s.b, k.label having min(r.label) < k.label)
select v.vec_id, coalesce(n, 0)::bigint as n_links, r.label as component_id, v.vec_id = r.label as kept
from embeddings v join r on r.id = v.vec_id left join (select a, count(*) as n from s group by a) on a = v.vec_id"""

HARD_NEGATIVES = """
with e as materialized (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as x
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as materialized (
  select a.r as a, a.vec_id as anchor_id, a.label = e.label as same, e.r, e.vec_id, list_dot_product(a.x, e.x)::bigint as score
  from e a join e on len(a.x) = len(e.x) and a.r <> e.r where a.vec_id % 100 = 0),
p as (
  select a, r, anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by a order by score desc, vec_id, r) <= 5)
select p.anchor_id, positive_id, row_number() over (partition by p.a, p.r order by score desc, vec_id, s.r)::integer as rank,
  vec_id as negative_id, positive_score, score as negative_score
from p join s on s.a = p.a and not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5"""

CONVERSATION_TRIE = """
with o as materialized (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
t as materialized (
  select c, x, chars, row_number() over (partition by c order by turn nulls first, x) as k from (
    select c, turn, length(text) as chars, sha256(length(role)::varchar || ':' || role || text) as x from o)),
h as materialized (
  select c, c - c % 100 as base, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
    string_split(c::varchar, ''), lambda b: [ord(b)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda r, b: case when b >= 0 then xor(r, b) else xor(r >> 1, case when r & 1 = 1 then 3988292384 else 0 end) end)) % 6 as h
  from (select distinct c from o)),
r as (
  select h.c, 0 as part, k, x, chars from h join t on t.c = h.base and k <= h where h.c <> base
  union all select h.c, 1, k, x, chars from h join t on t.c = h.c where h.c = base or k > h),
p as materialized (
  select c, row_number() over w as d, string_agg(x, '') over w as p, chars from r window w as (partition by c order by part, k)
  union all select c, 0, '', 0 from h),
n as materialized (select d, p, min(c) as c, count(*) as n, any_value(chars) as chars from p group by d, p),
kids as materialized (select substr(p, 1, 64 * (d - 1)) as p, count(*) as kids from n where d > 0 group by all),
m as materialized (select n.*, coalesce(kids, 0) as kids from n left join kids using (p)),
s as (
  select a.p, sum((b.kids = 0)::bigint) as leaves, sum((b.n - 1) * b.chars) as saved
  from m a join m b on b.d >= a.d and substr(b.p, 1, 64 * a.d) = a.p group by a.p),
e as (
  select p, string_agg(c::varchar, ',' order by c) as ends from (
    select c, p from p qualify row_number() over (partition by c order by d desc) = 1) group by p)
select m.c as conv_id, m.d as depth, u.c as parent_conv_id, m.n as n_convs, m.kids as n_children, leaves::bigint as n_leaves,
  saved::bigint as saved_tokens, sha256(coalesce(ends, '')) as ends_sha256
from m join s using (p) left join e using (p) left join n u on m.d > 0 and u.p = substr(m.p, 1, 64 * (m.d - 1))"""
