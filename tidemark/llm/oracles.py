"""The registered queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP9 = rf"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
         coalesce(text, '') as text, {_WORDS} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
win as (
  select rid, i, array_to_string(w[i:i+4], ' ') as g from d, unnest(range(1, len(w) - 3)) as u(i)),
rep as (
  select rid, i from (select *, count(*) over (partition by rid, g) as c from win) where c > 1),
cov as (
  select rid, sum(least(5, coalesce(nxt - i, 5))) as n
  from (select rid, i, lead(i) over (partition by rid order by i) as nxt from rep) group by rid),
m as (
  select rid, doc_id, lang, source, len(w)::bigint as n_words,
         length(array_to_string(w, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         len(l)::bigint as n_lines,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(cov.n, 0)::bigint as n_repeat_words
  from d left join cov using (rid)),
j as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
         least(n_symbols * 1000 // greatest(n_words, 1), 2000) as symbols,
         least(n_dup_lines * 1000 // greatest(n_lines, 1), 1000) as lines,
         least(n_repeat_words * 1000 // greatest(n_words, 1), 1000) as repeats,
         least(word_chars * 100 // greatest(n_words, 1), 5000) as length
  from m),
p as (
  select lang, source, measure, point, count(*) as docs
  from (unpivot (select lang, source, symbols, lines, repeats, length from j where not base_failed)
        on symbols, lines, repeats, length into name measure value point)
  group by all),
levels as (
  select 1 as level, lang as k1, source as k2, measure, point, docs from p
  union all select 2, lang, '', measure, point, sum(docs) from p group by lang, measure, point
  union all select 3, '', '', measure, point, sum(docs) from p group by measure, point),
c as (
  select *, sum(docs) over (partition by level, k1, k2, measure order by point) as upto,
         sum(docs) over (partition by level, k1, k2, measure) as total from levels),
q as (
  select level, k1, k2, measure, max(total) as total,
         min(point) filter (4 * upto >= total) as q1, min(point) filter (4 * upto >= 3 * total) as q3
  from c group by all),
f as (
  select *, greatest(4 * (q3 - q1), case measure when 'symbols' then 100 when 'lines' then 300
                                    when 'repeats' then 200 else 400 end) as reach from q),
w as (
  select level, k1, k2, max(total) as docs,
         max(q3 + reach) filter (measure = 'symbols') as s, max(q3 + reach) filter (measure = 'lines') as l,
         max(q3 + reach) filter (measure = 'repeats') as r, max(q3 + reach) filter (measure = 'length') as h,
         max(q1 - reach) filter (measure = 'length') as b
  from f group by level, k1, k2),
v as (
  select j.*, case when w1.docs >= 100 then w1 when w2.docs >= 100 then w2 else w3 end as t
  from j left join w w1 on w1.level = 1 and w1.k1 = lang and w1.k2 = source
         left join w w2 on w2.level = 2 and w2.k1 = lang
         left join w w3 on w3.level = 3)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(symbols <= t.s and lines <= t.l and repeats <= t.r
         and length <= t.h and length >= t.b, false) as kept
from v
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
with d as (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
x as (
  select rid, i, l[i] as line,
         {_LOWER.format("regexp_replace(l[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} as k
  from d, unnest(range(1, len(l) + 1)) as u(i)),
f as (select k from x where k <> '' group by k having count(distinct rid) >= 10),
y as (select rid, i, line, k in (select k from f) as gone from x),
z as (
  select rid, count(*) as n, count(*) filter (gone) as g,
         coalesce(string_agg(line, chr(10) order by i) filter (not gone), '') as kept
  from y group by rid)
select doc_id, n::bigint as n_lines, g::bigint as n_dropped, sha256(kept) as kept_sha256
from d join z using (rid)
"""

OP3 = rf"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
win as (select rid, i, array_to_string(w[i:i+34], ' ') as g from d, unnest(range(1, len(w) - 33)) as u(i)),
rep as (select rid, i from (select *, count(*) over (partition by g) as c from win) where c > 1),
gone as (select distinct rid, i + j as k from rep, unnest(range(0, 35)) as u(j)),
each as (select rid, k, w[k] as word from d, unnest(range(1, len(w) + 1)) as u(k)),
kept as (
  select e.rid, array_to_string(list(word order by e.k) filter (gone.k is null), ' ') as t, count(gone.k) as n
  from each e left join gone on gone.rid = e.rid and gone.k = e.k group by e.rid)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (rid)
"""

OP8 = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (
  select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as h from p),
f as (select h, min(page_id) as first from d group by h),
b as (
  select d.*, first, list_reduce(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_reduce(list_transform(range(0, 5), lambda k:
      ((('0x' || substr(h, 1 + (5 * i + k) // 4, 1))::int >> (3 - (5 * i + k) % 4)) & 1) << (4 - k)), lambda x, y: x + y)::int, 1)),
    lambda x, y: x || y) as digest
  from d join f using (h))
select page_id, payload_bytes, digest as payload_digest,
       case when page_id > first then 'revisit' else 'response' end as record_type,
       case when page_id > first then first end as refers_to
from b
"""

OP11 = r"""
with d as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, ''))::bigint as n,
         sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
h as (
  select *, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
         ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4 from d),
c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when text = '' or regexp_matches(text, '<[PSM]>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end as form from h),
p as (select *, substring(text, 1, a) as x, substring(text, a + 1, b - a) as y, substring(text, b + 1, n - b) as z from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'psm' then '<P>' || x || '<S>' || z || '<M>' || y
                        when 'spm' then '<S>' || z || '<P>' || x || '<M>' || y else text end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""

OP12 = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as id,
         list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 50 = 0),
p as (
  select anchor_id, id as positive_id, score as positive_score
  from (select *, row_number() over (partition by anchor_id order by score desc, id) as k
        from s where same and id <> anchor_id)
  where k <= 5),
n as (
  select anchor_id, positive_id, id as negative_id, positive_score, score as negative_score,
         row_number() over (partition by anchor_id, positive_id order by score desc, id) as k
  from p join s using (anchor_id)
  where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, k::int as rank, negative_id, positive_score, negative_score from n where k <= 3
"""

ORACLES = {
    "op2_line_dedup": OP2,
    "op3_repeats": OP3,
    "op8_warc": OP8,
    "op9_quality_rules": OP9,
    "op11_fim": OP11,
    "op12_hard_negatives": OP12,
}
