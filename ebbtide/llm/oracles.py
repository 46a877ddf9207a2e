"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""with d as (select doc_id, {_WORDS} as w from documents),
 i as (select item_id, {_WORDS} as w from benchmark where item_id is not null),
 win as (select distinct item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda k: md5(array_to_string(w[k:k + n - 1], ' ')))) as s
  from (select *, least(13, len(w)) as n from i where len(w) > 0)),
 lens as (select distinct n from win),
 places as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as p,
  unnest(list_transform(range(1, len(w) - n + 2), lambda k: md5(array_to_string(w[k:k + n - 1], ' ')))) as s from d, lens where len(w) >= n),
 hits as (select doc_id, p, n, item_id from places join win using (n, s)),
 hit as (select doc_id, count(distinct p + q) as n_hit from hits, lateral (select unnest(range(0, n)) as q) group by doc_id),
 items as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as names
  from (select distinct doc_id, item_id from hits) group by doc_id)
 select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
 from d left join hit using (doc_id) left join items using (doc_id)"""

TOP_K = """with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
 s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v))
 select query_id, rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
 where rank <= 5"""

SUBSTRINGS = r"""with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
 win as (select doc_id, unnest(range(1, len(w) - 11)) as p,
  unnest(list_transform(range(1, len(w) - 11), lambda k: md5(array_to_string(w[k:k + 12], ' ')))) as s from d where len(w) >= 13),
 firsts as (select s, min(doc_id) as first from win group by s),
 gone as (select distinct doc_id, p + q as p from (select doc_id, p from win join firsts using (s) where first < doc_id),
  lateral (select unnest(range(0, 13)) as q)),
 words as (select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from d),
 kept as (select words.doc_id, count(gone.p) as n_removed, string_agg(word, ' ' order by words.p) filter (where gone.p is null) as text
  from words left join gone on gone.doc_id = words.doc_id and gone.p = words.p group by words.doc_id)
 select d.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
 from d left join kept on kept.doc_id = d.doc_id"""

WARC = """with p as (select page_id, coalesce(html, '') as h from pages), g as (select h, max(page_id) as m from p group by h),
 x as (select page_id, strlen(h) as payload_bytes, sha1(h) as hex, m from p join g using (h))
 select page_id, payload_bytes::bigint as payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda k: array_to_string(list_transform([15, 10, 5, 0], lambda b:
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(((('0x' || hex[5*k + 1:5*k + 5])::bigint >> b) & 31) + 1)::int]), '')), '') as payload_digest,
  case when page_id = m then 'response' else 'revisit' end as record_type, case when page_id <> m then m end as refers_to from x"""

JACCARD = f"""with recursive d as (select doc_id, {_WORDS} as w from documents),
 sets as (select doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1), lambda k:
  md5(array_to_string(w[k:k + 4], ' ')))) as s from d),
 grams as (select doc_id, unnest(s) as g, len(s) as n from sets),
 links as (select a.doc_id as a, b.doc_id as b from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 9 * count(*) >= 4 * (a.n + b.n)),
 reached as (select doc_id as a, doc_id as b from sets union select r.a, l.b from reached r join links l on l.a = r.b),
 classes as (select a as doc_id, min(b) as class_id from reached group by a),
 counts as (select a as doc_id, count(*) as n from links group by a),
 copies as (select doc_id, count(*) over (partition by list_sort(s)) - 1 as n from sets where len(s) > 0)
 select s.doc_id, class_id, len(s.s)::bigint as n_shingles, coalesce(copies.n, 0) as n_copies, coalesce(counts.n, 0) as n_links
 from sets s join classes using (doc_id) left join counts using (doc_id) left join copies using (doc_id)"""

SUFFIXES = """with d as (select doc_id, encode(coalesce(text, '')) as x, octet_length(encode(coalesce(text, '')))::bigint as n from documents),
 win as (select doc_id, unnest(range(0, greatest(n - 99, 0))) as p, unnest(list_transform(range(0, greatest(n - 99, 0)), lambda i: md5(x[i + 1:i + 100]))) as s from d),
 firsts as (select s, min({'d': doc_id, 'p': p}) as f from win group by s),
 gone as (select doc_id, p from win join firsts using (s) where f <> {'d': doc_id, 'p': p}),
 bytes as (select doc_id, unnest(range(0, n)) as i, unnest(list_transform(range(0, n), lambda i: x[i + 1:i + 1])) as b from d),
 covered as (select bytes.doc_id, i, b, coalesce(max(p) over (partition by bytes.doc_id order by i) >= i - 99, false) as removed
  from bytes left join gone on gone.doc_id = bytes.doc_id and gone.p = i),
 runs as (select *, removed and not coalesce(lag(removed) over (partition by doc_id order by i), false) as start from covered),
 sums as (select doc_id, count(*) filter (where removed) as n_removed, count(*) filter (where start) as n_spans,
  string_agg(hex(b), '' order by i) filter (where not removed) as kept from runs group by doc_id)
 select d.doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, ''))) as kept_sha256
 from d left join sums on sums.doc_id = d.doc_id"""

ORACLES = {"op1_decontamination": DECONTAMINATION, "op2_jaccard_join": JACCARD, "op3_exact_top_k": TOP_K,
           "op5_substring_dedup": SUBSTRINGS, "op9_warc": WARC, "op12_suffix_dedup": SUFFIXES}
