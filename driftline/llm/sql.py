"""DuckDB SQL for queries whose rows plain SQL can state, if not compute at scale."""

from __future__ import annotations

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = "'[^\\x20\\x09-\\x0D]+'"

NEAR_DEDUP = f"""
with recursive split as (select doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, {_SPACED}) as w from documents),
grams as (
  select distinct doc_id, md5(array_to_string(w[i:i + 4], ' ')) as g from split, unnest(generate_series(1, greatest(len(w) - 4, 1))) t(i) where len(w) > 0),
sizes as (select doc_id, count(*) as n from grams group by 1),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as common from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * common >= 75 * (x.n + y.n - common)),
both_ways as (select a as s, b as t from links union all select b, a from links),
label(d, c) using key (d) as (
  select doc_id, doc_id from documents
  union
  (select l.t, min(label.c) from label join both_ways l on l.s = label.d left join recurring.label p on p.d = l.t where label.c < p.c group by 1))
select d as doc_id, coalesce(n, 0) as n_shingles, c as component_id, d = c as kept from label left join sizes on sizes.doc_id = d
"""

_WORDS5 = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(_LOW.format("coalesce(text, '')"))

DECONTAMINATION = f"""
with docs as (select doc_id, {_WORDS5} as w from documents),
items as (select cast(item_id as varchar) as item_id, {_WORDS5} as w from benchmark),
wanted as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as k from items, unnest(generate_series(1, greatest(len(w) - 9, 1))) t(i) where len(w) > 0),
sizes as (select distinct n from wanted),
here as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as k from docs, sizes, unnest(generate_series(1, len(w) - n + 1)) t(i)),
found as (select doc_id, n, i, item_id from here join wanted using (n, k)),
hit as (select doc_id, count(distinct i + r) as n_hit from found, unnest(generate_series(0, n - 1)) s(r) group by 1),
named as (select doc_id, list_sort(list(distinct item_id)) as names from found group by 1)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, cast(coalesce(len(names), 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(names, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (doc_id) left join named using (doc_id)
"""

SUBSTRING = f"""
with split as (select doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) as w from documents),
windows as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from split, unnest(generate_series(1, len(w) - 49)) t(i)),
firsts as (select h, min(doc_id) as low from windows group by h),
gone as (select distinct doc_id, i + r as p from windows join firsts using (h), unnest(generate_series(0, 49)) s(r) where low < doc_id),
places as (select doc_id, p, w[p] as word from split, unnest(generate_series(1, len(w))) t(p)),
kept as (select doc_id, string_agg(word, ' ' order by p) as text, count(*) as n from places anti join gone using (doc_id, p) group by 1)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from split left join kept using (doc_id)
"""
