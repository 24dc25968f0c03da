"""DuckDB SQL for the corpus queries that SQL can express, straight from their contracts (no fingerprints, bands or indexes)."""

from __future__ import annotations

LOWERED = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"

DECONTAMINATION = rf"""
with d as (select doc_id, regexp_extract_all({LOWERED.format("text")}, '{PLAIN}') as w from documents),
b as (select item_id, regexp_extract_all({LOWERED.format("text")}, '{PLAIN}') as w from benchmark),
items as (select item_id, w, least(len(w), 13) as m from b where len(w) > 0),
windows as (select distinct item_id, m, array_to_string(list_slice(w, i + 1, i + m), ' ') as win from (select *, unnest(range(0, len(w) - m + 1)) as i from items)),
places as (select doc_id, m, i, array_to_string(list_slice(w, i + 1, i + m), ' ') as win from (select doc_id, w, m, unnest(range(0, len(w) - m + 1)) as i from d, (select distinct m from items) where len(w) >= m)),
hits as (select doc_id, p.m, i, item_id from places p join windows v on p.m = v.m and p.win = v.win),
covered as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + m)) as k from hits) group by doc_id),
found as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(listed, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join covered c on c.doc_id = d.doc_id left join found f on f.doc_id = d.doc_id
"""

#: A leaf is a sentence of at most 48 characters with its separator, or a piece of a longer one.
FINGERPRINTS = r"""
with o as (select doc_id, coalesce(text, '') as t, coalesce(lead(text) over (order by doc_id desc), first_value(text) over (order by doc_id desc), '') as u from documents),
e as (select *, substring(t, 1, length(t) - length(t) // 2) || substring(u, 1, length(t) // 2) as v from o),
texts as (select distinct x from (select t as x from e union all select v from e union all select u from e)),
sections as (select x, sec, i from (select x, string_split(x, chr(10) || chr(10)) as l from texts), unnest(l) with ordinality as s(sec, i)),
paragraphs as (select x, i, par, j from (select x, i, string_split(sec, chr(10)) as l from sections), unnest(l) with ordinality as s(par, j)),
sentences as (select x, i, j, k, case when k < len(l) then sen || '. ' else sen end as sen from (select x, i, j, string_split(par, '. ') as l from paragraphs), unnest(l) with ordinality as s(sen, k)),
leaves as (select x, i, j, k, p, md5(substring(sen, p * 48 + 1, 48)) as h from (select *, unnest(range(0, greatest(1, (length(sen) + 47) // 48))) as p from sentences)),
nodes as (select x, i, j, md5(string_agg(h, '' order by k, p)) as h, string_agg(substr(to_base64(unhex(substr(h, 1, 16))), 1, 11), '' order by k, p) as shown from leaves group by x, i, j),
tops as (select x, i, md5(string_agg(h, '' order by j)) as h, string_agg(substr(to_base64(unhex(substr(h, 1, 16))), 1, 11) || '.' || shown, ',' order by j) as shown from nodes group by x, i),
prints as (select x, md5(string_agg(h, '' order by i)) || '/' || string_agg(substr(to_base64(unhex(substr(h, 1, 16))), 1, 11) || ':' || shown, ';' order by i) as f from tops group by x),
counts as (select x, substr(h, 1, 16) as h, count(*) as n from leaves group by 1, 2),
totals as (select x, sum(n) as n from counts group by x),
likes as (select q.x, q.y, case when q.x = q.y then 1.0 else 2.0 * coalesce(sum(case when b.n is not null then least(a.n, b.n) end), 0) / (any_value(ta.n) + any_value(tb.n)) end as near
  from (select t as x, v as y from e union select t, u from e) q join totals ta on ta.x = q.x join totals tb on tb.x = q.y left join counts a on a.x = q.x left join counts b on b.x = q.y and b.h = a.h group by q.x, q.y)
select doc_id, cast(length(t) as bigint) as n_chars, sha256(v) as edited_sha256, p.f as fingerprint, r.f as edited_fingerprint, cast(l1.near as double) as near_edited, cast(l2.near as double) as near_next
from e join prints p on p.x = t join prints r on r.x = v join likes l1 on l1.x = t and l1.y = v join likes l2 on l2.x = t and l2.y = u
"""

#: CRC-32 by the table that its polynomial gives, over the bytes' hexadecimal digits.
SHARDS = r"""
with recursive steps(i, k, c) as (select i, 0, i from (select unnest(range(0, 256)) as i) union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where k < 8),
tab as (select list(c order by i) as t from steps where k = 8),
hashed as (select doc_id, cast(octet_length(encode(coalesce(text, ''))) + 1 as bigint) as size, hex(encode(coalesce(text, ''))) as x, cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) % 4096 as virtual_slot from documents),
bytes as (select *, list_transform(range(0, size - 1), lambda i: cast('0x' || substr(x, i * 2 + 1, 2) as bigint)) as b from hashed),
crcs as (select doc_id, size, virtual_slot, xor(list_reduce(list_prepend(cast(4294967295 as bigint), b), lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) as text_crc32 from bytes, tab),
placed as (select *, virtual_slot % 16 as shard, sum(size) over (partition by virtual_slot) as slot_bytes from crcs)
select doc_id, size, text_crc32, 'key' as law, cast(shard as int) as shard, row_number() over (partition by shard order by virtual_slot, text_crc32 % 16, doc_id, size, text_crc32) - 1 as slot,
  cast(case when virtual_slot // 16 + 1 > 241 then 16 else shard end as int) as grown_shard, cast(virtual_slot as int) as virtual_slot, cast(slot_bytes as bigint) as slot_bytes, 1 as map_version
from placed
"""

PASSAGES = rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') as w from documents),
windows as (select doc_id, i, array_to_string(list_slice(w, i + 1, i + 50), ' ') as win from (select doc_id, w, unnest(range(0, len(w) - 49)) as i from d where len(w) >= 50)),
firsts as (select win, min(doc_id) as owner from windows group by win),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as k from windows join firsts using (win) where owner < doc_id),
words as (select doc_id, unnest(w) as word, unnest(range(0, len(w))) as k from d),
kept as (select doc_id, string_agg(word, ' ' order by k) as kept, count(*) as n from words anti join gone using (doc_id, k) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join kept on kept.doc_id = d.doc_id
"""

NEAR_DUPLICATES = rf"""
with recursive d as (select doc_id, regexp_extract_all({LOWERED.format("text")}, '{SPACED}') as w from documents),
shingles as (select distinct doc_id, array_to_string(list_slice(w, i + 1, i + 5), ' ') as s from (select doc_id, w, unnest(range(0, greatest(1, len(w) - 4))) as i from d where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
both_ways as (select a, b from links union all select b, a from links),
reach(doc_id, other) as (select doc_id, doc_id from d union select r.doc_id, e.b from reach r join both_ways e on e.a = r.other),
least_ as (select doc_id, min(other) as component_id from reach group by doc_id)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept from d left join sizes using (doc_id) join least_ using (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_winnow_decontamination": DECONTAMINATION, "op4_merkle_fingerprints": FINGERPRINTS, "op6_slot_shards": SHARDS,
        "op8_fm_index_passages": PASSAGES, "op9_oph_near_duplicates": NEAR_DUPLICATES,
    }
