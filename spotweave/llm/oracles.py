"""DuckDB SQL with the same rows as those contract queries that SQL can express.

The others (classifier, similarity components, approximate search, tokenizers)
are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from spotweave.llm import secrets

MIX = r"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size, length(coalesce(text, '')) as chars from documents),
k as (select *, -ln((cast(concat('0x', substr(md5(concat('11:', coalesce(cast(doc_id as varchar), ''), ':', cast(size as varchar))), 1, 13)) as bigint) + 0.5) / 4503599627370496.0::double)
  / greatest(1 / (1 + abs(chars::double / greatest(size, 1) - 6.0::double) / 4), 0.05::double) as key from d),
s as (select source, cast(sum(size) as bigint) as source_size from d group by 1),
r as (select *, [5.0::double, 2.0::double, 1.0::double][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as w, row_number() over (order by source nulls last) as place from s),
c as (select *, cast(3 * source_size as double) as cap, cast(sum(source_size) over () as double) as total from r),
f as (select *, total - coalesce(sum(cap) over (order by cap / w, place rows between unbounded preceding and 1 preceding), 0) as rest_size,
  sum(w) over () - coalesce(sum(w) over (order by cap / w, place rows between unbounded preceding and 1 preceding), 0) as rest_w from c),
g as (select *, cap * rest_w <= rest_size * w as capped from f),
t as (select source, source_size, case when capped then cap else (total - coalesce(sum(case when capped then cap end) over (), 0)) * w / sum(case when not capped then w end) over () end as target from g),
e as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as epochs from t),
p as (select k.*, source_size, target, epochs, target - epochs * source_size as rest, sum(size) over (partition by k.source order by key, doc_id, size rows unbounded preceding) - size / 2.0::double as place
  from k join e on k.source is not distinct from e.source)
select doc_id, size, source_size, target, cast(size * (epochs + case when place <= rest and epochs < 3 then 1 else 0 end) as bigint) as taken, source from p"""

_CRC = """tab as (select list(v order by i) as t from (select i, list_reduce(list_prepend(i, range(8)), lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v from range(256) r(i)))"""

SHARD = f"""
with {_CRC}, d as (select doc_id, coalesce(text, '') as text, hex(encode(coalesce(text, ''))) as hx, cast(concat('0x', substr(md5(coalesce(text, '')), 1, 15)) as bigint) as h from documents),
b as (select doc_id, h, cast(length(hx) // 2 + 8 as bigint) as size, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(hx) // 2), lambda k: cast(concat('0x', substr(hx, cast(k * 2 + 1 as int), 2)) as bigint))),
  lambda x, y: xor(x >> 8, t[cast((xor(x, y) & 255) + 1 as int)])), 4294967295) as crc from d, tab),
o as (select *, sum(size) over (order by h, doc_id, size, crc rows unbounded preceding) - size as start, row_number() over (order by h, doc_id, size, crc) - 1 as place, sum(size) over () as total from b),
g as (select h, sum(size) as g_bytes, min(start) as g_start from o group by h having count(*) > 1 and sum(size) * 192 <= min(total)),
s as (select o.*, cast(least(23, floor(coalesce(2 * g_start + g_bytes, 2 * start + size) * 24 / (2.0::double * total))) as int) as shard from o left join g on o.h = g.h)
select doc_id, size, crc as text_crc32, 'bytes' as law, shard, cast(place - min(place) over (partition by shard) as bigint) as slot, cast(null as int) as grown_shard from s"""

TOP = """
with v as (select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.rid as qid, q.vec_id as query_id, c.rid, c.vec_id, cast(coalesce(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])), 0) as bigint) as score from v q join v c on q.vec_id % 50 = 0 and q.rid <> c.rid),
r as (select *, cast(row_number() over (partition by qid order by score desc, vec_id, rid) as int) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5"""

WARC = """
with p as (select page_id, coalesce(html, '') as html, lower(coalesce(url, '-')) as u, strftime(to_timestamp(1700000000 + (coalesce(page_id, 0) % 1000000000 + 1000000000) % 1000000000) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as stamp from pages),
d as (select page_id, stamp, u, octet_length(encode(html)) as payload_bytes, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  cast(((cast(concat('0x', substr(sha1(html), cast(i // 4 * 5 + 1 as int), 5)) as bigint) >> cast(15 - i % 4 * 5 as bigint)) & 31) + 1 as int), 1)), 'string_agg', '') as payload_digest from p),
g as (select *, max(page_id) over (partition by payload_digest) as best from d),
k as (select *, concat(list_aggregate(list_reverse(string_split(regexp_extract(u, '^[a-z]+://([^/?#:]*)', 1), '.')), 'string_agg', ','), ')', case when regexp_extract(u, '^(?:[a-z]+://[^/?#]*)?([^?#]*)', 1) = '' then '/' else regexp_extract(u, '^(?:[a-z]+://[^/?#]*)?([^?#]*)', 1) end,
  case when regexp_extract(u, '\\?([^#]*)', 1) <> '' then concat('?', regexp_extract(u, '\\?([^#]*)', 1)) else '' end) as url_key from g)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest, case when best is null or page_id is not distinct from best then 'response' else 'revisit' end as record_type, case when page_id is distinct from best then best end as refers_to,
url_key, stamp, cast(row_number() over (order by url_key, stamp, page_id) - 1 as bigint) as position from k"""

FIM = r"""
with t as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u, sha256(concat('1:', coalesce(cast(doc_id as varchar), ''))) as x from documents),
c as (select *, len(u) as n, cast(concat('0x', x[1:8]) as bigint) % (len(u) + 1) as i, cast(concat('0x', x[9:16]) as bigint) % (len(u) + 1) as j,
  cast(concat('0x', x[17:24]) as bigint) % 100 as r, cast(concat('0x', x[25:32]) as bigint) % 100 as s from t),
l as (select *, coalesce(list_sum(list_transform(u[1:least(i, j)], lambda w: length(w))), 0) as p, coalesce(list_sum(list_transform(u[least(i, j) + 1:greatest(i, j)], lambda w: length(w))), 0) as m,
  case when text = '' or regexp_matches(text, '<[PSM]>') or r >= 90 then 'plain' when s < 20 then 'spm' else 'psm' end as form from c),
o as (select *, substr(text, 1, cast(p as bigint)) as a, substr(text, cast(p as bigint) + 1, cast(m as bigint)) as b, substr(text, cast(p + m as bigint) + 1) as z from l)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then cast(p as bigint) end as prefix_chars, case when form <> 'plain' then cast(m as bigint) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || a || '<S>' || z || '<M>' || b else '<S>' || z || '<P>' || a || '<M>' || b end) as output_sha256, sha256(text) as restored_sha256 from o"""


def _spans(kind: str, pattern: str, keep: str = "true") -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""select doc_id, tid, i.kind, i.start, i.start + length(i.m) as stop from (select doc_id, tid, unnest(list_transform(range(1, len(m) + 1), lambda k: {{'kind': {secrets.KINDS.index(kind)}, 'm': m[k],
 'start': cast(list_sum(list_transform(s[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0) as bigint)}})) as i
 from (select doc_id, tid, regexp_extract_all(text, {p}) as m, string_split_regex(text, {p}) as s from t)) where {keep}"""


def secret_sql() -> str:
    assign = secrets.ASSIGN.replace("'", "''")
    base = " union all ".join(
        [
            _spans("assign", secrets.ASSIGN, f"length(regexp_extract(i.m, '{assign}', 2)) >= 6"),
            _spans("access", secrets.ACCESS, "length(i.m) >= 20"),
            _spans("hex", secrets.HEX, "length(i.m) >= 24"),
        ]
    )
    weak = " union all ".join(_spans(k, p) for k, p in (("weak_access", secrets.WEAK_ACCESS), ("weak_secret", secrets.WEAK_SECRET), ("weak_hex", secrets.WEAK_HEX), ("endpoint", secrets.ENDPOINT)))
    names = str(secrets.KINDS)
    n = secrets.SCOPE
    shown = f"coalesce(string_agg(concat(({names})[kind + 1], ':', cast(start as varchar), ':', cast(stop as varchar)), ',' order by start, kind, stop), '')"
    return f"""
with t as (select doc_id, coalesce(text, '') as text, row_number() over () as tid from documents),
base as ({base}), weak0 as ({weak}),
weak as (select * from weak0 w where not exists (select 1 from base b where b.tid = w.tid and b.start < w.stop and w.start < b.stop)),
strong as (select tid, start, stop, kind = 1 as id from base union all select tid, start, stop, false from weak where kind = 4),
near as (select w.doc_id, w.tid, w.kind, w.start, w.stop, bool_or(s.id) as id, bool_or(not s.id) as secret from weak w join strong s on w.tid = s.tid and s.start <= w.stop + {n} and w.start <= s.stop + {n} and (s.stop <= w.start or w.stop <= s.start) group by all),
linked as (select doc_id, tid, kind, start, stop from near where (kind = 3 and secret) or (kind in (4, 5) and id) or (kind = 6 and id and secret)),
b as (select tid, count(*) filter (kind = 0) as a, count(*) filter (kind = 1) as k, count(*) filter (kind = 2) as h, {shown} as shown from base group by tid),
a as (select tid, {shown} as shown from (select * from base union all select * from linked) group by tid)
select t.doc_id, coalesce(b.a, 0) as n_assign, coalesce(b.k, 0) as n_access, coalesce(b.h, 0) as n_hex, sha256(coalesce(b.shown, '')) as base_sha256, coalesce(a.shown, '') as spans from t left join b on t.tid = b.tid left join a on t.tid = a.tid"""


def all_sql() -> dict[str, str]:
    return {"op2_mix_sources": MIX, "op5_shard_splitters": SHARD, "op7_secret_scan": secret_sql(), "op8_top_products": TOP, "op9_warc_index": WARC, "op11_fill_in_middle": FIM}
