"""DuckDB SQL for the queries of this subpackage that need more of it than a few lines."""

from __future__ import annotations


def crc_step(c: int) -> int:
    for _ in range(8):
        c = (c >> 1) ^ (0xEDB88320 * (c & 1))
    return c


CRC_TABLE = "[" + ",".join(str(crc_step(b)) for b in range(256)) + "]::bigint[]"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::bigint)"
    step = f"xor(c >> 8, ({CRC_TABLE})[xor(c & 255, x) + 1])"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {data}), lambda c, x: {step}), 4294967295::bigint)"


def hilbert(source: str, bits: int = 5, dims: int = 3) -> str:
    """``source`` has coordinates x0, x1, ...; the result adds ``curve``, a level of turns at a time."""
    axes = range(dims)
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in axes:
            swap = f"(xor(x0, x{i}) & {low})"
            first = f"case when x{i} & {q} <> 0 then xor(x0, {low}) else xor(x0, {swap}) end as x0"
            own = f", case when x{i} & {q} <> 0 then x{i} else xor(x{i}, {swap}) end as x{i}" if i else ""
            source = f"select * replace ({first}{own}) from ({source})"
    for i in axes[1:]:
        source = f"select * replace (xor(x{i}, x{i - 1}) as x{i}) from ({source})"
    flip = "0"
    for b in range(1, bits):
        flip = f"xor({flip}, case when x{dims - 1} & {1 << b} <> 0 then {(1 << b) - 1} else 0 end)"
    parts = [f"((xor(x{i}, flip) >> {b}) & 1) * {1 << (b * dims + dims - 1 - i)}" for b in range(bits) for i in axes]
    return f"select *, {' + '.join(parts)} as curve from (select *, {flip} as flip from ({source}))"


def text_grid(column: str) -> str:
    start = f"(select coalesce(max(i), 0) from (select unnest(range(0, 100)) as i), (select min({column}) as a, max({column}) as b from documents) where left(a, i) = left(b, i) and i <= least(length(a), length(b)))"
    code = lambda at: f"least(case when length({column}) >= {start} + {at} then unicode(substr({column}, {start} + {at}, 1)) else 0 end, 255)"
    return f"{code(1)} * 256 + {code(2)}"


def equal_steps(grid: str, name: str) -> str:
    return f"select {grid}, floor(coalesce(sum(n) over (order by {grid} rows between unbounded preceding and 1 preceding), 0) * 32 / sum(n) over ())::bigint as {name} from (select {grid}, count(*) as n from g group by 1)"


SHARDING = f"""
with d as (
  select doc_id, lang, source, octet_length(encode(coalesce(text, ''))) + 8 as size, {crc32("coalesce(text, '')")} as text_crc32 from documents
), g as (
  select *, {text_grid("lang")} as g0, {text_grid("source")} as g1,
    length(bin(size)) * 32 + ((size >> greatest(length(bin(size)) - 6, 0)) & 31) as g2,
    ('0x' || left(md5(coalesce(cast(doc_id as varchar), '') || ':' || text_crc32), 8))::bigint as digest
  from d
), c0 as ({equal_steps("g0", "x0")}), c1 as ({equal_steps("g1", "x1")}), c2 as ({equal_steps("g2", "x2")}),
h as ({hilbert("select g.*, x0, x1, x2 from g join c0 using (g0) join c1 using (g1) join c2 using (g2)")}),
p as (select *, row_number() over (order by curve, digest, doc_id, size) - 1 as place, count(*) over () as n from h),
s as (select *, (place * 24) // n as shard from p)
select doc_id, size, text_crc32, 'rows' as law, cast(shard as int) as shard, place - (shard * n + 23) // 24 as slot, cast(null as int) as grown_shard from s
"""


def code_round(number: int) -> str:
    """One round: the nearest entry of each part, then the averages."""
    old, new = f"e{number}", f"e{number + 1}"
    return f"""
{nearest(old, f'a{number}')},
m{number} as (
  select p, i, list(m order by k) as xs from (
    select a.p, a.i, k, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as m
    from a{number} a join (select vec_id, p, unnest(xs) as x, unnest(range(16)) as k from v) u using (vec_id, p) group by a.p, a.i, k)
  group by p, i
),
{new} as materialized (select e.p, e.i, coalesce(m.xs, e.xs) as xs from {old} e left join m{number} m using (p, i))"""


def nearest(entries: str, name: str) -> str:
    apart = "list_sum(list_transform(range(1, 17), lambda k: (v.xs[k] - e.xs[k]) * (v.xs[k] - e.xs[k])))"
    return f"""{name} as materialized (
  select vec_id, p, i, d from (select v.vec_id, v.p, e.i, {apart}::bigint as d from v join {entries} e using (p))
  qualify row_number() over (partition by vec_id, p order by d, i) = 1
)"""


VECTOR_CODES = f"""
with w as (
  select vec_id, label, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), v as materialized (select vec_id, p, v[p * 16 + 1 : p * 16 + 16] as xs from w, (select unnest(range(4)) as p)),
e0 as materialized (
  select p, dense_rank() over (order by vec_id) - 1 as i, xs from v where vec_id in (select vec_id from w order by vec_id limit 256)
), {",".join(code_round(r) for r in range(4))}, {nearest("e4", "z")},
c as (select vec_id, string_agg(printf('%02x', i), '' order by p) as code, sum(d)::bigint as error from z group by vec_id),
b as (select sha256(string_agg(array_to_string(xs, ','), ',' order by p, i)) as codebooks_sha256 from e4)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from c join w using (vec_id), b
"""

WORDS = r"regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+')"

IMPORTANCE = f"""
with w as (select 0 as side, doc_id as id, {WORDS} as ws from documents union all select 1, item_id, {WORDS} from benchmark),
f as materialized (
  select side, id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as f from w
), b as materialized (select f, {crc32("f")} % 10000 as bucket from (select distinct f from f)),
c as (select bucket, count(*) filter (where side = 0) as s, count(*) filter (where side = 1) as t from f join b using (f) group by bucket),
k as (select sum(s) as ss, sum(t) as tt from c),
g as (select bucket, floor(1000 * ln(((t + 1) * (tt * 0 + ss + 10000))::double / ((s + 1) * (tt + 10000))::double))::bigint as gain from c, k),
d as (
  select id as doc_id, count(*) as n_features, sum(gain)::bigint as total from f join b using (f) join g using (bucket) where side = 0 group by id
), s as (
  select id as doc_id, len(ws) as n_words, coalesce(n_features, 0) as n_features, coalesce(floor(total::double / n_features), 0)::bigint as weight,
    ('0x' || left(sha256('7:' || id), 8))::bigint as h
  from w left join d on d.doc_id = w.id where side = 0
), r as (select *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::bigint as score from s),
o as (select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from r where n_words >= 20)
select doc_id, n_features, weight, score, case when rank <= n * 25 // 100 then rank end as rank from r left join o using (doc_id)
""".replace("tt * 0 + ", "")

# Texts are cut into blocks of 1,024 bytes first, so that no position is searched for from the start of a long text.
REPEATS = """
with d as materialized (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
blocks as (
  select doc_id, b * 1024 as base, substr(h, b * 2048 + 1, 2146) as s, len(h) // 2 as n
  from (select *, unnest(range((len(h) // 2 + 1023) // 1024)) as b from d)
), bytes as materialized (
  select doc_id, base + i as p, substr(s, 2 * i + 1, 2) as x, case when base + i + 50 <= n then substr(s, 2 * i + 1, 100) end as w
  from (select *, unnest(range(least(1024, n - base))) as i from blocks)
), first as (select w, min(doc_id) as least from bytes where w is not null group by w having min(doc_id) < max(doc_id)),
marked as (select bytes.*, case when least < doc_id then p end as start from bytes left join first using (w)),
covered as (select doc_id, p, x, coalesce(p - max(start) over (partition by doc_id order by p) < 50, false) as gone from marked),
runs as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by p), false) as opens from covered),
kept as (
  select doc_id, count(*) filter (gone) as n_removed, count(*) filter (opens) as n_spans, coalesce(string_agg(x, '' order by p) filter (not gone), '') as rest
  from runs group by doc_id
)
select doc_id, len(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(rest, ''))) as kept_sha256
from d left join kept using (doc_id)
"""
