"""Longer SQL twins, put together from parts that repeat."""

from __future__ import annotations

from railmill.llm.conversations import ENDS, SPACES
from railmill.llm.sharding import SHARDS, SLACK, VNODES

NEGATIVES_SQL = """
with v as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
    select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_dot_product(a.v, c.v)::bigint as score
    from v a join v c on a.vec_id <> c.vec_id
    where a.vec_id % 100 = 0
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score
    from scored
    where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id,
       row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id)::int as rank,
       n.vec_id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
     and 30 * p.positive_score <= 100 * n.score and 100 * n.score <= 90 * p.positive_score
qualify rank <= 10
"""


def _crc_table() -> str:
    """The 256 steps of a CRC-32 over a byte, as a list in SQL."""
    steps = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        steps.append(value)
    return f"[{','.join(map(str, steps))}]::bigint[]"


def crc32_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes."""
    digits = f"hex(encode({text}))"
    digit = "instr('0123456789ABCDEF', h[2 * i + {}]) - 1"
    octets = f"list_transform(range(length(h) // 2), lambda i: 16 * ({digit.format(1)}) + {digit.format(2)})"
    step = f"xor(c >> 8, ({_crc_table()})[(xor(c, x) & 255) + 1])"
    folded = f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), lambda c, x: {step}), 4294967295)"
    return f"(select {folded} from (select {digits} as h))"


def _shards_sql(shards: int = SHARDS, vnodes: int = VNODES, slack: int = SLACK) -> str:
    n = shards * vnodes
    place = "('0x' || substr(md5({}), 1, 15))::bigint"
    rounds = []
    for turn in range(shards):
        rounds.append(f"""
asked{turn} as (select *, coalesce(shard, wanted[{turn + 1}]) as asked from pieces{turn}),
room{turn} as (
    select *, first + case when shard is not null then last - first else greatest(0, least(last - first, bound
           - coalesce(sum(last - first) filter (shard is not null) over (partition by asked), 0)
           - coalesce(sum(last - first) filter (shard is null) over (partition by asked order by arc, first
                      rows between unbounded preceding and 1 preceding), 0))) end as cut
    from asked{turn}
),
pieces{turn + 1} as (
    select arc, wanted, bound, first, cut as last, asked as shard from room{turn} where cut > first
    union all
    select arc, wanted, bound, cut as first, last, null as shard from room{turn} where last > cut
),""")
    return f"""
with ring as (
    select row_number() over (order by pos, shard) - 1 as arc, pos, shard
    from (select s.s as shard, {place.format("s.s || ':' || v.v")} as pos from range({shards}) s(s), range({vnodes}) v(v))
), arcs as (
    select arc, coalesce(lag(pos) over (order by arc) + 1, 0) as low, pos as high from ring
    union all
    select {n}, max(pos) + 1, {(1 << 60) - 1} from ring
), onward as (
    select arc, list(shard order by ahead) as wanted
    from (select a.arc, p.shard, min((p.arc - a.arc + {n}) % {n}) as ahead from arcs a, ring p group by all)
    group by arc
), docs as (
    select doc_id, coalesce(text, '') as text, md5(coalesce(text, '')) as digest, octet_length(encode(coalesce(text, ''))) + 1 as size
    from documents
), lined as (
    select *, (sum(size) over (order by pos, digest, doc_id nulls first rows unbounded preceding) - size)::bigint as start
    from (select *, {place.format("text")} as pos from docs)
), located as (
    select l.*, a.arc from lined l join arcs a on l.pos >= a.low and l.pos <= a.high
), sums as (
    select arc, sum(size)::bigint as bytes from located group by arc
), pieces0 as (
    select arc, wanted, ceil(sum(bytes) over () * {1000 + slack} / {1000 * shards})::bigint as bound,
           (sum(bytes) over (order by arc) - bytes)::bigint as first, (sum(bytes) over (order by arc))::bigint as last, null::int as shard
    from sums join onward using (arc)
),{"".join(rounds)}
placed as (
    select l.*, p.shard, p.wanted[1] as home
    from located l join pieces{shards} p on l.arc = p.arc and l.start >= p.first and l.start < p.last
)
select doc_id, size::bigint as size, {crc32_sql("text")}::bigint as text_crc32, 'bytes' as law, shard::int as shard,
       row_number() over (partition by shard order by start) - 1 as slot, null::int as grown_shard, home::int as home_shard
from placed
"""


def _conversations_sql() -> str:
    key = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
    spaces = " || ".join(f"chr({ord(c)})" for c in SPACES)
    base = [
        "least(3 + a[1], if(free, 2 + cut + a[3], 1e9::bigint), if(free and initial = 's', cut + a[2], 1e9::bigint), if(free and initial = 'u', cut + a[3], 1e9::bigint))",
        "least(3 + a[2], if(free, 2 + cut + a[3], 1e9::bigint), if(free and initial = 'u', cut + a[3], 1e9::bigint))",
        "least(3 + a[3], if(free, 2 + cut + a[4], 1e9::bigint), if(free and initial = 'a', cut + a[4], 1e9::bigint))",
        "least(3 + a[4], if(free, 2 + cut + a[3], 1e9::bigint), if(free and initial = 'u', cut + a[3], 1e9::bigint))",
    ]
    named = ", ".join(f"{b} as b{q}" for q, b in enumerate(base))
    user, assistant = "least(b2, b3 + 2)", "least(b3, b2 + 2)"
    return f"""
with recursive kinds as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc32_sql(key)} % 20 as kind
    from conversations
), after_damage as (
    select conv_id, turn, if(kind = 4, 'user', role) as role,
           case kind when 1 then '' when 2 then translate(text, '{ENDS}', '') else text end as text
    from (select * from kinds union all select * from kinds where kind = 3)
    where kind <> 0
), numbered as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i,
           substr(role, 1, 1) as initial, right(rtrim(text, {spaces}), 1) as ending
    from after_damage
), faulty as (
    select *, case when ending = '' then 'blank'
                   when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
                   when instr('{ENDS}', ending) = 0 then 'truncated' end as fault,
           lag(initial) over (partition by conv_id order by i) as before
    from numbered
), turns as materialized (
    select *, fault is null or fault = 'truncated' as free, if(fault = 'truncated', 1, 0) as cut
    from faulty
), counts as (
    select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
           count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
           count(*) filter (fault = 'truncated') as truncated,
           count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
    from turns group by conv_id
), costs as (
    select conv_id, n + 1 as i, [0, 4, 2, 0]::bigint[] as v from counts
    union all
    select conv_id, i, [least(b0, {user} + 2), least(b1, {user} + 2), {user}, {assistant}]::bigint[] as v
    from (
        select conv_id, i, {named}
        from (select t.*, c.v as a from costs c join turns t on t.conv_id is not distinct from c.conv_id and t.i = c.i - 1)
    )
), stored as materialized (select * from costs), steps as materialized (
    select s.conv_id, s.i, s.v, a.v as a, t.role, t.text, t.initial, t.free, t.cut
    from stored s
    left join stored a on a.conv_id is not distinct from s.conv_id and a.i = s.i + 1
    left join turns t on t.conv_id is not distinct from s.conv_id and t.i = s.i
), walked as (
    select conv_id, 1::bigint as i, 0 as q, '' as audit, 0 as lines, '' as body from counts
    union all
    select conv_id, if(letter = 'I', i, i + 1), case letter when 'D' then q when 'K' then kept else onward end, audit || letter,
           lines + if(letter = 'D', 0, 1),
           body || case when letter = 'D' then '' else if(lines > 0, chr(10), '') || case letter
               when 'K' then role || ':' || text
               else if(onward = 2, 'user:', 'assistant:') || if(letter = 'R', text, '') end end
    from (
        select *, case when role is not null and v[q + 1] = 3 + a[q + 1] then 'D'
                       when v[q + 1] = 2 + v[onward + 1] then 'I'
                       when free and kept is not null and v[q + 1] = cut + a[kept + 1] then 'K'
                       else 'R' end as letter
        from (
            select w.*, s.v, s.a, s.role, s.text, s.free, s.cut, if(w.q = 2, 3, 2) as onward,
                   case when w.q = 0 and s.initial = 's' then 1 when w.q = 2 and s.initial = 'a' then 3
                        when w.q <> 2 and s.initial = 'u' then 2 end as kept
            from walked w join steps s on s.conv_id is not distinct from w.conv_id and s.i = w.i
            where s.role is not null or s.v[w.q + 1] > 0
        )
    )
), ends as (
    select conv_id, audit, body from walked
    qualify row_number() over (partition by conv_id order by length(audit) desc) = 1
), starts as (select conv_id, v[1] as cost from stored where i = 1)
select o.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(c.blank, 0)::bigint as blank, coalesce(c.duplicate, 0)::bigint as duplicate,
       coalesce(c.truncated, 0)::bigint as truncated, coalesce(c.illegal, 0)::bigint as illegal, coalesce(s.cost, 0)::bigint as cost,
       coalesce(e.audit, '') as audit, sha256(coalesce(e.body, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join starts s on s.conv_id is not distinct from o.conv_id
left join ends e on e.conv_id is not distinct from o.conv_id
"""


SHARDS_SQL = _shards_sql()
CONVERSATIONS_SQL = _conversations_sql()
