"""DuckDB SQL of the queries that SQL can express on whole tables."""
from __future__ import annotations

#: crc32 of the decimal digits of conv_id, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)), lambda v, k:
        case when v % 2 = 1 then xor(v // 2, 3988292384::bigint) else v // 2 end)), 4294967295::bigint)"""

OP13_SQL = f"""
with turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, role, text) as place
    from conversations where conv_id is not null),
own as (
    select conv_id, list({{'role': role, 'text': text}} order by place) as steps, {_CRC32} % 6 as h
    from turns group by conv_id),
built as (
    select o.conv_id, list_concat(case when b.steps is null then o.steps[1:0] else b.steps[1:o.h] end, o.steps[o.h + 1:]) as steps
    from own o left join own b on b.conv_id = o.conv_id - o.conv_id % 100),
prefixes as (
    select conv_id, depth, steps[1:depth] as path, len(steps) = depth as ended
    from (select conv_id, steps, unnest(range(0, len(steps) + 1)) as depth from built)),
nodes as (
    select path, depth, min(conv_id) as conv_id, count(*) as n_convs,
        coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '') as ended
    from prefixes group by path, depth),
families as (
    select n.*, case when depth = 0 then null else path[1:depth - 1] end as parent,
        case when depth = 0 then 0 else (n_convs - 1) * length(path[depth].text) end as saved,
        not exists (select 1 from nodes c where c.depth = n.depth + 1 and c.path[1:n.depth] = n.path) as leaf
    from nodes n),
subtrees as (
    select path[1:above] as path, sum(leaf::bigint) as n_leaves, sum(saved) as saved_tokens
    from (select path, leaf, saved, unnest(range(0, depth + 1)) as above from families)
    group by 1),
children as (select parent as path, count(*) as n_children from families where parent is not null group by 1)
select f.conv_id, f.depth, p.conv_id as parent_conv_id, f.n_convs, coalesce(c.n_children, 0) as n_children,
    s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, sha256(f.ended) as ends_sha256
from families f join subtrees s on s.path = f.path
left join nodes p on p.path = f.parent
left join children c on c.path = f.path
"""

#: Vectors with a null or non-finite component take no part; products are whole numbers below 2^53, exact as doubles.
OP3_SQL = """
with whole as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
    from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
scored as (
    select q.vec_id as query_id, d.vec_id, list_dot_product(q.v, d.v)::bigint as score
    from whole q join whole d on q.vec_id <> d.vec_id where q.vec_id % 100 = 0),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""
