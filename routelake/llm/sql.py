"""DuckDB SQL of the queries that SQL can express."""

SQL = {
    "op1_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as c from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and vec_id is not null
), s as (
  select q.vec_id as query_id, d.vec_id, list_sum(list_transform(list_zip(q.c, d.c), lambda p: p[1] * p[2]))::bigint as score
  from v q join v d on q.vec_id % 20 = 0 and q.vec_id <> d.vec_id and len(q.c) = len(d.c)
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20
""",
    "op6_mix": r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5('11:' || coalesce(doc_id::varchar, 'null')), 1, 15))::bigint as u
  from documents
), ranked as (
  select source, sum(size)::bigint as source_size, (row_number() over (order by source is null, encode(source)) - 1) % 3 + 1 as weight
  from sized group by source
), filled as (
  select *, 3 * source_size as cap,
    sum(3 * source_size) over w - 3 * source_size as cap_before, sum(weight) over () - (sum(weight) over w - weight) as weight_left,
    sum(source_size) over () as total, row_number() over w as place
  from ranked window w as (order by 3 * source_size / weight, source_size, encode(source) nulls last rows unbounded preceding)
), level as (
  select arg_min((total - cap_before)::bigint / weight_left::bigint, place) as level from filled
  where weight * ((total - cap_before)::bigint / weight_left::bigint) < cap
), target as (
  select source, source_size, case when cap <= weight * coalesce(level, 'infinity'::double) then cap::double else weight * level end as target
  from filled, level
), plan as (
  select d.doc_id, d.source, d.size, d.u, t.source_size, t.target,
    case when t.source_size > 0 then floor(t.target / t.source_size) else 0 end::bigint as whole,
    coalesce(sum(d.size) over (partition by d.source order by d.u, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as so_far
  from sized d join target t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target, (size * (whole + case when so_far + size / 2 <= target - whole * source_size then 1 else 0 end))::bigint as taken
from plan
""",
    "op10_vector_dedup": """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as c from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0 and label is not null and vec_id is not null
), link as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.c) = len(b.c)
  where list_inner_product(a.c, b.c) / (sqrt(list_inner_product(a.c, a.c)) * sqrt(list_inner_product(b.c, b.c))) >= 0.98
), reach as (
  select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a
)
select e.vec_id, (select count(*) from link where a = e.vec_id) as n_links,
  least(e.vec_id, coalesce((select min(b) from reach where a = e.vec_id), e.vec_id)) as component_id,
  e.vec_id = least(e.vec_id, coalesce((select min(b) from reach where a = e.vec_id), e.vec_id)) as kept
from embeddings e
""",
}
