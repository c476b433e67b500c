"""DuckDB SQL for the registered queries that SQL can express."""

URL_FILTER = r"""
with parsed as (
  select page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages
),
rules(host, path, verdict) as (
  values ('org', '', 'allow'), ('example.org', 'es/', 'block'), ('example.org', 'en/1', 'block'),
         ('com', 'fr/', 'allow'), ('com', 'de/', 'block')
),
fitting as (
  select p.page_id, r.host || '/' || r.path as rule, r.verdict,
    row_number() over (partition by p.page_id order by length(r.host || r.path) desc, length(r.host) desc) as place
  from parsed p join rules r
    on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, '/' || r.path)
),
listed as (
  select distinct host, case when path = '' then '/' else path end as path
  from parsed where page_id % 10 = 0 and host <> ''
)
select p.page_id, p.host, p.path, f.rule,
  coalesce(f.verdict, case when l.host is not null then 'block' else 'allow' end) as verdict
from parsed p
left join fitting f on f.page_id = p.page_id and f.place = 1
left join listed l on l.host = p.host and l.path = case when p.path = '' then '/' else p.path end
"""

HARD_NEGATIVES = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
positives as (
  select a.vec_id as anchor_id, a.v, a.label, p.vec_id as positive_id,
    list_dot_product(a.v, p.v)::bigint as positive_score
  from vectors a join vectors p on p.label = a.label and p.vec_id <> a.vec_id
  where a.vec_id % 100 = 0
  qualify row_number() over (partition by a.vec_id order by list_dot_product(a.v, p.v) desc, p.vec_id) <= 5
),
scored as (
  select p.anchor_id, p.positive_id, n.vec_id as negative_id, p.positive_score,
    list_dot_product(p.v, n.v)::bigint as negative_score
  from positives p join vectors n on n.label <> p.label
),
placed as (
  select *, row_number() over (
    partition by anchor_id, positive_id order by negative_score desc, negative_id)::int as rank
  from scored
  where 30 * positive_score <= 100 * negative_score and 100 * negative_score <= 90 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from placed where rank <= 10
"""

ORACLE: dict[str, str] = {"op5_url_filter": URL_FILTER, "op11_hard_negatives": HARD_NEGATIVES}
