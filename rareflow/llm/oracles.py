"""The queries that DuckDB can express, over the same tables."""

from __future__ import annotations

import corpus_pipeline

from rareflow.llm import divergence, forest, mixing, sharding, vptrees

OP5 = r"""
with cut as (
  select page_id, case when url is null or strpos(url, '://') = 0 then '' else substr(url, strpos(url, '://') + 3) end as rest from pages
), bare as (
  select page_id, regexp_extract(rest, '^[^?#]*') as rest from cut
), parts as (
  select page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '/.*$', 0, 's') as path from bare
), ruled as (
  select *, case
    when (host = 'www.example.com' or host like '%.www.example.com') and path like '/en/%' then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/en/%' then 'example.com/en/'
    when (host = 'net' or host like '%.net') and path like '/es/%' then 'net/es/'
    when (host = 'net' or host like '%.net') and path like '/fr/%' then 'net/fr/'
    when (host = 'com' or host like '%.com') and path like '/%' then 'com/'
    end as rule from parts
)
select page_id, host, path, rule,
  case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict
from ruled
"""

OP8 = f"""
with r as (
  select doc_id, octet_length(encode(coalesce(text, ''))) as bytes,
    ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint as place
  from documents
), l as (
  select d, place >> ({sharding.HASH_BITS} - d) as head, sum(bytes) as held
  from r, (select unnest(range(0, {sharding.HASH_BITS + 1})) as d) group by all
), f as (
  select r.doc_id, r.place, r.bytes, coalesce(min(l.d), {sharding.HASH_BITS})::bigint as depth
  from r left join l on l.head = r.place >> ({sharding.HASH_BITS} - l.d) and l.held <= {sharding.SHARD_BYTES}
  group by all
)
select doc_id, substr(lpad(bin(place), {sharding.HASH_BITS}, '0'), 1, depth) as shard, depth, cast(0 as bigint) as page,
  cast(bytes as bigint) as bytes
from f
"""

OP10 = f"""
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
), p as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= {forest.MIN_COSINE}
), reach as (
  select vec_id as n, vec_id as m from v
  union
  select reach.n, p.b from reach join p on p.a = reach.m
), least_ as (
  select n, min(m) as component_id from reach group by n
), links as (
  select a, count(*) as n_links from p group by a
)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from v join least_ on n = vec_id left join links on a = vec_id
"""


OP11 = f"""
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: cast(x as double) + 0.0) as e from embeddings
  where vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), n as (
  select *, list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b) as ee from v
), q as (
  select vec_id, min(e) as e from v where vec_id % 50 = 0 group by vec_id
), p as (
  select q.vec_id as query_id, n.vec_id,
    max(list_reduce(list_transform(list_zip(q.e, n.e), lambda z: z[1] * z[2]), lambda a, b: a + b) / sqrt(m.ee * n.ee)) as score
  from q join n m on m.vec_id = q.vec_id and m.e = q.e join n on n.vec_id <> q.vec_id and len(n.e) = len(q.e) group by all
), r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from p
)
select query_id, rank, vec_id, score from r where rank <= {vptrees.NEAREST}
"""

OP12 = rf"""
with d as (
  select row_number() over () as row, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents
), w as (
  select row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from d
), kept as (
  select lang, term from w group by all having count(distinct row) >= {divergence.MIN_DOCS}
), c as (
  select lang, source, term, count(*) as n from w join kept using (lang, term) group by all
), g as (
  select lang, source, coalesce((select sum(n) from c where c.lang = s.lang and c.source = s.source), 0) as total,
    (select count(*) from kept where kept.lang = s.lang) as v
  from (select distinct lang, source from d) s
), l as (
  select lang, sum(total) as total, any_value(v) as v from g group by lang
), p as (
  select g.lang, g.source, term, coalesce(n, 0) as n, 1 + (1000000000::hugeint * (coalesce(n, 0) + 2)) // (total + 2 * v)::hugeint as p
  from g join kept using (lang) left join c using (lang, source, term)
), q as (
  select lang, term, 1 + (1000000000::hugeint * (n + 2)) // (total + 2 * v)::hugeint as q
  from (select lang, term, sum(n) as n from c group by all) join l using (lang)
), apart as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join apart on apart.lang = a.lang and apart.source = a.source and apart.item = b.source
), terms as (
  select lang, source, 'term' as part, term as item, cast((p - q) * (p - q) // (p + q) as bigint) as value
  from p join q using (lang, term) where n > 0 and p > q
), ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
  from (select * from pairs union all select * from terms)
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {divergence.TOP_TERMS}
"""


def _op2() -> str:
    held = [(t, " or ".join(f"contains(lower(coalesce(text, '')), '{m}')" for m in marks)) for t, marks in mixing.TOPICS]
    topic = " ".join(f"when {h} then '{t}'" for t, h in held)
    steps, last = [], "w0"
    dims = ("source", "lang", "topic")
    for k in range(mixing.ROUNDS):
        for dim in dims:
            name = f"w{k}_{dim}"
            scaled = f"weight * t_{dim} / sum(weight) over (partition by {dim})"
            steps.append(f"{name} as (select source, lang, topic, tokens, {scaled} as weight, t_source, t_lang, t_topic from {last})")
            last = name
    margins = [
        f"m_{d} as (select {d}, pow(sum(tokens), {mixing.TEMPERATURE}) as t from cells group by {d}), "
        f"s_{d} as (select {d}, t / (select sum(t) from m_{d}) as t_{d} from m_{d})"
        for d in dims
    ]
    return f"""
with d as (
  select doc_id, source, lang, coalesce(source, '{mixing.NONE}') as s, coalesce(lang, '{mixing.NONE}') as l,
    case {topic} else '{mixing.OTHER_TOPIC}' end as topic,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as tokens,
    ('0x' || substr(md5(coalesce(cast(doc_id as varchar), text, '') || ':42'), 1, 8))::bigint / 4294967296.0::double as u
  from documents
), cells as (
  select s as source, l as lang, topic, cast(sum(tokens) as double) as tokens from d group by all having sum(tokens) > 0
), {", ".join(margins)}, w0 as (
  select c.*, c.tokens / (select sum(tokens) from cells) as weight, t_source, t_lang, t_topic
  from cells c join s_source using (source) join s_lang using (lang) join s_topic using (topic)
), {", ".join(steps)}, p as (
  select source, lang, topic, round((weight / tokens) / (select max(weight / tokens) from {last}), 9) as probability from {last}
), j as (
  select doc_id, d.source, d.lang, d.topic, d.tokens, u,
    case when d.tokens = 0 then 1.0::double else coalesce(probability, 0.0)::double end as probability
  from d left join p on p.source = d.s and p.lang = d.l and p.topic = d.topic
)
select doc_id, source, lang, topic, tokens, probability, u < probability as kept from j
"""


def oracles() -> dict[str, str]:
    found = {"op2_mixing": _op2(), "op5_url_filters": OP5, "op8_sharding": OP8, "op10_embedding_dedup": OP10, "op11_nearest_vectors": OP11, "op12_source_divergence": OP12}
    if corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
