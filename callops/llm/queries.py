"""Registered queries of the operators, each with the SQL it is checked against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from callops.llm import bpe, embeddings, exact, langid, mixing, packing, quality, repair, secret_scan, simhash, trie, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Fixed values of the contracts.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MIX_WEIGHTS, MIX_SHARE, MIX_REPEATS = (3, 1, 2), 1.5, 2
SIMHASH_WORDS, SIMHASH_BITS = 4, 4
PACKING_TOKENIZER, SEQUENCE_TOKENS, END_ID = "byte_bpe_50k.json", 1024, 2
FAMILY, SHARED_TURNS = 20, 4


def query(table: str, oracle: str | None = None):
    """Register a function from one table under its own name."""

    def register(build: Callable[[DataFrame], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(spark.read.parquet(f"{folder}/{table}.parquet"))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


@query("documents")
def op1_bpe(docs: DataFrame) -> DataFrame:
    tokens = bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return bpe.digests(tokens, ["doc_id"])


@query("documents", r"""
with texts as (
    select doc_id, length(coalesce(text, '')) as n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm,
           row_number() over () as row
    from documents
), ranked as (
    select *, first_value(doc_id) over stays as keep_id, count(*) over (partition by norm) as group_size,
           row_number() over stays = 1 as kept
    from texts window stays as (partition by norm order by n_chars desc, doc_id nulls last, row)
)
select doc_id, keep_id, group_size, kept, sha256(norm) as text_sha256 from ranked
""")
def op3_exact_dedup(docs: DataFrame) -> DataFrame:
    return exact.dedup(docs)


@query("documents", r"""
with placed as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
           md5(concat_ws(chr(31), coalesce(doc_id::varchar, ''), coalesce(text, ''))) as place
    from documents
), numbered as (
    select *, row_number() over (partition by source, place) as nth from placed
), sized as (
    select doc_id, source, size, case when nth = 1 then place else md5(place || ':' || nth) end as place from numbered
), totals as (
    select source, sum(size)::bigint as source_size, [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as weight
    from sized group by source
), filling as (
    select *, 2.0 * source_size as capacity, sum(source_size) over () * 1.5::double as budget,
           sum(weight) over () - coalesce(sum(weight) over earlier, 0) as room,
           sum(source_size) over () * 1.5::double - coalesce(sum(2.0::double * source_size) over earlier, 0) as left_over
    from totals window earlier as (order by 2.0 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)
), filled as (
    select *, capacity * room <= weight * left_over as is_full from filling
), goals as (
    select source, source_size, budget, case when is_full then capacity::double else
        weight * ((budget - sum(case when is_full then capacity else 0 end) over ()::double)
                  / nullif(sum(case when is_full then 0 else weight end) over (), 0)) end as target
    from filled
), served as (
    select s.*, g.source_size, g.target, g.budget,
           sum(size) over (partition by s.source order by place range between unbounded preceding and current row) as served
    from sized s join goals g on s.source is not distinct from g.source
), copies as (
    select *, (epoch * source_size + served) / target as finish from served, (values (0), (1)) e(epoch) where size > 0
), sent as (
    select doc_id, place, source, sum(size) over (order by finish, source nulls last, place, epoch range between unbounded preceding and current row) <= budget as goes, size
    from copies
), taken as (
    select source, place, sum(case when goes then size else 0 end) / count(*) * 2 as taken from sent group by source, place
)
select s.doc_id, s.size::bigint as size, s.source_size, s.target, coalesce(t.taken, 0)::bigint as taken
from served s left join taken t on s.place = t.place and s.source is not distinct from t.source
""")
def op4_mixing(docs: DataFrame) -> DataFrame:
    return mixing.report(docs, MIX_WEIGHTS, MIX_SHARE, MIX_REPEATS)


@query("documents")
def op5_language_id(docs: DataFrame) -> DataFrame:
    return langid.report(docs)


@query("documents")
def op8_simhash(docs: DataFrame) -> DataFrame:
    return simhash.report(docs, SIMHASH_WORDS, SIMHASH_BITS)


@query("documents")
def op10_secrets(docs: DataFrame) -> DataFrame:
    return secret_scan.scan(docs)


#: Fixed values of the contract: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query("pages", r"""
with recursive told as (
    select page_id, coalesce(html, '') as html,
           translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') as path
    from pages
), rules(domain, under, what) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), ruled as (
    select t.*, r.domain || r.under as rule, r.what from told t left join rules r
    on (t.host = r.domain or ends_with(t.host, '.' || r.domain)) and starts_with(t.path, r.under)
    qualify row_number() over (partition by t.page_id order by length(r.domain || r.under) desc nulls last, length(r.domain) desc) = 1
), counted as (
    select host, target, count(*)::double as links from (
        select host, translate(unnest(regexp_extract_all(html,
            '(?i)<a\s[^>]*?href\s*=\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s>]+)', 1)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as target
        from told) where host <> '' and host <> target group by host, target
), both_ways as (
    select 'trust' as kind, host, target, links from counted
    union all select 'distrust', target, host, links from counted
), steps as (
    select kind, host, target, links / sum(links) over (partition by kind, host) as share from both_ways
), hosts as (
    select host, count(*) as pages, count(case when what = 'allow' then 1 end)::double as trust,
           count(case when what = 'block' then 1 end)::double as distrust from ruled group by host
), waves(round, kind, host, score) as (
    select 0, kind, host, score from (
        select 'trust' as kind, host, trust as score from hosts union all select 'distrust', host, distrust from hosts)
    where host <> '' and score > 0
    union all
    select w.round + 1, s.kind, s.target, 0.85 * sum(w.score * s.share)
    from waves w join steps s on s.kind = w.kind and s.host = w.host where w.round < 12 group by w.round, s.kind, s.target
), blocked as (
    select h.host from hosts h join waves w on w.host = h.host group by h.host, h.pages
    having sum(case when kind = 'distrust' then score else -score end) > 0.5 * h.pages
)
select page_id, host, path, rule,
       coalesce(what, case when host in (select host from blocked) then 'block' else 'allow' end) as verdict
from ruled
""")
def op2_url_filters(pages: DataFrame) -> DataFrame:
    return urls.judge(pages, URL_RULES)


@query("pages")
def op7_warc(pages: DataFrame) -> DataFrame:
    manifest, _ = warc.write(pages)
    return warc.read(manifest)


@query("embeddings", r"""
with recursive unit as (
    select vec_id, label, embedding::double[] as v from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
          and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
    select a.vec_id as a, b.vec_id as b from unit a join unit b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.98
), reach(start, vec_id) as (
    select vec_id, vec_id from embeddings union select r.start, l.b from reach r join links l on l.a = r.vec_id
), component as (
    select start as vec_id, min(vec_id) as component_id from reach group by start
), counted as (
    select a as vec_id, count(*) as n_links from links group by a
)
select e.vec_id, coalesce(n.n_links, 0)::bigint as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join component c on c.vec_id = e.vec_id left join counted n on n.vec_id = e.vec_id
""")
def op6_embedding_dedup(vectors: DataFrame) -> DataFrame:
    return embeddings.near_groups(vectors, 0.98)


@query("documents")
def op9_quality(docs: DataFrame) -> DataFrame:
    return quality.classify(docs)


@query("documents")
def op11_packing(docs: DataFrame) -> DataFrame:
    pieces = packing.pieces(docs, public_tokenizers.path(PACKING_TOKENIZER), SEQUENCE_TOKENS, END_ID)
    told = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(told, SEQUENCE_TOKENS)


@query("conversations", r"""
with turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as pos
    from conversations where conv_id is not null
), convs as (
    -- crc32 of the decimal id: bytes, then eight steps of one bit each
    select conv_id, conv_id - conv_id % 20 as base, count(*) as n,
           xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
               lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, step: xor(c // 2, (c % 2) * 3988292384)))) % 4 as h
    from turns group by conv_id
), rebuilt as (
    select c.conv_id, t.pos as place, t.role, t.text from convs c join turns t on t.conv_id = c.base and t.pos <= c.h
    union all select c.conv_id, t.pos, t.role, t.text from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h
), placed as (
    select conv_id, role, text, row_number() over (partition by conv_id order by place) as depth from rebuilt
), prefixes as (
    select conv_id, depth, text, sha256(string_agg(sha256(role) || sha256(text), '' order by depth)
           over (partition by conv_id order by depth)) as prefix from placed
    union all select conv_id, 0, '', '' from convs
), named as (
    select *, min(conv_id) over (partition by depth, prefix) as node, count(*) over (partition by conv_id) - 1 as length from prefixes
), nodes as (
    select node, depth, count(*) as n_convs, any_value(text) as text,
           coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = length), '') as ends
    from named group by node, depth
), paths as (
    select conv_id, depth, node from named
), linked as (
    select n.*, p.node as parent from nodes n left join paths p on p.conv_id = n.node and p.depth = n.depth - 1
), grown as (
    select l.*, coalesce(c.n, 0) as n_children from linked l
    left join (select parent, depth - 1 as depth, count(*) as n from linked where depth > 0 group by all) c on c.parent = l.node and c.depth = l.depth
), sums as (
    select p.node, p.depth, count(case when g.n_children = 0 then 1 end) as n_leaves,
           sum((g.n_convs - 1) * len(regexp_extract_all(g.text, '[^\x20\x09-\x0D]+')))::bigint as saved_tokens
    from grown g join paths p on p.conv_id = g.node and p.depth <= g.depth group by p.node, p.depth
)
select g.node as conv_id, g.depth, g.parent as parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) as ends_sha256
from grown g join sums s on s.node = g.node and s.depth = g.depth
""")
def op12_prefix_trie(conversations: DataFrame) -> DataFrame:
    return trie.report(conversations, FAMILY, SHARED_TURNS)


@query("conversations")
def op13_repair(conversations: DataFrame) -> DataFrame:
    return repair.report(conversations, repair.damage(conversations))
