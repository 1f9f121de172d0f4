"""The operators on the check tables, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.llm import (
    exact, fingerprints, language, licenses, mixing, negatives, packing, quality, simhash, suffixes, tokenfile, urls, variants,
)
from perron.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which document of each group of equal texts stays."""
    return exact.exact_dedup(table(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


ORACLE["op1_exact_dedup"] = r"""
with d as (
    select doc_id, length(coalesce(text, '')) as points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
    from documents),
k as (
    select *, first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) as keep_id,
           count(*) over (partition by text_sha256) as group_size
    from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from k"""


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of the quality rules."""
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, folder, "labels")))


@query
def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License labels of every text."""
    return licenses.scan(table(spark, folder, "documents"), stretch=licenses.STRETCH).drop("spans")


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of all documents and the sequences that they stand in."""
    return packing.pack(table(spark, folder, "documents"), with_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query
def op5_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """What repeated passages take from every document."""
    return suffixes.repeated_passages(table(spark, folder, "documents")).drop("removed")


@query
def op6_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return urls.judge(pages).select("page_id", "__url.*")


def _url_sql() -> str:
    """The rounds one behind another."""
    lower = "translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = lower % r"coalesce(regexp_extract(%s, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '')"
    rounds = "".join(
        f""",
r{n} as materialized (
    select host, sum(trust) as trust, sum(distrust) as distrust
    from (select host, trust, distrust from r0
          union all select dst, trust * of_src * 0.85, 0.0 from e join r{n - 1} on src = host
          union all select src, 0.0, distrust * of_dst * 0.85 from e join r{n - 1} on dst = host)
    group by host)"""
        for n in range(1, urls.ROUNDS + 1)
    )
    return rf"""
with p as materialized (
    select page_id, html, {host % 'url'} as host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
    from pages),
rules(verdict, rhost, rpath) as (
    values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
j as materialized (
    select page_id, host, path,
           (select arg_max(rhost || rpath, length(rhost || rpath)) from rules
            where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)) as rule
    from p),
v as materialized (select j.*, rules.verdict from j left join rules on rule = rhost || rpath),
l as (
    select host as src, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)', 1)) as link from p),
t as (
    select src, case when link like '%://%' then {host % 'link'} else {host % "'http:' || link"} end as dst
    from l where link like '%://%' or link like '//%'),
c as materialized (select src, dst, count(*) as links from t where src <> dst and src <> '' and dst <> '' group by src, dst),
e as materialized (
    select src, dst, links / sum(links) over (partition by src) as of_src, links / sum(links) over (partition by dst) as of_dst
    from c),
r0 as materialized (
    select host, sum((verdict = 'allow')::int) * 0.15::double as trust, sum((verdict = 'block')::int) * 0.15::double as distrust
    from v where verdict is not null and host <> '' group by host){rounds}
select page_id, v.host, path, rule,
       coalesce(verdict, case when distrust > 2.0 * trust then 'block' else 'allow' end) as verdict
from v left join r{urls.ROUNDS} r on v.host = r.host"""


ORACLE["op6_urls"] = _url_sql()


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints and the groups that they link."""
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text, learned from the others."""
    docs = table(spark, folder, "documents")
    marked = docs.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "text")
    return language.identify(marked, language.train(docs), ["doc_id", "held_out"])


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.schedule(table(spark, folder, "documents")).drop("source")


ORACLE["op9_mixing"] = r"""
with d as (
    select doc_id, source, md5('mix:' || doc_id) as hash,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
    from documents),
s as (select source, sum(size)::bigint as total from d group by source),
w as (select *, 3 * total as cap, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from s),
l as (
    select *, row_number() over fill as turn,
           (sum(total) over ()::double - (sum(cap) over (fill rows unbounded preceding) - cap)::double)
           / (sum(weight) over (fill rows between current row and unbounded following))::double as level
    from w window fill as (order by cap::double / weight, source nulls last)),
t as (
    select source, total, cap, weight,
           (select arg_min(level, turn) from l where level * weight <= cap) as level
    from l),
q as (
    select doc_id, d.source, size, total, coalesce(least(cap::double, level * weight), cap::double) as target,
           (sum(size) over (partition by d.source order by hash, doc_id rows unbounded preceding) - size)::bigint as before
    from d join t on d.source is not distinct from t.source),
c as (
    select doc_id, size, epoch * total + before as start,
           sum(size) over (order by (epoch * total + before + size)::double / target, coalesce('=' || source, 'null'),
                           epoch * total + before rows unbounded preceding) - size as sent
    from q, range(3) e(epoch) where size > 0 and target > 0),
k as (
    select doc_id, sum(greatest(0, least(size, (select sum(size) from d) - sent)))::bigint as taken from c group by doc_id)
select q.doc_id, size, total as source_size, target, coalesce(taken, 0)::bigint as taken
from q left join k on q.doc_id = k.doc_id"""


@query
def op10_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """What the token files have of each document."""
    files = scratch(spark, "token-files")
    tokenfile.write_tokens(table(spark, folder, "documents"), files)
    return tokenfile.digest(spark, files)


@query
def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """How much of every document its fingerprint finds again in its edited text and in the next document."""
    return fingerprints.compare_with_next(table(spark, folder, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The hard negatives of every anchor's positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").select(
        "vec_id", label.alias("label"), negatives.integers("embedding", 256).alias("vector")
    )
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLE["op12_hard_negatives"] = """
with e as materialized (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as vector
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (
    select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
           list_inner_product(a.vector, c.vector)::bigint as score
    from e a join e c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id),
p as (
    select anchor_id, vec_id as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5"""


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """The words of all documents and the words that they are variants of."""
    return variants.spelling_variants(table(spark, folder, "documents"))
