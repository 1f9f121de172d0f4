"""URL filters: rules first, and for the rest trust and distrust that spread over links between hosts.

Hosts with pages that rules allow are trusted seeds, hosts with pages that rules block are distrusted ones, each by
the number of such pages. Trust follows links (personalised PageRank), distrust goes against them: who links to blocked
hosts is suspect. A host whose distrust exceeds `RATIO` times its trust is blocked, any other is allowed.

Links are added up per pair of hosts before anything is shuffled by host, so a host with a third of all pages is a few
rows; every round is written to the shared folder, and the one before the last goes. Rounds end when no host is newly
reached and none has more than `TOLERANCE` of its trust or distrust from the last round.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.session import scratch

DAMPING = 0.85
#: Rounds of `spread` if it is not told to go on until nothing changes, as `judge` does.
ROUNDS = 10
TOLERANCE = 1e-6
RATIO = 2.0
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Fits urls of `host` and its subdomains whose path starts with `path`. A list has tens of rules, not thousands."""

    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; empty for null and for urls without."""
    return lowered(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as (length, rule, verdict), or null."""
    found = []
    for r in rules:
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = r.host + r.path
        found.append(F.when(fits, F.struct(F.lit(len(name)).alias("length"), F.lit(name).alias("rule"), F.lit(r.verdict).alias("verdict"))))
    return F.array_max(F.array_compact(F.array(*found)))


def host_links(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """Links from one host to another (`src`, `dst`, `links`); links within a host vouch for nothing."""
    absolute = F.col("link").contains("://")
    relative = F.col("link").startswith("//")
    target = F.when(absolute, host_of(F.col("link"))).when(relative, host_of(F.concat(F.lit("http:"), F.col("link"))))
    links = pages.select(
        host_of(F.col(url)).alias("src"),
        F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1))).alias("link"),
    )
    return (
        links.where(absolute | relative)
        .select("src", target.alias("dst"))
        .where("src != dst and src != '' and dst != ''")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("links"))
    )


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(
    links: DataFrame, seeds: DataFrame, rounds: int | None = ROUNDS, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """Hosts with `trust` and `distrust`, from seeds (`host`, `trusted`, `distrusted`).

    After `rounds` rounds, or with None when they have converged: what a round adds is never less than nothing and falls by
    `damping` at least, and a host that is reached for the first time has all of its rank from that round.
    """
    spark = links.sparkSession
    folder = scratch(spark, "host-links")
    links.write.parquet(f"{folder}/links")
    links = spark.read.parquet(f"{folder}/links")
    sent = links.groupBy("src").agg(F.sum("links").alias("sent"))
    got = links.groupBy("dst").agg(F.sum("links").alias("got"))
    links.join(sent, "src").join(got, "dst").select(
        "src", "dst", (F.col("links") / F.col("sent")).alias("of_src"), (F.col("links") / F.col("got")).alias("of_dst")
    ).write.parquet(f"{folder}/edges")
    edges = spark.read.parquet(f"{folder}/edges")
    base = seeds.select(
        "host",
        (F.col("trusted") * F.lit(1 - damping)).alias("trust"),
        (F.col("distrusted") * F.lit(1 - damping)).alias("distrust"),
    )
    base.write.parquet(f"{folder}/round-0")
    base = ranks = spark.read.parquet(f"{folder}/round-0")
    if edges.isEmpty():
        return ranks
    none, number = F.lit(0.0), 0
    while rounds is None or number < rounds:
        number += 1
        last = ranks.select("host", none.alias("trust"), none.alias("distrust"), F.col("trust").alias("trusted"), F.col("distrust").alias("distrusted"))
        forth = edges.join(ranks, edges["src"] == ranks["host"]).select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("of_src") * F.lit(damping)).alias("trust"), none.alias("distrust")
        )
        back = edges.join(ranks, edges["dst"] == ranks["host"]).select(
            F.col("src").alias("host"), none.alias("trust"), (F.col("distrust") * F.col("of_dst") * F.lit(damping)).alias("distrust")
        )
        base.union(forth).union(back).unionByName(last, allowMissingColumns=True).groupBy("host").agg(
            F.sum("trust").alias("trust"),
            F.sum("distrust").alias("distrust"),
            F.coalesce(F.sum("trusted"), none).alias("trusted"),
            F.coalesce(F.sum("distrusted"), none).alias("distrusted"),
        ).write.parquet(f"{folder}/round-{number}")
        if number > 1:
            _drop(spark, f"{folder}/round-{number - 1}")
        ranks = spark.read.parquet(f"{folder}/round-{number}")
        moved = [F.col(c) - F.col(c + "ed") > F.lit(tolerance) * F.col(c) for c in ("trust", "distrust")]
        if rounds is None and ranks.where(moved[0] | moved[1]).isEmpty():
            break
    return ranks.select("host", "trust", "distrust")


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, ratio: float = RATIO, *, url: str = "url", html: str = "html"
) -> DataFrame:
    """All columns of `pages` with a struct `__url`: host, path, rule and verdict of each.

    Null urls and those without `://` have an empty host and path, which no rule fits and no link reaches: they
    are allowed. Null or empty html has no links. Repeated pages count as often as they come. An empty table
    stays empty. Only the names beginning with `__url` are taken.
    """
    spark = pages.sparkSession
    host, path = host_of(F.col(url)), path_of(F.col(url))
    judged = pages.withColumn("__url_host", host).withColumn("__url_path", path).withColumn(
        "__url_rule", longest_rule(F.col("__url_host"), F.col("__url_path"), rules)
    )
    verdict = F.col("__url_rule.verdict")
    seeds = judged.where("__url_rule is not null and __url_host != ''").groupBy(F.col("__url_host").alias("host")).agg(
        F.sum((verdict == "allow").cast("double")).alias("trusted"),
        F.sum((verdict == "block").cast("double")).alias("distrusted"),
    )
    folder = scratch(spark, "host-verdicts")
    spread(host_links(pages, url=url, html=html), seeds, rounds=None).select(
        F.col("host").alias("__url_of"), (F.col("distrust") > F.lit(ratio) * F.col("trust")).alias("__url_blocked")
    ).write.parquet(folder)
    hosts = spark.read.parquet(folder)
    by_host = F.when(F.coalesce("__url_blocked", F.lit(False)), "block").otherwise("allow")
    return judged.join(hosts, F.col("__url_host") == F.col("__url_of"), "left").select(
        *[F.col(f"`{c}`") for c in pages.columns],
        F.struct(
            F.col("__url_host").alias("host"),
            F.col("__url_path").alias("path"),
            F.col("__url_rule.rule").alias("rule"),
            F.coalesce(verdict, by_host).alias("verdict"),
        ).alias("__url"),
    )
