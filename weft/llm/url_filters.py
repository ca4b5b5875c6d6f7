"""URL filters: rules by host and path, and trust that spreads over the link graph.

Rules decide the urls they fit. They also give the seeds: a host's share of all
urls that rules allow is its trusted seed, its share of those they block its
blocked seed. Trust follows links from the trusted seeds, distrust goes against
links from the blocked ones, both as personalised PageRank over host edges:
``r = (1 - damping) * seed + damping * (shares of the neighbours' r)``. A host whose
distrust exceeds ``ratio`` times its trust is blocked; urls that no rule fits take
their host's verdict, allow where neither reaches it.

Scale: html is read once, for edges, which are summed by (source, target) before
the shuffle, so a hot host is at most one row for each of its neighbours and task.
Iterations move host rows only. The last join is on urls without html; Spark can
split a hot host's rows there, as hosts are unique on the other side. Each
iteration's ranks are written to the shared folder, so lineage stays short.

Defined results: a null url, or one without "://", has empty host and path, no
rule, and the verdict of the empty host: allow, for it is never a seed. Repeated
rows give repeated results; an empty table gives an empty one. Null html has no links.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, table, written


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: Safety limit: at damping 0.85 about 130 rounds bring the ranks within 1e-9.
MOST_ROUNDS = 1000
#: The contract's rules: fixed values.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r)):  # the last one set wins
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts, subdomains of one domain among them.

    Links without a host go to that of the page's ``base``, else stay on their own host and are none;
    links of other schemes (``mailto:``), and those within a page, are none.
    """
    page = F.coalesce(F.col(html), F.lit(""))
    value = r"""\s*=\s*["']?\s*([^"'\s>]*)"""
    links = F.regexp_extract_all(page, F.lit(rf"(?is)<a\s[^>]*?href{value}"), 1)
    absolute = lambda c: host_of(F.regexp_replace(c, "^//", "x://"))
    base = absolute(F.regexp_extract(page, rf"(?is)<base\s[^>]*?href{value}", 1))
    own = host_of(F.col(url))
    home = F.when(base != "", base).otherwise(own)
    # links that stay at home are dropped before rows are made of them
    away = F.filter(links, lambda x: x.rlike("^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//") | ((home != own) & ~x.rlike("^(?:#|[A-Za-z][A-Za-z0-9+.-]*:)") & (x != "")))
    linked = pages.select(own.alias("src"), home.alias("home"), F.explode(away).alias("to"))
    linked = linked.select("src", F.when(F.col("to").contains("//") & F.col("to").rlike("^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"), absolute(F.col("to"))).otherwise(F.col("home")).alias("dst"))
    return linked.filter("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(
    seeds: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int | None = None, tolerance: float = 1e-9
) -> DataFrame:
    """(host, trust, distrust) from (host, trusted, blocked) and (src, dst, n).

    Rank that reaches a host without links onward ends there. Stops when a round
    changes the ranks by less than ``tolerance`` in all, or after ``rounds`` where
    given. Without, ``MOST_ROUNDS`` that do not reach the tolerance are an error.
    """
    out = edges.groupBy("src").agg(F.sum("n").alias("out"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("into"))
    shares = written(
        edges.join(out, "src").join(into, "dst").select("src", "dst", (F.col("n") / F.col("out")).alias("ahead"), (F.col("n") / F.col("into")).alias("back"))
    )
    linked = shares.select(F.col("src").alias("host")).union(shares.select(F.col("dst").alias("host"))).distinct()
    base = written(seeds.join(linked, "host", "full").select("host", F.coalesce("trusted", F.lit(0.0)).alias("trusted"), F.coalesce("blocked", F.lit(0.0)).alias("blocked")))
    ranks = base.select("host", F.col("trusted").alias("trust"), F.col("blocked").alias("distrust"))
    if shares.isEmpty():
        return ranks.select("host", (F.col("trust") * (1 - damping)).alias("trust"), (F.col("distrust") * (1 - damping)).alias("distrust"))
    for k in range(MOST_ROUNDS if rounds is None else rounds):
        ahead = shares.join(ranks, F.col("src") == F.col("host")).select(F.col("dst").alias("host"), (F.col("ahead") * F.col("trust")).alias("t"), F.lit(0.0).alias("b"))
        back = shares.join(ranks, F.col("dst") == F.col("host")).select(F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("back") * F.col("distrust")).alias("b"))
        got = ahead.union(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
        step = lambda seed, x: F.col(seed) * (1 - damping) + damping * F.coalesce(x, F.lit(0.0))
        new = base.join(got, "host", "left").select("host", step("trusted", F.col("t")).alias("trust"), step("blocked", F.col("b")).alias("distrust"))
        new = written(new)
        moved = new.alias("a").join(ranks.alias("b"), "host").agg(F.sum(F.abs(F.col("a.trust") - F.col("b.trust")) + F.abs(F.col("a.distrust") - F.col("b.distrust")))).first()[0]
        if k:
            dropped(ranks)  # a round reads the last one's ranks alone
        ranks = new
        if (moved or 0.0) < tolerance:
            break
    else:
        if rounds is None:
            raise RuntimeError(f"ranks still move by {moved} after {MOST_ROUNDS} rounds")
    return ranks


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, ratio: float = 4.0, url: str = "url", html: str = "html", damping: float = 0.85
) -> DataFrame:
    """``pages`` without html, with ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust``."""
    own = ("host", "path", "rule", "verdict", "trust", "distrust")
    urls = pages.select(*[c for c in pages.columns if c not in (html, *own)], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    urls = urls.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    counts = urls.filter("host <> ''").groupBy("host").agg(
        F.count_if(F.col("rule.verdict") == "allow").alias("a"), F.count_if(F.col("rule.verdict") == "block").alias("b")
    )
    total = counts.agg(F.sum("a"), F.sum("b")).first()
    seeds = counts.select("host", (F.col("a") / F.lit(float(total[0] or 1))).alias("trusted"), (F.col("b") / F.lit(float(total[1] or 1))).alias("blocked"))
    ranks = propagate(seeds, host_edges(pages, url, html), damping)
    # rounded, so that the order in which shares were summed decides nothing
    ranks = ranks.select("host", F.round("trust", 12).alias("trust"), F.round("distrust", 12).alias("distrust"))
    spread = F.when(F.col("distrust") > ratio * F.col("trust"), "block").otherwise("allow")
    out = urls.join(ranks, "host", "left").withColumn("verdict", F.coalesce("rule.verdict", spread)).withColumn("rule", F.col("rule.rule"))
    return out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")})


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


QUERIES = {"op9_url_filters": op9_url_filters}


def _rule_sql(column: str) -> str:
    """The longest rule's text or verdict."""
    best = sorted(RULES, key=lambda r: (len(r.host + r.path), r), reverse=True)
    return "CASE " + " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.host + r.path if column == 'rule' else r.verdict}'" for r in best) + " END"


#: Holds where no page links to another host, as in the driver's tables: ranks are then the seeds' (1 - damping).
#: Where one does, the SQL has no rows; ``propagate`` itself is held against matrices in the tests.
ORACLE = f"""WITH u AS (SELECT page_id, CASE WHEN coalesce(url, '') LIKE '%://%' THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
CASE WHEN coalesce(url, '') LIKE '%://%' THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path, html FROM pages),
l AS (SELECT count(*) AS n FROM u WHERE regexp_matches(coalesce(html, ''), '(?is)<a\\s[^>]*?href\\s*=\\s*["'']?\\s*([a-z][a-z0-9+.-]*:)?//') OR regexp_matches(coalesce(html, ''), '(?is)<base\\s')),
r AS (SELECT *, {_rule_sql("rule")} AS rule, {_rule_sql("verdict")} AS own FROM u), h AS (SELECT host, count(*) FILTER (own = 'allow') AS a, count(*) FILTER (own = 'block') AS b FROM r WHERE host <> '' GROUP BY host), s AS (SELECT greatest(sum(a), 1) AS a, greatest(sum(b), 1) AS b FROM h),
k AS (SELECT host, round(h.a / s.a * (1 - 0.85), 12) AS trust, round(h.b / s.b * (1 - 0.85), 12) AS distrust FROM h, s)
SELECT page_id, r.host, path, rule, coalesce(own, CASE WHEN distrust > 4 * trust THEN 'block' ELSE 'allow' END) AS verdict, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust FROM r LEFT JOIN k ON r.host = k.host, l WHERE l.n = 0"""

ORACLE_SQL = {"op9_url_filters": ORACLE}
