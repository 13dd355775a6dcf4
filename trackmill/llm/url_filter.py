"""URL filters: rules by host and path, and link-graph propagation for the rest.

Rules decide the pages they fit.  For all other pages the host decides: trust starts at hosts
whose pages the rules allow and follows the links between hosts; distrust starts at hosts
whose pages they block and runs against the links, to those that point there.  Both are
personalised PageRank over host edges, kept as DataFrames: one join with the edges and one
sum per step, both combining map-side.

A rank is divided among all that a host passes it to, so the figure itself says little of a
host whose neighbours have many others.  What links bring a host is therefore set against
what they would bring it if every host were a seed.  A host is blocked when that share of its
distrust, or the share of its own pages that the rules block, reaches ``LEAST_SHARE`` and
exceeds the same of its trust.  A fixed threshold on the rank itself can be named instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import ascii_lower
from trackmill.session import durable

FOLLOWED = 0.85
STEPS = 20
CHECKPOINT_EVERY = 5
LEAST_SHARE = 0.5
# For a fixed threshold, in parts of what a wholly blocked host starts with.
LEAST_DISTRUST = 0.5

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s<>]+)"""


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


# The rules, as the filter's contract names them.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def url_host(url: Column) -> Column:
    """Host of a URL in lower case; empty for an absent URL or one without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The longest rule that fits, as a struct ``rule``, ``verdict``; null if none does."""
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        own = (host == rule.host) | host.endswith("." + rule.host)
        told = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        fitting = F.when(own & path.startswith(rule.path), told).otherwise(fitting)
    return fitting


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """Links between different hosts: ``src``, ``dst`` and the number ``n`` of pages of ``src``
    that link there.  Relative links stay within their host and are no edges."""
    links = F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINK), 1))
    targets = pages.where(F.col(host) != "").select(F.col(host).alias("src"), F.explode(links).alias("link"))
    target = url_host(F.concat(F.lit("http:"), F.regexp_replace("link", r"(?i)^https?:", "")))
    found = targets.select("src", target.alias("dst")).where("dst <> '' AND dst <> src")
    return found.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, steps: int = STEPS, followed: float = FOLLOWED) -> DataFrame:
    """Personalised PageRank ``host``, ``rank`` from ``seeds`` (``host``, ``start``) along weighted
    ``edges``; what a host without links would pass on is lost."""
    shares = durable(
        edges.join(edges.groupBy("src").agg(F.sum("n").alias("_all")), "src")
        .select("src", "dst", (F.col("n") / F.col("_all")).alias("share"))
    )
    own = seeds.select("host", (F.col("start") * (1 - followed)).alias("own"))
    ranks = own.select("host", F.col("own").alias("rank"))
    for step in range(steps):
        passed = ranks.join(shares, ranks["host"] == shares["src"]).select(
            F.col("dst").alias("host"), (F.col("rank") * F.col("share") * followed).alias("part")
        )
        ranks = (
            passed.union(own.select("host", F.col("own").alias("part")))
            .groupBy("host").agg(F.sum("part").alias("rank"))
        )
        if (step + 1) % CHECKPOINT_EVERY == 0:
            ranks = durable(ranks)
        if not step and not shares.head(1):
            break  # without links nothing moves
    return ranks


def received_share(
    edges: DataFrame, seeds: DataFrame, ranks: DataFrame, steps: int = STEPS, followed: float = FOLLOWED
) -> DataFrame:
    """``host``, ``share``: of what links would bring a host if every host were a seed, the part
    that the ``seeds`` bring it by their ``ranks``; or the host's own start if that is more.
    Hosts that neither links nor seeds reach are left out."""
    every = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct()
    whole = propagate(edges, every.withColumn("start", F.lit(1.0)), steps, followed).withColumnRenamed("rank", "whole")
    own = seeds.select("host", F.col("start").alias("own"))
    found = ranks.select("host", "rank").join(own, "host", "left").join(whole, "host", "left")
    start = F.coalesce("own", F.lit(0.0))
    brought, most = F.col("rank") - start * (1 - followed), F.col("whole") - (1 - followed)
    return found.select("host", F.greatest(start, F.when(most > 0, brought / most).otherwise(0.0)).alias("share"))


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    rules: Sequence[Rule] = RULES, steps: int = STEPS, followed: float = FOLLOWED,
    least_share: float = LEAST_SHARE, least_distrust: float | None = None,
) -> DataFrame:
    """One row per input row: ``id``, ``host``, ``path``, ``rule``, ``verdict``, and the host's
    ``trust`` and ``distrust``: shares between 0 and 1 (``received_share``), or ranks if
    ``least_distrust`` names a fixed threshold for them.

    Absent URLs and URLs without ``://`` have an empty host and path, fit no rule and are
    allowed; absent pages have no links; repeated pages count as pages of their host again.
    """
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    named = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    ruled = named.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    counts = (
        ruled.where("host <> ''").groupBy("host").agg(
            F.count("*").alias("n"),
            F.sum(F.when(F.col("fit.verdict") == "allow", 1).otherwise(0)).alias("allowed"),
            F.sum(F.when(F.col("fit.verdict") == "block", 1).otherwise(0)).alias("blocked"),
        )
    )
    counts = durable(counts)
    edges = durable(host_edges(named))
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")

    def seeds(column: str) -> DataFrame:
        return counts.where(F.col(column) > 0).select("host", (F.col(column) / F.col("n")).alias("start"))

    def told(along: DataFrame, column: str, name: str) -> DataFrame:
        ranks = propagate(along, seeds(column), steps, followed)
        if least_distrust is not None:
            return ranks.withColumnRenamed("rank", name)
        return received_share(along, seeds(column), ranks, steps, followed).withColumnRenamed("share", name)

    trust, distrust = told(edges, "allowed", "trust"), told(against, "blocked", "distrust")
    # Written, so that the join with it can be split where one host has very many pages.
    hosts = durable(counts.select("host").join(trust, "host", "left").join(distrust, "host", "left").select(
        "host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    ))
    least = least_share if least_distrust is None else least_distrust * (1 - followed)
    bad = (F.col("distrust") >= least) & (F.col("distrust") > F.col("trust"))
    judged = ruled.select("id", "host", "path", "fit").join(hosts, "host", "left")
    return judged.select(
        "id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
