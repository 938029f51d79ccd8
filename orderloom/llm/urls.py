"""URL filters: rules on host and path, and trust and distrust that flow over links between hosts.

Trust starts at trusted hosts and flows along links (personalised PageRank); distrust starts at blocked hosts and flows
against links, to the hosts that point to them. Everything is DataFrame functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shipping import stored

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """``verdict`` is allow or block; ``host`` stands for itself and all subdomains, ``path`` for what begins with it."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to a slash, question mark, number sign or the end, with A-Z
    lower-cased; empty if there is no ``://`` or no url."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), *LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, number sign or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...], field: str = "name") -> Column:
    """The name (or verdict) of the longest rule that fits; null if none does. Of equally long ones the first."""
    found = None
    for r in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.lit(getattr(r, field))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("string") if found is None else found


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """``src``, ``dst``, ``n``: links from one host to another, counted in the map tasks first.

    Absolute and scheme-relative http links of ``a``, ``area`` and ``link`` tags; a relative one stays on its host.
    """
    target = r"(?is)<(?:a|area|link)\s[^>]*?href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"
    found = pages.where(F.col(html).contains("//")).select(
        F.col(host).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(target), 1)).alias("dst")
    )
    return (
        found.withColumn("dst", F.translate("dst", *LOWER))
        .where("src <> dst and src <> ''")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


#: Walks along links and against them: from seeds, and from all hosts alike.
KINDS = ("trust", "pagerank", "distrust", "reverse")


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-4) -> DataFrame:
    """``host``, ``trust``, ``distrust``, ``trust_share`` and ``distrust_share`` of every host with a link or a seed.

    ``seeds`` has ``host``, ``kind`` (trust or distrust) and ``weight`` up to 1. In a round each host passes ``damping`` of what it
    received last on, trust over its links in proportion to their number, distrust over the links that come in; a seed starts with
    1 - ``damping`` times its weight. ``trust`` and ``distrust`` are sums over all rounds: personalised PageRank from the trusted seeds, and from
    the distrusted ones over reversed links. A seed of full weight takes nothing in: what it is is known.

    What a host has is divided among its partners, so amounts shrink as partners grow. The shares don't: they compare what a host received with what
    it would have received had every host started alike (plain PageRank over the same links). A host all of whose links go
    to distrusted seeds has a ``distrust_share`` of 1, whether it is one of two such hosts or of a million.

    After k rounds at most ``damping`` ** k of what the seeds started with is on its way, so rounds end when that is below
    ``tolerance``, earlier if links run out. State and edges are written to the shared folder, so lineage stays short. Sums
    are taken in the map tasks first, and the join on a host with very many links may be split by Spark.
    """
    certain = seeds.where("weight >= 1").select("host", "kind").distinct()

    def flow(kinds: tuple[str, str], seed: str, host: str, to: str) -> DataFrame:
        known = certain.where(F.col("kind") == seed).select(F.col("host").alias(to))
        total = edges.groupBy(host).agg(F.sum("n").alias("total"))
        shares = edges.join(total, host).join(known, to, "left_anti")
        return shares.select(
            F.explode(F.array(*map(F.lit, kinds))).alias("kind"), F.col(host).alias("host"), F.col(to).alias("to"), (F.col("n") / F.col("total")).alias("share")
        )

    flows = stored(
        flow(("trust", "pagerank"), "trust", "src", "dst").unionByName(flow(("distrust", "reverse"), "distrust", "dst", "src")), "flows"
    )
    hosts = edges.select(F.explode(F.array("src", "dst")).alias("host")).union(seeds.select("host")).distinct()
    alike = hosts.select(F.explode(F.array(F.lit("pagerank"), F.lit("reverse"))).alias("kind"), "host", F.lit(1.0).alias("weight"))
    start = seeds.select("kind", "host", "weight").unionByName(alike).groupBy("kind", "host")
    moving = stored(start.agg((F.sum("weight") * (1 - damping)).alias("amount")), "moving")
    parts = [moving.withColumn("own", F.lit(True))]
    started = _by_kind(moving)
    for k in range(0 if flows.isEmpty() else math.ceil(math.log(tolerance) / math.log(damping))):
        moving = stored(
            moving.join(flows, ["kind", "host"])
            .groupBy("kind", F.col("to").alias("host"))
            .agg((F.sum(F.col("amount") * F.col("share")) * damping).alias("amount")),
            f"moving-{k}",
        )
        parts.append(moving.withColumn("own", F.lit(False)))
        if len(parts) == 8:  # keep the union short
            parts = [stored(_summed(parts), "total")]
        left = _by_kind(moving)
        if all(left.get(kind, 0.0) <= tolerance * began for kind, began in started.items()):
            break
    total = {kind: F.sum(F.when(F.col("kind") == kind, F.col("amount")).otherwise(0.0)) for kind in KINDS}
    received = {kind: F.sum(F.when((F.col("kind") == kind) & ~F.col("own"), F.col("amount")).otherwise(0.0)) for kind in KINDS}
    sums = _summed(parts).groupBy("host").agg(
        *(amount.alias(kind) for kind, amount in total.items()), *(amount.alias(f"got_{kind}") for kind, amount in received.items())
    )
    share = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
    return sums.select(
        "host",
        "trust",
        "distrust",
        share("got_trust", "got_pagerank").alias("trust_share"),
        share("got_distrust", "got_reverse").alias("distrust_share"),
    )


def _by_kind(moving: DataFrame) -> dict[str, float]:
    return {r["kind"]: r["amount"] for r in moving.groupBy("kind").agg(F.sum("amount").alias("amount")).collect()}


def _summed(parts: list[DataFrame]) -> DataFrame:
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("kind", "host", "own").agg(F.sum("amount").alias("amount"))


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...],
    trusted: tuple[str, ...] = (),
    blocked: tuple[str, ...] = (),
    block_at: float = 0.5,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    **flow,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``trust``, ``distrust`` and ``verdict`` (allow or block) of every page.

    A rule decides where one fits. Elsewhere the host decides: a distrusted seed is blocked and a trusted one of full weight is not; of the others those are
    blocked whose ``distrust_share`` (see ``propagate``) is at least ``block_at`` and more than their ``trust_share``: at least half of
    the distrust that could have come to them over their links has come. One step further back shares fall below half, so a host that
    merely links to such a host is allowed. Seeds are ``trusted`` and ``blocked`` hosts with their subdomains (weight 1); hosts
    that a rule for all paths covers (weight 1); and hosts with pages that a rule for some paths allows, with the share of such pages. A rule
    that blocks some paths says nothing about the rest of a host.

    Null urls and urls without ``://`` have an empty host, which has no links and no seeds: they are allowed unless a
    rule fits. Null html has no links. Repeated pages count each time as links and are judged each time.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    slim = pages.select(
        F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html).alias("html")
    )
    place = F.col("host"), F.col("path")
    judged = slim.select(
        "page_id", *place, rule_of(*place, rules).alias("rule"), rule_of(*place, rules, "verdict").alias("said")
    )
    by_host = (
        judged.where("host <> ''")
        .groupBy("host")
        .agg(F.avg(F.when(F.col("said") == "allow", 1.0).otherwise(0.0)).alias("allowed"))
    )
    fits = lambda names: _any_of([(F.col("host") == h) | F.col("host").endswith("." + h) for h in names])
    whole = {v: [r.host for r in rules if r.verdict == v and r.path in ("", "/")] for v in ("allow", "block")}
    good = F.when(fits([*trusted, *whole["allow"]]), 1.0).otherwise(F.col("allowed"))
    bad = F.when(fits([*blocked, *whole["block"]]), 1.0).otherwise(0.0)
    edges = stored(host_edges(slim), "edges")
    known = by_host.select("host", "allowed").unionByName(
        edges.select(F.explode(F.array("src", "dst")).alias("host"), F.lit(0.0).alias("allowed"))
    ).groupBy("host").agg(F.max("allowed").alias("allowed"))
    seeds = known.select(
        "host",
        F.explode(
            F.array(
                F.struct(F.lit("trust").alias("kind"), good.alias("weight")),
                F.struct(F.lit("distrust").alias("kind"), bad.alias("weight")),
            )
        ).alias("s"),
    ).select("host", "s.kind", "s.weight")
    seeds = stored(seeds.where("weight > 0"), "seeds")
    scores = propagate(edges, seeds, **flow).join(
        seeds.groupBy("host").agg(
            F.max(F.col("kind") == "distrust").alias("bad"), F.max((F.col("kind") == "trust") & (F.col("weight") >= 1)).alias("good")
        ),
        "host",
        "left",
    )
    by_share = (F.col("distrust_share") >= block_at) & (F.col("distrust_share") > F.col("trust_share"))
    by_score = F.when(F.col("bad"), True).when(F.col("good"), False).otherwise(by_share)
    return judged.join(scores, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        F.coalesce("said", F.when(by_score, "block").otherwise("allow")).alias("verdict"),
    )


def _any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
