"""URL filtering with trust and distrust propagated over the host link graph.

Method: explicit rules judge what they fit, the longest rule winning.  The hosts of judged pages are
seeds, weighted by the share of their pages that a rule allows or blocks.  Over the host graph (one edge per
pair of hosts, weighted by links), personalised PageRank carries trust along links from trusted
seeds and, on the reversed links, distrust from blocked seeds: a host that links to
blocked hosts is suspect.  A page that no rule fits is blocked where its host's distrust exceeds
``threshold`` of trust plus distrust.  DataFrame expressions only.

The state is one row per host.  Rounds are few and fixed, each cut off with a checkpoint in the
shared folder.  Links are reduced to host pairs before any join, map-side first, so a hot host
costs one row per neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basket.llm.common import cut

#: (host, path, verdict): a rule fits its host and all subdomains where the url's path starts with its path.
Rule = tuple[str, str, str]

TOLERANCE, DAMPING, THRESHOLD = 1e-6, 0.85, 0.5
BROADCAST_HOSTS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)\bhref\s*=\s*["']?([^"'>\s]*)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, ruled``: the longest fitting rule and its verdict, or nulls.

    Rules are configuration, checked one after the other in each row.  Of equally
    long rules a block wins, then the greater text.
    """
    fits = []
    for host, path, verdict in rules:
        on = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        row = F.struct(
            F.lit(len(host) + len(path)).alias("n"),
            F.lit(int(verdict == "block")).alias("block"),
            F.lit(host + path).alias("rule"),
        )
        fits.append(F.when(on & F.startswith(F.col("path"), F.lit(path)), row))
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    best = F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,block:int,rule:string>")
    found = parsed.withColumn("_best", best)
    ruled = F.when(F.col("_best.block") == 1, "block").when(F.col("_best.block") == 0, "allow")
    return found.select("page_id", "host", "path", F.col("_best.rule").alias("rule"), ruled.alias("ruled"))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, links``: links from pages of one host to another host (relative links stay on their host)."""
    absolute = F.filter(F.regexp_extract_all("html", F.lit(_HREF), 1), lambda x: x.rlike(r"^([A-Za-z][A-Za-z0-9+.\-]*:)?//"))
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(absolute).alias("link"))
    target = host_of(F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link")))
    pairs = links.select("src", target.alias("dst")).filter("src <> dst AND src <> '' AND dst <> ''")
    return pairs.groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(seeds: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """``host, trust, distrust`` of every host in ``seeds`` (host, seed_trust, seed_distrust) or ``edges``.

    Personalised PageRank as the sum of its series: round n adds what arrives over paths of n links, so scores only grow.
    It ends when a round reaches no new host and adds at most ``tolerance`` of all there is; on a graph
    without cycles that is the exact sum, whatever its depth.
    """
    own = 1 - damping
    edges = cut(edges)
    given = seeds.select("host", "seed_trust", "seed_distrust")
    if edges.isEmpty():
        # Without links every round gives the same: the seeds' own share.
        return given.select("host", (F.col("seed_trust") * own).alias("trust"), (F.col("seed_distrust") * own).alias("distrust"))
    sent = edges.groupBy("src").agg(F.sum("links").alias("out_links"))
    got = edges.groupBy("dst").agg(F.sum("links").alias("in_links"))
    flows = cut(
        edges.join(sent, "src")
        .join(got, "dst")
        .select("src", "dst", (F.col("links") / F.col("out_links")).alias("down"), (F.col("links") / F.col("in_links")).alias("up"))
    )
    zero = F.lit(0.0)
    hosts = edges.select(F.explode(F.array("src", "dst")).alias("host")).distinct()
    base = cut(
        hosts.join(given, "host", "full_outer").select(
            "host",
            F.coalesce("seed_trust", zero).alias("seed_trust"),
            F.coalesce("seed_distrust", zero).alias("seed_distrust"),
        )
    )
    rank = base.select("host", (F.col("seed_trust") * own).alias("trust"), (F.col("seed_distrust") * own).alias("distrust"))
    summary = [*[F.sum(c).alias(c) for c in ("trust", "distrust")], *[F.count_if(F.col(c) > 0).alias(f"n_{c}") for c in ("trust", "distrust")]]
    before = rank.agg(*summary).head()
    while True:
        forward = flows.join(rank.select(F.col("host").alias("src"), "trust"), "src").select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("down")).alias("t"), zero.alias("d")
        )
        backward = flows.join(rank.select(F.col("host").alias("dst"), "distrust"), "dst").select(
            F.col("src").alias("host"), zero.alias("t"), (F.col("distrust") * F.col("up")).alias("d")
        )
        arrived = forward.unionByName(backward).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        rank = cut(
            base.join(arrived, "host", "left").select(
                "host",
                (F.col("seed_trust") * own + F.coalesce("t", zero) * damping).alias("trust"),
                (F.col("seed_distrust") * own + F.coalesce("d", zero) * damping).alias("distrust"),
            )
        )
        now = rank.agg(*summary).head()
        reached = any(now[f"n_{c}"] > before[f"n_{c}"] for c in ("trust", "distrust"))
        if not reached and all(now[c] - before[c] <= tolerance * now[c] for c in ("trust", "distrust")):
            return rank
        before = now


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    tolerance: float = TOLERANCE,
    damping: float = DAMPING,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page.

    A null url, or one without ``://``, has an empty host and path, fits no rule and has no
    links; with neither trust nor distrust the verdict is allow.  Null html has no links.  Repeated rows are
    judged each and count each as a page of their host.  An empty table gives no rows.  Other
    columns of ``pages`` are ignored.
    """
    judged = judge(pages, rules)
    share = [F.avg(F.when(F.col("ruled") == v, 1.0).otherwise(0.0)).alias(c) for v, c in (("allow", "seed_trust"), ("block", "seed_distrust"))]
    seeds = judged.filter("host <> ''").groupBy("host").agg(*share)
    scores = cut(propagate(seeds, host_edges(pages), tolerance, damping))
    # Up to that many hosts the pages stay where they are; beyond, adaptive execution splits a hot host's pages.
    if scores.count() <= BROADCAST_HOSTS:
        scores = F.broadcast(scores)
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    suspect = distrust > threshold * (trust + distrust)
    return judged.join(scores, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(suspect, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
