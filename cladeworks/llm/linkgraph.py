"""URL verdicts: rules first, then trust and distrust spread over the host graph.

Links in the pages' html make weighted edges between hosts, counted per pair before
anything is shuffled by host. A host's seed is the share of its pages that an allow
(or block) rule fits, over one page more than it has. Trust follows links forward:
x = s + damping * P^T x with P the shares of a host's outgoing links (personalised
PageRank up to the factor 1 - damping). Distrust follows them backward, from blocked
hosts to those that link to them, by the shares of incoming links. Next to each the
same sum runs with every host as a whole seed, and what a host is judged by is the
quotient: the share of all that spreads to it which comes from seeds (or the host's own
seed, if that is larger). The quotient doesn't depend on the size of the graph or on how
many hosts share a neighbour. A host is blocked when its distrust is over ``threshold`` and
over its trust.

The sums are iterated, a table a round in the shared folder, until a round adds at most
``tolerance`` of all that has spread; no host's or edge's share is dropped for being small.

Defined results: a null url or one without ``://`` has empty host and path and,
fitting no rule and linked with nothing, is allowed; null html has no links; links of a
host to itself don't count; repeated rows count as pages of their own; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, small, table, written

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host(url: Column) -> Column:
    return F.coalesce(lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (null: none) and its verdict. ``rules`` is a short list that goes into the plan."""
    rule = verdict = None
    for action, text in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(action)) if verdict is None else verdict.when(fits, F.lit(action))
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if rule is None else (rule, verdict)


def edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: how many links the pages of one host have to another."""
    links = pages.select(host(F.col("url")).alias("src"), F.explode(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lower))).alias("dst"))
    return links.where((F.col("dst") != F.col("src")) & (F.col("src") != "")).groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(seeds: DataFrame, links: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """kind, host, y, z: the sums of what spreads from ``seeds`` (kind, host, y: from seeds, z: the baseline) along ``links`` (kind, host, to, w)."""
    seeds = written(seeds, "link-seeds", keep=True)
    at, before = seeds, seeds.agg(F.sum("z")).first()[0] or 0.0
    while before:
        with scratch(seeds.sparkSession):
            moved = at.join(links, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("y") * F.col("w") * damping).alias("y"), (F.col("z") * F.col("w") * damping).alias("z"))
            at = written(seeds.union(moved).groupBy("kind", "host").agg(F.sum("y").alias("y"), F.sum("z").alias("z")), "link-sums", keep=True)
        # P keeps or lowers mass, so what rounds add shrinks by the damping at least
        now = at.agg(F.sum("z")).first()[0]
        if now - before <= tolerance * now:
            break
        before = now
    return at


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, damping: float = 0.85, threshold: float = 0.5, tolerance: float = 1e-6) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every page."""
    named = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, verdict = fitting(F.col("host"), F.col("path"), rules)
    named = named.withColumn("rule", rule).withColumn("_verdict", verdict)
    counts = named.groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("_verdict") == "allow").alias("allow"), F.count_if(F.col("_verdict") == "block").alias("block"))
    shares = counts.where(F.col("host") != "").select("host", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), (F.col(k) / (F.col("n") + 1)).alias("y")) for k in ("allow", "block")))).alias("_s"))
    own = written(shares.select("_s.kind", "host", "_s.y").where(F.col("y") > 0), "link-own")
    graph = written(edges(pages), "link-edges")
    if graph.isEmpty():
        sums = own.select("kind", "host", "y", F.lit(1.0).alias("z"))
    else:
        forward = graph.join(graph.groupBy("src").agg(F.sum("n").alias("_all")), "src").select(F.lit("allow").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), (F.col("n") / F.col("_all")).alias("w"))
        backward = graph.join(graph.groupBy("dst").agg(F.sum("n").alias("_all")), "dst").select(F.lit("block").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), (F.col("n") / F.col("_all")).alias("w"))
        links = written(forward.union(backward), "link-weights")
        everyone = graph.select(F.explode(F.array("src", "dst")).alias("host")).union(own.select("host")).distinct()
        everyone = everyone.select(F.explode(F.array(F.lit("allow"), F.lit("block"))).alias("kind"), "host")
        sums = spread(everyone.join(own, ["kind", "host"], "left").select("kind", "host", F.coalesce("y", F.lit(0.0)).alias("y"), F.lit(1.0).alias("z")), links, damping, tolerance)
    parts = sums.join(own.withColumnRenamed("y", "own"), ["kind", "host"], "left").withColumn("own", F.coalesce("own", F.lit(0.0)))
    reached = F.when(F.col("z") > 1.0, (F.col("y") - F.col("own")) / (F.col("z") - 1.0)).otherwise(0.0)
    of = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.greatest("own", reached))), F.lit(0.0))
    hosts = written(parts.groupBy("host").agg(of("allow").alias("trust"), of("block").alias("distrust")), "link-hosts")
    rows = named.join(small(hosts), "host", "left").fillna(0.0, ["trust", "distrust"])
    spread_verdict = F.when((F.col("distrust") > threshold) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("_verdict", spread_verdict).alias("verdict"), "trust", "distrust")


def op1_link_graph(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))
