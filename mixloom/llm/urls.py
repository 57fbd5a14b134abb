"""URL filter: rules first, then trust and distrust that spread over the links between hosts.

Trust is a personalised PageRank from the hosts of pages that a rule allows; distrust is the same over the reversed
links, from the hosts of pages that a rule blocks, so it reaches whoever links to them. A host with more distrust than
trust, or than ``ratio`` times it, is blocked. Links to one's own host count for nothing, a host that reaches no seed is allowed.

Rounds go on until less than ``RESIDUE`` of a kind's mass moves in one. What reaches a host without links of that kind goes back to the
seeds: that multiplies all ranks of a kind by one factor, so it is done once, at the end, by dividing them by their sum.

Ranks are whole numbers (``MASS`` in all) and every share is rounded down on its own edge, so sums do not depend on
their order and reruns agree. A null URL, or one without ``://``, has an empty host and path, to which no rule
fits. Null HTML links to nothing. Repeated pages are judged each, and each counts for its host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.llm.base import stored

MASS = 10**15
DAMPING = 0.85
#: The rounds end when ranks change by less than this part of the mass in one.
RESIDUE = 1e-6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?:href|src)\s*=\s*["']?(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, name: str) -> Rule:
    """A rule such as ``("block", "example.org/en/1")``."""
    host, slash, path = name.partition("/")
    return Rule(verdict, host, slash + path)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def longest_rule(rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits ``host`` and ``path``. The rules are configuration, so few."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        host = (F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")
        fits = host & F.col("path").startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def judged_by_rules(pages: DataFrame, rules: list[Rule], keep: list[str]) -> DataFrame:
    parsed = pages.select(*keep, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, verdict = longest_rule(rules)
    return parsed.select("*", name.alias("rule"), verdict.alias("_by_rule"))


def linked_hosts(html: Column) -> Column:
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINK), 1)
    return F.transform(found, lambda host: F.translate(host, UPPER, LOWER))


def host_edges(linked: DataFrame) -> DataFrame:
    """``src, dst, weight``: pages (``host, _links``) of one host times their links to another."""
    links = linked.select(F.col("host").alias("src"), F.explode("_links").alias("dst"))
    return links.where("src <> dst and src <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def _both_ways(edges: DataFrame) -> DataFrame:
    """Each edge once for trust and, reversed, for distrust, with its part of all that leaves its source."""
    ways = F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src"), F.col("dst")),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")),
    )
    ways = edges.select("weight", F.inline(ways))
    out = ways.groupBy("kind", "src").agg(F.sum("weight").alias("_all"))
    share = F.col("weight").cast("double") / F.col("_all")
    return ways.join(out, ["kind", "src"]).select("kind", "src", "dst", share.alias("share"))


def _seeds(judged: DataFrame) -> DataFrame:
    kind = F.when(F.col("_by_rule") == "allow", "trust").when(F.col("_by_rule") == "block", "distrust")
    pages = judged.select(kind.alias("kind"), "host").where("kind is not null")
    hosts = pages.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("n"))
    all_pages = hosts.groupBy("kind").agg(F.sum("n").alias("_all"))
    mass = F.floor(F.lit(float(MASS)) * (F.col("n").cast("double") / F.col("_all")))
    return hosts.join(all_pages, "kind").select("kind", "host", mass.alias("seed"))


def propagate(edges: DataFrame, seeds: DataFrame, iterations: int | None = None, residue: float = RESIDUE) -> DataFrame:
    """``kind, host, rank``; ranks of a kind are parts of ``MASS``.

    Each round is written to the shared folder: ranks are summed per host where they arise before they are shuffled, and with them
    how far they moved. ``iterations`` ends the rounds earlier.
    """
    ways = stored(_both_ways(edges), "edges")
    base = stored(seeds.select("kind", "host", "seed"), "seeds")
    none = F.lit(0).cast("long")
    own = base.select("kind", "host", F.floor(F.col("seed") * F.lit(1 - DAMPING)).alias("rank"), none.alias("was"))
    ranks, rounds = base.select("kind", "host", F.col("seed").alias("rank")), 0
    while iterations is None or rounds < iterations:
        sent = ways.join(ranks.select("kind", F.col("host").alias("src"), "rank"), ["kind", "src"])
        parts = sent.select("kind", F.col("dst").alias("host"), F.floor(F.col("rank") * F.col("share")).alias("part"))
        moved = parts.groupBy("kind", "host").agg(F.sum("part").alias("part"))
        moved = moved.select("kind", "host", F.floor(F.col("part") * F.lit(DAMPING)).alias("rank"), none.alias("was"))
        before = ranks.select("kind", "host", none.alias("rank"), F.col("rank").alias("was"))
        summed = own.unionByName(moved).unionByName(before).groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("was").alias("was"))
        ranks, rounds = stored(summed, "ranks"), rounds + 1
        far = ranks.groupBy("kind").agg(F.sum(F.abs(F.col("rank") - F.col("was"))).alias("far")).agg(F.max("far")).first()[0]
        if far is None or far <= residue * MASS:
            break
    totals = ranks.groupBy("kind").agg(F.sum("rank").alias("_all"))
    part = F.floor(F.col("rank").cast("double") * (F.lit(float(MASS)) / F.col("_all").cast("double")))
    return ranks.where("rank > 0").join(totals, "kind").select("kind", "host", part.alias("rank"))


def filter_urls(pages: DataFrame, rules: list[Rule], iterations: int | None = None, ratio: float = 1.0) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every page (``page_id, url, html``).

    The pages are read once; of each, host, path, rule and linked hosts are kept.
    """
    html = pages.withColumn("_links", linked_hosts(F.col("html")))
    judged = stored(judged_by_rules(html, rules, ["page_id", "_links"]), "judged")
    ranks = propagate(host_edges(judged), _seeds(judged), iterations)

    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0))

    hosts = ranks.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
    ranked = judged.join(hosts.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left")
    spread = F.when(F.col("distrust") > F.col("trust") * F.lit(ratio), "block").otherwise("allow")
    return ranked.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("_by_rule", spread).alias("verdict"),
        F.coalesce("trust", F.lit(0).cast("long")).alias("trust"),
        F.coalesce("distrust", F.lit(0).cast("long")).alias("distrust"),
    )
