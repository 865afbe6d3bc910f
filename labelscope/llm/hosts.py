"""URL filter: host and path rules, and trust propagated over the graph of links between hosts.

A rule is (``host/path``, verdict). It fits its host and all subdomains when the url's path
starts with the rule's path; the longest fitting rule decides. Pages without a rule get the
verdict of their host. Seeds are hosts of which more than half of the pages have an allow rule
(trusted) or a block rule (blocked). Two random walks with restart run over the links between
hosts that the pages' html holds: trust along the links from trusted seeds, distrust against
them from blocked seeds. A walk goes on until no host's mass still grows by TOLERANCE of itself, so
that hosts far from all seeds, and small masses on large graphs, count in full. A host whose
trust minus distrust is below ``threshold`` by more than TIE of the two is blocked; a host that neither
walk reaches has 0 and is allowed.

A null url, or one without ``://``, has an empty host and path, which no rule fits and which
is no node of the graph; its pages are allowed. A null html has no links. A link that begins with ``//`` takes the scheme of its page. Repeated rows count
as pages of their own and come back as often. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelscope.runtime import stored

DAMPING = 0.85
#: Growth of a host's mass in one round, as a share of that mass, at which a walk ends.
TOLERANCE = 1e-9
#: Trust and distrust that differ by no more than this share of their sum are equal.
TIE = 1e-7
THRESHOLD = 0.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = "(?i)\\b(?:href|src)\\s*=\\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'\\s>]+)"


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as struct<rule, verdict>, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """from, to, links: counts of links between different hosts."""
    return (
        pages.select(host_of(F.col("url")).alias("from"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link"))
        .select("from", host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("any:"), "link")).otherwise(F.col("link"))).alias("to"))
        .where("from <> '' and to <> '' and from <> to")
        .groupBy("from", "to").agg(F.count("*").alias("links"))
    )


def walk(links: DataFrame, seeds: DataFrame, source: str, target: str, damping: float, tolerance: float) -> DataFrame:
    """host, mass: random walk with restart at ``seeds`` (host, weight) along ``source`` -> ``target``.

    Mass is shared over a host's links by their counts; what reaches a host without links is
    given up. Each round moves what the last one added (a join and an aggregate over host edges, never a
    page) and adds it to the mass, until no host gains more than ``tolerance`` of its mass.
    """
    total = seeds.agg(F.sum("weight")).first()[0]
    start = stored(seeds.select("host", (F.col("weight") / F.lit(float(total or 1))).alias("mass")), "seeds")
    if not total or links.isEmpty():
        return start
    out = links.groupBy(source).agg(F.sum("links").alias("_all"))
    steps = stored(
        links.join(out, source).select(F.col(source).alias("host"), F.col(target).alias("_next"), (F.col("links") / F.col("_all")).alias("_part")),
        "steps",
    )
    mass = start.select("host", (F.col("mass") * (1 - damping)).alias("mass"), (F.col("mass") * (1 - damping)).alias("added"))
    while True:
        moved = mass.where("added > 0").join(steps, "host").select(
            F.col("_next").alias("host"), F.lit(0.0).alias("mass"), (F.col("added") * F.col("_part") * damping).alias("added")
        )
        both = mass.select("host", "mass", F.lit(0.0).alias("added")).union(moved).groupBy("host").agg(
            F.sum("mass").alias("mass"), F.sum("added").alias("added")
        )
        mass = stored(both.select("host", (F.col("mass") + F.col("added")).alias("mass"), "added"), "mass")
        if mass.where(F.col("added") > tolerance * F.col("mass")).isEmpty():
            return mass.select("host", "mass")


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]], threshold: float = THRESHOLD,
    damping: float = DAMPING, tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    url = F.col("url")
    ruled = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path")).withColumn(
        "_found", rule_for(F.col("host"), F.col("path"), rules)
    )
    is_verdict = lambda v: F.count_if(F.col("_found.verdict") == v)
    per_host = stored(
        ruled.where("host <> ''").groupBy("host").agg(
            F.count("*").alias("pages"), is_verdict("allow").alias("allowed"), is_verdict("block").alias("blocked")
        ),
        "host-pages",
    )
    seeds = lambda column: per_host.where(2 * F.col(column) > F.col("pages")).select("host", F.col(column).alias("weight"))
    links = stored(host_links(pages), "host-links")
    trust = walk(links, seeds("allowed"), "from", "to", damping, tolerance)
    distrust = walk(links, seeds("blocked"), "to", "from", damping, tolerance)
    score = trust.select("host", "mass", F.col("mass").alias("size")).union(distrust.select("host", -F.col("mass"), "mass"))
    score = score.groupBy("host").agg(F.sum("mass").alias("score"), F.sum("size").alias("size"))
    bad = score.where(F.col("score") < threshold - TIE * F.col("size")).select("host", F.lit("block").alias("_host_verdict"))
    return (
        ruled.join(stored(bad, "blocked-hosts"), "host", "left")
        .select("page_id", "host", "path", F.col("_found.rule").alias("rule"),
                F.coalesce("_found.verdict", "_host_verdict", F.lit("allow")).alias("verdict"))
    )
