"""URL filter: rules by host and path, and trust and distrust spread over links between hosts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.tables import if_small, store

DAMPING = 0.85
TOLERANCE = 1e-6
THRESHOLD = 0.5
HOST_ROW_BYTES = 128
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*([a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>\\]+)"""


@dataclass(frozen=True)
class Rule:
    """Allows or blocks a host with its subdomains, below the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: str) -> Column:
    """From behind the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: str) -> Column:
    """From behind the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits as a struct of its text and verdict, else null; of rules equally
    long one that blocks."""
    choices = []
    for r in sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        choices.append(F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))))
    return F.coalesce(*choices)


def host_links(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(source, target, n): links between different hosts; relative links stay on their host."""
    targets = F.expr(f"regexp_extract_all({html}, '{_escaped(_LINK)}', 2)")
    return (
        pages.where(f"{html} like '%//%'")
        .select(F.col(host).alias("source"), F.explode(targets).alias("target"))
        .select("source", _lower(F.col("target")).alias("target"))
        .where("source != target and source != ''")
        .groupBy("source", "target")
        .agg(F.count("*").alias("n"))
    )


def _escaped(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def spread(
    seeds: DataFrame, links: DataFrame, damping: float, tolerance: float, averaged: tuple[str, ...] = ()
) -> DataFrame:
    """(kind, host, score): personalised PageRank for several kinds of seeds at once.

    ``seeds`` (kind, host, mass), ``links`` (kind, from, to, share): shares of one (kind, from) sum to
    1, or those of one (kind, to) to 1 at most if the kind is ``averaged``. A score is (1 - damping) times
    the mass that reaches a host, so seeds need not sum to 1. Stops once a round moves, of each kind, less
    than ``tolerance`` of the seeds' mass in all, or of an averaged kind less than ``tolerance`` of one seed
    at any host. Both shrink by ``damping`` a round, so that point is always reached.
    """
    if not 0 <= damping < 1 or tolerance <= 0:
        raise ValueError("damping must be in [0, 1) and tolerance above 0")
    seeds = store(seeds)
    links = store(links)
    own = seeds.select("kind", "host", ((1 - damping) * F.col("mass")).alias("score"))
    mass = {r["kind"]: r["mass"] or 0.0 for r in seeds.groupBy("kind").agg(F.sum("mass").alias("mass")).collect()}
    scores = store(own)
    settled = links.isEmpty()
    while not settled:
        passed = links.join(scores.withColumnRenamed("host", "from"), ["kind", "from"]).select(
            "kind", F.col("to").alias("host"), (damping * F.col("score") * F.col("share")).alias("score")
        )
        added = own.unionByName(passed).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        following = store(added)
        change = F.abs(F.coalesce("now", F.lit(0.0)) - F.coalesce("score", F.lit(0.0)))
        moved = (
            following.withColumnRenamed("score", "now")
            .join(scores, ["kind", "host"], "full")
            .groupBy("kind")
            .agg(F.sum(change).alias("all"), F.max(change).alias("most"))
            .collect()
        )
        scores = following
        settled = all(
            r["most"] <= tolerance * (1 - damping) if r["kind"] in averaged else r["all"] <= tolerance * mass.get(r["kind"], 0.0)
            for r in moved
        )
    return scores


def judge_hosts(pages: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust, exposure) from judged pages (host, html, ruled: allow, block or null).

    A host is a seed of trust by the share of its pages that rules allow and of distrust by the share
    that rules block. Trust follows links, distrust goes against them, from a blocked
    host to those that link to it; both are shared out by numbers of links. Both are given in units of a
    seed's own part, so a host all of whose pages are allowed has trust 1 at least.

    Distrust is divided among all linkers of a blocked host and so gets thinner with each. Exposure does
    not: it is the chance, 1 at most, that who starts on a page of the host, and from pages not blocked
    follows its links to other hosts with probability ``damping``, comes to a blocked page.
    """
    of_host = pages.where("host != ''").groupBy("host").agg(
        F.avg(F.when(F.col("ruled") == "allow", 1.0).otherwise(0.0)).alias("allowed"),
        F.avg(F.when(F.col("ruled") == "block", 1.0).otherwise(0.0)).alias("blocked"),
    )
    of_host = store(of_host)
    links = store(host_links(pages))
    out = links.groupBy("source").agg(F.sum("n").alias("all"))
    back = links.groupBy("target").agg(F.sum("n").alias("all"))
    share = (F.col("n") / F.col("all")).alias("share")
    onward = out.join(of_host.select(F.col("host").alias("source"), "blocked"), "source")
    all_links = links.join(out, "source").select(
        F.lit("trust").alias("kind"), F.col("source").alias("from"), F.col("target").alias("to"), share
    ).unionByName(
        links.join(back, "target").select(
            F.lit("distrust").alias("kind"), F.col("target").alias("from"), F.col("source").alias("to"), share
        )
    ).unionByName(
        links.join(onward, "source").select(
            F.lit("exposure").alias("kind"),
            F.col("target").alias("from"),
            F.col("source").alias("to"),
            ((1 - F.col("blocked")) * F.col("n") / F.col("all")).alias("share"),
        )
    )
    masses = {"trust": "allowed", "distrust": "blocked", "exposure": "blocked"}
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(m).alias("mass")) for k, m in masses.items()])
    seeds = of_host.select("host", F.explode(kinds).alias("s")).select("s.kind", "host", "s.mass")
    scores = spread(seeds, all_links, damping, tolerance, averaged=("exposure",))

    def of(kind: str) -> Column:
        value = F.sum(F.when(F.col("kind") == kind, F.col("score")))
        return (F.coalesce(value, F.lit(0.0)) / (1 - damping)).alias(kind)

    return scores.groupBy("host").agg(*map(of, masses))


def filter_urls(pages: DataFrame, rules: list[Rule], threshold: float = THRESHOLD) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust`` and ``exposure``.

    The longest fitting rule decides. A page that no rule fits is blocked if its host's distrust or exposure
    is ``threshold`` or more and above its trust, and allowed otherwise, as is a page without a host. A null
    url has empty host and path. Input columns named like the added ones are replaced.
    """
    added = ("host", "path", "rule", "verdict", "trust", "distrust", "exposure")
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in added]).alias("row")
    ruled = best_rule(rules, F.col("host"), F.col("path"))
    parts = pages.select(
        row, F.col("html").alias("html"), url_host("url").alias("host"), url_path("url").alias("path")
    ).withColumn("best", ruled)
    hosts = store(judge_hosts(parts.select("host", "html", F.col("best.verdict").alias("ruled"))))
    hosts = hosts.where("trust != 0 or distrust != 0")
    judged = parts.join(if_small(hosts, HOST_ROW_BYTES), "host", "left")
    trust, distrust, exposure = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust", "exposure"))
    against = F.greatest(distrust, exposure)
    by_graph = F.when((against >= threshold) & (against > trust), "block").otherwise("allow")
    return judged.select(
        "row.*",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", by_graph).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
        exposure.alias("exposure"),
    )
