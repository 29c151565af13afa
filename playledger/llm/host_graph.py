"""URL verdicts: rules by host and path, and trust propagated over the graph of hosts.

DataFrame functions only: no Python runs on the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import Steps, written

DAMPING = 0.85
CUT_EVERY = 8
TOLERANCE = 1e-5
WORSE = 1.5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LINK = r"(?i)(?:href|src)\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s<>]+)"


@dataclass(frozen=True)
class Rule:
    """`host` and its subdomains, for paths that start with `path`; verdict is allow or block."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; path: then up to
    `?`, `#` or the end. Both are empty for null and for a url without `://`."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null; a list of rules, not a table of them."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name, r.verdict)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        fits = fits & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) between different hosts: links with a host of their own in `html`, counted, and each host
    with the domain above it, both ways. Pre-aggregated, so a host's many pages weigh as rows only before that."""
    links = pages.filter("host != ''").select(
        F.col("host").alias("src"),
        F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1)))).alias("dst"),
    )
    links = links.withColumn("dst", F.translate("dst", _UPPER, _UPPER.lower())).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    hosts = pages.filter("host != ''").select("host").distinct()
    above = hosts.select("host", F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1).alias("up")).filter("up != ''")
    up = above.select(F.col("host").alias("src"), F.col("up").alias("dst"), F.lit(1).cast("long").alias("n"))
    down = above.select(F.col("up").alias("src"), F.col("host").alias("dst"), F.lit(1).cast("long").alias("n"))
    return links.unionByName(up).unionByName(down).filter("src != dst").groupBy("src", "dst").agg(F.sum("n").alias("n"))


def _shares(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Arcs (source -> target) with the share of the source's weight."""
    total = edges.groupBy(F.col(source).alias("of")).agg(F.sum("n").alias("total"))
    return edges.join(total, F.col(source) == F.col("of")).select(
        F.col(source).alias("from_host"), F.col(target).alias("to_host"), (F.col("n") / F.col("total")).alias("share")
    )


def spread(arcs: DataFrame, seeds: DataFrame, rounds: int | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank (host, rank) from `seeds(host, seed)`, seeds summing to 1, along `arcs`.

    Mass that reaches a host without arcs goes no further. Without `rounds`, until no host's rank changes by more than
    `tolerance` of itself over CUT_EVERY rounds, however small it is; so a host that is reached late is waited for. A
    round shrinks the change by DAMPING at least, so this ends. One number per CUT_EVERY rounds reaches the driver, and
    only the last two tables of ranks are kept.
    """
    steps = Steps(arcs.sparkSession)
    home = seeds.select("host", (F.col("seed") * (1 - DAMPING)).alias("rank"))
    ranks = last = seeds.select("host", F.col("seed").alias("rank"))
    turn = 0
    while rounds is None or turn < rounds:
        moved = arcs.join(ranks, F.col("from_host") == F.col("host")).select(
            F.col("to_host").alias("host"), (F.col("rank") * F.col("share") * DAMPING).alias("rank")
        )
        ranks = moved.unionByName(home).groupBy("host").agg(F.sum("rank").alias("rank"))
        turn += 1
        if turn % CUT_EVERY == 0:
            ranks = steps.put(ranks)
            if rounds is None and _change(ranks, last) <= tolerance:
                break
            steps.drop(last)
            last = ranks
    return ranks


def _change(ranks: DataFrame, last: DataFrame) -> float:
    """The largest change of a host's rank as a share of it."""
    both = ranks.select("host", "rank", F.col("rank").alias("change")).unionByName(
        last.select("host", F.lit(0.0).alias("rank"), (-F.col("rank")).alias("change"))
    )
    by_host = both.groupBy("host").agg(F.sum("rank").alias("rank"), F.abs(F.sum("change")).alias("change"))
    return by_host.agg(F.max(F.when(F.col("change") > 0, F.col("change") / F.greatest("rank", F.lit(1e-300))))).first()[0] or 0.0


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row of `pages(page_id, url, html)`.

    A page takes the verdict of the longest rule that fits. Other pages take their host's: trust
    starts at hosts by their number of pages under allow rules and follows links; distrust
    starts under block rules and goes against links, to those who link there. A host is blocked
    if its distrust is over WORSE times its trust; without evidence it is allowed, and so is a
    page without a host. Nulls in any column are kept; repeated rows get a row each.
    """
    host, path = host_and_path(F.col("url"))
    named = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    seen = named.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("of_rule"))
    counts = written(
        seen.filter("host != ''").groupBy("host").agg(F.count_if(F.col("of_rule") == "allow").alias("good"), F.count_if(F.col("of_rule") == "block").alias("bad"))
    )
    edges = written(host_edges(named))
    sums = counts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()

    # trust and distrust walk together, as two parts of one graph that are not connected
    def seeds(mark: str, column: str, total: int | None) -> DataFrame:
        rows = counts.filter(F.col(column) > 0)
        return rows.select(F.concat(F.lit(mark), "host").alias("host"), (F.col(column) / F.lit(float(total or 1))).alias("seed"))

    def arcs(mark: str, source: str, target: str) -> DataFrame:
        ends = [F.concat(F.lit(mark), name).alias(name) for name in ("from_host", "to_host")]
        return _shares(edges, source, target).select(*ends, "share")

    both = written(arcs("+", "src", "dst").unionByName(arcs("-", "dst", "src")))
    ranks = spread(both, written(seeds("+", "good", sums.good).unionByName(seeds("-", "bad", sums.bad))))
    trust = ranks.filter(F.col("host").startswith("+")).select(F.substr("host", F.lit(2)).alias("of_host"), F.col("rank").alias("trust"))
    against = ranks.filter(F.col("host").startswith("-")).select(F.substr("host", F.lit(2)).alias("by_host"), F.col("rank").alias("distrust"))
    hosts = counts.join(trust, F.col("host") == F.col("of_host"), "left").join(against, F.col("host") == F.col("by_host"), "left")
    hosts = hosts.select(
        F.col("host").alias("judged"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    )
    own = F.when(F.col("distrust") > WORSE * F.col("trust"), "block").otherwise("allow")
    return seen.join(hosts, F.col("host") == F.col("judged"), "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("of_rule", own).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
