"""URL verdicts from rules and from trust that spreads over links between hosts.

Rules decide the urls they fit.  The others are judged by their host: trust starts at
hosts with allowed pages and follows links (personalised PageRank), distrust starts at
hosts with blocked pages and follows links backwards (who links to bad hosts is bad).
Both start at a host with the share of its pages that rules allow or block, so scores
do not depend on the size of the corpus.  A host is blocked when its distrust is more than
``margin`` times its trust; a host that neither reaches is allowed.

Edges are weighted by the number of links and summed before anything is joined; links of a
host to itself say nothing and are left out.  Null urls and urls without ``://`` have an
empty host and path, fit no rule and are allowed; null html has no links; repeated rows
count as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinary.sources.scratch import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINKS = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host, then the start of a path, as in ``example.org/en/``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    longest_first = sorted(rules, key=lambda rule: (-len(rule.pattern), rule.pattern))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(longest_first):
        in_host = (host == rule.host) | host.endswith(f".{rule.host}")
        hit = F.struct(F.lit(rule.pattern).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(in_host & path.startswith(rule.path), hit).otherwise(found)
    return found


def host_edges(pages: DataFrame, source: str = "host") -> DataFrame:
    """(src, dst, links): links between different hosts, counted."""
    target = F.explode(F.regexp_extract_all(F.col("html"), F.lit(_LINKS), F.lit(1))).alias("target")
    # without user and port
    bare = F.regexp_replace(F.regexp_replace(lower_ascii(F.col("target")), "^.*@", ""), r":\d*$", "")
    links = pages.select(F.col(source).alias("src"), target).select("src", bare.alias("dst"))
    return links.filter("src != '' and dst != '' and src != dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def spread(seeds: DataFrame, edges: DataFrame, follow: float, steps: int | None, tolerance: float) -> DataFrame:
    """(host, trust, distrust) after ``steps`` rounds, or as many as it takes until no score moves by ``tolerance``.

    ``seeds``: (host, trust_seed, distrust_seed).  Every few rounds the scores are written and
    compared with the ones before, which also cuts the lineage.  A round shrinks the sum of all changes to
    ``follow`` of it, so the scores settle on cycles, too.
    """
    if not 0 <= follow < 1 or (steps is None and tolerance <= 0):
        raise ValueError("scores settle with follow below 1 and a tolerance above 0 only")
    out = edges.groupBy("src").agg(F.sum("links").alias("all_out"))
    into = edges.groupBy("dst").agg(F.sum("links").alias("all_in"))
    weighted = edges.join(out, "src").join(into, "dst")
    weighted = weighted.select("src", "dst", (F.col("links") / F.col("all_out")).alias("down"), (F.col("links") / F.col("all_in")).alias("up"))
    weighted = materialize(weighted, "host-edges")
    known = seeds.select("host").union(weighted.select("src")).union(weighted.select("dst")).distinct()
    start = known.join(seeds, "host", "left").select(
        "host", F.coalesce("trust_seed", F.lit(0.0)).alias("trust_seed"), F.coalesce("distrust_seed", F.lit(0.0)).alias("distrust_seed")
    )
    start = materialize(start, "host-seeds")
    keep = 1 - follow
    scores = start.select("host", (keep * F.col("trust_seed")).alias("trust"), (keep * F.col("distrust_seed")).alias("distrust"))
    if weighted.isEmpty():
        return scores
    together = 4
    before = scores
    for step in count() if steps is None else range(steps):
        sent = weighted.join(scores.select(F.col("host").alias("src"), "trust"), "src").select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("down")).alias("trust"), F.lit(0.0).alias("distrust")
        )
        blamed = weighted.join(scores.select(F.col("host").alias("dst"), "distrust"), "dst").select(
            F.col("src").alias("host"), F.lit(0.0).alias("trust"), (F.col("distrust") * F.col("up")).alias("distrust")
        )
        got = sent.union(blamed).groupBy("host").agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d"))
        scores = start.join(got, "host", "left").select(
            "host",
            (keep * F.col("trust_seed") + follow * F.coalesce("t", F.lit(0.0))).alias("trust"),
            (keep * F.col("distrust_seed") + follow * F.coalesce("d", F.lit(0.0))).alias("distrust"),
        )
        if step % together == together - 1 or (steps is not None and step == steps - 1):
            scores = materialize(scores, "host-scores")
            moved = F.abs(F.col("trust") - F.col("t")) + F.abs(F.col("distrust") - F.col("d"))
            change = scores.join(before.toDF("host", "t", "d"), "host").agg(F.max(moved)).first()[0]
            if change is None or change < tolerance:
                break
            before = scores
    return scores


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    follow: float = 0.85,
    steps: int | None = None,
    tolerance: float = 1e-6,
    margin: float = 2.0,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page."""
    parsed = pages.select(
        F.col("page_id"), F.col("html"), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    ruled = parsed.withColumn("hit", fitting_rule(F.col("host"), F.col("path"), rules))

    def share(verdict: str) -> Column:
        return F.avg(F.when(F.col("hit.verdict") == verdict, 1.0).otherwise(0.0))

    seeds = ruled.filter("host != ''").groupBy("host").agg(share("allow").alias("trust_seed"), share("block").alias("distrust_seed"))
    scores = spread(seeds, materialize(host_edges(parsed), "host-links"), follow, steps, tolerance)
    named = scores.select(F.col("host").alias("of"), "trust", "distrust")
    judged = ruled.drop("html").join(named, F.col("host") == F.col("of"), "left").withColumns(
        {"trust": F.coalesce("trust", F.lit(0.0)), "distrust": F.coalesce("distrust", F.lit(0.0))}
    )
    by_host = F.when(F.col("distrust") > margin * F.col("trust"), F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.coalesce("hit.verdict", by_host)
    return judged.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"), "trust", "distrust")
