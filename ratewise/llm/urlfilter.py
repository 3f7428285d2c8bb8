"""URL filters by rules and by trust that flows along links between hosts; DataFrame functions only.

A page that a rule fits gets the rule's verdict. The others get their host's: trust starts at hosts with more
allowed than blocked pages and follows links (personalised PageRank); distrust starts at hosts of which
at least half the pages are blocked and follows links backwards, since who links to a bad host is suspect. A host is blocked where its distrust
exceeds its trust by more than a threshold. Edges are summed by (host, host) before any shuffle, so a host
with a third of the pages costs one row per target and task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The host of an absolute or protocol-relative link in a tag.
LINK_HOST = r"""(?i)\b(?:href|src|action)\s{0,8}=\s{0,8}["']?\s{0,8}(?:[a-z][a-z0-9+.\-]{0,15}:)?//([^/?#"'\s<>\\]+)"""

#: Scores have settled when none changes by more than this part of itself in STEPS rounds and no host is new.
#: More rounds than MOST_ROUNDS raise.
TOLERANCE, STEPS, MOST_ROUNDS = 1e-6, 3, 2000


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the url's path starts with `path`."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (null without one). Of rules with equal text, the first."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(str(r))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, F.lit(str(rule))).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame, host_col: str = "host", html_col: str = "html") -> DataFrame:
    """src, dst, weight: links from pages of one host to another host."""
    links = pages.filter(F.col(host_col) != "").select(F.col(host_col).alias("src"), F.explode(F.regexp_extract_all(html_col, F.lit(LINK_HOST), F.lit(1))).alias("raw"))
    bare = F.regexp_replace(F.regexp_replace(lower_ascii(F.col("raw")), r"^.*@", ""), r":[0-9]*$", "")
    return links.select("src", bare.alias("dst")).filter((F.col("dst") != "") & (F.col("dst") != F.col("src"))).groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def settled(before: DataFrame, after: DataFrame) -> bool:
    """Whether both have the same hosts, with about the same scores."""
    was = before.select(F.col("kind").alias("w_kind"), F.col("host").alias("w_host"), F.col("score").alias("was"))
    both = after.join(was, (F.col("kind") == F.col("w_kind")) & (F.col("host") == F.col("w_host")), "left")
    return not both.filter(F.col("was").isNull() | (F.abs(F.col("score") - F.col("was")) > TOLERANCE * F.col("score"))).limit(1).count()


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = None) -> DataFrame:
    """Trust and distrust of every host that is a seed or linked: host, trust, distrust.

    `seeds`: host, trust, distrust (any positive weights). Each round is one join and one sum; every third
    state is written to the shared folder, which cuts lineage. Goes on until the scores have settled, or for
    `rounds`. What hosts without links forward would pass on
    is lost, which scales all scores of a kind alike.
    """
    forward = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "weight")
    backward = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "weight")
    flows = forward.unionByName(backward)
    out = flows.groupBy("kind", "a").agg(F.sum("weight").alias("total"))
    shares = stage(flows.join(out, ["kind", "a"]).select("kind", "a", "b", (F.col("weight") / F.col("total")).alias("share")), "url-shares")
    start = stage(
        seeds.select("host", F.explode(F.map_from_arrays(F.array(F.lit("trust"), F.lit("distrust")), F.array("trust", "distrust"))).alias("kind", "w")).filter("w > 0"),
        "url-seeds",
    )
    sums = start.groupBy("kind").agg(F.sum("w").alias("all"))
    start = start.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("w") / F.col("all")).alias("seed"))
    state = start.select("kind", "host", F.col("seed").alias("score"))
    last = state
    for k in range(MOST_ROUNDS if rounds is None else rounds):
        sent = state.join(shares, (shares["kind"] == state["kind"]) & (shares["a"] == state["host"])).select(state["kind"], F.col("b").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"))
        back = start.select("kind", "host", ((1 - damping) * F.col("seed")).alias("score"))
        state = back.unionByName(sent).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if k % STEPS == STEPS - 1 or k + 1 == rounds:
            state = stage(state, "url-round")
            if rounds is None:
                if settled(last, state):
                    break
                last = state
    else:
        if rounds is None:
            raise RuntimeError("trust did not settle")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
    return state.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = 0.0, rounds: int | None = None) -> DataFrame:
    """Host, path, rule, verdict, trust and distrust of every page.

    Null urls and urls without ``://`` have an empty host, fit no rule and are allowed; null html has no
    links. Every row of a repeated page is judged alike; an empty table gives no rows.
    """
    host, path = url_parts(F.col(url_col))
    known = pages.select(F.col(id_col).alias("page_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), F.col(html_col).alias("html"))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = known.select("page_id", "host", "path", name.alias("rule"), verdict.alias("said"))
    count = lambda v: F.sum(F.when(F.col("said") == v, 1.0).otherwise(0.0))
    hosts = ruled.filter("host != ''").groupBy("host").agg(count("allow").alias("allowed"), count("block").alias("blocked"), F.count("*").alias("n"))
    seeds = hosts.select("host", F.when(F.col("allowed") > F.col("blocked"), F.col("allowed")).otherwise(0.0).alias("trust"), F.when((2 * F.col("blocked") >= F.col("n")) & (F.col("blocked") > F.col("allowed")), F.col("blocked")).otherwise(0.0).alias("distrust"))
    scores = stage(propagate(stage(host_edges(known), "url-edges"), seeds, rounds=rounds), "url-scores")
    bad = scores.select(F.col("host").alias("s_host"), "trust", "distrust")
    found = ruled.join(bad, ruled["host"] == bad["s_host"], "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    own = F.when(distrust > trust + threshold, F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", F.coalesce("said", own).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
