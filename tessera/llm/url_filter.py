"""URL filter: rules on host and path, and trust that spreads over links.

Rules decide the urls they fit.  Every other url takes the verdict of its
host, which comes from the host graph: personalised PageRank carries trust
from hosts with allowed urls along links, and distrust from hosts with blocked
urls against them (a host that links to bad hosts is suspect).  Native.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, small_side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: An absolute or protocol-relative link in an html attribute named href itself.
LINK = "(?i)[\\s\"'/]href\\s*=\\s*[\"']?\\s*((?:https?:)?//[^\"'\\s<>]+)"
#: Comments and scripts: what stands there is no link.
UNSEEN = "(?is)<!--.*?-->|<script\\b.*?</script\\s*>"
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url: the host is what follows the first ``://`` up
    to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path goes on up to
    ``?``, ``#`` or the end.  Both are empty for null and without ``://``."""
    host, path = (F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit("")) for k in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as ``struct<rule, verdict>``; null if none.
    The rules are a list that the caller writes, tried longest first."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for action, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("verdict"))).otherwise(best)
    return best


def host_edges(pages: DataFrame, host: Column, html_col: str) -> DataFrame:
    """``src, dst, n``: pages of host ``src`` that link to host ``dst``."""
    seen = F.regexp_replace(F.col(html_col), UNSEEN, " ")
    links = pages.select(host.alias("src"), F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all(seen, F.lit(LINK), F.lit(1)),
        lambda u: F.translate(F.regexp_extract(u, "//([^/?#]*)", 1), UPPER, LOWER)))).alias("dst"))
    return (links.where("src <> '' and dst <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def spread(seeds: DataFrame, edges: DataFrame, damping: float = 0.7, rounds: int | None = None,
           tolerance: float = 1e-4) -> DataFrame:
    """``host, trust, distrust`` of all hosts in ``seeds`` (``host, trust0,
    distrust0``, unique hosts) or ``edges``.

    ``x = (1 - damping) * seed + damping * inflow`` until no host is further
    than ``tolerance`` from the fixpoint, or for ``rounds`` rounds if given.
    What all hosts change by shrinks by ``damping`` a round, so the sum of the
    changes bounds what any host can still gather.
    Trust flows from source to target in proportion to the link counts,
    distrust the other way.  Each round is one join and one pre-aggregated sum.
    """
    own = seeds.select("host", (F.col("trust0") * (1 - damping)).alias("trust"),
                       (F.col("distrust0") * (1 - damping)).alias("distrust"))
    if edges.isEmpty():  # nothing flows: the seeds' own mass is the fixpoint
        return own
    out = edges.groupBy("src").agg(F.sum("n").alias("out_n"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("in_n"))
    good = edges.join(out, "src").select(F.col("src").alias("a"), F.col("dst").alias("b"),
                                         (F.col("n") / F.col("out_n")).alias("t"), F.lit(0.0).alias("d"))
    bad = edges.join(into, "dst").select(F.col("dst").alias("a"), F.col("src").alias("b"),
                                         F.lit(0.0).alias("t"), (F.col("n") / F.col("in_n")).alias("d"))
    flow = materialize(good.unionByName(bad), "url_flow")
    hosts = materialize(
        seeds.select("host", "trust0", "distrust0")
        .unionByName(flow.select(F.col("b").alias("host"), F.lit(0.0).alias("trust0"), F.lit(0.0).alias("distrust0")))
        .groupBy("host").agg(F.max("trust0").alias("trust0"), F.max("distrust0").alias("distrust0")), "url_hosts")
    state = hosts.select("host", (F.col("trust0") * (1 - damping)).alias("trust"),
                         (F.col("distrust0") * (1 - damping)).alias("distrust"))
    k, left = 0, float("inf")
    while left > tolerance if rounds is None else k < rounds:
        inflow = (flow.join(state, flow["a"] == state["host"])
                  .groupBy("b").agg(F.sum(F.col("t") * F.col("trust")).alias("ti"),
                                    F.sum(F.col("d") * F.col("distrust")).alias("di")))
        new = materialize(
            hosts.join(inflow, F.col("host") == F.col("b"), "left")
            .select("host", (F.col("trust0") * (1 - damping) + F.coalesce(F.col("ti"), F.lit(0.0)) * damping).alias("trust"),
                    (F.col("distrust0") * (1 - damping) + F.coalesce(F.col("di"), F.lit(0.0)) * damping).alias("distrust")),
            f"url_round{k}")
        if rounds is None:
            old = state.select("host", F.col("trust").alias("t0"), F.col("distrust").alias("d0"))
            moved = new.join(old, "host").agg(F.sum(F.abs(F.col("trust") - F.col("t0"))), F.sum(F.abs(F.col("distrust") - F.col("d0")))).first()
            left = max(x or 0.0 for x in moved) * damping / (1 - damping)
        state, k = new, k + 1
    return state


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html", damping: float = 0.7, rounds: int | None = None,
               threshold: float = 0.15) -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict, trust, distrust``.

    ``rule`` is the longest rule that fits (null if none) and decides the
    verdict; other urls are blocked if their host's distrust exceeds its trust
    by more than ``threshold`` (the default is what a host without links has
    when rules block half of its pages).  A host's seeds are the shares of its
    pages that rules allow and block.  Null urls, and urls without a host, are
    allowed: nothing speaks against them.  Null html has no links.  Repeated
    rows are judged alike (and count as pages); an empty table gives an empty
    result.  Two scans of the urls, one of the html; only hosts are shuffled.
    """
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    seeds = (urls.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(F.col("r.verdict") == "allow", 1.0).otherwise(0.0)).alias("trust0"),
        F.avg(F.when(F.col("r.verdict") == "block", 1.0).otherwise(0.0)).alias("distrust0")))
    edges = materialize(host_edges(pages, host, html_col), "url_edges")
    scores = materialize(spread(seeds, edges, damping, rounds, threshold / 1000).withColumnRenamed("host", "h"), "url_scores")
    judged = urls.join(small_side(scores), F.col("host") == F.col("h"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    return judged.select(
        F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.verdict"), F.when(distrust - trust > threshold, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"))
