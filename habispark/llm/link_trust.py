"""URL filters: explicit rules, and for all other pages trust and distrust spread over the links between hosts.

Trust is a personalised PageRank that starts at hosts with allowed pages and follows links; distrust starts at hosts
with blocked pages and follows links backwards, to those who point there. Hosts and their parent domains
count as weakly linked both ways, but not through a bare suffix. Both ranks are computed together by power iteration over the table of
host edges, in which equal links are counted before anything else, so a host with a large share of all pages is a few
rows. A host whose distrust outweighs its trust is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habispark.llm.tables import lower_ascii, stored

# (verdict, host, start of the path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DAMPING = 0.85
ITERATIONS = 15
# Share of distrust in trust and distrust together from which a host is blocked.
BLOCKED_FROM = 0.5
# What a host and its parent domain count as, against 1 for every link.
PARENT_WEIGHT = 0.1
_STORED_EVERY = 5
_LINK = "(?i)href\\s*=\\s*[\"']?\\s*(?:https?:)?//([^/?#\"'\\s<>]+)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _fits(host: str, path: str) -> Column:
    return ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Adds `rule` and `verdict` of the longest rule that fits, NULL where none does."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))

    def first(value) -> Column:
        return reduce(lambda rest, r: F.when(_fits(r[1], r[2]), F.lit(value(r))).otherwise(rest), reversed(ordered), F.lit(None).cast("string"))

    return pages.withColumns({"rule": first(lambda r: r[1] + r[2]), "verdict": first(lambda r: r[0])})


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target, links: how often pages of one host link to another, and PARENT_WEIGHT each way between a host and
    its parent domain. Links within a host are left out. A suffix without a dot (`com`) is no parent, as unrelated hosts
    would meet in it, and addresses of numbers have none. Longer public suffixes (`co.uk`) cannot be told from domains."""
    linked = pages.filter(F.col("host") != "").select(
        F.col("host").alias("source"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), 1)).alias("target")
    )
    linked = linked.select("source", lower_ascii(F.col("target")).alias("target")).filter("source != target")
    linked = linked.groupBy("source", "target").agg(F.count(F.lit(1)).alias("links"))
    named = pages.select("host").filter(F.col("host") != "").distinct().unionByName(linked.select(F.col("target").alias("host")))
    labels = F.split("host", "\\.")
    # a.b.c: a.b.c with b.c, b.c with c.
    chain = named.distinct().select(
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(labels)),
                lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
            )
        ).alias("child")
    )
    child = chain.filter(F.instr("child", ".") > 0).distinct().select(
        "child", F.substring(F.col("child"), F.instr("child", ".") + 1, F.length("child")).alias("parent")
    ).filter(F.col("parent").rlike("[^.]\\.[^.]") & ~F.col("child").rlike("^[0-9.]+(:[0-9]*)?$"))
    both = child.toDF("source", "target").unionByName(child.select(F.col("parent").alias("source"), F.col("child").alias("target")))
    both = both.withColumn("links", F.lit(PARENT_WEIGHT))
    return linked.withColumn("links", F.col("links").cast("double")).unionByName(both).groupBy("source", "target").agg(F.sum("links").alias("links"))


def spread(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """kind, host, score after ITERATIONS steps.

    `edges` has kind, source, target, links; `seeds` kind, host, weight (adding up to 1 per kind). What
    reaches a host without onward links goes no further.
    """
    degree = edges.groupBy("kind", "source").agg(F.sum("links").alias("degree"))
    part = (DAMPING * F.col("links") / F.col("degree")).alias("part")
    steps = stored(edges.join(degree, ["kind", "source"]).select("kind", "source", "target", part), "host-steps")
    seeds = stored(seeds, "host-seeds")
    start = seeds.select("kind", "host", ((1 - DAMPING) * F.col("weight")).alias("score"))
    scores = seeds.select("kind", F.col("host").alias("source"), F.col("weight").alias("score"))
    for i in range(1, ITERATIONS + 1):
        moved = scores.join(steps, ["kind", "source"]).select(
            "kind", F.col("target").alias("host"), (F.col("score") * F.col("part")).alias("score")
        )
        scores = (
            moved.unionByName(start)
            .groupBy("kind", F.col("host").alias("source"))
            .agg(F.sum("score").alias("score"))
        )
        if i % _STORED_EVERY == 0:
            scores = stored(scores, "host-scores")
    return scores.withColumnRenamed("source", "host")


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row of `pages` (page_id, url, html).

    A NULL url or one without `://` has an empty host and path, fits no rule and is allowed, as is a host that neither
    rank reaches; NULL html has no links. Rows are judged one by one, so repeated rows and NULL identifiers are no
    special case, though every row's links count. Ties between trust and distrust block. An empty table
    gives an empty result; other columns of `pages` may have any name.
    """
    host, path = host_and_path(F.col("url"))
    plain = ruled(pages.select("page_id", host.alias("host"), path.alias("path"), "html"), rules)
    edges = host_edges(plain)
    forward = edges.select(F.lit("allow").alias("kind"), "source", "target", "links")
    backward = edges.select(F.lit("block").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "links")
    counted = plain.filter(F.col("verdict").isNotNull()).groupBy(F.col("verdict").alias("kind"), "host").agg(F.count(F.lit(1)).alias("n"))
    total = counted.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = counted.join(total, "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("weight"))
    scores = (
        spread(forward.unionByName(backward), seeds)
        .groupBy("host")
        .agg(
            F.sum(F.when(F.col("kind") == "allow", F.col("score")).otherwise(0.0)).alias("trust"),
            F.sum(F.when(F.col("kind") == "block", F.col("score")).otherwise(0.0)).alias("distrust"),
        )
    )
    found = plain.drop("html").join(scores, "host", "left").fillna(0.0, ["trust", "distrust"])
    both = F.col("trust") + F.col("distrust")
    blocked = (both > 0) & (F.col("distrust") >= BLOCKED_FROM * both)
    return found.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        "trust",
        "distrust",
    )
