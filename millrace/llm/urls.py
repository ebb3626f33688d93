"""URL filters: rules first, and trust against distrust spread over the links between hosts.

Rules name a host and a path; the longest that fits decides. Where none fits, the host decides: trust is
the personalised PageRank of host links from trusted hosts, distrust that of reversed links from blocked
ones. A host is a seed when more than half of its pages fall under rules of that verdict. A host whose distrust is
above THRESHOLD times its trust is blocked.

Null url or url without ``://``: empty host and path, no rule, allowed. Null html: no links. Links that a
page repeats count once per pair of hosts and page; links inside a host say nothing. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import table, written

#: Rule, host, path, verdict. Fixed values.
RULES = (
    ("net/", "net", "/", "block"),
    ("example.net/en/", "example.net", "/en/", "allow"),
    ("example.com/de/", "example.com", "/de/", "block"),
    ("org/fr/", "org", "/fr/", "allow"),
)
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Summed change of all scores over ROUNDS rounds, up to which they count as settled.
TOLERANCE = 1e-6
#: Rounds between two looks at the change.
ROUNDS = 3
DAMPING = 0.85
THRESHOLD = 1.0


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(url.isNotNull() & (at > 0), F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule, rule_host, rule_path, _ in sorted(rules, key=lambda r: len(r[0])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def rule_verdict(rule: Column, rules=RULES) -> Column:
    verdict = F.lit(None).cast("string")
    for name, _, _, said in rules:
        verdict = F.when(rule == name, F.lit(said)).otherwise(verdict)
    return verdict


def spread(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank as (host, score). edges: src, dst, weight; seeds: host, seed (adding up to 1, or none).

    What reaches a host without links is lost; so scores add up to at most 1, which both sides share alike.
    It goes on until the scores are settled and no more hosts are reached, however long the chains are.
    Every few rounds the scores are written and held against those written before, so that the plan stays short.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("all"))
    moves = written(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("all")).alias("share")), "moves")
    score = seeds.select("host", F.col("seed").alias("score"))
    if moves.isEmpty() or seeds.isEmpty():
        return score
    rest = written(seeds.select("host", ((1 - damping) * F.col("seed")).alias("score")), "seeds")
    score = written(score, "scores")
    while True:
        before = score
        for _ in range(ROUNDS):
            moved = moves.join(score, moves.src == score.host).select(
                F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("score")
            )
            score = moved.unionAll(rest).groupBy("host").agg(F.sum("score").alias("score"))
        score = written(score, "scores")
        both = score.join(before.select("host", F.col("score").alias("old")), "host", "full")
        change = both.agg(
            F.sum(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("old", F.lit(0.0)))).alias("sum"),
            # A host with a score below what a double holds ends a chain.
            F.count_if(F.col("old").isNull() & (F.col("score") > 0)).alias("new"),
        ).first()
        if change["sum"] <= tolerance and not change["new"]:
            return score


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) of links between different hosts. pages: host, html."""
    found = pages.where("html IS NOT NULL AND host <> ''").select(
        F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(
            F.regexp_extract_all("html", F.lit(LINK), 1),
            lambda u: host_of(F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u)),
        ))).alias("dst")
    )
    found = found.where("dst <> '' AND dst <> src")
    return found.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every row; pages has page_id, url, html."""
    named = pages.select("page_id", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    named = named.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    named = named.withColumn("ruled", rule_verdict(F.col("rule"), rules))
    hosts = written(
        named.where("host <> ''")
        .groupBy("host")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("ruled") == "allow").alias("good"),
            F.count_if(F.col("ruled") == "block").alias("bad"),
        ),
        "hosts",
    )
    links = written(host_links(named), "links")
    scores = []
    for side, name in (("good", "trust"), ("bad", "distrust")):
        edges = links if side == "good" else links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
        chosen = hosts.where(2 * F.col(side) > F.col("n"))
        total = chosen.agg(F.sum(side)).first()[0]
        seeds = chosen.select("host", (F.col(side) / F.lit(float(total or 1))).alias("seed"))
        scores.append(spread(edges, seeds).withColumnRenamed("score", name))
    judged = hosts.select("host").join(scores[0], "host", "left").join(scores[1], "host", "left").na.fill(0.0)
    judged = judged.select(
        "host", "trust", "distrust",
        F.when(F.col("distrust") > threshold * F.col("trust"), "block").otherwise("allow").alias("host_verdict"),
    )
    verdict = F.coalesce("ruled", "host_verdict", F.lit("allow"))
    return named.drop("html").join(judged, "host", "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op8_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).drop("trust", "distrust")
