"""URL verdicts by rules and by trust and distrust along links.

A rule that fits decides. For the rest, hosts with allowed and without blocked pages are trusted
seeds, and hosts whose pages are all blocked are distrusted ones. Trust walks along the links of the pages (personalised PageRank
from the trusted seeds); distrust walks against them: who links to blocked hosts earns some of it.
A host is blocked when most of what reached it is distrust. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import ASCII_LOWER, ASCII_UPPER, free_name
from airshed.session import settle

#: (host, path, verdict) of each rule.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
DAMPING = 0.85
STEPS = 12  # links that the SQL follows trust and distrust along
TOLERANCE = 1e-9  # of the seeds' trust, or distrust: what may be left unspread
MERGE = 8  # steps after which their scores are added up in one table
THRESHOLD = 0.5  # share of distrust beyond which a host is blocked

LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(https?://[^\s"'<>]+)"""


def lowered(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The rule (struct of rule, verdict) with the longest text that fits; null if none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for on, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == on) | host.endswith(f".{on}")) & path.startswith(start)
        chosen = F.when(fits, F.struct(F.lit(on + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, weight: the share of the links from one host to others that go to dst.

    Links within a host, without a host, or in pages without one are left out.
    """
    out = pages.select(
        host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("link")
    )
    out = out.select("src", host_of(F.col("link")).alias("dst")).where("src <> dst and src <> '' and dst <> ''")
    n = out.groupBy("src", "dst").agg(F.count("*").alias("n"))
    total = n.groupBy("src").agg(F.sum("n").alias("total"))
    return n.join(total, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("weight"))


def spread(
    edges: DataFrame, seeds: DataFrame, steps: int | None = None, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """kind, host, score: what of each kind's seeds reaches a host.

    edges: kind, src, dst, weight; seeds: kind, host, score. The score is the sum over walks of k
    links of (1 - damping) damping^k times what they carry. Walks go on until less than ``tolerance``
    of what a kind's seeds have is left to be spread and no host is reached for the first time, or
    for ``steps`` links if given. Hosts that have got nothing in the last step are not looked at in
    the next one; every step is written, so a lost executor repeats one step.
    """
    front = settle(seeds.select("kind", "host", (F.col("score") * (1 - damping)).alias("score")), "url-seeds")
    every, step = front, 0
    while steps is None or step < steps:
        step += 1
        carried = front.withColumnRenamed("host", "src").join(edges, ["kind", "src"])
        front = carried.groupBy("kind", F.col("dst").alias("host")).agg(
            F.sum(F.col("score") * F.col("weight") * damping).alias("score")
        )
        front = settle(front.where("score > 0"), "url-step")
        mass = [r["mass"] for r in front.groupBy("kind").agg(F.sum("score").alias("mass")).collect()]  # a number a kind
        if not mass:
            break
        # A step hands on at most ``damping`` of what it got: all later ones together, a geometric sum.
        left = max(mass) * damping / (1 - damping)
        last = steps is None and left < tolerance and front.join(every, ["kind", "host"], "left_anti").isEmpty()
        every = every.unionByName(front)
        if last:
            break
        if step % MERGE == 0:
            every = settle(every.groupBy("kind", "host").agg(F.sum("score").alias("score")), "url-spread")
    return every.groupBy("kind", "host").agg(F.sum("score").alias("score"))


def host_scores(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """host, trust, distrust of each host that trust or distrust reaches."""
    verdict = fitting(host_of(F.col("url")), path_of(F.col("url")), rules)["verdict"]
    part = lambda v: F.sum(F.when(F.col("verdict") == v, 1).otherwise(0)).alias(v)
    known = pages.select(host_of(F.col("url")).alias("host"), verdict.alias("verdict")).where("host <> ''")
    known = settle(known.groupBy("host").agg(part("allow"), part("block"), F.count("*").alias("pages")), "url-hosts")
    seeds = None
    for kind, chosen in (("trust", "allow > 0 and block = 0"), ("distrust", "block = pages")):
        of_kind = known.where(chosen)
        n = of_kind.count()
        of_kind = of_kind.select(F.lit(kind).alias("kind"), "host", F.lit(1.0 / max(n, 1)).alias("score"))
        seeds = of_kind if seeds is None else seeds.unionByName(of_kind)
    edges = settle(host_edges(pages), "url-edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight")
    total = back.groupBy("src").agg(F.sum("weight").alias("total"))
    back = back.join(total, "src").select(F.lit("distrust").alias("kind"), "src", "dst", (F.col("weight") / F.col("total")).alias("weight"))
    scores = spread(settle(both.unionByName(back), "url-graph"), seeds)
    part = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0))
    return scores.groupBy("host").agg(part("trust").alias("trust"), part("distrust").alias("distrust"))


def judged(pages: DataFrame, rules: tuple = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """pages with host, path, rule, verdict, trust, distrust (names get underscores if taken).

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed, as
    is every host that neither trust nor distrust reaches. Repeated rows are judged alike.
    """
    names = {c: free_name(pages, c) for c in ("host", "path", "rule", "verdict", "trust", "distrust")}
    scores = settle(host_scores(pages.select("url", "html"), rules), "url-scores")
    scores = scores.select(F.col("host").alias("__host"), F.col("trust").alias("__trust"), F.col("distrust").alias("__distrust"))
    url = F.col("url")
    rows = pages.withColumns({names["host"]: host_of(url), names["path"]: path_of(url)})
    rows = rows.withColumn("__rule", fitting(F.col(names["host"]), F.col(names["path"]), rules))
    rows = rows.join(scores, F.col(names["host"]) == F.col("__host"), "left")
    trust, distrust = F.coalesce("__trust", F.lit(0.0)), F.coalesce("__distrust", F.lit(0.0))
    by_score = F.when(distrust > threshold * (trust + distrust), "block").otherwise("allow")
    return rows.withColumns(
        {
            names["rule"]: F.col("__rule.rule"),
            names["verdict"]: F.coalesce(F.col("__rule.verdict"), by_score),
            names["trust"]: trust,
            names["distrust"]: distrust,
        }
    ).drop("__rule", "__host", "__trust", "__distrust")


def digest(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of each page."""
    return judged(pages.select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")
