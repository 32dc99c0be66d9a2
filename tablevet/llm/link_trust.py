"""URL filters: explicit rules, then trust and distrust over the link graph, in DataFrame functions.

Trust starts at hosts whose pages the rules allow and follows links; distrust starts at hosts whose
pages the rules block and follows links backwards. Both are personalised PageRank over host edges. A
host without a fitting rule for a page is blocked where its distrust exceeds its trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevet.llm.common import ascii_lower, join_by_size
from tablevet.session import staged

# (host, path prefix, verdict). Fixed values.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DAMPING = 0.85
TOLERANCE = 1e-9
LINK = "(?i)href\\s*=\\s*[\"']?\\s*(?:https?:)?//([^/?#\"'\\s>]+)"


def host_of(url: Column) -> Column:
    rest = F.substr(url, F.locate("://", url) + 3)
    found = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return F.when(F.locate("://", url) > 0, found).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substr(url, F.locate("://", url) + 3)
    found = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(F.locate("://", url) > 0, found).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links): absolute links between different hosts. Links fold before the shuffle."""
    linked = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    links = pages.where("html is not null").select(host_of(F.col("url")).alias("src"), linked.alias("dst"))
    links = links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> '' and dst <> src")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) from ``seeds`` (host, trust, distrust), one row per host.

    Trust of a host is shared among the hosts it links to, by number of links; distrust among the
    hosts that link to it. Each round is a written table. Rounds go on until no host gets its first
    trust or distrust and the sum of all changes is at most ``tolerance`` times the seeds' weight, so
    what is missing is at most damping / (1 - damping) times that. Values never fall from round to
    round, so sums and counts tell both.
    """
    out = edges.groupBy("src").agg(F.sum("links").alias("out"))
    into = edges.groupBy("dst").agg(F.sum("links").alias("into"))
    edges = edges.join(out, "src").join(into, "dst")
    edges = staged(
        edges.select("src", "dst", (F.col("links") / F.col("out")).alias("ahead"), (F.col("links") / F.col("into")).alias("back")),
        "edges",
    )
    start = staged(seeds.select("host", ((1 - damping) * F.col("trust")).alias("trust"), ((1 - damping) * F.col("distrust")).alias("distrust")), "seeds")
    if edges.isEmpty():
        return start

    def state(ranks: DataFrame):
        weight = F.coalesce(F.sum(F.col("trust") + F.col("distrust")), F.lit(0.0))
        return ranks.agg(
            F.count_if(F.col("trust") > 0).alias("trusted"), F.count_if(F.col("distrust") > 0).alias("distrusted"), weight.alias("weight")
        ).first()

    ranks, before = start, state(start)
    least = tolerance * before["weight"] / (1 - damping)
    while True:
        ahead = edges.join(ranks, F.col("src") == F.col("host")).select(
            F.col("dst").alias("host"), (damping * F.col("trust") * F.col("ahead")).alias("trust"), F.lit(0.0).alias("distrust")
        )
        back = edges.join(ranks, F.col("dst") == F.col("host")).select(
            F.col("src").alias("host"), F.lit(0.0).alias("trust"), (damping * F.col("distrust") * F.col("back")).alias("distrust")
        )
        sums = start.unionByName(ahead).unionByName(back).groupBy("host")
        ranks = staged(sums.agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "ranks")
        now = state(ranks)
        grown = now["trusted"] > before["trusted"] or now["distrusted"] > before["distrusted"]
        if not grown and now["weight"] - before["weight"] <= least:
            return ranks
        before = now


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row of ``pages``.

    A null url or one without ``://`` has an empty host and path, fits no rule and is allowed; null
    html has no links; null and repeated ids are rows like others. Hosts without any evidence have
    trust and distrust 0 and are allowed. Seeds weigh by their share of all pages with a rule.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, says = rule_of(F.col("host"), F.col("path"), rules)
    judged = staged(judged.withColumns({"rule": name, "says": says}), "judged")
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("says") == "allow").alias("good"), F.count_if(F.col("says") == "block").alias("bad")
    )
    hosts = staged(hosts, "hosts")
    total = hosts.agg(F.sum(F.col("good") + F.col("bad")).alias("t")).first()["t"] or 1
    seeds = hosts.where("host <> '' and good + bad > 0").select(
        "host", (F.col("good") / total).alias("trust"), (F.col("bad") / total).alias("distrust")
    )
    ranks = propagate(host_edges(pages), seeds)
    table = staged(hosts.select("host", "n").join(ranks, "host", "left"), "trust")
    out = join_by_size(judged, table, "host", "n", judged.count())
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when(distrust > trust * (1 + 1e-9), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
