"""URL filters: block and allow rules, and link-graph propagation for the rest
(SQL functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import partitions
from cohortlab.plans.guards import broadcast_if_bounded, discard, hot_keys, materialize, salted_lookup_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed values: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
LINK = r"""(?i:href)\s*=\s*["']?\s*((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s)(.*?)://(.*)$", 2)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s)(.*?)://(.*)$", 2)
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_rules(hosts: DataFrame, rules: tuple) -> DataFrame:
    """``host, fits``: for each host the rules of its own and its parents' names,
    longest first.  A host meets the rules once per label, by equality."""
    table = hosts.sparkSession.createDataFrame(
        [(h, p, v, f"{h}{p}", len(h + p)) for h, p, v in rules],
        "rule_host string, rule_path string, verdict string, rule string, n int")
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return (hosts.select("host", F.explode(parents).alias("rule_host"))
            .join(broadcast_if_bounded(table), "rule_host")
            .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("n", "rule", "rule_path", "verdict")), asc=False).alias("fits")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6,
              max_steps: int = 400) -> DataFrame:
    """Personalised PageRank for several personalisations at once:
    ``kind, host, score``, where ``score = start + damping * inflow``.

    ``edges``: ``kind, src, dst, share`` (shares of a source add up to 1);
    ``seeds``: ``kind, host, start``.  Scores are those of PageRank in units of
    a seed of start 1 without inflow, whatever the number of seeds and hosts:
    only what links to a host, near or far, moves its score.  Every step is
    one join and one sum over the host edges, written to the shared folder;
    steps end when no host's score moves by ``tolerance``, of a score above 1
    by that part.  What moves shrinks by ``damping`` a step, so more than
    ``max_steps`` is an error.
    """
    edges = materialize(edges, "pagerank-edges")
    seeds = materialize(seeds, "pagerank-seeds")
    rank, both_before = seeds.select("kind", "host", F.col("start").alias("score")), None
    for _ in range(max_steps):
        flow = (rank.withColumnRenamed("host", "src").join(edges, ["kind", "src"])
                .groupBy("kind", F.col("dst").alias("host"))
                .agg(F.sum(F.col("score") * F.col("share")).alias("in")))
        both = (flow.join(seeds, ["kind", "host"], "full")
                .join(rank.withColumnRenamed("score", "old"), ["kind", "host"], "full")
                .select("kind", "host", (F.lit(damping) * F.coalesce("in", F.lit(0.0))
                                         + F.coalesce("start", F.lit(0.0))).alias("score"),
                        F.coalesce("old", F.lit(0.0)).alias("old")))
        last, both = both_before, materialize(both, "pagerank-flow")
        moved = both.agg(F.max(F.abs(F.col("score") - F.col("old")) / F.greatest("score", F.lit(1.0))).alias("d")).first()["d"] or 0.0
        rank, both_before = both.select("kind", "host", "score"), both
        if last is not None:
            discard(last)
        if moved < tolerance:
            return rank
    raise RuntimeError(f"scores still move after {max_steps} steps")


def judge_urls(pages: DataFrame, rules: tuple = RULES, damping: float = 0.85, threshold: float = 0.5,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, trust, distrust``.

    The longest rule that fits the url decides.  For the others trust flows
    from hosts with allowed pages along links, distrust from hosts with
    blocked pages against them (who links to the blocked is distrusted); a
    host is blocked when its distrust exceeds its trust by ``threshold`` or
    more.  Each seed host starts with the blocked, or allowed, share of all its
    pages, and both scores are in units of a host with all of them under one
    verdict, so neither the number of hosts nor that of a host's pages counts,
    and a rule on few of a host's pages does not condemn the others.

    Null urls and urls without ``://`` have empty host and path, fit no rule
    and are allowed; null html has no links; repeated rows are judged alike;
    an empty table gives no rows.
    """
    url, html = F.coalesce(F.col(url_col), F.lit("")), F.col(html_col)
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    # hosts with more than a task's share of the pages are split
    per_host = materialize(urls.groupBy("host").agg(F.count("*").alias("pages")), "url-pages")
    total = per_host.agg(F.sum("pages").alias("n")).first()["n"] or 0
    hot = materialize(hot_keys(per_host, "host", "pages", max(1, total // partitions(pages))), "url-hot")

    def of_host(rows, table):
        return salted_lookup_join(rows, table.withColumnRenamed("host", "_host"), "host", "_host", "left",
                                  salt_from=rows.columns, hot=hot).drop("_host")
    per_path = materialize(host_rules(per_host.select("host"), rules), "url-rules")
    rule = F.get(F.filter("fits", lambda r: F.startswith(F.col("path"), r["rule_path"])), F.lit(0))
    placed = of_host(urls.groupBy("host", "path").agg(F.count("*").alias("pages")), per_path)
    judged = placed.withColumn("r", rule).groupBy("host").agg(
        F.sum(F.when(F.col("r.verdict") == "allow", F.col("pages")).otherwise(0)).alias("allowed"),
        F.sum(F.when(F.col("r.verdict") == "block", F.col("pages")).otherwise(0)).alias("blocked"),
        F.sum("pages").alias("all"), F.max("fits").alias("fits"))
    judged = materialize(judged, "url-hosts")
    kinds = F.explode(F.array(F.struct(F.lit("trust").alias("kind"), (F.col("allowed") / F.col("all")).alias("start")),
                              F.struct(F.lit("distrust").alias("kind"), (F.col("blocked") / F.col("all")).alias("start"))))
    seeds = (judged.where(F.col("host") != "").select("host", kinds.alias("s"))
             .where("s.start > 0").select("s.kind", "host", "s.start"))
    to = F.explode(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINK), F.lit(1)))
    target = F.col("to")
    links = (pages.select(host_of(url).alias("src"), to.alias("to"))
             .select("src", host_of(F.when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
                            .otherwise(target)).alias("dst"))
             .where("src <> '' and dst <> '' and src <> dst")
             .groupBy("src", "dst").agg(F.count("*").alias("n")))
    links = materialize(links, "url-links")
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    outward = edges.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    edges = edges.join(outward, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("all")).alias("share"))
    score = propagate(edges, seeds, damping)
    score = score.groupBy("host").agg(
        F.max(F.when(F.col("kind") == "trust", F.col("score"))).alias("trust"),
        F.max(F.when(F.col("kind") == "distrust", F.col("score"))).alias("distrust"))
    known = materialize(judged.select("host", "fits").join(score, "host", "left")
                        .select("host", "fits", F.coalesce("trust", F.lit(0.0)).alias("trust"),
                                F.coalesce("distrust", F.lit(0.0)).alias("distrust")), "url-scores")
    bad = F.col("distrust") - F.col("trust") >= threshold - 1e-9      # equal but for the order of a sum
    return (of_host(urls, known).withColumn("r", rule)
            .select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                    F.coalesce(F.col("r.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
                    "trust", "distrust"))
