"""URL filter by host reputation.

Labelled pages give each host a number of pages and of bad ones. Small hosts say little on their own, so that each host's share of bad pages
is shrunk towards its registered domain's, that towards its suffix's, and that towards the share of all pages. Each level is a
beta-binomial prior whose strength the spread of the data itself gives (method of moments). A host is blocked if the lower bound of its
posterior share passes a limit. Explicit rules come first.

Everything meets at the level of hosts; pages join one row per host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Standard deviations of the bound, share of bad pages from which a host is blocked, limits of the within-group correlation.
DEVIATIONS, LIMIT, LEAST, MOST = 1.645, 0.2, 0.001, 0.999
#: Second-level labels that form a suffix with a country. Fixed values.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gov", "net", "nom", "or", "org")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or the end, capitals lowered; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def levels(hosts: DataFrame) -> DataFrame:
    """Adds suffix and domain (one label more) to hosts. Ports and user names are no part of them."""
    labels = F.split(F.regexp_replace("host", r"^[^@]*@|:[0-9]*$", ""), r"\.")
    size = F.size("labels")
    two = (size > 2) & (F.length(F.element_at("labels", -1)) == 2) & F.element_at("labels", F.greatest(-size, F.lit(-2))).isin(*SECOND_LEVEL)
    last = lambda n: F.concat_ws(".", F.slice("labels", F.greatest(size - n, F.lit(0)) + 1, n))
    wide = hosts.withColumn("labels", labels).withColumn("k", F.when(two, 2).otherwise(1))
    return wide.withColumns({"suffix": last(F.col("k")), "domain": last(F.col("k") + 1)}).drop("labels", "k")


def _strength(children: DataFrame) -> DataFrame:
    """Strength of the prior, from children (n, bad, prior): one row with k.

    The summed squared deviations, scaled by the binomial variance, exceed the number of children by the correlation within them.
    """
    square = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2) / (F.col("prior") * (1 - F.col("prior")))
    rho = (F.sum(square) - F.count("*")) / F.nullif(F.sum("n") - F.count("*"), F.lit(0))
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(LEAST)), F.lit(LEAST)), F.lit(MOST))
    return children.agg(((1 - rho) / rho).alias("k"))


def _shrunk(groups: DataFrame) -> DataFrame:
    """Groups (n, bad, prior) with `mean`, their posterior share, and `k`, the strength of the prior. k is one row."""
    return groups.crossJoin(F.broadcast(_strength(groups))).withColumn(
        "mean", (F.col("bad") + F.col("k") * F.col("prior")) / (F.col("n") + F.col("k"))
    )


def reputation(outcomes: DataFrame, hosts: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """Per row of `hosts` (host): n, bad, share (posterior mean), bound (its lower bound).

    `outcomes` has host and bad (true for a bad page); rows without one are left out. Hosts without labelled pages take their domain's
    share, then their suffix's, then all pages'; without any labelled page the share is one half.
    """
    seen = levels(outcomes.where("bad is not null").groupBy("host").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad")))
    total = seen.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).alias("all"))  # one row
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes = _shrunk(seen.groupBy("suffix").agg(*sums).crossJoin(F.broadcast(total)).withColumn("prior", F.col("all")))
    by_suffix = suffixes.select("suffix", F.col("mean").alias("suffix_mean"))
    domains = seen.groupBy("suffix", "domain").agg(*sums).join(by_suffix, "suffix").withColumn("prior", F.col("suffix_mean"))
    by_domain = _shrunk(domains).select("domain", F.col("mean").alias("domain_mean"))
    known = seen.join(by_domain, "domain").withColumn("prior", F.col("domain_mean"))
    strength = _strength(known)
    every = (
        levels(hosts.select("host").distinct())
        .join(seen.select("host", "n", "bad"), "host", "left")
        .join(by_domain, "domain", "left")
        .join(by_suffix, "suffix", "left")
        .crossJoin(F.broadcast(total))
        .crossJoin(F.broadcast(strength))
    )
    prior = F.coalesce("domain_mean", "suffix_mean", "all")
    a = F.coalesce("bad", F.lit(0)) + F.col("k") * prior
    b = F.coalesce("n", F.lit(0)) - F.coalesce("bad", F.lit(0)) + F.col("k") * (1 - prior)
    mean = F.col("a") / (F.col("a") + F.col("b"))
    spread = F.sqrt(mean * (1 - mean) / (F.col("a") + F.col("b") + 1))
    return every.withColumns({"a": a, "b": b}).select(
        "host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad"),
        mean.alias("share"), (mean - deviations * spread).alias("bound"),
    )


def judge(pages: DataFrame, outcomes: DataFrame, rules: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The pages with host, path, rule, verdict, share and bound.

    A rule (host, path, action) fits its host and all below it if the page's path starts with the rule's; the longest wins. Else the
    host's bound decides: block above the limit. Null urls have an empty host, which is a host like any other. Every page gives one row.
    Columns of the same names are replaced.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "share", "bound").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    hosts = pages.select("host").distinct()
    known = reputation(outcomes, hosts)
    # each host and all domains above it, so that rules are found by equality
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    ruled = rules.select(F.col("host").alias("of"), F.col("path").alias("start"), "action")
    fitting = (
        hosts.withColumn("of", F.explode(above)).join(ruled, "of")
        .groupBy("host").agg(F.sort_array(F.collect_list(F.struct(F.length(F.concat("of", "start")).alias("size"), "start", F.concat("of", "start").alias("rule"), "action")), asc=False).alias("rules"))
    )
    own = known.join(fitting, "host", "left")
    first = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["start"])), 0)
    verdict = F.coalesce(F.col("best.action"), F.when(F.col("bound") > limit, "block").otherwise("allow"))
    return (
        pages.join(own.drop("n", "bad"), "host")
        .withColumn("best", first)
        .withColumns({"rule": F.col("best.rule"), "verdict": verdict})
        .select(*pages.columns, "rule", "verdict", "share", "bound")
    )
