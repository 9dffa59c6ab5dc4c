"""Host reputation by empirical Bayes, and rule lists, as a filter of urls.

Labelled page outcomes are counted per host, registered domain (the last two
labels) and public suffix (the last label). Each level's beta-binomial prior has
its parent's posterior mean; its strength comes from the spread of the level's
members around that mean (method of moments). A host is allowed when the lower
posterior bound of its good share reaches ``min_good``.

Only DataFrame operations. One row per level (three sums) reaches the driver.

Defined cases: a null url or one without ``://`` has an empty host and path and
is judged like any other host; hosts without outcomes take their domain's,
suffix's or the overall posterior; with no outcomes at all the overall share is
one half; labels repeated for one document count once (the worst); repeated
pages give repeated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

Z = 1.645
MIN_GOOD = 0.75
#: Limits of the estimated correlation within a group, so that strengths stay finite.
RHO = (0.001, 0.9)
#: (verdict, host, path): a rule fits the host and its subdomains, and paths that start so.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    part = lambda k: F.coalesce(F.regexp_extract(F.col(url), _URL, k), F.lit(""))
    return df.withColumns({"host": ascii_lower(part(1)), "path": part(2)})


def registered(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*(?:\.[^.]*)?)$", 1)


def suffix(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*)$", 1)


def rule_columns(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule's string and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _level(members: DataFrame, parent_mean: str) -> float:
    """Prior strength of a level: members carry n, k and their parent's mean."""
    m, n, k = F.col(parent_mean), F.col("n"), F.col("k")
    row = members.filter("n > 0").agg(
        F.sum(n * F.pow(k / n - m, F.lit(2.0))).alias("spread"),
        F.sum(m * (1 - m)).alias("noise"),
        F.sum(m * (1 - m) * (n - 1)).alias("room")).first()
    spread, noise, room = (x or 0.0 for x in row)
    rho = (spread - noise) / room if room > 0 else RHO[0]
    return 1 / min(max(rho, RHO[0]), RHO[1]) - 1


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """``outcomes``: host, good (1, 0 or null for pages without a label); one row per host
    with n, k, mean and lower bound of the good share."""
    hosts = outcomes.groupBy("host").agg(
        F.count("good").cast("double").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("k"))
    hosts = hosts.withColumns({"domain": registered(F.col("host")), "suffix": suffix(F.col("host"))})
    hosts = hosts.checkpoint()
    all_n, all_k = hosts.agg(F.sum("n"), F.sum("k")).first()
    overall = ((all_k or 0.0) + 1) / ((all_n or 0.0) + 2)
    up = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("m", F.lit(overall))
    strength = _level(up, "m")
    suffixes = up.select("suffix", ((strength * F.col("m") + F.col("k")) / (strength + F.col("n"))).alias("m"))
    up = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).join(suffixes, "suffix")
    strength = _level(up, "m")
    domains = up.select("domain", ((strength * F.col("m") + F.col("k")) / (strength + F.col("n"))).alias("m"))
    up = hosts.join(domains, "domain")
    strength = _level(up, "m")
    a, b = strength * F.col("m") + F.col("k"), strength * (1 - F.col("m")) + F.col("n") - F.col("k")
    return up.select("host", "n", "k", (a / (a + b)).alias("mean"),
                     (a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("bound"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
                min_good: float = MIN_GOOD, z: float = Z, url: str = "url") -> DataFrame:
    """Every row of ``pages`` with host, path, rule, verdict (allow or block) and bound.

    ``outcomes``: url, good. A page's verdict is its longest rule's, else allow when
    the host's lower posterior bound is at least ``min_good``.
    """
    judged = host_reputation(with_host_path(outcomes.select(F.col(url), "good"), url), z)
    rule, verdict = rule_columns(rules)
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "bound")]
    out = with_host_path(pages.select(*keep), url)
    out = out.join(judged.select("host", "bound"), "host", "left")
    return out.select(*keep, "host", "path", rule.alias("rule"),
                      F.coalesce(verdict, F.when(F.col("bound") >= min_good, "allow").otherwise("block")).alias("verdict"),
                      "bound")
