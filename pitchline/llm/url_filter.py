"""URL filtering by explicit rules and by empirical-Bayes host reputation.

Labelled pages are outcomes, good or bad. The share of good pages is shrunk down
a hierarchy of beta-binomial models: the suffix's rate towards the overall one,
the registered domain's towards its suffix's, the host's towards its domain's.
How strongly a level is shrunk is learned from the data: its concentration is
1 / rho - 1, where rho is the intra-class correlation of outcomes among the
units below a common parent (method of moments). A host is allowed if the lower
bound of its posterior, ``z`` standard deviations below the mean, reaches
``least``. A host without outcomes inherits its domain's mean, a domain its
suffix's.

Only counts are shuffled: outcomes are summed on the map side before any
exchange, whatever the share of a host. Rules are a short list given by the
caller and become expressions.

Defined cases: a null url, or one without ``://``, has an empty host and path and
follows the reputation of the empty host; a page with several label rows counts
each; without labelled pages every rate is 1/2 and the concentrations are at
their least; equal rows each give a row.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Suffixes of two labels below which domains are registered; others have one.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Allow or block a host with its subdomains, below a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, _URL, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct of name and verdict."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _concentration(units: DataFrame, parent: str, most: float) -> float:
    """1 / rho - 1 for units (n, good) below parents; between 1 and ``most``."""
    sums = units.groupBy(parent).agg(F.sum("n").alias("_n"), F.sum("good").alias("_good"))
    rate = F.col("_good") / F.col("_n")
    own = F.col("good") / F.col("n")
    row = (
        units.join(sums, parent)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * (own - rate) ** 2).alias("between"),
            F.sum(F.col("n") * own * (1 - own)).alias("within"),
            F.count(F.lit(1)).alias("units"),
            F.count_distinct(parent).alias("parents"),
            F.sum(F.col("n") * F.col("n") / F.col("_n")).alias("squares"),
        )
        .first()
    )
    free = (row["units"] or 0) - (row["parents"] or 0)
    if free <= 0 or row["n"] <= row["units"]:
        return 1.0
    between, within = row["between"] / free, row["within"] / (row["n"] - row["units"])
    average = (row["n"] - row["squares"]) / free
    if between + (average - 1) * within <= 0:
        return 1.0
    rho = max(0.0, (between - within) / (between + (average - 1) * within))
    return most if rho <= 1 / (most + 1) else max(1.0, 1 / rho - 1)


def reputation(outcomes: DataFrame, least: float = 0.5, z: float = 1.645, most: float = 1000.0) -> tuple[DataFrame, DataFrame, DataFrame, float, float]:
    """Posterior means and verdicts from ``outcomes`` (host, good 0 or 1).

    Returns the hosts (host, verdict), the domains (domain, domain_verdict), the
    suffixes (suffix, suffix_verdict) for hosts without outcomes of their own, and
    the overall rate with its verdict's bound.
    """
    host, domain, suffix = F.col("host"), F.col("domain"), F.col("suffix")
    hosts = (
        outcomes.groupBy("host")
        .agg(F.count("good").alias("n"), F.sum("good").alias("good"))
        .where(F.col("n") > 0)
        .withColumn("domain", domain_of(host))
        .withColumn("suffix", suffix_of(host))
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    # all suffixes have one parent; as a literal it would make the join a cross join
    suffixes = suffixes.withColumn("all", F.substring("suffix", 1, 0))
    total = suffixes.agg(F.sum("good"), F.sum("n")).first()
    rate = (total[0] + 1) / (total[1] + 2) if total[1] else 0.5
    by_host = _concentration(hosts.select("host", "domain", "n", "good"), "domain", most)
    by_domain = _concentration(domains, "suffix", most)
    by_suffix = _concentration(suffixes, "all", most)

    def mean(prior: Column, strength: float) -> Column:
        return (strength * prior + F.col("good")) / (strength + F.col("n"))

    def verdict(p: Column, n: Column) -> Column:
        return F.when(p - z * F.sqrt(p * (1 - p) / (by_host + n + 1)) >= least, "allow").otherwise("block")

    none = F.lit(0)
    suffixes = suffixes.select("suffix", mean(F.lit(rate), by_suffix).alias("suffix_mean"))
    domains = domains.join(suffixes, "suffix").select("domain", mean(F.col("suffix_mean"), by_domain).alias("domain_mean"))
    hosts = hosts.join(domains, "domain").select("host", verdict(mean(F.col("domain_mean"), by_host), F.col("n")).alias("host_verdict"))
    return (
        hosts,
        domains.select("domain", verdict(F.col("domain_mean"), none).alias("domain_verdict")),
        suffixes.select("suffix", verdict(F.col("suffix_mean"), none).alias("suffix_verdict")),
        rate,
        rate - z * (rate * (1 - rate) / (by_host + 1)) ** 0.5,
    )


def url_filter(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...], id_col: str = "page_id", url_col: str = "url", least: float = 0.5, z: float = 1.645) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``labels``: (page_id, good), good 0 or 1; pages may have none or several.
    """
    url = F.col(url_col)
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    given = labels.where(F.col("good").isNotNull()).select(F.col("page_id").alias("_labelled"), "good")
    outcomes = parts.select("page_id", "host").join(given, F.col("page_id") == F.col("_labelled")).select("host", "good")
    hosts, domains, suffixes, _, bound = reputation(outcomes, least, z)
    method = F.coalesce("host_verdict", "domain_verdict", "suffix_verdict", F.lit("allow" if bound >= least else "block"))
    known = (
        parts.select("host")
        .distinct()
        .withColumn("domain", domain_of(F.col("host")))
        .withColumn("suffix", suffix_of(F.col("host")))
        .join(hosts, "host", "left")
        .join(domains, "domain", "left")
        .join(suffixes, "suffix", "left")
        .select("host", method.alias("_method"))
    )
    return (
        parts.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
        .join(known, "host")
        .select(
            "page_id",
            "host",
            "path",
            F.col("_rule.rule").alias("rule"),
            F.coalesce(F.col("_rule.verdict"), F.col("_method")).alias("verdict"),
        )
    )
