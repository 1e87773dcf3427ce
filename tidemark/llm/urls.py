"""Filtering of urls by rules and by the empirical-Bayes reputation of their hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import beta_strength
from tidemark.plans.storage import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The rules of the registered query as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def registered_domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def reputations(outcomes: DataFrame, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, float]:
    """Posterior means and variances of the bad rate of hosts, domains and suffixes, and the overall rate.

    ``outcomes`` has host and bad (0 or 1) of labelled pages. A suffix shrinks towards the overall rate, a domain towards its suffix, a
    host towards its domain, each by the strength that the spread of its level shows. Hot hosts are sums; no group is gathered.
    Without outcomes all three are empty and the overall rate is 0.
    """
    hosts = store(outcomes.groupBy("host").agg(F.sum("bad").cast("double").alias("k"), F.count("bad").cast("double").alias("n")), folder, "hosts")
    domains = store(hosts.groupBy(registered_domain(F.col("host")).alias("domain")).agg(F.sum("k").alias("k"), F.sum("n").alias("n")), folder, "domains")
    suffixes = store(domains.groupBy(suffix(F.col("domain")).alias("suffix")).agg(F.sum("k").alias("k"), F.sum("n").alias("n")), folder, "suffixes")
    k, n = suffixes.agg(F.sum("k"), F.sum("n")).first()
    overall = (k or 0.0) / n if n else 0.0

    def posterior(table: DataFrame, prior: Column, strength: float, name: str) -> DataFrame:
        a = F.col("k") + prior * F.lit(strength)
        b = F.col("n") - F.col("k") + (1 - prior) * F.lit(strength)
        mean = a / (a + b)
        return table.withColumns({f"{name}_mean": mean, f"{name}_var": mean * (1 - mean) / (a + b + 1)})

    suffixes = store(posterior(suffixes, F.lit(overall), beta_strength(suffixes), "suffix").select("suffix", "suffix_mean", "suffix_var"), folder, "suffix_rates")
    domains = domains.withColumn("suffix", suffix(F.col("domain"))).join(suffixes, "suffix")
    domains = store(posterior(domains, F.col("suffix_mean"), beta_strength(domains), "domain").select("domain", "domain_mean", "domain_var"), folder, "domain_rates")
    hosts = hosts.withColumn("domain", registered_domain(F.col("host"))).join(domains, "domain")
    hosts = store(posterior(hosts, F.col("domain_mean"), beta_strength(hosts), "host").select("host", "host_mean", "host_var"), folder, "host_rates")
    return hosts, domains, suffixes, overall


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null. The rules are configuration: a few, not data."""
    name = verdict = F.lit(None).cast("string")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, outcomes: DataFrame, folder: str, rules: tuple[tuple[str, str, str], ...] = RULES, limit: float = 0.5, z: float = 1.645) -> DataFrame:
    """page_id, host, path, rule, verdict and the bound of the bad rate for every row of ``pages`` (page_id, url).

    ``outcomes`` (page_id, bad) labels some pages; several of one page count each, null ones not at all. The rule's verdict stands;
    otherwise a page is blocked if the lower posterior bound (mean less ``z`` deviations) of the bad rate of its host exceeds ``limit``.
    A host without outcomes takes its domain's posterior, then its suffix's, then the overall rate with no certainty (bound 0).
    A null url has empty host and path, a null page_id no outcome. Repeated rows give repeated rows; urls of any length are read whole;
    other columns are not read. An empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    judged = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    judged = judged.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.select(F.col("page_id").cast("long").alias("page_id"), F.col("bad").cast("int").alias("bad")).where("bad is not null")
    hosts, domains, suffixes, _ = reputations(judged.select("page_id", "host").join(known, "page_id"), folder)
    rated = judged.withColumns({"domain": registered_domain(F.col("host")), "suffix": suffix(F.col("host"))})
    rated = rated.join(hosts, "host", "left").join(domains, "domain", "left").join(suffixes, "suffix", "left")
    mean = F.coalesce("host_mean", "domain_mean", "suffix_mean")
    deviation = F.sqrt(F.coalesce("host_var", "domain_var", "suffix_var"))
    bound = F.greatest(F.lit(0.0), F.coalesce(mean - F.lit(z) * deviation, F.lit(0.0)))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rated = rated.select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"), bound.alias("bad_bound"))
    method = F.when(F.col("bad_bound") > limit, "block").otherwise("allow")
    return rated.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "bad_bound")
