"""URL filters: rules by host and path, and elsewhere the empirical-Bayes reputation of the host.

Page outcomes (1 bad, 0 good) are counted by host. A host's rate is shrunk through a beta prior centred on its
registered domain's posterior mean, the domain's on its suffix's, the suffix's on the rate of all; the strength of each
level's prior is estimated by moments from the spread of the rates below it. A page is blocked if the lower bound of its
host's posterior lies above a limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The lower posterior bound is the mean less Z standard deviations; above LIMIT the host is blocked.
Z, LIMIT = 1.645, 0.5
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    pattern: str  # host, then path


def host_of(url: Column) -> Column:
    """From after the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or no ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits, null if none does. Equal lengths: the first given."""
    pattern = verdict = None
    for rule in sorted(rules, key=lambda r: -len(r.pattern)):
        site, slash, rest = rule.pattern.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(slash + rest)
        pattern = (pattern.when if pattern is not None else F.when)(fits, rule.pattern)
        verdict = (verdict.when if verdict is not None else F.when)(fits, rule.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if pattern is None else (pattern, verdict)


def site_levels(host: Column, suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, its port aside: the longest of `suffixes` that the host ends in, else its last
    label; and that with one label more."""
    labels = F.split(F.regexp_replace(host, r":[0-9]*$", ""), r"\.")
    n = F.size(labels)
    ends = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))  # the longest first
    known = F.filter(ends, lambda x: x.isin(list(suffixes))) if suffixes else F.slice(ends, 1, 0)
    suffix = F.coalesce(F.get(known, F.lit(0)), F.element_at(ends, -1))
    at = F.array_position(ends, suffix).cast("int")
    return F.element_at(ends, F.greatest(at - 1, F.lit(1))), suffix


def reputation(outcomes: DataFrame, suffixes: Sequence[str] = ()) -> DataFrame:
    """From rows (host, bad: 1, 0 or null for no outcome): one row per host with n, bad, mean, low.

    Hosts without outcomes take their domain's posterior. Without any outcome at all the rate of all is one half.
    Levels: the host, its registered domain, its suffix (site_levels).
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k"))
    domain, suffix = site_levels(F.col("host"), suffixes)
    hosts = hosts.withColumns({"domain": domain, "suffix": suffix})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    whole = suffixes.agg(F.coalesce(F.try_divide(F.sum("k"), F.sum("n")), F.lit(0.5)).alias("top"))

    def strength(level: DataFrame, name: str) -> DataFrame:
        """By moments: rates spread about the mean m with variance m(1-m)(1/n + (1-1/n)/(s+1)) each."""
        x = level.where("n > 0").agg(F.sum("n").alias("a"), F.sum("k").alias("b"), F.count("*").alias("g"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("q"))
        m = F.try_divide("b", "a")
        spread = F.col("q") - F.col("a") * m * m  # the weighted sum of squares
        share = F.try_divide(F.try_divide(spread, m * (1 - m)) - F.col("g"), F.col("a") - F.col("g"))  # 1 / (s + 1)
        s = F.when((m <= 0) | (m >= 1) | share.isNull() | (share <= 0), STRONGEST).otherwise(F.try_divide(F.lit(1.0), share) - 1)
        return x.select(F.least(F.lit(STRONGEST), F.greatest(F.lit(WEAKEST), s)).alias(name))

    level = suffixes.crossJoin(whole).crossJoin(strength(suffixes, "s"))  # one row each
    level = level.select("suffix", ((F.col("k") + F.col("s") * F.col("top")) / (F.col("n") + F.col("s"))).alias("above"))
    domains = domains.join(level, "suffix").crossJoin(strength(domains, "s"))
    domains = domains.select("domain", ((F.col("k") + F.col("s") * F.col("above")) / (F.col("n") + F.col("s"))).alias("above"))
    hosts = hosts.join(domains, "domain").crossJoin(strength(hosts, "s"))
    a, b = F.col("k") + F.col("s") * F.col("above"), F.col("n") - F.col("k") + F.col("s") * (1 - F.col("above"))
    hosts = hosts.withColumns({"mean": a / (a + b), "size": a + b})
    return hosts.select("host", "n", F.col("k").alias("bad"), "mean", (F.col("mean") - Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("size") + 1))).alias("low"))


def judge(pages: DataFrame, rules: list[Rule], page: str = "page_id", url: str = "url", outcome: str | None = None, suffixes: Sequence[str] = ()) -> DataFrame:
    """One row per row of pages: page, host, path, rule, verdict, low (the host's lower bound).

    suffixes: public suffixes of more than one label, as of a public list; hosts below one are different registered domains.
    outcome names a column of pages with 1 (bad), 0 (good) or null; without it, pages that a rule decides are the
    labelled ones. A null url has the empty host, which is a host like others. Repeated rows count each. The join with
    the hosts' reputations is one that Spark can split where one host holds many pages.
    """
    given = F.lit(None).cast("int") if outcome is None else F.col(f"`{outcome}`").cast("int")
    rows = pages.select(F.col(page).alias("page"), F.col(url).cast("string").alias("u"), given.alias("given"))
    rows = rows.select("page", "given", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    pattern, ruled = first_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": pattern, "ruled": ruled})
    bad = F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0) if outcome is None else F.col("given")
    known = reputation(rows.select("host", bad.alias("bad")), suffixes).select(F.col("host").alias("site"), "low")
    joined = rows.join(known, F.col("host") == F.col("site"), "left")
    verdict = F.coalesce("ruled", F.when(F.col("low") > LIMIT, "block").otherwise("allow"))
    return joined.select(F.col("page").alias(page), "host", "path", "rule", verdict.alias("verdict"), "low")
