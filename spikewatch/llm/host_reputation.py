"""URL filters: fixed rules, and for the rest the host's reputation by empirical Bayes.

Labelled pages are good or bad. A host's share of bad pages is shrunk towards that of its
registered domain, the domain's towards that of its public suffix, and the suffix's towards
the share overall, by a beta-binomial prior at each level whose strength is estimated from
all groups of the level (method of moments). A host is blocked if the lower bound of its
posterior is above the tolerated share of bad pages.

Pages are counted before they are shuffled by host, and posteriors are computed on one row
per host. The join back is on the host alone; a host with a large part of all pages is split
by adaptive execution, as nothing after the join needs its pages together. Only the four
numbers of the priors pass through the driver.

A page without ``://`` in its address has the empty host and path. Labels without an outcome
are ignored; several labels of a page count once, as bad if one is. Repeated pages each get a
row. A host without labelled pages gets its domain's posterior, and so on up. Without
any labels nothing is blocked by reputation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikewatch.llm.tables import keep

# Public suffixes of two labels; other suffixes are a host's last label.
TWO_LABELS = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.mx", "gov.uk", "org.uk")
# Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 2.0, 1000.0
# Strength of the prior at the top, whose groups are few.
SUFFIX_STRENGTH = 50.0


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls whose host is ``host`` or below it and whose path starts so."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        below = (host == self.host) | host.endswith("." + self.host)
        return below & path.startswith(self.path)


def rule(verdict: str, name: str) -> Rule:
    """A rule written as host and path in one, such as ``net/es/``."""
    at = name.index("/")
    return Rule(verdict, name[:at], name[at:])


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABELS), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The registered domain: the suffix with one more label."""
    labels = F.size(F.split(suffix, r"\."))
    return F.when(labels == 2, F.substring_index(host, ".", -3)).otherwise(
        F.substring_index(host, ".", -2)
    )


def _strength(level: DataFrame, centre: str) -> float:
    """How many pages a group's prior is worth, from how far groups stray from ``centre``."""
    n, m = F.col("n"), F.col(centre)
    spread = m * (1 - m)
    row = level.agg(
        F.sum(F.pow(F.col("bad") - n * m, 2) - n * spread).alias("excess"),
        F.sum(n * (n - 1) * spread).alias("room"),
    ).first()
    if not row["room"] or row["excess"] is None:
        return STRONGEST
    share = row["excess"] / row["room"]
    return STRONGEST if share <= 0 else min(max(1 / share - 1, WEAKEST), STRONGEST)


def reputation(
    outcomes: DataFrame, tolerated: float = 0.35, deviations: float = 1.0
) -> DataFrame:
    """Posterior per host, from ``host`` and ``bad`` (0, 1 or, unlabelled, null) per page."""
    suffix = suffix_of(F.col("host"))
    hosts = keep(
        outcomes.groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("suffix", suffix)
        .withColumn("domain", domain_of(F.col("host"), F.col("suffix"))),
        "hosts",
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = (total["bad"] + 1) / (total["n"] + 2) if total["n"] else 0.0

    def grouped(*keys: str) -> DataFrame:
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def shrunk(centre: Column, strength: float) -> Column:
        return (F.col("bad") + centre * strength) / (F.col("n") + F.lit(strength))

    suffixes = grouped("suffix").select(
        "suffix", shrunk(F.lit(overall), SUFFIX_STRENGTH).alias("suffix_rate")
    )
    domains = grouped("suffix", "domain").join(suffixes, "suffix")
    domain_strength = _strength(domains, "suffix_rate")
    domains = domains.select(
        "domain", shrunk(F.col("suffix_rate"), domain_strength).alias("domain_rate")
    )
    hosts = hosts.join(domains, "domain")
    host_strength = _strength(hosts, "domain_rate")
    weight = F.col("n") + F.lit(host_strength)
    rate = shrunk(F.col("domain_rate"), host_strength)
    judged = hosts.select("host", "n", "bad", rate.alias("rate"), weight.alias("weight"))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))
    return judged.withColumn("bound", F.col("rate") - F.lit(deviations) * deviation).withColumn(
        "blocked", F.col("bound") > tolerated
    )


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule],
    tolerated: float = 0.35,
    deviations: float = 1.0,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page, with ``rate`` and ``bound``.

    ``pages`` needs ``page_id, url``; ``labels`` are ``doc_id, quality, toxic`` of pages by
    their number: a page is bad if its quality is 0 or it is toxic.
    """
    outcome = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = (
        labels.select(F.col("doc_id").alias("page_id"), outcome.cast("int").alias("bad"))
        .filter("page_id IS NOT NULL AND bad IS NOT NULL")
        .groupBy("page_id")
        .agg(F.max("bad").alias("bad"))
    )
    placed = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    outcomes = placed.join(known, "page_id", "left").select("host", "bad")
    judged = reputation(outcomes, tolerated, deviations)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for one in sorted(rules, key=lambda r: len(r.name)):
        fits = one.fits(F.col("host"), F.col("path"))
        name = F.when(fits, F.lit(one.name)).otherwise(name)
        verdict = F.when(fits, F.lit(one.verdict)).otherwise(verdict)
    by_host = F.when(F.col("blocked"), "block").otherwise("allow")
    return placed.join(judged, "host").select(
        "page_id",
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, by_host).alias("verdict"),
        "rate",
        "bound",
    )
