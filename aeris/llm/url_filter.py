"""URL filter by empirical-Bayes host reputation. DataFrame functions only.

Labelled page outcomes (good or bad) are counted per host. Reputation is shrunk down the
hierarchy suffix -> registered domain -> host: at each level a group's outcomes update a beta
prior whose mean is the posterior mean of the level above and whose strength (pseudo-count) is
estimated from the data, from the over-dispersion of the counts around their prior means
(method of moments of the beta-binomial; with no group of two outcomes, the upper bound). A host is blocked when even the upper bound of its
posterior, mean + z standard deviations of the beta, lies below the least good rate. Explicit
rules go before reputation.

Scale: counting is partially aggregated, so a host with a third of all pages is one row per task.
The levels are roll-ups of the host counts; hosts meet their pages in one equi-join, where
Spark broadcasts a small side or splits a hot host by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """Allow or block a host with all its subdomains, for paths starting with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


#: Suffixes of more than one label under which domains are registered (a parameter; extend as needed).
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "com.br", "co.jp", "co.nz", "co.in", "com.cn")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, upper.lower())


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (of equally long ones the longer host wins,
    then block before allow), null where none does. For policy lists of up to some hundred rules."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block")):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def host_levels(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host (user, port and a final dot left out)."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")
    labels = F.split(name, r"\.")
    is_long = F.substring_index(name, ".", -2).isin(*long_suffixes)
    suffix = F.when(is_long, F.substring_index(name, ".", -2)).otherwise(F.element_at(labels, -1))
    domain = F.when(is_long, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return domain, suffix


def _shrink(counts: DataFrame, level: str, strength: tuple[float, float]) -> DataFrame:
    """Posterior mean and total pseudo-count per group of ``level``: ``counts`` has ``good, n, prior``."""
    least, most = strength
    excess = F.pow(F.col("good") - F.col("n") * F.col("prior"), F.lit(2.0)) / (F.col("prior") * (1 - F.col("prior"))) - F.col("n")
    exact = lambda c: F.sum(c.cast("decimal(30,9)")).cast("double")  # noqa: E731  the same in any order of rows
    rho = exact(excess) / F.nullif(F.sum(F.col("n") * (F.col("n") - 1)), F.lit(0))
    spread = counts.agg(F.least(F.greatest(1 / F.greatest(rho, F.lit(1e-9)) - 1, F.lit(least)), F.lit(most)).alias("s"))
    total = F.coalesce(spread.scalar(), F.lit(most))
    return counts.withColumn("total", total + F.col("n")).withColumn(
        "mean", (total * F.col("prior") + F.col("good")) / F.col("total")).select(level, "good", "n", "mean", "total")


def host_reputation(outcomes: DataFrame, strength: tuple[float, float] = (2.0, 1000.0)) -> DataFrame:
    """``host, good, n, mean, sd`` of each host of ``outcomes`` (``host, good`` with good 0 or 1; null
    outcomes don't count). ``strength`` bounds the estimated pseudo-counts."""
    domain, suffix = host_levels(F.col("host"))
    hosts = (
        outcomes.where(F.col("good").isNotNull()).groupBy("host")
        .agg(F.sum("good").cast("long").alias("good"), F.count("*").alias("n"))
        .withColumn("domain", domain).withColumn("suffix", suffix)
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    overall = suffixes.agg(((F.sum("good") + 0.5) / (F.sum("n") + 1.0)).alias("p")).scalar()  # half a pseudo-count each keeps it inside (0, 1)
    top = _shrink(suffixes.withColumn("prior", overall), "suffix", strength)
    top = top.select("suffix", F.col("mean").alias("prior"))
    mid = _shrink(domains.join(top, "suffix"), "domain", strength).select("domain", F.col("mean").alias("prior"))
    low = _shrink(hosts.join(mid, "domain"), "host", strength)
    return low.withColumn("sd", F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("total") + 1))).drop("total")


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], least_good: float = 0.5, z: float = 2.0) -> DataFrame:
    """Every row of ``pages`` (``page_id, url``) as ``page_id, host, path, rule, verdict, good, n, reputation, upper``.

    ``outcomes`` has ``page_id, good`` (0 or 1) for some pages; an outcome of a page that occurs
    several times counts for each row of that page. A url that is null or has no ``://`` has an
    empty host and path and takes part like any other host. Hosts without outcomes are allowed
    (nothing is held against them). Extra columns are ignored; empty tables give no rows or no
    reputation.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    marks = outcomes.groupBy("page_id").agg(F.min("good").alias("good"))  # contradicting marks: bad
    reputation = host_reputation(urls.join(marks, "page_id").select("host", "good"))
    text, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    upper = F.col("mean") + z * F.col("sd")
    return (
        urls.join(reputation, "host", "left")
        .withColumn("upper", upper)
        .select("page_id", "host", "path", text.alias("rule"),
                F.coalesce(verdict, F.when(F.col("upper") < least_good, "block").otherwise("allow")).alias("verdict"),
                F.coalesce(F.col("good"), F.lit(0)).cast("long").alias("good"), F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
                F.round("mean", 6).alias("reputation"), F.round("upper", 6).alias("upper"))
    )
