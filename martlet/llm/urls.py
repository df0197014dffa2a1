"""Url filter by empirical-Bayes host reputation (DataFrame functions only).

Labelled page outcomes are counted per host and summed up to registered
domain, suffix and the whole. Each level's good rate is shrunk towards the
posterior mean of the level above by a beta prior whose strength comes from
the spread between the groups of that level (method of moments). A host is
blocked when the upper posterior bound of its good rate is under
``MIN_GOOD``. Fixed rules (longest host + path first) override the method.

Every page is kept in the result. Defined cases: a null url or one without
``://`` has an empty host and path, fits no rule, and is judged by the counts
of the empty host like any other; hosts without labelled pages take the prior
of their domain; null outcomes are not counted; repeated pages are judged
alike; with no outcome at all the rate is taken as 1 and nothing is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (verdict, host, path); the longest host + path that fits wins.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: A host stays unless its good rate lies under this with the bound's confidence.
MIN_GOOD = 0.5
#: Standard deviations above the posterior mean at which the bound lies.
BOUND_SD = 1.64
#: Limits of a prior's strength, in pages.
PRIOR_PAGES = (1.0, 1000.0)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _under(host: Column, parent: str) -> Column:
    return (host == parent) | host.endswith("." + parent)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict), else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [
        F.when(
            _under(host, h) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        )
        for verdict, h, p in ordered
    ]
    return F.coalesce(*fits)


def registered_domain(host: Column) -> Column:
    """The last two labels of the host without user and port (whole host if fewer)."""
    return F.substring_index(_bare(host), ".", -2)


def host_suffix(host: Column) -> Column:
    return F.substring_index(_bare(host), ".", -1)


def _bare(host: Column) -> Column:
    return F.regexp_replace(host, r"^.*@|:[0-9]*$", "")


def _strength(groups: DataFrame) -> tuple[float, float]:
    """Overall good rate and prior strength of one level, from its (n, k) rows."""
    low, high = PRIOR_PAGES
    row = groups.agg(
        F.sum("n").alias("n"),
        F.sum("k").alias("k"),
        F.count(F.when(F.col("n") > 0, 1)).alias("g"),
        F.sum(F.when(F.col("n") > 0, F.col("k") * F.col("k") / F.col("n"))).alias("kk"),
    ).first()
    n, k = row["n"] or 0, row["k"] or 0
    if not n:
        return 1.0, low
    rate = k / n
    noise = rate * (1 - rate)
    spread = (row["kk"] - k * rate) / n - noise * row["g"] / n
    if noise <= 0 or spread <= 0:
        return rate, high
    return rate, min(high, max(low, noise / spread - 1))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, posterior mean, upper bound) from rows of (host, good 0/1 or null)."""
    hosts = outcomes.groupBy("host").agg(
        F.count("good").alias("n"), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("k")
    )
    hosts = hosts.withColumns({"domain": registered_domain(F.col("host")), "suffix": host_suffix(F.col("host"))})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    rate, m_suffix = _strength(suffixes)
    _, m_domain = _strength(domains)
    _, m_host = _strength(hosts)

    def shrunk(prior, m):
        return (F.col("k") + m * prior) / (F.col("n") + m)

    suffixes = suffixes.select("suffix", shrunk(F.lit(rate), m_suffix).alias("p_suffix"))
    domains = domains.join(suffixes, "suffix").select("domain", shrunk(F.col("p_suffix"), m_domain).alias("p_domain"))
    a = F.col("k") + m_host * F.col("p_domain")
    total = F.col("n") + m_host
    mean = a / total
    return hosts.join(domains, "domain").select(
        "host",
        mean.alias("good_rate"),
        (mean + BOUND_SD * F.sqrt(mean * (1 - mean) / (total + 1))).alias("good_bound"),
    )


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, min_good: float = MIN_GOOD) -> DataFrame:
    """Rows of ``pages`` as (page_id, host, path, rule, verdict, good_bound).

    ``outcomes``: (url, good) of labelled pages; good is 1, 0 or null.
    """
    seen = outcomes.select(url_host(F.col("url")).alias("host"), F.col("good"))
    bounds = host_reputation(seen).select("host", "good_bound")
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("good_bound") < min_good, "block").otherwise("allow")
    return (
        parsed.join(bounds, "host", "left")
        .withColumn("fit", fit)
        .select(
            "page_id",
            "host",
            "path",
            F.col("fit.rule").alias("rule"),
            F.coalesce("fit.verdict", own).alias("verdict"),
            "good_bound",
        )
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcome of each page: ``labels.quality`` of the document its url numbers.

    The number is the first run of digits that starts a path segment.
    """
    number = F.regexp_extract(url_path(F.col("url")), r"/([0-9]{1,18})", 1)
    numbered = pages.select("url", F.when(number != "", number).cast("long").alias("doc_id"))
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("good"))
    return numbered.join(good, "doc_id", "left").select("url", "good")


def judged_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``op10``: host, path, rule and verdict of every page."""
    return judge_urls(pages, page_outcomes(pages, labels)).drop("good_bound")
