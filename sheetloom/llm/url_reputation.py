"""URL filters: rules first, then the reputation of a page's host by empirical Bayes.

Labelled pages are good or bad. The share of bad pages of a host is drawn towards that of its registered
domain, that one's towards its suffix, and that one's towards all: at each level the groups' shares follow a beta
distribution around their parent's mean, whose strength comes from the spread of the groups beyond
what chance gives (method of moments, beta-binomial). A host is blocked if the lower bound of
its posterior share, ``Z`` standard deviations below the mean, exceeds ``MAX_BAD``. A host without labelled pages has the
posterior of its domain, suffix or all.

Nulls and texts without ``://`` have an empty host and path, to which no rule applies and which are allowed. A host
with a trailing dot, a port or user information keeps them in ``host`` but not in its reputation. Repeated
rows are judged alike; of several labels of one page the worst counts, null labels are ignored, empty tables allow all that no rule
blocks. Only the columns named are read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_unique

# A rule is (verdict, host and all its subdomains, beginning of the path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")
Z = 1.645
MAX_BAD = 0.5
STRENGTHS = (1.0, 10_000.0)  # least and most pages that a parent's mean counts for
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def first_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else NULL."""
    text = verdict = F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        text, verdict = F.when(fits, own + start).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def levels_of(host: Column) -> tuple[Column, Column, Column]:
    """Host without port and user, its registered domain and its suffix."""
    bare = F.rtrim(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", ""), F.lit("."))
    two = F.substring_index(bare, ".", -2)
    suffix = F.when(two.isin(*SECOND_LEVEL), two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(two.isin(*SECOND_LEVEL), F.substring_index(bare, ".", -3)).otherwise(two)
    return bare, domain, suffix


def _strength(groups: DataFrame) -> float:
    """How many pages the parent's mean counts for, from ``(n, bad, mean)`` of all groups of a level."""
    p, spread = F.col("bad") / F.col("n"), F.col("mean") * (1 - F.col("mean"))
    row = groups.agg(
        F.sum(F.col("n") * (p - F.col("mean")) * (p - F.col("mean")) - spread).alias("beyond"),
        F.sum(spread * (F.col("n") - 1)).alias("room"),
    ).first()
    least, most = STRENGTHS
    share = (row["beyond"] or 0.0) / row["room"] if row["room"] else 0.0
    return min(max(1 / share - 1, least), most) if share > 0 else most


def host_reputation(pages: DataFrame, outcomes: DataFrame, key: str = "page_id", url: str = "url", bad: str = "bad") -> DataFrame:
    """``(host, n, bad, posterior_mean, lower_bound)`` for every host; ``outcomes`` has key and ``bad`` (boolean)."""
    site, domain, suffix = levels_of(host_of(F.col(url)))
    placed = pages.select(F.col(key).alias("page"), site.alias("site"), domain.alias("domain"), suffix.alias("suffix"))
    judged = outcomes.filter(F.col(bad).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("page")).agg(F.max(F.col(bad).cast("int")).alias("_bad"))
    hosts = placed.join(judged, "page", "left").groupBy("site", "domain", "suffix").agg(F.count("_bad").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    top = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)

    def posterior(groups: DataFrame, strength: float) -> DataFrame:
        return groups.withColumn("posterior", (F.col("bad") + F.col("mean") * strength) / (F.col("n") + strength))

    tops = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("mean", F.lit(top))
    tops = posterior(tops, _strength(tops.filter("n > 0")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(tops.select("suffix", F.col("posterior").alias("mean")), "suffix")
    domains = posterior(domains, _strength(domains.filter("n > 0")))
    sites = hosts.join(domains.select("domain", "suffix", F.col("posterior").alias("mean")), ["domain", "suffix"])
    strength = _strength(sites.filter("n > 0"))
    mean = F.col("posterior")
    deviation = F.sqrt(mean * (1 - mean) / (F.col("n") + strength + 1))
    return posterior(sites, strength).select(F.col("site"), "n", "bad", mean.alias("posterior_mean"), (mean - Z * deviation).alias("lower_bound"))


def judge(pages: DataFrame, outcomes: DataFrame, key: str = "page_id", url: str = "url", bad: str = "bad", rules=RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """``(key, host, path, rule, verdict, lower_bound)`` for every page; the bound is that of a blocked host."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    site, _, _ = levels_of(F.col("host"))
    judged = pages.select(F.col(key), host.alias("host"), path.alias("path")).withColumns({"rule": rule, "_verdict": verdict, "site": site})
    blocked = host_reputation(pages, outcomes, key, url, bad).filter((F.col("lower_bound") > max_bad) & (F.col("site") != "")).select("site", "lower_bound")
    found = join_unique(judged, blocked, "site")
    method = F.when(F.col("lower_bound").isNotNull(), "block").otherwise("allow")
    return found.select(key, "host", "path", "rule", F.coalesce("_verdict", method).alias("verdict"), "lower_bound")
