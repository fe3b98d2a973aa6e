"""URL filter by rules and by the reputation of hosts.

A rule decides where one fits. Elsewhere the host's share of bad pages does, as far as it is
known: outcomes of labelled pages are counted per host, registered domain and suffix, and each
level is shrunk towards the one above by a beta-binomial prior whose strength the spread among
its siblings sets (method of moments). A host is blocked if the lower bound of its posterior
share of bad pages is above a threshold, so a few bad pages alone do not condemn it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import stored

MOST_BAD = 0.25  # a host is blocked if its share of bad pages is surely above this
DEVIATIONS = 1.645  # distance of the bound from the posterior mean
STRENGTH = (1.0, 4.0, 1000.0)  # least, usual and most pages that a prior weighs as much as

# Suffixes of two labels below which anyone may register.
TWO_LABELS = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp",
    "or.jp", "com.br", "com.cn", "com.tr", "com.mx", "co.in", "co.kr", "co.za",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
IPV4 = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def registered(host: Column) -> tuple[Column, Column]:
    """``(domain, suffix)`` of a host without user, port and final dot.

    An address in numbers is its own domain and has an empty suffix, as has a single label.
    """
    site = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    site = F.regexp_replace(site, r"\.$", "")
    two = F.substring_index(site, ".", -2)
    three = F.substring_index(site, ".", -3)
    double = two.isin(*TWO_LABELS)
    whole = site.rlike(IPV4) | ~site.contains(".")
    domain = F.when(whole, site).when(double, three).otherwise(two)
    suffix = F.when(whole, F.lit("")).when(double, two).otherwise(F.substring_index(site, ".", -1))
    return domain, suffix


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]], as_verdict: bool) -> Column:
    """The longest rule that fits, or its verdict; null if none does.

    ``rules`` are (rule, verdict); a rule is a host and the start of a path. It fits its host
    and all subdomains. Of equally long ones the first in the list wins.
    """
    found = None
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        own, slash, start = rule.partition("/")
        inside = (host == own) | host.endswith("." + own)
        fits = inside & path.startswith(slash + start)
        value = F.lit(verdict if as_verdict else rule)
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("string") if found is None else found


def located(pages: DataFrame, rules: list[tuple[str, str]], url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``ruled`` (the verdict of the rule)."""
    host, path = F.col("host"), F.col("path")
    return (
        pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
        .withColumn("rule", fitting_rule(host, path, rules, False))
        .withColumn("ruled", fitting_rule(host, path, rules, True))
    )


def _shrunk(children: DataFrame, parents: DataFrame, parent: list[str], own: list[str]) -> DataFrame:
    """``children`` (keys, n, bad) with the posterior ``(mean, weight)`` below their parents' mean."""
    n, k = F.col("n").cast("double"), F.col("bad").cast("double")
    spread = children.groupBy(*parent).agg(
        F.sum("n").cast("double").alias("pn"),
        F.sum("bad").cast("double").alias("pk"),
        F.count(F.lit(1)).cast("double").alias("siblings"),
        F.sum(n * n).alias("squares"),
        F.sum(k * k / n).alias("within"),
    )
    p = F.col("pk") / F.col("pn")
    left = F.col("siblings") - 1
    # Share of the variance that lies between the siblings, from their spread around p.
    above = (F.col("within") - F.col("pk") * p) - p * (1 - p) * left
    below = p * (1 - p) * (F.col("pn") - F.col("squares") / F.col("pn") - left)
    least, usual, most = (F.lit(s) for s in STRENGTH)
    known = (left >= 1) & (below > 1e-9)
    strength = (
        F.when(~known, usual)
        .when(above <= 0, most)
        .otherwise(F.greatest(least, F.least(most, below / F.greatest(above, F.lit(1e-12)) - 1)))
    )
    priors = spread.select(*parent, strength.alias("strength")).join(
        parents.select(*parent, F.col("mean").alias("prior")), parent
    )
    weight = F.col("strength") + n
    return children.join(priors, parent).select(
        *own,
        ((F.col("strength") * F.col("prior") + k) / weight).alias("mean"),
        weight.alias("weight"),
    )


def reputations(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Posteriors per host, domain and suffix: keys, ``mean`` (of bad pages) and ``weight``.

    ``outcomes`` is ``(host, bad)`` with bad 0, 1 or null (not labelled). Every level keeps
    the keys that some labelled page has; the mean of all pages is where suffixes start from.
    """
    domain, suffix = registered(F.col("host"))
    hosts = stored(
        outcomes.where("bad is not null")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
        .withColumns({"domain": domain, "suffix": suffix}),
        "hosts",
    )
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = stored(domains, "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = stored(suffixes.withColumn("all", F.lit(0)), "suffixes")
    everything = suffixes.groupBy("all").agg(
        ((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("mean")
    )
    top = stored(_shrunk(suffixes, everything, ["all"], ["suffix"]), "suffix-reputations")
    middle = stored(_shrunk(domains, top, ["suffix"], ["suffix", "domain"]), "domain-reputations")
    low = _shrunk(hosts, middle, ["suffix", "domain"], ["host"])
    return stored(low, "host-reputations"), middle, top


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    most_bad: float = MOST_BAD,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """``(id, host, path, rule, verdict, bad_bound)`` per page.

    ``outcomes`` is ``(host, bad)`` of labelled pages. The verdict is that of the longest
    rule that fits, else ``block`` if ``bad_bound``, the lower bound of the share of bad pages
    of the host, is above ``most_bad``, else ``allow``. A host without labelled pages goes by its
    domain, its suffix, or if nothing is known is allowed with a null bound.

    A null url or one without ``://`` has an empty host and path. Repeated rows are judged
    alike; an empty table gives no rows; without outcomes only rules block. Other
    columns are not read.
    """
    low, middle, top = reputations(outcomes)
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    domain, suffix = registered(F.col("host"))
    found = located(named, rules, "url").withColumns({"domain": domain, "suffix": suffix})
    levels = [(low, ["host"]), (middle, ["suffix", "domain"]), (top, ["suffix"])]
    for number, (level, keys) in enumerate(levels):
        known = F.struct("mean", "weight").alias(f"known_{number}")
        found = found.join(level.select(*keys, known), keys, "left")
    known = F.coalesce(*[F.col(f"known_{i}") for i in range(len(levels))])
    spread = F.sqrt(known["mean"] * (1 - known["mean"]) / (known["weight"] + 1))
    bound = known["mean"] - deviations * spread
    verdict = F.when(bound > most_bad, F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("ruled", verdict).alias("verdict"),
        bound.alias("bad_bound"),
    )


# Words in host names that advertise rather than inform.
SPAM_WORDS = (
    "ads", "bet", "casino", "cheap", "viagra", "lottery", "payday", "pills", "poker", "porn",
    "replica", "spam", "track", "warez", "xxx",
)

# A page whose text is this rich in symbols is junk, as is one without text.
MARKUP = r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>|&[a-z]+;"
SYMBOLS = r"[^#*$%|]"
SPAM = r"(^|[^a-z0-9])(" + "|".join(SPAM_WORDS) + r")([^a-z0-9]|$)"


def page_outcomes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, bad)`` of pages: 1 for spam or junk, 0 for text, null where nothing was fetched.

    A page is spam if its host is named so. It is junk without text, or with more than 5
    symbols among 100 characters that are no space. Rules are policy and label nothing.
    """
    host = host_of(F.col(url_col))
    text = F.regexp_replace(html_col, MARKUP, " ")
    full = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]", ""))
    symbols = F.length(F.regexp_replace(text, SYMBOLS, ""))
    junk = ((full == 0) | (100 * symbols > 5 * full)).cast("int")
    return pages.select(host.alias("host"), F.when(host.rlike(SPAM), 1).otherwise(junk).alias("bad"))
