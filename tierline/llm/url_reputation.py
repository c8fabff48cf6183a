"""URL filter: empirical-Bayes host reputation with overriding rules.

Labelled pages are good or bad outcomes of their host. Hosts with few labels learn
from their registered domain, and domains from their suffix: each level's bad
rate is shrunk towards the level above by a beta-binomial prior whose mean is the
parent's posterior mean and whose strength is estimated from the spread of the
level's own rates (method of moments). A host is blocked when the lower bound of
its posterior, mean less ``Z`` standard deviations, lies above ``MOST_BAD``. Explicit
rules go before the estimate. Built from SQL functions only: every level is one
aggregation of counts, so a host with a third of all pages is summed map-side.

The suffix is the longest of a list of public suffixes that the host ends with, else
its last label; the registered domain is the suffix with one more label. The list is
a parameter of :func:`reputations`, as literals of a SQL expression.

Defined results: repeated rows are judged one by one, and a label counts as often as its row
is there; columns of the pages beside key and url are left out, whatever their names;
long urls are cut like any other. Urls that are null or without ``://`` have an empty host and path
and the reputation of unlabelled hosts; without any label nothing is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import staged

#: One-sided posterior bound in standard deviations (about 95 %), and the rate above which a host is blocked.
Z = 1.645
MOST_BAD = 0.5
#: Bounds of a prior's strength, in labels.
STRENGTH = (1.0, 1000.0)
#: Mean of the top prior in labels of weight one each.
TOP_PRIOR = (1.0, 1.0)

#: Public suffixes of more than one label under which unrelated sites register: the common ones.
PUBLIC_SUFFIXES: tuple[str, ...] = tuple(
    "co.uk org.uk me.uk ac.uk gov.uk com.au net.au org.au edu.au gov.au co.nz org.nz co.jp ne.jp or.jp ac.jp co.kr or.kr com.br"
    " net.br org.br com.cn net.cn org.cn com.hk com.tw com.sg com.my com.mx com.ar com.co com.pe com.tr com.ua com.pl co.in co.id"
    " co.il co.th co.za com.vn com.eg com.sa github.io gitlab.io blogspot.com wordpress.com herokuapp.com netlify.app vercel.app"
    " web.app firebaseapp.com pages.dev workers.dev appspot.com azurewebsites.net cloudfront.net s3.amazonaws.com"
    " blogspot.co.uk blogspot.com.au".split()
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path``) that fits, as a struct (rule, verdict); null where none does."""

    def fits(rule: str) -> Column:
        of, _, prefix = rule.partition("/")
        return ((host == of) | host.endswith("." + of)) & path.startswith("/" + prefix)

    ordered = sorted(rules, key=lambda r: (-len(r), r))
    if not ordered:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    struct = {r: F.struct(F.lit(r).alias("rule"), F.lit(rules[r]).alias("verdict")) for r in ordered}
    return F.coalesce(*(F.when(fits(r), struct[r]) for r in ordered))


def _level(counts: DataFrame, name: str, parent: str | None) -> DataFrame:
    return counts.groupBy(*([name, parent] if parent else [name])).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _strength(rows: DataFrame, mean: Column) -> DataFrame:
    """One row ``strength``: the prior's weight in labels, from how far the rates spread beyond chance.

    With rates r = bad/n around means m, the excess of n (r - m)^2 over m (1 - m)
    gives the share 1/(strength + 1) of the variance that lies between members.
    """
    chance = mean * (1 - mean)
    n, rate = F.col("n").cast("double"), F.col("bad") / F.col("n")
    excess = F.sum(F.when(n > 1, n * F.pow(rate - mean, 2) - chance))
    scale = F.sum(F.when(n > 1, (n - 1) * chance))
    share = F.coalesce(excess / F.nullif(scale, F.lit(0.0)), F.lit(0.0))
    low, high = STRENGTH
    value = F.when(share <= 1 / (high + 1), F.lit(high)).otherwise(F.greatest(F.lit(low), 1 / share - 1))
    return rows.agg(value.alias("strength"))


def _posterior(rows: DataFrame, prior: Column) -> DataFrame:
    """Add ``mean`` and ``weight`` of the posterior, shrunk to ``prior`` with the level's strength (one row)."""
    strength = _strength(rows, prior)
    joined = rows.join(F.broadcast(strength))  # exactly one row
    weight = F.col("n") + F.col("strength")
    return joined.withColumn("mean", (F.col("bad") + F.col("strength") * prior) / weight).withColumn("weight", weight)


def _suffix_labels(host: Column, suffixes: Sequence[str]) -> Column:
    """Number of labels of the host's longest suffix in the list; one where none fits."""
    by_labels: dict[int, list[str]] = {}
    for name in sorted({s.lower().strip(".") for s in suffixes} - {""}):
        by_labels.setdefault(name.count(".") + 1, []).append(name)
    fits = [F.when(F.substring_index(host, ".", -k).isin(by_labels[k]), k) for k in sorted(by_labels, reverse=True)]
    return F.coalesce(*fits, F.lit(1))


def _last_labels(host: Column, count: Column) -> Column:
    labels = F.split(host, "[.]")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - count, F.lit(0)) + 1, count), ".")


def registered_domain(host: Column, suffixes: Sequence[str] = ()) -> Column:
    return _last_labels(host, _suffix_labels(host, suffixes) + 1) if suffixes else F.substring_index(host, ".", -2)


def suffix(host: Column, suffixes: Sequence[str] = ()) -> Column:
    return _last_labels(host, _suffix_labels(host, suffixes)) if suffixes else F.substring_index(host, ".", -1)


def reputations(hosts: DataFrame, suffixes: Sequence[str] = ()) -> DataFrame:
    """(host, mean, bound) of every host in ``hosts`` (host, n labels, bad labels; any number of rows a host).

    ``mean`` is the posterior mean of the bad rate, ``bound`` its lower bound; ``suffixes``
    are public suffixes of more than one label.
    """
    counts = hosts.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    host = F.col("host")
    counts = counts.withColumn("domain", registered_domain(host, suffixes)).withColumn("suffix", suffix(host, suffixes))
    counts = staged(counts, "host-counts")  # one row a host; every level and strength comes from it
    a, b = TOP_PRIOR
    top = counts.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + a) / (F.coalesce(F.sum("n"), F.lit(0)) + a + b)).alias("top"))
    suffixes = _posterior(_level(counts, "suffix", None).join(F.broadcast(top)), F.col("top"))
    suffixes = suffixes.select(F.col("suffix").alias("s"), F.col("mean").alias("suffix_mean"))
    domains = _level(counts, "domain", "suffix").join(suffixes, F.col("suffix") == F.col("s"))
    domains = staged(domains, "domain-counts")
    domains = _posterior(domains, F.col("suffix_mean")).select(F.col("domain").alias("d"), F.col("mean").alias("domain_mean"))
    members = counts.join(domains, F.col("domain") == F.col("d"))
    members = _posterior(members, F.col("domain_mean"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return members.select("host", "mean", (F.col("mean") - Z * deviation).alias("bound"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: dict[str, str],
    page: str = "page_id",
    url: str = "url",
    most_bad: float = MOST_BAD,
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """(page, host, path, rule, verdict, bad_rate) of every row of ``pages``.

    ``outcomes`` (url, bad boolean) are labelled pages; rows with a null label count for nothing.
    """
    rows = pages.select(F.col(page).alias(page), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    labelled = outcomes.filter(F.col("bad").isNotNull()).select(
        url_host(F.col("url")).alias("host"), F.lit(1).cast("long").alias("n"), F.col("bad").cast("long").alias("bad")
    )
    everyone = rows.groupBy("host").agg(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    known = reputations(labelled.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).unionByName(everyone), suffixes)
    known = known.withColumnRenamed("host", "__host")
    found = rows.join(known, rows["host"] == F.col("__host"), "left")
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    estimate = F.when(F.col("bound") > most_bad, "block").otherwise("allow")
    return found.withColumn("__rule", rule).select(
        page,
        "host",
        "path",
        F.col("__rule.rule").alias("rule"),
        F.coalesce("__rule.verdict", estimate).alias("verdict"),
        F.col("mean").alias("bad_rate"),
    )


def any_bad(*flags: Column) -> Column:
    """Whether any of the outcomes is bad; null where all are null."""
    return reduce(lambda a, b: F.coalesce(a | b, a, b), flags)
