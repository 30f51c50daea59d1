"""URL filtering by rules and by an empirical-Bayes reputation of hosts.

Labelled page outcomes (bad or not) are counted by host, registered domain and suffix. The
bad share of a host is shrunk towards that of its domain, the domain's towards its suffix,
the suffix's towards all pages, each by a beta-binomial prior whose strength is estimated
from the spread of that level's groups. A host is blocked when the lower bound of its
posterior (mean less ``z`` deviations) is above ``max_bad``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import saved

#: Bounds of a prior's strength in pages.
STRENGTHS = (2.0, 1000.0)


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; ``lower`` would change other letters too."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and
    path (from there up to ``?``, ``#`` or the end); both empty without a ``://`` or url."""
    cut = F.when(F.coalesce(F.locate("://", url), F.lit(0)) > 0,
                 F.substr(url, F.locate("://", url) + 3)).otherwise("")
    return (lower_ascii(F.regexp_extract(cut, r"^[^/?#]*", 0)),
            F.regexp_extract(cut, r"^[^/?#]*([^?#]*)", 1))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule (host and path prefix) that fits, and its verdict; null if none. A
    rule fits its host and all subdomains, on paths that start with its path."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found, verdict = F.when(fits, text).otherwise(found), F.when(fits, says).otherwise(verdict)
    return found, verdict


def domain_and_suffix(host: Column, suffixes: list[str]) -> tuple[Column, Column]:
    """Registered domain and suffix of a host: the suffix is the longest listed one it ends
    with, else its last label; the domain has one label more, if the host has. A port is
    left out."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    suffix = F.regexp_extract(name, r"[^.]*$", 0)
    for s in sorted(suffixes, key=len):
        suffix = F.when((name == s) | name.endswith(f".{s}"), s).otherwise(suffix)
    above = F.substr(name, F.lit(1), F.greatest(F.length(name) - F.length(suffix) - 1, F.lit(0)))
    label = F.regexp_extract(above, r"[^.]*$", 0)
    return F.when(above == "", name).otherwise(F.concat(label, F.lit("."), suffix)), suffix


def _strength(groups: DataFrame, share: Column, level: str) -> DataFrame:
    """One row: the strength of the beta prior over the groups' bad shares (``n``, ``bad``), by
    the moments of the beta-binomial; the upper bound if they spread no more than chance."""
    low, high = STRENGTHS
    n = F.sum("n")
    spread = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - share, 2))
    free = F.count("*") - 1
    rho = F.try_divide(F.try_divide(spread, F.max(share * (1 - share))) - free,
                       n - F.try_divide(F.sum(F.col("n") * F.col("n")), n) - free)
    return groups.where("n > 0").agg(F.when(rho > 0, F.greatest(
        F.lit(low), F.least(F.lit(high), 1 / rho - 1))).otherwise(high).alias(level))


def host_reputation(hosts: DataFrame, z: float = 1.0) -> DataFrame:
    """``host`` with ``mean`` and ``lower`` of its posterior bad share, from ``hosts`` (``host``,
    ``domain``, ``suffix``, ``n`` labelled pages, ``bad`` of them; unique hosts)."""
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    zones = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # the share of all pages, with half a page of either outcome added
    root = zones.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5)
                      / (F.coalesce(F.sum("n"), F.lit(0)) + 1.0)).alias("root"))
    root = saved(root, "root")
    share = root.scalar()
    strengths = {level: saved(_strength(groups, share, level), "strength").scalar()
                 for level, groups in (("zone", zones), ("domain", domains), ("host", hosts))}

    def shrunk(level, prior):
        return (F.col("bad") + strengths[level] * prior) / (F.col("n") + strengths[level])

    zones = zones.select("suffix", shrunk("zone", share).alias("zone_mean"))
    domains = domains.join(zones, "suffix").select(
        "suffix", "domain", shrunk("domain", F.col("zone_mean")).alias("domain_mean"))
    posterior = hosts.join(domains, ["suffix", "domain"]).select(
        "host", "n", shrunk("host", F.col("domain_mean")).alias("mean"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + strengths["host"] + 1))
    return posterior.select("host", "mean", (F.col("mean") - z * deviation).alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]] = (),
               suffixes: list[str] = (), id_col: str = "page_id", url_col: str = "url",
               z: float = 1.0, max_bad: float = 0.3) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``mean`` and
    ``lower`` of every row. ``outcomes`` has ``id_col`` and ``bad`` (boolean).

    The longest fitting rule decides; else the reputation of the host. A host without
    labelled pages has its domain's reputation, an empty host (null or odd url) is a host
    like any other. Outcomes without a page, with a null id or null ``bad``, count nothing;
    of several outcomes of a page one bad one makes it bad. Rows of one id all count. Other
    columns are ignored. With no outcomes at all every host has a mean of one half, and a
    lower bound below it.

    Pages are counted by host before anything is joined, so a hot host is one row; the last
    join, host to pages, is an equi-join whose hot side Spark splits.
    """
    host, path = host_and_path(F.col(url_col))
    judged = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    outcomes = outcomes.where(F.col(id_col).isNotNull() & F.col("bad").isNotNull()) \
        .groupBy(id_col).agg(F.max("bad").alias("bad"))
    seen = judged.select(id_col, "host").join(outcomes, id_col, "left")
    domain, suffix = domain_and_suffix(F.col("host"), list(suffixes))
    hosts = seen.groupBy("host").agg(F.count("bad").alias("n"),
                                     F.count(F.when(F.col("bad"), 1)).alias("bad"))
    hosts = saved(hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"),
                  "hosts")
    known = saved(host_reputation(hosts, z), "reputation")
    rule, says = matching_rule(F.col("host"), F.col("path"), list(rules))
    by_host = F.when(F.col("lower") > max_bad, "block").otherwise("allow")
    return judged.join(known, "host").select(
        id_col, "host", "path", rule.alias("rule"), F.coalesce(says, by_host).alias("verdict"),
        "mean", "lower")
