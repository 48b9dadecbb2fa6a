"""URL filter by rules and by the reputation of hosts, from empirical-Bayes estimates.

Labelled pages are good or bad outcomes of their host. The share of bad pages of a suffix is shrunk
towards that of all pages, a registered domain's towards its suffix, and a host's towards its domain.
Each level has a beta-binomial prior: its mean is the parent's estimate, and its weight, the number
of pages it stands for, is found by the method of moments from the spread of the children around
their parents, within `WEIGHTS`. A url without a rule is blocked when the posterior of its host,
beta(a, b), puts the bad share above `LIMIT` with certainty: the lower bound, mean - `SPREAD`
standard deviations, exceeds it.

A suffix is the last label of a host, or a longer name under which many domains register: one with at least
`REGISTERED` names right below it that have hosts below themselves, as `co.uk` has. These are learned from all hosts, or
given as a table. The registered domain is the suffix and the label before it. An address of numbers and a
name of one label are their own domains, and addresses have the empty suffix. A host without labelled pages has the estimate
of its domain, suffix or all pages, the closest that is known. Null urls and urls without `://` have
the empty host and path, no rule, and are judged as a host of their own. Labels of unknown pages, null
outcomes and null ids count nothing. Rows are judged one by one, whatever the length of their urls; repeated rows stay, and
repeated outcomes count each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stage

#: Bad share from which a host is blocked.
LIMIT = 0.5
#: Standard deviations below the posterior mean.
SPREAD = 1.64
#: Least and largest weight of a prior, in pages.
WEIGHTS = (2.0, 1000.0)
#: Names with hosts below them that stand right below a suffix, at least.
REGISTERED = 20
ADDRESS = r"^[\d.]+$|^\["


@dataclass(frozen=True)
class Rule:
    verdict: str  # block or allow
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def host_of(url: str) -> Column:
    """Text between the first :// and the next / ? # or the end, A-Z in lower case."""
    raw = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def bare(host: Column) -> Column:
    """A host without user and port, and without dots at its end."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"(:\d*)?\.*$", "")


def names_above(hosts: DataFrame) -> DataFrame:
    """host, name, below: every name of two labels or more above a host, and the name right below it on the way to the host."""
    labels = F.split("bare", r"\.")
    n = F.size(labels)
    ways = hosts.withColumn("bare", bare(F.col("host"))).where(~F.col("bare").rlike(ADDRESS) & (n > 2))
    ways = ways.select("host", "bare", F.explode(F.sequence(F.lit(2), n - 1)).alias("k"))
    below = F.expr("substring_index(bare, '.', -k - 1)")
    return ways.select("host", F.expr("substring_index(bare, '.', -k)").alias("name"), below.alias("below"), (F.col("bare") != below).alias("deeper"))


def suffixes_of(hosts: DataFrame, registered: int = REGISTERED) -> DataFrame:
    """name: the suffixes of two labels or more that the hosts show."""
    return names_above(hosts).where("deeper").select("name", "below").distinct().groupBy("name").count().where(
        F.col("count") >= registered).select("name")


def with_domains(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Distinct hosts with their suffix, the longest that is known, and their registered domain."""
    known = names_above(hosts).join(suffixes.distinct(), "name").groupBy("host").agg(
        F.max(F.struct(F.length("name").alias("size"), "name", "below")).alias("up"))
    name = bare(F.col("host"))
    address = name.rlike(ADDRESS)
    return hosts.join(known, "host", "left").select(
        *hosts.columns,
        F.when(address, name).otherwise(F.coalesce("up.below", F.substring_index(name, ".", -2))).alias("domain"),
        F.when(address, "").otherwise(F.coalesce("up.name", F.substring_index(name, ".", -1))).alias("suffix"))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or null; a block wins among equally long ones."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def _shrunk(children: DataFrame, parents: DataFrame | float, parent: str = "") -> DataFrame:
    """Children with their posterior: prior mean from the parent, weight by the method of moments."""
    if isinstance(parents, float):
        both = children.withColumn("prior", F.lit(parents))
    else:
        both = children.join(parents.select(parent, F.col("mean").alias("prior")), parent)
    p = F.col("bad") / F.col("n")
    v = F.col("prior") * (1 - F.col("prior"))
    # Spread of the shares beyond that of counting: sum n (p - prior)^2 = sum v (1 + (n - 1) rho).
    moments = both.agg(
        F.sum(F.col("n") * (p - F.col("prior")) ** 2).alias("s"), F.sum(v).alias("v"), F.sum(v * (F.col("n") - 1)).alias("w"))
    weight = F.when(F.col("w") > 0, F.when(F.col("s") > F.col("v"), F.col("w") / (F.col("s") - F.col("v")) - 1).otherwise(WEIGHTS[1]))
    row = moments.select(F.least(F.greatest(F.coalesce(weight, F.lit(WEIGHTS[1])), F.lit(WEIGHTS[0])), F.lit(WEIGHTS[1]))).first()
    a, b = F.col("prior") * row[0] + F.col("bad"), (1 - F.col("prior")) * row[0] + F.col("n") - F.col("bad")
    return both.withColumn("mean", a / (a + b)).withColumn("deviation", F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))).drop("prior")


def counts(outcomes: DataFrame) -> DataFrame:
    """host, n, bad: labelled pages of each host; pages are counted here once, and all levels above sum these counts."""
    found = outcomes.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(F.count("bad").alias("n"), F.sum("bad").alias("bad"))
    return found.where("n > 0")


def estimate(hosts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, float]:
    """Posteriors of hosts, domains and suffixes, and the mean of all, from rows (host, domain, suffix, n, bad)."""
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    mean = (total[1] + 0.5) / (total[0] + 1.0) if total[0] else 0.0
    s = _shrunk(suffixes, mean)
    d = _shrunk(domains, s, "suffix")
    return _shrunk(hosts, d, "domain"), d, s, mean


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], url: str = "url", suffixes: DataFrame | None = None) -> DataFrame:
    """All rows of `pages` with host, path, rule, verdict, bad_share and lower_bound.

    `outcomes` has rows (host, bad); `suffixes` rows (name), learned from the hosts if not given. Columns of
    `pages` with the new names are replaced.
    """
    names = ["host", "path", "rule", "verdict", "bad_share", "lower_bound"]
    kept = pages.drop(*(c for c in pages.columns if c.lower() in names))
    # Each host is counted and judged once, then the verdict is joined to its pages.
    labelled = counts(outcomes)
    hosts = pages.select(host_of(url).alias("host")).distinct().join(labelled, "host", "full").select(
        "host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad"))
    hosts = stage(hosts, "url-hosts")
    hosts = stage(with_domains(hosts, suffixes_of(hosts) if suffixes is None else suffixes), "url-domains")
    level_1, level_2, level_3, mean = estimate(hosts.where("n > 0"))
    level = lambda df, key, n: df.select(key, F.col("mean").alias(f"m{n}"), F.col("deviation").alias(f"d{n}"))
    judged = (
        hosts.join(level(level_1, "host", 1), "host", "left").join(level(level_2, "domain", 2), "domain", "left")
        .join(level(level_3, "suffix", 3), "suffix", "left")
        .select("host", F.coalesce("m1", "m2", "m3", F.lit(mean)).alias("bad_share"), F.coalesce("d1", "d2", "d3", F.lit(0.5)).alias("_d"))
        .select("host", "bad_share", F.greatest(F.col("bad_share") - SPREAD * F.col("_d"), F.lit(0.0)).alias("lower_bound")))
    rows = kept.withColumn("host", host_of(url)).withColumn("path", path_of(url)).join(judged, "host", "left")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn(
        "verdict", F.coalesce(verdict, F.when(F.col("lower_bound") > LIMIT, "block").otherwise("allow")))
    return rows.select(*kept.columns, *names)
