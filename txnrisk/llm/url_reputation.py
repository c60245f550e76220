"""URL filter: rules first, then the reputation of the host.

Labelled page outcomes (bad or not) are counted by host, registered domain and
suffix. Each level's rate is a posterior mean under a beta prior around the
level above: suffix around the whole corpus, domain around its suffix, host
around its domain. The weight of each prior is estimated from the data by
moments of the beta-binomial. A host is blocked when the lower bound of its
posterior bad rate exceeds a limit, so a few bad pages alone block nothing.
All of it is DataFrame expressions.

Defined results: a null url and one without ``://`` have an empty host and
path, which is a host like any other; hosts without outcomes take the rate
of what is above them; with no outcomes at all every url is allowed; repeated
rows count each; an empty table gives an empty result; columns beyond those
named are not looked at.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.tables import stored

#: A host whose bad rate is above this, with the given confidence, is blocked.
MOST_BAD = 0.5
Z = 1.645
#: Bounds of a prior's weight, in pages.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1000.0

# The rules, as (verdict, rule); a rule is a host and the begin of a path.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
# Public suffixes of two labels; any other suffix is the last label.
LONG_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """The registered domain and its suffix; user, port and a last dot are left out."""
    bare = F.regexp_replace(host, r"^.*@|:[0-9]*$|\.$", "")
    two = F.substring_index(bare, ".", -2)
    long = two.isin(*LONG_SUFFIXES)
    suffix = F.when(long, two).otherwise(F.substring_index(bare, ".", -1))
    return F.when(long, F.substring_index(bare, ".", -3)).otherwise(two), suffix


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, _, begin = self.text.partition("/")
        inside = (host == name) | host.endswith(f".{name}")
        return inside & path.startswith(f"/{begin}")


def ruled(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null. Of equally long ones, the
    one with the longer host wins, then a blocking one."""
    listed = sorted(
        (Rule(*r) for r in rules),
        key=lambda r: (-len(r.text), -len(r.text.partition("/")[0]), r.verdict != "block"),
    )
    text = verdict = F.lit(None).cast("string")
    for rule in reversed(listed):
        fits = rule.fits(host, path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _weight(level: DataFrame, n: str, k: str, above: str) -> Column:
    """How many pages the prior of a level counts for, by moments of the beta-binomial.

    Squared deviations beyond those of a binomial tell how much the groups
    differ: their share rho is 1 / (1 + weight).
    """
    p = F.col(above)
    noise = F.col(n) * p * (1 - p)
    excess = F.sum(F.pow(F.col(k) - F.col(n) * p, F.lit(2.0)) - noise)
    # Groups that differ no more than a binomial's do give no rho, and the largest weight.
    weight = F.when(excess > 0, F.sum(noise * (F.col(n) - 1)) / excess - 1)
    bounded = F.greatest(F.lit(LEAST_WEIGHT), F.least(F.lit(MOST_WEIGHT), weight))
    return F.coalesce(bounded, F.lit(MOST_WEIGHT))


def _shrunk(level: DataFrame, n: str, k: str, above: str, name: str) -> tuple[DataFrame, float]:
    """The level's posterior mean as a column, and its prior's weight: one number of the driver's."""
    weight = level.agg(_weight(level, n, k, above).alias("w")).first()["w"]
    mean = (F.col(k) + weight * F.col(above)) / (F.col(n) + weight)
    return level.withColumn(name, mean), weight


def reputation(counts: DataFrame, z: float = Z) -> DataFrame:
    """host, n_labelled, and ``low``, the lower bound of the posterior bad rate.

    ``counts`` has host, domain, suffix, n (labelled pages) and k (bad ones),
    one row for each host. Suffixes and domains are pre-aggregated from it.
    """
    total = counts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    rate = ((total["k"] or 0) + 1) / ((total["n"] or 0) + 2)
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    suffixes = counts.groupBy("suffix").agg(*sums).withColumn("above", F.lit(rate))
    suffixes, _ = _shrunk(suffixes, "n", "k", "above", "mean")
    domains = counts.groupBy("suffix", "domain").agg(*sums)
    domains = domains.join(suffixes.select("suffix", F.col("mean").alias("above")), "suffix")
    domains, _ = _shrunk(domains, "n", "k", "above", "mean")
    hosts = counts.join(domains.select("domain", "suffix", F.col("mean").alias("above")), ["domain", "suffix"])
    hosts, weight = _shrunk(hosts, "n", "k", "above", "mean")
    size = F.col("n") + weight
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))
    return hosts.select("host", F.col("n").alias("n_labelled"), (F.col("mean") - z * deviation).alias("low"))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: tuple = RULES, most_bad: float = MOST_BAD
) -> DataFrame:
    """page_id, host, path, rule, verdict and n_labelled, one row for each page.

    ``outcomes`` has ``page_number`` (the number that ends a url's path) and
    ``bad``, one row for each number. Hosts are counted before any join by host,
    and a host's row is joined to its pages with Spark's handling of skewed keys.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    number = F.regexp_extract("path", r"/([0-9]+)(?:\.html|/)?$", 1).try_cast("long")
    known = outcomes.select("page_number", F.col("bad").cast("long").alias("bad"))
    labelled = parsed.select("host", number.alias("page_number")).join(known, "page_number", "left")
    domain, suffix = domain_and_suffix(F.col("host"))
    counts = stored(
        labelled.groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
        .withColumns({"domain": domain, "suffix": suffix}),
        "hosts",
    )
    standing = stored(reputation(counts), "reputation")
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("low") > most_bad, "block").otherwise("allow")
    return parsed.join(standing, "host").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, own).alias("verdict"), "n_labelled",
    )


def outcomes_of(labels: DataFrame) -> DataFrame:
    """A document is bad if any of its labels says low quality or toxic; without either, it has no row."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return (
        labels.groupBy(F.col("doc_id").alias("page_number"))
        .agg(F.max(F.coalesce(bad, F.when(F.coalesce("quality", "toxic").isNotNull(), F.lit(False)))).alias("bad"))
        .filter("bad is not null and page_number is not null")
    )
