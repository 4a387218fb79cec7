"""URL filter: rules of hosts and paths first, then the reputation of hosts.

A rule names a host and the beginning of a path; it fits that host and its subdomains, and the
longest rule that fits decides. Rules are joined to the distinct hosts by host suffix, so a list
of millions of rules is no broadcast.

Where no rule fits, the outcomes of labelled pages decide. A host's share of good pages is
shrunk towards its registered domain's, that towards its suffix's, and that towards the
corpus's. The strength of each prior is the method-of-moments estimate of the beta-binomial
spread among the groups of that level. A page is blocked if the upper bound of its host's posterior is
below `MIN_GOOD`, so that a host without evidence is not blocked.

A NULL url or one without `://` has an empty host and path and is judged by the corpus alone. Hosts are
those of all pages, labelled or not; a page's outcome may be NULL. A host with a large part of all
pages is reduced by partial aggregates, and its verdict reaches its pages by broadcast. Repeated
rows count as often as they come. Rules of one length that fit are in the order of their text. Very long
urls meet only row-level functions; extra columns are not read. Empty tables give empty results; without any outcome everything
that no rule blocks is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.llm.common import Scratch, attach, hot_keys

MIN_GOOD = 0.6
# Standard deviations between a posterior mean and its bound.
BOUND = 1.645
# Prior strengths are kept within these limits, in pages.
WEAKEST, STRONGEST = 1.0, 10000.0
# Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "com.cn", "co.in",
    "co.jp", "ne.jp", "or.jp", "co.kr", "com.mx", "co.nz", "com.tr", "com.tw", "co.za",
)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    there = F.instr(url, "://") > 0
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(there, host).otherwise(""), F.when(there, path).otherwise("")


def _labels(host: Column) -> Column:
    return F.split(host, r"\.")


def suffix_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(two)


def _strength(groups: DataFrame) -> Column:
    """The prior strength that explains how far groups (n, good, parent) spread."""
    expected = F.col("parent") * (1 - F.col("parent"))
    excess = F.sum(F.pow(F.col("good") - F.col("n") * F.col("parent"), F.lit(2.0)) - F.col("n") * expected)
    room = F.sum(F.col("n") * (F.col("n") - 1) * expected)
    spread = F.try_divide(excess, room)
    k = F.when(spread > 0, 1 / spread - 1).otherwise(F.lit(STRONGEST))
    k = F.least(F.greatest(F.coalesce(k, F.lit(STRONGEST)), F.lit(WEAKEST)), F.lit(STRONGEST))
    return F.lit(groups.agg(k).first()[0])


def _shrunk(groups: DataFrame) -> DataFrame:
    return groups.withColumn("k", _strength(groups)).withColumn(
        "mean", (F.col("good") + F.col("k") * F.col("parent")) / (F.col("n") + F.col("k"))
    )


def reputations(hosts: DataFrame, scratch: Scratch, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """(host, n, good) to (host, reputation, low, high): posterior mean and bounds."""
    domain, suffix = domain_of(F.col("host"), suffixes), suffix_of(F.col("host"), suffixes)
    named = hosts.select("host", "n", "good", domain.alias("domain"), suffix.alias("suffix"))
    total = F.sum("good"), F.sum("n")
    corpus = named.agg(F.coalesce(F.try_divide(*total), F.lit(1.0))).first()[0]
    domains = named.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = scratch.save(domains, "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = scratch.save(suffixes.withColumn("parent", F.lit(corpus)), "suffixes")
    above = scratch.save(_shrunk(suffixes).select("suffix", F.col("mean").alias("parent")), "suffix-means")
    domains = scratch.save(domains.join(above, "suffix"), "domains-in-suffix")
    above = scratch.save(_shrunk(domains).select("domain", "suffix", F.col("mean").alias("parent")), "domain-means")
    groups = scratch.save(named.join(above, ["domain", "suffix"]), "hosts-in-domain")
    good = F.col("good") + F.col("k") * F.col("parent")
    size = F.col("n") + F.col("k")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))
    return _shrunk(groups).withColumn("mean", good / size).select(
        "host", F.col("mean").alias("reputation"),
        (F.col("mean") - BOUND * deviation).alias("low"), (F.col("mean") + BOUND * deviation).alias("high"),
    )


def with_outcomes(pages: DataFrame, shows: Column, outcomes: DataFrame, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """page_id, url and the outcome of the document that each page shows; `outcomes` has (shows, outcome).

    Pages that show none, which may be most, stay where they are, and a document shown by very many is broadcast.
    """
    scratch = Scratch(pages.sparkSession, "outcomes")
    rows = scratch.save(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), shows.alias("shows")), "rows")
    known = scratch.save(outcomes, "known")
    return attach(rows, known, "shows", scratch.save(hot_keys(rows, "shows"), "hot")).drop("shows")


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule_host string, rule_path string, verdict string")


def _fitting(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Per host the rules of its own name and the domains above it, longest first."""
    parts = _labels(F.col("host"))
    count = F.size(parts)
    above = F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(parts, k, count), "."))
    rule = F.struct(
        (-(F.length("rule_host") + F.length("rule_path"))).alias("short"),
        F.col("rule_path").alias("path"), F.concat("rule_host", "rule_path").alias("rule"), "verdict",
    )
    return (
        hosts.select("host", F.explode(above).alias("rule_host")).distinct()
        .join(rules, "rule_host")
        .groupBy("host").agg(F.sort_array(F.collect_set(rule)).alias("rules"))
    )


def judge(
    pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", outcome: str | None = None,
    suffixes: Sequence[str] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's reputation bound of every page.

    `outcome` names a column with 1 for a good page, 0 for a bad one, NULL where unknown. `suffixes`
    are the public suffixes of two labels; the default is a short list of common ones.
    """
    scratch = Scratch(pages.sparkSession, "url-filter")
    host, path = host_and_path(F.col(url))
    known = F.col(outcome).cast("int") if outcome else F.lit(None).cast("int")
    rows = scratch.save(pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), known.alias("good")), "pages")
    hosts = scratch.save(
        rows.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")), "hosts"
    )
    lookup = scratch.save(
        reputations(hosts, scratch, suffixes).select("host", "reputation", "high").join(_fitting(hosts, rules), "host", "left"), "lookup"
    )
    found = attach(rows, lookup, "host", scratch.save(hot_keys(rows, "host"), "hot"))
    fits = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    return found.withColumn("fit", fits).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(F.col("high") < MIN_GOOD, "block").otherwise("allow")).alias("verdict"),
        "reputation", "high",
    )
