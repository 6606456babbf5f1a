"""URL filter by rules and, where none fits, by the reputation of the host.

Labelled outcomes of a host's pages are few, so its rate of bad ones is drawn towards that
of its registered domain, this one's towards its suffix, and that towards all pages:
beta-binomial priors whose weight is fitted from how much hosts (domains, suffixes) differ
beyond chance. A host is blocked only if even a low bound of its rate is beyond the limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..sources.workspace import materialize


class Rule(NamedTuple):
    """``verdict`` (allow or block) for a host, all its subdomains, and paths that start so."""

    verdict: str
    host: str
    path: str = "/"


#: Before any outcome, one page in ten is taken to be bad, with the weight of ten pages.
PRIOR_BAD, PRIOR_PAGES = 1.0, 10.0
#: A host goes if its rate lies above this with its mean so many standard deviations higher.
LIMIT, DEVIATIONS = 0.5, 2.0
#: Correlation of outcomes within a host (domain, suffix): the least and the most that is fitted.
LEAST_CORRELATION, MOST_CORRELATION = 0.001, 0.5
_LEVELS = ("suffix", "domain", "host")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next of ``/?#``, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host, ".", -1)


def domain_of(host: Column) -> Column:
    """The last two labels of a host: the name that was registered under its suffix."""
    return F.substring_index(host, ".", -2)


def _mean(bad: Column | str, pages: Column | str, prior: Column, weight: Column) -> Column:
    return (F.col(bad) + prior * weight) / (F.col(pages) + weight)


def _weight(level: DataFrame) -> float:
    """Pages that the parent's rate (``prior``) counts for, by the method of moments.

    With a correlation c within a group of n pages, n (rate - prior)^2 / (prior (1 - prior))
    is 1 + (n - 1) c on average. One row comes to the driver.
    """
    n, bad, prior = F.col("pages"), F.col("bad"), F.col("prior")
    surplus = F.pow(bad - n * prior, 2) / (n * prior * (1 - prior)) - 1
    found = level.filter(n > 0).agg(F.sum(surplus).alias("over"), F.sum(n - 1).alias("more")).first()
    correlation = found["over"] / found["more"] if found["more"] else 0.0
    return 1 / min(MOST_CORRELATION, max(LEAST_CORRELATION, correlation)) - 1


def reputations(hosts: DataFrame) -> DataFrame:
    """``hosts`` (host, pages, bad; one row per host) with rate and bound.

    ``rate`` is the mean of the host's posterior, ``bound`` that less ``DEVIATIONS`` of its
    standard deviations, which leaves at most a fifth of the posterior below it whatever
    its shape, and about a fortieth where it is near normal. Hosts without outcomes get
    their domain's rate. The empty host has the empty domain and suffix.
    """
    counts = {"host": hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})}
    sums = [F.sum(c).alias(c) for c in ("pages", "bad")]
    counts["domain"] = materialize(counts["host"].groupBy("domain", "suffix").agg(*sums), "domains")
    counts["suffix"] = materialize(counts["domain"].groupBy("suffix").agg(*sums), "suffixes")
    total = counts["suffix"].agg(*[F.coalesce(s, F.lit(0)).alias(c) for s, c in zip(sums, ("pages", "bad"))]).first()
    overall = (total["bad"] + PRIOR_BAD) / (total["pages"] + PRIOR_PAGES)
    above = None
    for name in _LEVELS:
        level = counts[name]
        if above is None:
            level = level.withColumn("prior", F.lit(overall))
        else:
            parent = above.columns[0]
            level = lookup_join(level, above.withColumnRenamed("rate", "prior"), parent)
        weight = _weight(level)
        rate = _mean("bad", "pages", F.col("prior"), F.lit(weight))
        level = level.withColumns({"rate": rate, "_weight": F.col("pages") + F.lit(weight)})
        above = level.select(name, "rate")
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("_weight") + 1))
    return level.withColumn("bound", F.col("rate") - DEVIATIONS * deviation).select("host", "pages", "bad", "rate", "bound")


def _rules_by_host(hosts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(host, fitting): the rules of a host and of all that it is a subdomain of.

    Rules meet the suffixes of distinct hosts, so their number doesn't touch the pages' plan.
    """
    spark = hosts.sparkSession
    schema = "verdict string, at string, path string"
    given = spark.createDataFrame([tuple(r) for r in rules], schema).withColumn("rule", F.concat("at", "path"))
    order = F.struct((-F.length("rule")).alias("a"), (-F.length("at")).alias("b"), (F.col("verdict") != "block").alias("c"))
    by_name = given.groupBy("at").agg(F.collect_list(F.struct(order.alias("order"), "path", "rule", "verdict")).alias("of_name"))
    labels = F.split("host", r"\.")
    names = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."),
    )
    met = lookup_join(hosts.select("host", F.explode(names).alias("at")), by_name, "at", how="inner")
    return met.groupBy("host").agg(F.array_sort(F.flatten(F.collect_list("of_name"))).alias("fitting"))


def judged(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], *, limit: float = LIMIT, keep: Sequence[str] = ("page_id",)
) -> DataFrame:
    """One row per row of ``pages`` (url, document and ``keep``): its verdict.

    Columns: ``keep``, host, path, rule (the longest that fits; of equally long ones that of
    the longer host, then block), verdict (the rule's, else block if the host's bound is over
    ``limit``, else allow), pages and bad (labelled documents of the host, and bad ones).
    ``outcomes``: document, bad (boolean); a document is bad if any of its rows says so, rows
    with NULL say nothing. A document counts once per host however often its page is
    repeated. A NULL url, or one without ``://``, has an empty host and path; no rule fits it
    and all such rows are judged together as one host. No pages give no rows; without
    outcomes no host is blocked. Other columns aren't read.
    """
    read = pages.select(*keep, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("document"))
    seen = read.filter(F.col("document").isNotNull()).select("host", "document").distinct()
    known = (
        outcomes.filter(F.col("bad").isNotNull() & F.col("document").isNotNull())
        .groupBy("document")
        .agg(F.max(F.col("bad").cast("int")).alias("bad"))
    )
    evidence = (
        lookup_join(seen, materialize(known, "outcomes"), "document", how="inner")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("pages"), F.sum("bad").alias("bad"))
    )
    nothing = read.select("host", F.lit(0).cast("long").alias("pages"), F.lit(0).cast("long").alias("bad"))
    hosts = evidence.unionByName(nothing.distinct()).groupBy("host").agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))
    hosts = materialize(hosts, "hosts")
    judged_hosts = reputations(hosts).join(_rules_by_host(hosts, rules), "host", "left")
    table = materialize(
        judged_hosts.select(
            "host", "pages", "bad", F.when(F.col("bound") > limit, "block").otherwise("allow").alias("by_host"), "fitting"
        ),
        "judged-hosts",
    )
    found = lookup_join(read.drop("document"), table, "host")
    fits = F.filter("fitting", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.get(F.coalesce(fits, F.array()), F.lit(0))
    return found.select(
        *keep,
        "host",
        "path",
        best["rule"].alias("rule"),
        F.coalesce(best["verdict"], "by_host").alias("verdict"),
        "pages",
        "bad",
    )
