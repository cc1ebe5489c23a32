"""URL filters: empirical-Bayes host reputation plus explicit host/path rules.

Labelled page outcomes (bad or not) are counted by host, registered domain and
suffix.  Each level is a beta-binomial whose prior mean is the posterior mean of
the level above and whose prior strength is estimated from the spread of the
level's rates (method of moments, each name counting alike, so that no large one sets it), up to ``max_strength``
pseudo-pages: with more, what is known of a level could outweigh any evidence on a host.  A host is blocked if the lower bound of its
posterior bad rate, mean - z * sd, reaches ``block_from``; unlabelled hosts fall
back to the prior of their domain.  Rules win over the method.

Defined results: a null url or one without ``://`` has an empty host and path, and
the empty host has a reputation like any other; repeated pages count as often as
they occur; with no labels at all every host has the assumed rate and nothing is blocked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsmith.llm.common import lower_az
from gridsmith.session import cut_lineage

URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: A host with more than one in HOT_SHARE of all pages (so fewer than HOT_SHARE hosts) is joined in SALTS parts.
HOT_SHARE, SALTS = 1000, 64

#: Registries' names under two-letter country domains: there hosts are registered below two labels (gov.uk, com.cn, co.in),
#: elsewhere below the last one.
SECOND_LEVEL = ("ac", "asn", "co", "com", "edu", "go", "gob", "gouv", "gov", "gv", "id", "ltd", "me", "mil", "ne", "net", "nhs",
                "nom", "or", "org", "plc", "sch")
TWO_LABELS = rf"(^|\.)({'|'.join(SECOND_LEVEL)})\.[a-z][a-z]$"


@dataclass(frozen=True)
class Params:
    z: float = 1.645
    block_from: float = 0.30
    #: Bad rate assumed with the weight of one page on top of all labelled ones.
    prior_rate: float = 0.1
    #: Bounds of the prior strength, in pseudo-pages.
    min_strength: float = 2.0
    max_strength: float = 50.0


def split_url(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path) of a url."""
    host = F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit(""))
    return lower_az(host), F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def with_domain(hosts: DataFrame) -> DataFrame:
    """Add ``suffix`` and ``domain`` (suffix and one label more) to rows with ``host``."""
    last = lambda n: F.substring_index("host", ".", -n)
    two = F.col("host").rlike(TWO_LABELS)
    return hosts.withColumns({"suffix": F.when(two, last(2)).otherwise(last(1)),
                              "domain": F.when(two, last(3)).otherwise(last(2))})


def strength(rows: DataFrame, p: Params) -> float:
    """Prior strength M = 1/rho - 1 from rows (n, k, prior): rho matches the squared deviations of the counts' rates
    from their prior means, sum (k/n - prior)^2, to their expectation under a beta-binomial,
    sum prior (1 - prior) (1/n + rho (1 - 1/n))."""
    v = F.col("prior") * (1 - F.col("prior"))
    got = rows.where("n > 0").agg(F.sum(F.pow(F.col("k") / F.col("n") - F.col("prior"), F.lit(2.0))).alias("s"),
                                  F.sum(v / F.col("n")).alias("v"), F.sum(v * (1 - 1 / F.col("n"))).alias("w")).first()
    if got["s"] is None or not got["w"]:
        return p.max_strength
    rho = (got["s"] - got["v"]) / got["w"]
    return min(p.max_strength, max(p.min_strength, 1 / rho - 1)) if rho > 0 else p.max_strength


def host_reputation(pages: DataFrame, outcomes: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per host of ``pages`` (page_id, host): pages, n, k, mean, bound.  ``outcomes``: (page_id, bad 0/1).

    Hosts are counted in one partial aggregate, so a hot host is collapsed before the shuffle; domains and
    suffixes are sums over the host table, which is cut from its lineage once.
    """
    bad = outcomes.where("page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = pages.join(bad, "page_id", "left").groupBy("host").agg(
        F.count("*").alias("pages"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    hosts = cut_lineage(with_domain(hosts))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total["k"] or 0) + p.prior_rate) / ((total["n"] or 0) + 1.0)

    def shrunk(rows: DataFrame) -> DataFrame:
        m = F.lit(strength(rows, p))
        a, b = F.col("k") + m * F.col("prior"), F.col("n") - F.col("k") + m * (1 - F.col("prior"))
        return rows.withColumn("mean", a / (a + b)).withColumn("sd", F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))))

    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    suffixes = shrunk(hosts.groupBy("suffix").agg(*counts).withColumn("prior", F.lit(overall)))
    domains = shrunk(hosts.groupBy("suffix", "domain").agg(*counts)
                     .join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix"))
    result = shrunk(hosts.join(domains.select("suffix", "domain", F.col("mean").alias("prior")), ["suffix", "domain"]))
    return result.select("host", "domain", "suffix", "pages", "n", "k", "mean", (F.col("mean") - p.z * F.col("sd")).alias("bound"))


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """For each host the rules (rule, verdict) whose host part is the host or a domain above it, as ``fitting``."""
    r = rules.select(F.substring_index("rule", "/", 1).alias("at"),
                     F.struct(F.length("rule").alias("n"), F.col("verdict").alias("v"), F.col("rule").alias("r"),
                              F.expr("substr(rule, instr(rule, '/'))").alias("p")).alias("one"))
    labels = F.split("host", r"\.")
    above = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(
        ".", F.slice(labels, i, F.size(labels))))).alias("at"))
    return above.join(r, "at").groupBy("host").agg(F.collect_list("one").alias("fitting"))


def judge(pages: DataFrame, reputation: DataFrame, rules: DataFrame, p: Params = Params()) -> DataFrame:
    """Rows (page_id, host, path) with ``rule`` (the longest that fits, else null), ``verdict`` and the host's figures.
    Equal rules with two verdicts: block wins.  Pages of hot hosts are dealt to ``SALTS`` tasks; the list of hot
    hosts has fewer than ``HOT_SHARE`` names."""
    known = reputation.join(rules_by_host(reputation.select("host"), rules), "host", "left")
    total = reputation.agg(F.sum("pages")).first()[0] or 0
    hot = [r.host for r in reputation.where(F.col("pages") * HOT_SHARE > total).select("host").collect()]
    part = F.when(F.col("host").isin(hot), F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS))).otherwise(F.lit(0)).cast("long")
    parts = F.when(F.col("host").isin(hot), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    pages = pages.withColumn("part", part)
    known = known.withColumn("part", F.explode(parts))
    fit = F.filter(F.col("fitting"), lambda x: F.col("path").startswith(x["p"]))
    best = F.array_max(F.transform(fit, lambda x: F.struct(x["n"], x["v"], x["r"])))
    return (pages.join(known, ["host", "part"], "left").withColumn("best", best)
            .select("page_id", "host", "path", F.col("best.r").alias("rule"),
                    F.coalesce("best.v", F.when(F.col("bound") >= p.block_from, "block").otherwise("allow")).alias("verdict"),
                    F.col("n").alias("n_labelled"), F.col("k").alias("n_bad"), F.round("mean", 6).alias("bad_rate"),
                    F.round("bound", 6).alias("bad_rate_bound")))


def url_filter(pages: DataFrame, outcomes: DataFrame, rules: DataFrame, p: Params = Params()) -> DataFrame:
    """Judge every page of ``pages`` (page_id, url); see the module."""
    host, path = split_url(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    return judge(pages, cut_lineage(host_reputation(pages.select("page_id", "host"), outcomes, p)), rules, p)
