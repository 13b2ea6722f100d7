"""URL filter by empirical-Bayes host reputation, DataFrame functions only.

Labelled page outcomes are counted per host.  A host's share of good pages
has a beta prior around its registered domain's share, which has one around
its suffix's, which has one around the share of all pages.  How strongly
each level is drawn to the level above is estimated from the data: the
beta-binomial's within-group correlation, from the spread between groups.
A page is allowed if a lower bound of its host's posterior is high enough.
Rules for parts of sites come before the reputation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A level's prior weighs as much as this many labelled pages: the least, the most, and where it cannot be told.
PRIOR_LEAST, PRIOR_MOST, PRIOR_UNKNOWN = 1.0, 10_000.0, 20.0

# Suffixes of several labels under which anyone registers names; what is not here has one label.
PUBLIC_SUFFIXES = tuple("""ac.jp ac.kr ac.nz ac.uk ac.za appspot.com blogspot.com cloudfront.net co.id co.il co.in co.jp co.kr
    co.nz co.th co.uk co.za com.ar com.au com.br com.cn com.co com.eg com.hk com.mx com.my com.ng com.pe com.ph com.pk com.sa
    com.sg com.tr com.tw com.ua com.vn edu.au edu.br edu.cn edu.hk edu.mx edu.tw fly.dev github.io gitlab.io go.id go.jp go.kr
    gob.ar gob.mx gov.au gov.br gov.cn gov.in gov.uk gov.za govt.nz herokuapp.com ltd.uk me.uk ne.jp net.au net.br net.cn net.in
    net.nz net.uk netlify.app nhs.uk nom.br or.jp or.kr org.ar org.au org.br org.cn org.il org.in org.mx org.nz org.tw org.uk
    org.za pages.dev plc.uk sch.uk vercel.app web.app wordpress.com""".split())
IP_ADDRESS, IP_SUFFIX = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\])$", "[ip]"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the pages of ``host`` and its subdomains whose path starts with ``path``."""
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], verdict: bool = False) -> Column:
    """Name (or verdict) of the longest rule that fits, else null.  Rules of one name: the first."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):  # longest last: it is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.verdict if verdict else r.name)).otherwise(out)
    return out


def domain_levels(host: Column, suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """Public suffix and registered domain of a host without its port.

    The suffix is the longest of ``suffixes`` that the host ends with, else
    its last label; the registered domain has one label more.  A host of one
    label is its own suffix and domain.  An IP address is its own domain,
    and all of them have the suffix ``IP_SUFFIX``.
    """
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    suffix = F.substring_index(bare, ".", -1)
    domain = F.substring_index(bare, ".", -2)
    for s in sorted(suffixes, key=len):
        ends = (bare == s) | bare.endswith("." + s)
        suffix = F.when(ends, F.lit(s)).otherwise(suffix)
        domain = F.when(ends, F.substring_index(bare, ".", -(s.count(".") + 2))).otherwise(domain)
    address = bare.rlike(IP_ADDRESS)
    return F.when(address, F.lit(IP_SUFFIX)).otherwise(suffix), F.when(address, bare).otherwise(domain)


def _prior_weights(groups: DataFrame) -> DataFrame:
    """Per ``level``: pages that its prior weighs as much as.

    ``groups``: ``level``, ``n`` and ``good`` of each labelled group.  From
    the mean squares between and within groups follows the within-group
    correlation ``rho`` of the beta-binomial; the prior's weight is
    ``1 / rho - 1``, the larger the more alike the groups are.
    """
    per_page = F.col("good") * F.try_divide("good", "n")
    sums = groups.groupBy("level").agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").cast("double").alias("total"), F.sum("good").alias("hits"),
        F.sum(F.col("n") * F.col("n")).alias("squares"), F.sum(per_page).alias("s"))
    total, g = F.col("total"), F.col("g")
    mean = F.try_divide("hits", "total")
    between = F.try_divide(F.col("s") - total * mean * mean, g - 1)
    within = F.try_divide(F.col("hits") - F.col("s"), total - g)
    usual = F.try_divide(total - F.try_divide("squares", "total"), g - 1)
    rho = F.try_divide(between - within, between + (usual - 1) * within)
    told = (g > 1) & (total > g) & (between + (usual - 1) * within > 0)
    weight = F.when(~told, F.lit(PRIOR_UNKNOWN)).when(rho <= 0, F.lit(PRIOR_MOST)).otherwise(
        F.least(F.greatest(F.try_divide(F.lit(1.0), rho) - 1, F.lit(PRIOR_LEAST)), F.lit(PRIOR_MOST)))
    return sums.select("level", weight.alias("k"))


def host_reputation(outcomes: DataFrame, hosts: DataFrame, z: float = 1.645,
                    suffixes: Sequence[str] = ()) -> DataFrame:
    """One row per host of ``hosts`` (column ``host``, distinct): ``host``,
    ``n_labels``, ``n_good``, ``mean`` and ``bound`` of its posterior.

    ``outcomes``: ``host`` and ``good`` (boolean), a row per labelled page;
    null outcomes do not count.  ``bound`` is the posterior mean less ``z``
    standard deviations, 0 at least.  A host without labels has its prior.
    Without any label the overall share counts as one half.
    """
    per_host = (outcomes.where(F.col("good").isNotNull()).groupBy("host")
                .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("good")))
    suffix, domain = domain_levels(F.col("host"), suffixes)
    known = materialise(hosts.join(per_host, "host", "left").na.fill(0, ["n", "good"])
                        .select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "good"), "hosts")
    # one row per host: the levels above are sums over hosts, not over pages
    grouped = known.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    tops = grouped.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    groups = (known.select(F.lit("host").alias("level"), "n", "good")
              .unionByName(grouped.select(F.lit("domain").alias("level"), "n", "good"))
              .unionByName(tops.select(F.lit("suffix").alias("level"), "n", "good")).where(F.col("n") > 0))
    # a row per level: three weights
    weights = _prior_weights(groups).agg(F.map_from_entries(F.collect_list(F.struct("level", "k"))).alias("k")).scalar()
    overall = tops.agg(F.sum("good").cast("double") / F.nullif(F.sum("n"), F.lit(0))).scalar()

    def shrunk(level: str, prior: Column) -> Column:
        k = F.coalesce(F.try_element_at(weights, F.lit(level)), F.lit(PRIOR_UNKNOWN))
        return (F.col("good") + k * prior) / (F.col("n") + k)
    tops = tops.select("suffix", shrunk("suffix", F.coalesce(overall, F.lit(0.5))).alias("p_suffix"))
    grouped = grouped.join(tops, "suffix").select(
        "domain", "suffix", shrunk("domain", F.col("p_suffix")).alias("p_domain"),
        F.coalesce(F.try_element_at(weights, F.lit("host")), F.lit(PRIOR_UNKNOWN)).alias("k_host"))
    a = F.col("good") + F.col("k_host") * F.col("p_domain")
    size = F.col("n") + F.col("k_host")
    mean = a / size
    deviation = F.sqrt(mean * (1 - mean) / (size + 1))
    return (known.join(grouped, ["suffix", "domain"])
            .select("host", F.col("n").alias("n_labels"), F.col("good").alias("n_good"), mean.alias("mean"),
                    F.greatest(mean - z * deviation, F.lit(0.0)).alias("bound")))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = (), page_id: str = "page_id",
                url: str = "url", label_id: str = "doc_id", good: Column | None = None, threshold: float = 0.5,
                z: float = 1.645, suffixes: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``,
    ``rule``, ``verdict``, ``n_labels``, ``n_good``, ``bound``.

    ``labels`` names pages by ``label_id``; ``good`` (default: quality 1 and
    not toxic) tells a page's outcome, null for none.  The verdict is the
    rule's, else ``allow`` if the host's posterior bound is at least
    ``threshold``, else ``block``.  A url that is null or has no ``://`` has
    the empty host, which has a reputation like any other.  Null ids have no
    label; an id labelled twice counts twice; repeated rows get the same
    answer.  Very long urls are read whole.  Without any labels all hosts
    count as one half; an empty table of pages gives no rows.  Other columns
    are not looked at.

    Only ids and urls are read.  Pages are counted per host before anything
    is joined, so a host with a third of all pages is one row there.
    """
    good = (F.col("quality") == 1) & (F.col("toxic") == 0) if good is None else good
    h, p = host_of(F.col(url).cast("string")), path_of(F.col(url).cast("string"))
    sites = pages.select(F.col(page_id).alias("page_id"), h.alias("host"), p.alias("path"))
    outcomes = sites.join(labels.select(F.col(label_id).alias("page_id"), good.alias("good")), "page_id")
    reputation = host_reputation(outcomes.select("host", "good"), sites.select("host").distinct(), z, suffixes)
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    by_rule = matching_rule(F.col("host"), F.col("path"), rules, verdict=True)
    by_host = F.when(F.col("bound") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    return sites.join(reputation, "host").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(by_rule, by_host).alias("verdict"),
        "n_labels", "n_good", F.round("bound", 6).alias("bound"))
