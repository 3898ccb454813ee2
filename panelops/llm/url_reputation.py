"""URL filter: explicit rules first, then empirical-Bayes host reputation.

Labelled page outcomes (good or bad) are counted per host, per registered
domain and per suffix. A suffix is the last label, or the last two where they
are on the table of two-label suffixes (a parameter); a registered domain is a
suffix and the label before it. A numeric address is its own domain and
suffix. A port does not belong to the host here. Each level's share of
good pages is shrunk towards its parent with a beta-binomial prior:

    corpus:  Beta(1, 1) posterior mean of all outcomes
    suffix:  (good + m_s * corpus) / (n + m_s)
    domain:  (good + m_d * suffix) / (n + m_d)
    host:    Beta(good + m_h * domain, bad + m_h * (1 - domain))

The strengths m come from the data (``concentration``), and no prior is stronger
than the evidence and prior it was formed from, so a host of an unseen domain
stays uncertain however alike the hosts of seen domains are. A host is blocked when
even the upper end of its posterior (mean + z sd) stays below ``min_good`` and
its registered domain has outcomes: little evidence never blocks, and neither
does a suffix alone.

Defined cases: a null url, or one without ``://``, has empty host and path,
fits no rule and has no evidence of its own (it gets the corpus prior). Hosts
without labelled pages get their domain's (or suffix's, or the corpus')
posterior. An empty table gives no rows; of rules of equal length the one that
is first by name wins; urls of any length are looked at whole. Repeated rows count as often as they occur. Without any outcome
everything not blocked by a rule is allowed. Extra columns are ignored.

Scale: outcomes are pre-aggregated to one row per host before any further
step, so a host with a third of all pages is one row after the map-side
combine; the reputation join has one row per host on its right side and is
left to AQE (broadcast by run-time bytes, or split where a host is hot).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.session import cut_lineage


@dataclass(frozen=True)
class Rule:
    host: str
    path: str  # starts with "/"
    verdict: str  # "allow" or "block"

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


# Fixed values of the query contract.
CONTRACT_RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]

# Two-label suffixes below which anybody may register (a parameter).
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "org.uk", "plc.uk", "sch.uk",
    "com.au", "edu.au", "net.au", "org.au", "co.nz", "net.nz", "org.nz", "co.za", "org.za",
    "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "com.cn", "net.cn", "org.cn", "com.tw",
    "com.hk", "com.sg", "co.kr", "or.kr", "co.in", "net.in", "org.in", "com.br", "net.br",
    "org.br", "com.ar", "com.mx", "com.tr", "com.ua", "com.pl", "co.il", "co.id", "co.th",
)
MIN_GOOD = 0.5
Z = 1.645
MIN_CONCENTRATION, MAX_CONCENTRATION = 2.0, 1000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of ``url``; both empty where it is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise(
        F.lit("")
    )
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    after_host = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, upper, lower), F.regexp_extract(after_host, r"\A([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    hit = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(ordered):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        hit = F.when(
            fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        ).otherwise(hit)
    return hit


def without_port(host: Column) -> Column:
    return F.regexp_replace(host, r":[0-9]*\z", "")


def _is_address(name: Column) -> Column:
    return name.rlike(r"\A[0-9]+(\.[0-9]+){3}\z") | name.startswith("[")


def suffix_of(host: Column, suffixes=SUFFIXES) -> Column:
    name = without_port(host)
    two = F.substring_index(name, ".", -2)
    return F.when(_is_address(name), name).when(two.isin(*suffixes), two).otherwise(
        F.substring_index(name, ".", -1)
    )


def domain_of(host: Column, suffixes=SUFFIXES) -> Column:
    name = without_port(host)
    two = F.substring_index(name, ".", -2)
    return F.when(_is_address(name), name).when(
        two.isin(*suffixes), F.substring_index(name, ".", -3)
    ).otherwise(two)


def concentration(units: DataFrame, prior: str) -> float:
    """Prior strength of a level by the method of moments (one number).

    ``d = sum n (p - prior)^2`` is expected to be ``sum pq + rho sum (n - 1) pq``
    for an overdispersion rho, and the strength is ``1 / rho - 1``. Without
    overdispersion, or without evidence, the strongest allowed prior is used.
    """
    p = F.col("good") / F.col("n")
    pq = F.col(prior) * (1 - F.col(prior))
    d, e, rest = units.where(F.col("n") > 0).agg(
        F.sum(F.col("n") * F.pow(p - F.col(prior), 2)),
        F.sum(pq),
        F.sum((F.col("n") - 1) * pq),
    ).first()
    if not d or not rest or d <= e or rest <= 0:
        return MAX_CONCENTRATION
    return min(max(rest / (d - e) - 1, MIN_CONCENTRATION), MAX_CONCENTRATION)


def shrunk(units: DataFrame, m: float) -> DataFrame:
    """Replace ``prior`` and ``strength`` (of the level above) by the unit's
    own posterior mean and strength."""
    weight = F.least(F.lit(m), F.col("strength"))
    mean = (F.col("good") + weight * F.col("prior")) / (F.col("n") + weight)
    return units.withColumns({"prior": mean, "strength": F.col("n") + weight})


def host_reputation(outcomes: DataFrame, hosts: DataFrame, suffixes=SUFFIXES) -> DataFrame:
    """Posterior of every host.

    ``outcomes``: (host, good 0/1), one row per labelled page. ``hosts``:
    (host), distinct. Returns host, n, good, mean, sd, domain_n (outcomes of
    the registered domain). The driver receives
    the corpus share and three prior strengths, nothing else.
    """
    counted = (
        outcomes.where(F.col("good").isNotNull() & F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("bigint")).alias("good"))
    )
    per_host = cut_lineage(
        hosts.join(counted, "host", "full").select(
            "host",
            domain_of(F.col("host"), suffixes).alias("domain"),
            suffix_of(F.col("host"), suffixes).alias("suffix"),
            F.coalesce("n", F.lit(0)).alias("n"),
            F.coalesce("good", F.lit(0)).alias("good"),
        ),
        "hosts",
    )
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    good, n = per_host.agg(F.sum("good"), F.sum("n")).first()
    corpus = {
        "prior": F.lit(((good or 0) + 1) / ((n or 0) + 2)), "strength": F.lit(float((n or 0) + 2))
    }

    suffixes = per_host.groupBy("suffix").agg(*sums).withColumns(corpus)
    suffixes = shrunk(suffixes, concentration(suffixes, "prior"))
    domains = per_host.groupBy("suffix", "domain").agg(*sums).join(
        suffixes.select("suffix", "prior", "strength"), "suffix"
    )
    domains = shrunk(domains, concentration(domains, "prior"))
    found = per_host.join(
        domains.select("suffix", "domain", "prior", "strength", F.col("n").alias("domain_n")),
        ["suffix", "domain"],
    )
    found = shrunk(found, concentration(found, "prior"))
    return found.select(
        "host", "n", "good", F.col("prior").alias("mean"),
        F.sqrt(F.col("prior") * (1 - F.col("prior")) / (F.col("strength") + 1)).alias("sd"),
        "domain_n",
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[Rule] = CONTRACT_RULES,
    min_good: float = MIN_GOOD,
    z: float = Z,
    suffixes=SUFFIXES,
) -> DataFrame:
    """Verdict per page: page_id, host, path, rule, verdict, reputation, upper.

    ``pages`` needs page_id and url; ``outcomes`` needs url and good (0/1).
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    labelled = outcomes.select(url_parts(F.col("url"))[0].alias("host"), "good")
    reputation = host_reputation(labelled, rows.select("host").distinct(), suffixes)
    upper = F.col("mean") + F.lit(z) * F.col("sd")
    hit = matched_rule(F.col("host"), F.col("path"), rules)
    known_bad = (F.round(upper, 6) < F.lit(min_good)) & (F.col("domain_n") > 0)
    by_reputation = F.when(known_bad, "block").otherwise("allow")
    return (
        rows.join(reputation, "host", "left")
        .withColumn("_hit", hit)
        .select(
            "page_id", "host", "path",
            F.col("_hit.rule").alias("rule"),
            F.coalesce(F.col("_hit.verdict"), by_reputation).alias("verdict"),
            F.round("mean", 6).alias("reputation"),
            F.round(upper, 6).alias("upper"),
        )
    )


def document_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled outcomes of the given tables: a page shows the document whose
    number ends its path, and ``labels.quality`` marks that document.

    (url, good). Labels are made unique per document first (the lowest label
    wins), so a repeated label row never counts a page twice.
    """
    _, path = url_parts(F.col("url"))
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html)?/?\z", 1)
    shown = pages.select("url", F.nullif(number, F.lit("")).cast("bigint").alias("doc_id"))
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(
        "doc_id"
    ).agg(F.min("quality").alias("good"))
    return shown.join(marks, "doc_id").select("url", "good")
