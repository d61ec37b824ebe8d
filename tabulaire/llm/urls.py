"""Operator 2: URL filters by empirical-Bayes host reputation.

Labelled outcomes of pages (bad or not) are counted by site (a host without
port), registered domain and suffix. Each level's rate is a beta-binomial
posterior whose prior is the level above: suffix to domain to site, with prior
strengths estimated from the spread of the labelled rates themselves (method of
moments), so where sites differ no more than by chance, none stands out. A site
is blocked if the lower posterior bound of its bad rate passes a limit that
follows the overall rate (``ODDS`` times its odds): it must be worse than others
beyond doubt, be there 200 outcomes in all or millions. Fixed rules go before
reputation.

Everything is counted before it is shuffled; hosts of very many pages are dealt
over tasks, and domains and suffixes of very many hosts are split by adaptive
execution, for they are joined with one row each. Only three prior strengths and the overall rate come to the driver.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import hot_join, keep, often, only

#: (host and path, verdict); a rule fits its host and all subdomains if the path starts with its path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
Z = 1.645  #: one-sided 95 % bound
ODDS = 2.0  #: sites whose bound of the bad rate has more than so many times the overall odds are blocked
STRENGTH = (1.0, 1000.0)  #: limits of a prior's strength, in outcomes
#: Common public suffixes of several labels.
MANY = (
    "ac.jp", "ac.nz", "ac.uk", "ac.za", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.co",
    "com.eg", "com.hk", "com.mx", "com.my", "com.ng", "com.pe", "com.ph", "com.pk", "com.pl", "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn", "edu.au", "edu.cn", "go.jp",
    "gov.au", "gov.br", "gov.cn", "gov.in", "gov.uk", "ltd.uk", "me.uk", "ne.jp", "net.au", "net.br", "net.cn", "net.nz", "net.uk", "nhs.uk", "or.jp", "or.kr", "org.au", "org.br",
    "org.cn", "org.nz", "org.uk", "org.za", "plc.uk", "police.uk", "sch.uk",
)
IP = "(ip)"  #: the suffix that all addresses share

def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits. Rules are a reviewed list of at most 1000."""
    if len(rules) > 1000:
        raise ValueError("more than 1000 rules: put them in the outcomes instead")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        at, _, below = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + below)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


_PORT, _ADDRESS = r"(^.*@)|(:[0-9]*$)", r"^([0-9]{1,3}\.){3}[0-9]{1,3}$|^\["


def _suffix_pattern(many: tuple[str, ...]) -> str:
    """Leftmost of all matches, so the longest of ``many`` that fits, else the last label."""
    return "(?:^|\\.)(" + "|".join(s.replace(".", "\\.") for s in sorted(many)) + ("|" if many else "") + "[^.]*)$"


def site_of(host: Column) -> Column:
    """The host that outcomes count for: without user, port and dots at the end."""
    return F.regexp_replace(F.regexp_replace(host, _PORT, ""), r"\.+$", "")


def suffix_of(site: Column, many: tuple[str, ...] = MANY) -> Column:
    """The last label, or the longest of ``many`` (suffixes of several labels) that fits; addresses share one."""
    return F.when(site.rlike(_ADDRESS), IP).otherwise(F.regexp_extract(site, _suffix_pattern(many), 1))


def domain_of(site: Column, suffix: Column) -> Column:
    """The registered domain: the suffix and one label more; an address is its own."""
    ahead = F.substring(site, F.lit(1), F.length(site) - F.length(suffix) - 1)
    return F.when((site == suffix) | (suffix == IP), site).otherwise(F.concat_ws(".", F.regexp_extract(ahead, r"[^.]*$", 0), suffix))


@dataclass
class Reputation:
    """Counted outcomes by level and what the priors weigh; ``rate`` is the overall bad rate, ``limit`` the bound from which sites are blocked."""

    sites: DataFrame
    domains: DataFrame
    suffixes: DataFrame
    rate: float
    strengths: tuple[float, float, float]  # of a domain for its sites, a suffix for its domains, all for suffixes
    many: tuple[str, ...]

    def limit(self, odds: float) -> float:
        return odds * self.rate / (1 - self.rate + odds * self.rate)


def _spread(children: DataFrame, n: str, k: str, of_n: str, of_k: str) -> DataFrame:
    """One row of sums that say how far children's rates lie from their parents'; ``of_n`` and ``of_k`` are the parent's counts on each child's row."""
    p, own, share = F.try_divide(of_k, of_n), F.try_divide(k, n), F.try_divide(n, of_n)
    return children.agg(F.sum(n).alias("total"), F.sum(F.col(n) * (own - p) * (own - p)).alias("seen"), F.sum(p * (1 - p) * (1 - share)).alias("expected"), F.sum(F.col(n) * p * (1 - p)).alias("binomial"))


def _strength(total: float | None, seen: float | None, expected: float | None, binomial: float | None) -> float:
    """Strength of the beta prior that parents give children, by the method of moments."""
    if not total or not binomial:
        return STRENGTH[0]
    between = max((seen - expected) / total, 1e-9)
    return min(max(binomial / total / between - 1, STRENGTH[0]), STRENGTH[1])


def learn(outcomes: DataFrame, many: tuple[str, ...] = MANY) -> Reputation:
    """Counts labelled outcomes, rows of (host, bad): bad 0 or 1, null not counted."""
    counted = outcomes.where("bad is not null").groupBy(site_of(F.col("host")).alias("site")).agg(F.count("*").alias("n_h"), F.sum("bad").alias("k_h"))
    suffix = suffix_of(F.col("site"), many)
    sites = keep(counted.select("site", domain_of(F.col("site"), suffix).alias("domain"), suffix.alias("suffix"), "n_h", "k_h"), "sites")
    domains = sites.groupBy("domain", "suffix").agg(F.sum("n_h").alias("n_d"), F.sum("k_h").alias("k_d"))
    suffixes = sites.groupBy("suffix").agg(F.sum("n_h").alias("n_s"), F.sum("k_h").alias("k_s"))
    n, k = sites.agg(F.sum("n_h"), F.sum("k_h")).first()
    levels = [
        _spread(sites.join(domains.drop("suffix"), "domain"), "n_h", "k_h", "n_d", "k_d"),
        _spread(domains.join(suffixes, "suffix"), "n_d", "k_d", "n_s", "k_s"),
        _spread(suffixes.withColumns({"n_all": F.lit(n or 0), "k_all": F.lit(k or 0)}), "n_s", "k_s", "n_all", "k_all"),
    ]
    sums = {r.level: r for r in reduce(DataFrame.unionByName, [s.withColumn("level", F.lit(i)) for i, s in enumerate(levels)]).collect()}
    strengths = tuple(_strength(*[float(x) if x is not None else None for x in sums[i][:4]]) for i in range(3))
    return Reputation(sites, domains, suffixes, (k / n) if n else 0.0, strengths, many)


def reputations(hosts: DataFrame, known: Reputation, z: float = Z) -> DataFrame:
    """For distinct ``hosts`` (host): n_h, bad_rate (posterior mean) and bad_bound (lower posterior bound)."""
    per_site, per_domain, per_suffix = map(F.lit, known.strengths)
    site = site_of(F.col("host"))
    suffix = suffix_of(F.col("site"), known.many)
    rows = hosts.select("host", site.alias("site")).select("host", "site", domain_of(F.col("site"), suffix).alias("domain"), suffix.alias("suffix"))
    rows = rows.join(known.sites.select("site", "n_h", "k_h"), "site", "left")
    rows = rows.join(known.domains.drop("suffix"), "domain", "left").join(known.suffixes, "suffix", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    m_s = (zero("k_s") + per_suffix * F.lit(known.rate)) / (zero("n_s") + per_suffix)
    m_d = (zero("k_d") + per_domain * m_s) / (zero("n_d") + per_domain)
    a, n = zero("k_h") + per_site * m_d, zero("n_h") + per_site
    rows = rows.select("host", zero("n_h").alias("n_h"), a.alias("a"), n.alias("n"))
    mean = F.col("a") / F.col("n")
    return rows.select("host", "n_h", mean.alias("bad_rate"), (mean - z * F.sqrt(mean * (1 - mean) / (F.col("n") + 1))).alias("bad_bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, odds: float = ODDS, z: float = Z, *, page_id: str = "page_id", url: str = "url", many: tuple[str, ...] = MANY) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict (allow or block), bad_rate, bad_bound.

    ``outcomes`` has rows of (host, bad). Every row of ``pages`` is kept, also
    repeated ones. A null url or one without ``://`` has an empty host and
    path, and the overall rate decides on it unless outcomes of the empty host
    are known. Ports, users and dots at the end make no other site of a host;
    an address is its own domain. A bound that equals the limit is allowed. A
    null page_id stays null; without outcomes all hosts have a bad rate of 0
    and are allowed but for the rules; empty tables give empty results; other
    columns are ignored.
    """
    rows = only(pages, page_id=page_id, url=url).select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = learn(outcomes, many)
    counts = keep(rows.groupBy("host").agg(F.count("*").alias("n")), "hosts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hosts = reputations(counts.select("host"), known, z)
    rows = hot_join(rows, hosts, "host", ["page_id", "path"], counts.where(F.col("n") >= often(total)).select("host"), "left")
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(says, F.when(F.col("bad_bound") > known.limit(odds), "block").otherwise("allow")).alias("verdict"), "bad_rate", "bad_bound")


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of labelled pages: a page's outcome is the label of the document of its id, bad if toxic or of low quality."""
    marked = only(labels, doc_id="doc_id", quality="quality", toxic="toxic").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return only(pages, page_id="page_id", url="url").select("page_id", host_of(F.col("url")).alias("host")).join(marked, "page_id").select("host", "bad")


def _rule_sql() -> tuple[str, str]:
    def case(value) -> str:
        return "CASE " + " ".join(
            f"WHEN (host = '{t.partition('/')[0]}' OR ends_with(host, '.{t.partition('/')[0]}')) AND starts_with(path, '/{t.partition('/')[2]}') THEN '{value(t, v)}'"
            for t, v in sorted(RULES, key=lambda r: -len(r[0]))
        ) + " END"

    return case(lambda t, v: t), case(lambda t, v: v)


def _strength_sql(rows: str, n: str, k: str, of_n: str, of_k: str) -> str:
    p = f"({of_k} * 1.0 / {of_n})"
    return f"""SELECT CASE WHEN coalesce(sum({n}), 0) = 0 OR sum({n} * {p} * (1 - {p})) = 0 THEN {STRENGTH[0]} ELSE
        least(greatest(sum({n} * {p} * (1 - {p})) / sum({n}) / greatest((sum({n} * power({k} * 1.0 / {n} - {p}, 2)) - sum({p} * (1 - {p}) * (1 - {n} * 1.0 / {of_n}))) / sum({n}), 1e-9) - 1, {STRENGTH[0]}), {STRENGTH[1]}) END AS s FROM {rows}"""


def sql() -> str:
    rule, verdict = _rule_sql()
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"""
WITH p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), '{upper}', '{lower}'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages)),
sited AS (SELECT host, regexp_replace(regexp_replace(host, '{_PORT}', '', 'g'), '\\.+$', '') AS site FROM (SELECT DISTINCT host FROM p)),
parted AS (SELECT host, site, CASE WHEN regexp_matches(site, '{_ADDRESS}') THEN '{IP}' ELSE regexp_extract(site, '{_suffix_pattern(MANY)}', 1) END AS suffix FROM sited),
named AS (SELECT host, site, suffix, CASE WHEN suffix = '{IP}' OR suffix = site THEN site ELSE regexp_extract(substr(site, 1, length(site) - length(suffix) - 1), '[^.]*$', 0) || '.' || suffix END AS domain FROM parted),
h AS (SELECT site, domain, suffix, count(*) AS n_h, sum(bad) AS k_h FROM p JOIN named USING (host) JOIN (SELECT doc_id, CAST(quality = 0 OR toxic = 1 AS INT) AS bad FROM labels) l ON l.doc_id = p.page_id WHERE bad IS NOT NULL GROUP BY ALL),
d AS (SELECT domain, suffix, sum(n_h) AS n_d, sum(k_h) AS k_d FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n_d) AS n_s, sum(k_d) AS k_s FROM d GROUP BY ALL),
g AS (SELECT coalesce(sum(n_s), 0) AS n_g, coalesce(sum(k_s), 0) AS k_g, CASE WHEN coalesce(sum(n_s), 0) = 0 THEN 0 ELSE sum(k_s) * 1.0 / sum(n_s) END AS rate FROM s),
s0 AS ({_strength_sql("h JOIN d USING (domain)", "n_h", "k_h", "n_d", "k_d")}),
s1 AS ({_strength_sql("d JOIN s USING (suffix)", "n_d", "k_d", "n_s", "k_s")}),
s2 AS ({_strength_sql("s, g", "n_s", "k_s", "n_g", "k_g")}),
r AS (SELECT named.host, rate, coalesce(k_h, 0) + s0.s * (coalesce(k_d, 0) + s1.s * (coalesce(k_s, 0) + s2.s * rate) / (coalesce(n_s, 0) + s2.s)) / (coalesce(n_d, 0) + s1.s) AS a, coalesce(n_h, 0) + s0.s AS n
  FROM named LEFT JOIN h USING (site) LEFT JOIN d ON d.domain = named.domain LEFT JOIN s ON s.suffix = named.suffix, g, s0, s1, s2)
SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN a / n - {Z} * sqrt(a / n * (1 - a / n) / (n + 1)) > {ODDS} * rate / (1 - rate + {ODDS} * rate) THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN r USING (host)"""
