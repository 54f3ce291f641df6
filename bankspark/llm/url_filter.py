"""URL filters with an empirical-Bayes reputation of hosts.

A rule names a host and the start of a path; it fits the host and all its
subdomains, and the longest fitting rule decides.  Where none fits, the
reputation of the host does.  Outcomes of labelled pages are counted per host,
registered domain and suffix.  Each level's share of bad pages is shrunk
towards the level above by a beta-binomial prior, whose strength is estimated
by moments from how much the level's shares differ.  A page is blocked when
the lower bound of its host's posterior share is above a limit, so a host with
little evidence is not blocked.

Defined results: a NULL url, and one without "://", has an empty host and an
empty path; a host without labelled pages has its domain's reputation;
repeated pages and repeated labels count as often as they stand there; without
any label nothing is blocked but by rule; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankspark.sources.scratch import store

#: Suffixes of several labels under which names are registered; a parameter (see ``suffix_rules``), not a full list.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "co.jp", "co.nz", "com.br", "com.cn", "com.my")
Z = 1.645  # standard deviations between the posterior mean and its bound
LIMIT = 0.5  # share of bad pages above which a host is blocked
MIN_RHO, MAX_RHO = 0.001, 0.95  # bounds on the correlation of pages within a group


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The text and the verdict of the longest of the (verdict, host, path) rules that fits, or NULL.

    The rules are a short configured list: they become one expression on the scan.
    """
    text = verdict = F.lit(None).cast("string")
    for said, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return text, verdict


def suffix_rules(lines: Iterable[str]) -> tuple[str, ...]:
    """The rules of a public suffix list: one to a line, up to the first blank; comments begin with //."""
    words = (line.split(maxsplit=1) for line in lines)
    return tuple(w[0].lower().strip(".") for w in words if w and not w[0].startswith("//"))


def domain_of(host: Column, rules: Iterable[str] = LONG_SUFFIXES) -> tuple[Column, Column]:
    """The registered domain and the suffix of a host (user and port are left off).

    Rules are names (``co.uk``), wildcards (``*.ck``: any label before ck) and exceptions to those (``!www.ck``: ck is
    its suffix).  An exception decides, else the rule of most labels, else the last label is the suffix.
    """
    labels = F.split(F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r":[0-9]*$", ""), r"\.")
    tail = lambda n: F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n))
    names: dict[str, dict[int, set[str]]] = {"!": {}, "*": {}, "": {}}
    for rule in set(rules):
        kind = "!" if rule.startswith("!") else "*" if rule.startswith("*.") else ""
        name = rule.removeprefix("!").removeprefix("*.")
        names[kind].setdefault(name.count(".") + 1, set()).add(name)
    # In the order in which they decide: (labels that must be there, labels compared, names, labels of the suffix).
    tests = [(n, n, found, n - 1) for n, found in sorted(names["!"].items(), reverse=True)]
    sizes = {n for n in names[""] if n > 1} | {n + 1 for n in names["*"]}
    for n in sorted(sizes, reverse=True):
        tests += [(n, n, names[""].get(n, set()), n), (n, n - 1, names["*"].get(n - 1, set()), n)]
    length = F.coalesce(
        *(F.when((F.size(labels) >= there) & tail(n).isin(*sorted(found)), size) for there, n, found, size in tests if found), F.lit(1)
    )
    return tail(length + 1), tail(length)


def _strength(groups: DataFrame) -> Column:
    """The prior's weight in pages, by moments, from groups with n, bad and their parent's totals."""
    p = F.try_divide("parent_bad", "parent_n")
    spread = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - p, 2))
    by_parent = groups.filter("n > 0").groupBy("parent").agg(
        spread.alias("spread"), F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.first("parent_n").alias("parent_n"), F.first("parent_bad").alias("parent_bad"),
    )
    pq = p * (1 - p)
    expected = pq * (F.col("groups") - 1)
    room = pq * (F.col("n") - F.col("squares") / F.col("n") - (F.col("groups") - 1))
    rho = F.sum(F.col("spread") - expected) / F.nullif(F.sum(room), F.lit(0.0))
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(MIN_RHO)), F.lit(MIN_RHO)), F.lit(MAX_RHO))
    return by_parent.agg(((1 - rho) / rho).alias("strength"))


def _level(groups: DataFrame, above: DataFrame) -> DataFrame:
    """Posterior counts of each group (name, parent, n, bad), shrunk to the mean of its parent."""
    return _shrunk(groups.join(
        above.select(
            F.col("name").alias("parent"), F.col("n").alias("parent_n"), F.col("bad").alias("parent_bad"),
            (F.col("a") / (F.col("a") + F.col("b"))).alias("mean"),
        ), "parent",
    ))


def _shrunk(placed: DataFrame) -> DataFrame:
    strength = F.lit(_strength(placed).first()[0])  # one number
    return placed.select(
        "name", "parent", "n", "bad",
        (strength * F.col("mean") + F.col("bad")).alias("a"),
        (strength * (1 - F.col("mean")) + F.col("n") - F.col("bad")).alias("b"),
    )


def reputations(outcomes: DataFrame, long_suffixes: Iterable[str] = LONG_SUFFIXES) -> DataFrame:
    """Per host the posterior beta counts ``a`` (bad) and ``b``, from outcomes (host, n, bad), one row per host."""
    domain, suffix = domain_of(F.col("host"), long_suffixes)
    hosts = outcomes.select(F.col("host").alias("name"), domain.alias("parent"), suffix.alias("suffix"), "n", "bad")
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = hosts.groupBy(F.col("parent").alias("name"), F.col("suffix").alias("parent")).agg(*sums)
    suffixes = store(domains.groupBy(F.col("parent").alias("name")).agg(*sums).withColumn("parent", F.lit("")))
    # All pages, two numbers: a flat prior of one good and one bad page.
    n, bad = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    whole = {"parent_n": F.lit(n), "parent_bad": F.lit(bad), "mean": F.lit((bad + 1.0) / (n + 2.0))}
    suffix_level = store(_shrunk(suffixes.withColumns(whole)))
    domain_level = store(_level(domains, suffix_level))
    return _level(hosts.drop("suffix"), domain_level).select(F.col("name").alias("host"), "n", "bad", "a", "b")


def lower_bound(a: Column, b: Column, z: float = Z) -> Column:
    mean = a / (a + b)
    return mean - F.lit(z) * F.sqrt(mean * (1 - mean) / (a + b + 1))


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], limit: float = LIMIT, z: float = Z,
    long_suffixes: Iterable[str] = LONG_SUFFIXES,
) -> DataFrame:
    """Every page (page_id, url) with host, path, rule, verdict and its host's evidence.

    ``labels`` (doc_id, quality, toxic) labels the page of the same id; a page of no quality or a toxic one is bad.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = store(pages.select("page_id", host.alias("host"), path.alias("path")))
    bad = ((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) != 0)).cast("long")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"), F.lit(1).cast("long").alias("n"))
    counted = store(
        parsed.select("page_id", "host").join(outcomes, "page_id", "left")
        .groupBy("host").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    known = store(reputations(counted, long_suffixes).withColumn("bound", lower_bound(F.col("a"), F.col("b"), z)))
    rule, said = fitting_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return parsed.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(said, by_method).alias("verdict"),
        F.col("n").alias("host_labels"), F.col("bad").alias("host_bad"), "bound",
    )


RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def op7_url_filter(pages: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(pages, labels, RULES).select("page_id", "host", "path", "rule", "verdict", "host_labels", "host_bad")


def _oracle_level(name: str, groups: str, above: str) -> str:
    return f"""
{name}_placed AS (
    SELECT g.*, u.n AS parent_n, u.bad AS parent_bad, u.a / (u.a + u.b) AS mean
    FROM {groups} g JOIN {above} u ON g.parent = u.name
), {name}_parents AS (
    SELECT sum(n * pow(bad / n - parent_bad / parent_n, 2)) AS spread, count(*) AS k, sum(n) AS n, sum(n * n) AS squares,
        any_value(parent_bad / parent_n) * (1 - any_value(parent_bad / parent_n)) AS pq
    FROM {name}_placed WHERE n > 0 GROUP BY parent
), {name}_rho AS (
    SELECT least(greatest(coalesce(sum(spread - pq * (k - 1)) / nullif(sum(pq * (n - squares / n - (k - 1))), 0), 0.001), 0.001), 0.95) AS rho
    FROM {name}_parents
), {name} AS (
    SELECT name, parent, n, bad, (1 - rho) / rho * mean + bad AS a, (1 - rho) / rho * (1 - mean) + n - bad AS b
    FROM {name}_placed, {name}_rho
)"""


ORACLE = r"""
WITH parsed AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), counted AS (
    SELECT host, count(l.doc_id)::DOUBLE AS n,
        coalesce(sum(CASE WHEN l.doc_id IS NOT NULL AND (l.quality = 0 OR l.toxic <> 0) THEN 1 ELSE 0 END), 0)::DOUBLE AS bad
    FROM parsed p LEFT JOIN labels l ON l.doc_id = p.page_id GROUP BY host
), split AS (
    SELECT *, string_split(regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':[0-9]*$', ''), '.') AS parts FROM counted
), named AS (
    SELECT *, CASE WHEN array_to_string(parts[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'net.au', 'co.jp',
        'co.nz', 'com.br', 'com.cn', 'com.my') THEN 2 ELSE 1 END AS long FROM split
), hosts AS (
    SELECT host AS name, array_to_string(parts[-(long + 1):], '.') AS parent, array_to_string(parts[-long:], '.') AS suffix, n, bad FROM named
), domains AS (
    SELECT parent AS name, suffix AS parent, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL
), suffixes AS (
    SELECT parent AS name, '' AS parent, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL
), everything AS (
    SELECT '' AS name, sum(n) AS n, sum(bad) AS bad, sum(bad) + 1.0::DOUBLE AS a, sum(n) - sum(bad) + 1.0::DOUBLE AS b FROM suffixes
),""" + ",".join([
    _oracle_level("suffix_level", "suffixes", "everything"),
    _oracle_level("domain_level", "domains", "suffix_level"),
    _oracle_level("host_level", "(SELECT name, parent, n, bad FROM hosts)", "domain_level"),
]) + r""",
rules(verdict, rule, rule_host, rule_path) AS (VALUES
    ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
    ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
), judged AS (
    SELECT p.page_id, p.host, p.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS said
    FROM parsed p LEFT JOIN rules r
        ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
    GROUP BY ALL
)
SELECT j.page_id, j.host, j.path, j.rule,
    coalesce(j.said, CASE WHEN a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
    h.n::BIGINT AS host_labels, h.bad::BIGINT AS host_bad
FROM judged j JOIN host_level h ON h.name = j.host
"""
