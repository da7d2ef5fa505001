"""URL filter: written rules first, then the reputation of the host by empirical Bayes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import lower_ascii, table
from almanac.sources.shared import materialise

# The rules of the query, as (host, path prefix, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Suffixes of two labels, below which domains are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "com.br", "co.nz", "co.in", "co.za")

#: Bounds of a prior's strength in pages: no level is trusted less or more than this.
WEAKEST, STRONGEST = 2.0, 200.0
#: Normal quantile of the posterior bound, and the least share of good pages that it must reach.
QUANTILE, LEAST_GOOD = 1.645, 0.5
#: Good and bad pages that every table is taken to have seen already, so that a single label doesn't decide for all hosts.
PRIOR = (9.0, 1.0)
_ADDRESS = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def site_of(host: Column) -> Column:
    """The host by which a url has its reputation: without user, port and dots at the end."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^(?s:.*)@", ""), r":[0-9]*\z", ""), r"\.+\z", "")


def suffix_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The last label, or the last two if they are one of ``suffixes``; an address is its own."""
    last_two = F.substring_index(host, ".", -2)
    return F.when(host.rlike(_ADDRESS), host).when(last_two.isin(*suffixes), last_two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The registered domain: the suffix and one label before it; an address is its own."""
    two = F.substring_index(host, ".", -2).isin(*suffixes)
    return F.when(host.rlike(_ADDRESS), host).when(two, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    return ((host == rule[0]) | F.endswith(host, F.lit("." + rule[0]))) & F.startswith(path, F.lit(rule[1]))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as its text and its verdict; NULL if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest is asked first
        fits = _fits(host, path, rule)
        name = F.when(fits, F.lit(rule[0] + rule[1])).otherwise(name)
        verdict = F.when(fits, F.lit(rule[2])).otherwise(verdict)
    return name, verdict


def _strength(counts: DataFrame, level: str, parent: str) -> DataFrame:
    """One row: how many pages a parent's mean is worth, by the spread of the children around it.

    Moments of the beta-binomial: with X = sum of n (p - parent mean)^2 over children, and what X would
    be without spread, the ratio tells the share of variance between children; its inverse less one is
    the strength. No spread beyond chance means the strongest prior.
    """
    child = counts.groupBy(parent, level).agg(F.sum("good").alias("g"), F.sum("n").alias("n"))
    up = counts.groupBy(F.col(parent).alias("up")).agg((F.sum("good") / F.sum("n")).alias("mean"))
    both = child.join(up, F.col(parent) == F.col("up"))
    spread = F.sum(F.col("n") * F.pow(F.col("g") / F.col("n") - F.col("mean"), F.lit(2)))
    chance = F.sum(F.col("mean") * (1 - F.col("mean")))
    between = F.sum((F.col("n") - 1) * F.col("mean") * (1 - F.col("mean")))
    share = (spread - chance) / between
    strength = F.when((between > 0) & (share > 0), 1 / share - 1).otherwise(F.lit(STRONGEST))
    return both.agg(F.least(F.greatest(F.coalesce(strength, F.lit(STRONGEST)), F.lit(WEAKEST)), F.lit(STRONGEST)).alias(f"k_{level}"))


def reputations(outcomes: DataFrame, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> tuple[dict[str, DataFrame], float]:
    """By level (suffix, domain, host): (level, good, n, mean, bound) of all labelled ones, from (host, good, n);
    and the bound of a host of which nothing is known, not even its suffix.

    A host's good pages of n labelled ones are drawn to the mean of its registered domain, that to the
    mean of its suffix, that to the mean of all, and that to ``PRIOR``, each by a beta prior whose strength is estimated
    from the spread at its level. ``bound`` is the lower end of the posterior. One row per labelled host is written, and one
    job over it gives the strengths and the overall mean, which are numbers from then on.
    """
    counts = outcomes.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).filter("n > 0")
    host = F.col("host")
    counts = counts.select("host", domain_of(host, suffixes).alias("domain"), suffix_of(host, suffixes).alias("suffix"), F.lit(0).alias("everything"), "good", "n")
    counts = materialise(counts, "hosts")
    levels = (("suffix", "everything"), ("domain", "suffix"), ("host", "domain"))
    total = counts.agg(F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("k"), F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"))
    numbers = total.select(F.lit("everything").alias("level"), "k", "n")
    for level, parent in levels:
        numbers = numbers.union(_strength(counts, level, parent).select(F.lit(level), f"k_{level}", F.lit(0.0)))
    numbers = {r.level: r for r in numbers.collect()}  # four rows
    overall = (numbers["everything"].k + PRIOR[0]) / (numbers["everything"].n + sum(PRIOR))
    known, found = None, {}
    for level, parent in levels:
        k = F.lit(numbers[level].k)
        child = counts.groupBy(parent, level).agg(F.sum("good").alias("g"), F.sum("n").alias("w"))
        child = child.withColumn("m_everything", F.lit(overall)) if known is None else child.join(known, parent)
        m = f"m_{level}"
        child = child.select(level, F.col("g").alias("good"), F.col("w").alias("n"), ((F.col("g") + k * F.col(f"m_{parent}")) / (F.col("w") + k)).alias(m), (F.col("w") + k).alias("weight"))
        found[level] = child.select(level, "good", "n", F.col(m).alias("mean"), lower_bound(F.col(m), F.col("weight")).alias("bound"))
        known = child.select(level, m)
    return found, overall - QUANTILE * (overall * (1 - overall) / (STRONGEST + 1)) ** 0.5


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, good, n, mean, bound) of every labelled host, from (host, good, n)."""
    return reputations(outcomes)[0]["host"]


def lower_bound(mean: Column, weight: Column) -> Column:
    """Lower end of a beta posterior with ``weight`` pages behind it, by its normal approximation."""
    return mean - QUANTILE * F.sqrt(mean * (1 - mean) / (weight + 1))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    least_good: float = LEAST_GOOD,
    suffixes: Sequence[str] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, bound), one row per row of ``pages`` (page_id, url).

    ``labels`` (doc_id, quality, toxic) labels pages by their id: a page is good if its quality is 1
    and it is not toxic. A url that a rule fits gets the rule's verdict, else ``allow`` if its host's
    posterior bound reaches ``least_good``, else ``block``. Hosts without labels take the bound of their registered
    domain, those of domains without labels that of their suffix, and others the bound of the mean over
    all; so do urls that are NULL or have no ``://`` (host and path empty), unless such urls are labelled. For its
    reputation a host goes without user, port and last dots, and an address is its own domain. Labels judge the pages of the
    same number, which is an assumption of this operator. NULL labels count for nothing; repeated rows count each time;
    other columns play no part, and a very long url is a url.

    Labels are summed by id and outcomes by host before they meet anything, so neither a hot host nor a
    repeated id multiplies rows. The tables of hosts and domains are broadcast only if Spark finds them small.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    good = (F.coalesce(F.col("quality") == 1, F.lit(False)) & F.coalesce(F.col("toxic") == 0, F.lit(True))).cast("long")
    known = labels.filter("doc_id is not null and quality is not null")
    outcomes = known.groupBy(F.col("doc_id").alias("page_id")).agg(F.sum(good).alias("good"), F.count("*").alias("n"))
    seen = rows.join(outcomes, "page_id").groupBy(site_of(F.col("host")).alias("host")).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))

    reputation, other = reputations(seen, suffixes)
    name, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    found = rows.withColumn("site", site_of(F.col("host")))
    found = found.select("*", domain_of(F.col("site"), suffixes).alias("domain"), suffix_of(F.col("site"), suffixes).alias("suffix"))
    for level, at in (("host", "site"), ("domain", "domain"), ("suffix", "suffix")):
        found = found.join(reputation[level].select(F.col(level).alias(at), F.col("bound").alias(f"b_{level}")), at, "left")
    bound = F.coalesce("b_host", "b_domain", "b_suffix", F.lit(other))
    judged = F.when(bound >= least_good, "allow").otherwise("block")
    return found.select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, judged).alias("verdict"), bound.alias("bound")
    )


def op3_judge_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _sql_strength(level: str, parent: str) -> str:
    return f"""k_{level} AS (SELECT least(greatest(coalesce(
        CASE WHEN between_ > 0 AND (spread - chance) / between_ > 0 THEN 1 / ((spread - chance) / between_) - 1
             ELSE {STRONGEST} END, {STRONGEST}), {WEAKEST}), {STRONGEST}) AS k
      FROM (SELECT sum(n * pow(g / n - mean, 2)) AS spread, sum(mean * (1 - mean)) AS chance,
                   sum((n - 1) * mean * (1 - mean)) AS between_
            FROM (SELECT {parent}, {level}, sum(good)::DOUBLE AS g, sum(n)::DOUBLE AS n FROM hosts GROUP BY ALL)
            JOIN (SELECT {parent}, sum(good)::DOUBLE / sum(n)::DOUBLE AS mean FROM hosts GROUP BY ALL) USING ({parent})))"""


def _sql_mean(level: str, parent: str) -> str:
    return f"""m_{level} AS (SELECT {level}, (g + k * m_{parent}.mean) / (w + k) AS mean, w + k AS weight
      FROM (SELECT {parent}, {level}, sum(good)::DOUBLE AS g, sum(n)::DOUBLE AS w FROM hosts GROUP BY ALL)
      JOIN m_{parent} USING ({parent}) CROSS JOIN k_{level})"""


_SUFFIXES = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
_SQL_RULES = sorted(RULES, key=lambda r: -len(r[0] + r[1]))


def _sql_rule(value: int | None) -> str:
    cases = " ".join(
        f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}') THEN '{h + p if value is None else v}'"
        for h, p, v in _SQL_RULES
    )
    return f"CASE {cases} END"


def _sql_last(n: int) -> str:
    return f"array_to_string(string_split(site, '.')[-{n}:], '.')"


def _sql_bound(mean: str, weight: str) -> str:
    return f"{mean} - {QUANTILE} * sqrt({mean} * (1 - {mean}) / ({weight} + 1))"


OP3_SQL = f"""WITH urls AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
  sites AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^(?s:.*)@', ''), ':[0-9]*$', ''), '\\.+$', '') AS site FROM urls),
  parts AS (SELECT *,
      CASE WHEN regexp_matches(site, '{_ADDRESS}') THEN site WHEN {_sql_last(2)} IN ({_SUFFIXES}) THEN {_sql_last(3)} ELSE {_sql_last(2)} END AS domain,
      CASE WHEN regexp_matches(site, '{_ADDRESS}') THEN site WHEN {_sql_last(2)} IN ({_SUFFIXES}) THEN {_sql_last(2)} ELSE {_sql_last(1)} END AS suffix
    FROM sites),
  outcomes AS (SELECT doc_id AS page_id, sum(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS good,
      count(*) AS n FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
  hosts AS (SELECT site AS host, sum(good) AS good, sum(n) AS n, 0 AS everything, any_value(domain) AS domain, any_value(suffix) AS suffix
    FROM parts JOIN outcomes USING (page_id) GROUP BY site),
  {_sql_strength('suffix', 'everything')}, {_sql_strength('domain', 'suffix')}, {_sql_strength('host', 'domain')},
  m_everything AS (SELECT 0 AS everything, (coalesce(sum(good), 0) + {PRIOR[0]}::DOUBLE) / (coalesce(sum(n), 0) + {sum(PRIOR)}::DOUBLE) AS mean FROM hosts),
  {_sql_mean('suffix', 'everything')}, {_sql_mean('domain', 'suffix')}, {_sql_mean('host', 'domain')},
  b_host AS (SELECT host AS site, {_sql_bound('mean', 'weight')} AS bound FROM m_host),
  b_domain AS (SELECT domain, {_sql_bound('mean', 'weight')} AS bound FROM m_domain),
  b_suffix AS (SELECT suffix, {_sql_bound('mean', 'weight')} AS bound FROM m_suffix),
  other AS (SELECT {_sql_bound('mean', str(STRONGEST))} AS bound FROM m_everything)
  SELECT page_id, host, path, {_sql_rule(None)} AS rule,
    coalesce({_sql_rule(1)}, CASE WHEN coalesce(b_host.bound, b_domain.bound, b_suffix.bound, other.bound) >= {LEAST_GOOD} THEN 'allow' ELSE 'block' END) AS verdict
  FROM parts LEFT JOIN b_host USING (site) LEFT JOIN b_domain USING (domain) LEFT JOIN b_suffix USING (suffix) CROSS JOIN other"""
