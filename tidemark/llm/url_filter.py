"""Filter URLs by host reputation: shrunken shares of bad pages from host to domain to suffix.

Everything here is DataFrame and SQL functions. Labelled page outcomes are summed per host,
registered domain and suffix. Each level is a beta-binomial model: its prior mean is the level
above, its prior weight is fitted to how much the level's shares differ beyond chance. The
posterior of the finest level with labels judges a host; hosts without labels inherit from their
domain, then their suffix, then all pages. Explicit rules come first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_ascii, stage

#: Verdict, host, path: a rule fits its host and all subdomains if the path starts with its path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: A host is blocked when the lower bound of its share of bad pages is above this share.
MOST_BAD = 0.25
#: Standard deviations between the posterior mean and its bound.
BOUND = 1.645
#: Limits of a level's prior weight, in pages.
WEIGHT_RANGE = (1.0, 10_000.0)
_LEVELS = ("suffix", "domain", "host")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return fold_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def registered_domain(host: Column) -> Column:
    """The last two labels of a host: its domain where a suffix is one label."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; nulls if none does."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _weight(groups: DataFrame) -> DataFrame:
    """One row: the prior weight that a level's spread of shares asks for (method of moments)."""
    sums = groups.agg(
        F.sum("n").alias("n"),
        F.sum("k").alias("k"),
        F.count(F.lit(1)).alias("g"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"),
    )
    mean = F.col("k") / F.col("n")
    spread = F.col("kk") / F.col("n") - mean * mean
    chance = mean * (1 - mean) * (F.col("g") - 1) / F.col("n")
    most = mean * (1 - mean) - chance
    rho = F.greatest(F.lit(0.0), (spread - chance) / F.when(most > 0, most))
    weight = F.when(rho > 0, 1 / rho - 1).otherwise(F.lit(WEIGHT_RANGE[1]))
    clamped = F.greatest(F.lit(WEIGHT_RANGE[0]), F.least(F.lit(WEIGHT_RANGE[1]), F.coalesce(weight, F.lit(WEIGHT_RANGE[1]))))
    return sums.select(F.coalesce(mean, F.lit(0.0)).alias("mean"), F.round(clamped, 6).alias("weight"))


def host_reputation(outcomes: DataFrame) -> tuple[dict[str, DataFrame], tuple[float, float]]:
    """Posteriors per level from rows ``host, bad`` (0 or 1), and the prior of an unseen suffix.

    Each level's table holds ``<level>, mean, weight``: the share of bad pages after shrinking it
    to the level above, and how many pages (seen and prior) it rests on. The prior weights are
    three rows of sums, which the driver reads.
    """
    hosts = stage(
        outcomes.where((F.col("host") != "") & F.col("bad").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
        .select("*", registered_domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix")),
        "hosts",
    )
    counted = {
        "host": hosts,
        "domain": hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")),
        "suffix": hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")),
    }
    fitted = reduce(
        DataFrame.unionByName, [_weight(counted[level]).select("*", F.lit(level).alias("level")) for level in _LEVELS]
    )
    by_level = {row["level"]: row for row in fitted.collect()}
    mean = by_level["suffix"]["mean"]
    levels: dict[str, DataFrame] = {}
    above = None
    for level in _LEVELS:
        weight, rows = by_level[level]["weight"], counted[level]
        if above is None:
            rows = rows.withColumn("prior", F.lit(mean))
        else:
            prior = levels[above].select(above, F.col("mean").alias("prior"))
            rows = rows.join(prior, above)
        shrunk = (F.col("k") + F.col("prior") * weight) / (F.col("n") + weight)
        levels[level] = rows.select(level, shrunk.alias("mean"), (F.col("n") + weight).alias("weight"))
        above = level
    return levels, (mean, by_level["suffix"]["weight"])


def filter_urls(pages: DataFrame, outcomes: DataFrame, *, rules=RULES, most_bad: float = MOST_BAD) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_share, bad_bound`` for every page.

    ``outcomes`` has rows ``page_id, bad``. A null URL or one without ``://`` has an empty host
    and path; it is judged like a page of an unseen suffix. Null outcomes and outcomes of unknown
    pages are left out; without any outcome all shares are 0 and the method allows. A repeated
    page counts as often as it stands there. Extra columns of either table are not read.
    """
    url = F.col("url").cast("string")
    judged = pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"))
    labelled = judged.select("page_id", "host").join(outcomes.select("page_id", "bad"), "page_id")
    levels, (mean, weight) = host_reputation(labelled)
    # Hosts are joined once per distinct host, and the hosts' verdicts then once to the pages.
    found = judged.select("host").distinct()
    found = found.select("*", registered_domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix"))
    for level in _LEVELS:
        table = levels[level].select(level, F.struct("mean", "weight").alias(f"{level}_p"))
        found = found.join(table, level, "left")
    root = F.struct(F.lit(mean).alias("mean"), F.lit(weight).alias("weight"))
    best = F.coalesce("host_p", "domain_p", "suffix_p", root)
    share, pages_seen = best["mean"], best["weight"]
    bound = share - BOUND * F.sqrt(share * (1 - share) / (pages_seen + 1))
    hosts = found.select(F.col("host").alias("h"), share.alias("bad_share"), bound.alias("bad_bound"))
    name, verdict = _rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_bound") > most_bad, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(hosts, F.col("host") == F.col("h")).select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "bad_share", "bad_bound"
    )


#: The columns ``page_id, host, path, rule, verdict`` of :func:`filter_urls` in DuckDB, with
#: ``labels.quality = 0`` of the page's id as a bad outcome.
SQL = r"""
WITH judged AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
hosts AS (
  SELECT host, regexp_extract(host, '([^.]*\.)?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix, count(*) AS n, sum((quality = 0)::INT)::BIGINT AS k
  FROM judged JOIN labels ON doc_id = page_id WHERE host <> '' AND quality IS NOT NULL GROUP BY host),
domains AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM hosts GROUP BY ALL),
groups AS (SELECT 'host' AS level, n, k FROM hosts UNION ALL SELECT 'domain', n, k FROM domains UNION ALL SELECT 'suffix', n, k FROM suffixes),
sums AS (SELECT level, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k, count(*) AS g, sum(k * k / n) AS kk FROM groups GROUP BY level),
moments AS (SELECT level, k / n AS mean, kk / n - (k / n) * (k / n) AS spread, (k / n) * (1 - k / n) * (g - 1) / n AS chance FROM sums),
rhos AS (SELECT level, mean, greatest(0.0, (spread - chance) / CASE WHEN mean * (1 - mean) - chance > 0 THEN mean * (1 - mean) - chance END) AS rho FROM moments),
fitted AS (SELECT level, coalesce(mean, 0.0) AS mean, round(greatest(1.0, least(10000.0, coalesce(CASE WHEN rho > 0 THEN 1 / rho - 1 ELSE 10000.0 END, 10000.0))), 6) AS weight FROM rhos),
w AS (SELECT max(mean) FILTER (WHERE level = 'suffix') AS mean, max(weight) FILTER (WHERE level = 'suffix') AS ws,
 max(weight) FILTER (WHERE level = 'domain') AS wd, max(weight) FILTER (WHERE level = 'host') AS wh FROM fitted),
ps AS (SELECT suffix, (k + mean * ws) / (n + ws) AS m, n + ws AS s FROM suffixes, w),
pd AS (SELECT d.domain, (d.k + ps.m * wd) / (d.n + wd) AS m, d.n + wd AS s FROM domains d JOIN ps USING (suffix), w),
ph AS (SELECT h.host, (h.k + pd.m * wh) / (h.n + wh) AS m, h.n + wh AS s FROM hosts h JOIN pd USING (domain), w),
seen AS (SELECT DISTINCT host, regexp_extract(host, '([^.]*\.)?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix FROM judged),
best AS (SELECT host, coalesce(ph.m, pd.m, ps.m, w.mean) AS m, coalesce(ph.s, pd.s, ps.s, w.ws) AS s
 FROM seen LEFT JOIN ph USING (host) LEFT JOIN pd USING (domain) LEFT JOIN ps USING (suffix), w),
ruled AS (SELECT j.*, CASE
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM judged j)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
 WHEN m - 1.645 * sqrt(m * (1 - m) / (s + 1)) > 0.25 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN best USING (host)
"""
