"""Operator 5. URL filters: explicit rules first, else the host's empirical-Bayes reputation.

Outcomes of labelled pages are counted for each host, and shrunk through beta-binomial priors: a
suffix towards the overall share of bad pages, a registered domain towards its suffix, a host towards
its domain. How strongly each level shrinks is estimated from the spread of its members around their
parents (moments). A page is blocked when the lower bound of its host's bad share exceeds a limit.

All is DataFrame work: one aggregation of pages by host (partial sums, so a host of a third of all
pages is no burden), small tables above it, and one join back on the host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host, path): fits the host and its subdomains where the path begins so; the longest wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: A host is blocked when its bad share lies above LIMIT, with Z standard deviations to spare.
LIMIT = 0.5
Z = 1.645
#: Pseudo-counts of a prior where a level's spread can't be estimated, and their range.
STRENGTH, LEAST, MOST = 10.0, 0.1, 1e6

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, UPPER.lower())
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label; the last two where a country's two letters follow a label of up to three."""
    return F.coalesce(
        F.nullif(F.regexp_extract(host, r"\.([^.]{1,3}\.[a-z]{2})$", 1), F.lit("")),
        F.regexp_extract(host, r"([^.]*)$", 1),
    )


def domain_of(host: Column) -> Column:
    """The registered domain: one label more than the suffix, as far as the host has one."""
    return F.coalesce(
        F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]{1,3}\.[a-z]{2})$", 1), F.lit("")),
        F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")),
        host,
    )


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the last one tested is the longest
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(start))
        name = F.when(fits, F.lit(own + start)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, mean, low) from (host, n, bad): the posterior mean of the bad share and its lower bound.

    Hosts with n = 0 have their domain's posterior as a prior and nothing else. A null host counts as
    ''; repeated hosts are summed. Without any outcome every share is 0 with a lower bound of 0.
    """
    host = outcomes.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    host = host.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    domain = host.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffix = domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffix.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = float(total.bad or 0) / float(total.n) if total.n else 0.0

    suffix = _shrunk(suffix.withColumn("parent", F.lit(mean)), "suffix")
    domain = _shrunk(domain.join(suffix.select("suffix", F.col("mean").alias("parent")), "suffix"), "domain")
    host = _shrunk(host.join(domain.select("suffix", "domain", F.col("mean").alias("parent")), ["suffix", "domain"]), "host")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return host.select("host", "mean", F.greatest(F.lit(0.0), F.col("mean") - Z * spread).alias("low"))


def _shrunk(level: DataFrame, name: str) -> DataFrame:
    """`level` (n, bad, parent) with the posterior's mean and weight, under one prior strength."""
    known = level.where((F.col("n") > 0) & (F.col("parent") > 0) & (F.col("parent") < 1))
    p, n = F.col("parent"), F.col("n")
    found = known.agg(
        F.sum(n * (F.col("bad") / n - p) * (F.col("bad") / n - p) / (p * (1 - p))).alias("spread"),
        F.count("*").alias("k"),
        F.sum(n).alias("n"),
        F.sum(n * n).alias("n2"),
    ).first()
    strength = STRENGTH
    if found.k and found.k > 1:
        room = found.n - found.n2 / found.n - (found.k - 1)
        if room > 0:
            rho = (found.spread - (found.k - 1)) / room  # correlation of pages of one member
            strength = (1 - rho) / rho if rho > 0 else MOST
    strength = min(MOST, max(LEAST, strength))
    return level.withColumn("mean", (F.lit(strength) * p + F.col("bad")) / (F.lit(strength) + n)).withColumn(
        "weight", F.lit(strength) + n
    )


def filtered_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules=RULES,
    limit: float = LIMIT,
) -> DataFrame:
    """(key, host, path, rule, verdict) for each row of `pages`.

    `outcomes`: (key, bad) of labelled pages, bad being 0 or 1; null is no outcome. Several outcomes of
    one key count each. A null url, or one without ://, has an empty host and path and is judged as the
    host ''. Rows that repeat are judged each; a null key has no outcome. Columns other than key and
    url are not read. An empty `pages` gives an empty table; without outcomes nothing is blocked but by
    a rule.
    """
    rows = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    labels = outcomes.select(F.col(key).alias("key"), F.col("bad").cast("long").alias("bad"))
    labels = labels.where("bad is not null").groupBy("key").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    counts = rows.join(labels, "key", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = rows.join(host_reputation(counts), "host", "left").withColumn("rule", name)
    own = F.when(F.col("low") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce(verdict, own).alias("verdict"),
        F.col("mean").alias("bad_share"), F.col("low").alias("bad_share_low"),
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """A labelled page is bad when it is toxic or of low quality; `doc_id` is the page's number."""
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    return labels.select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filtered_urls(pages, page_outcomes(labels)).select("page_id", "host", "path", "rule", "verdict")


def _level_sql(name: str, source: str, keys: str, parent: str) -> str:
    return f"""
{name}_in AS ({source}),
{name}_s AS (
  SELECT CASE WHEN k > 1 AND n - n2 / n - (k - 1) > 0
              THEN CASE WHEN spread > k - 1 THEN (n - n2 / n - (k - 1)) / (spread - (k - 1)) - 1 ELSE {MOST} END
              ELSE {STRENGTH} END AS raw
  FROM (SELECT sum(n * (bad / n - parent) ** 2 / (parent * (1 - parent))) AS spread, count(*) AS k,
               sum(n) AS n, sum(n * n) AS n2
        FROM {name}_in WHERE n > 0 AND parent > 0 AND parent < 1)
),
{name} AS (
  SELECT {keys}, n, bad, least({MOST}, greatest({LEAST}, raw)) AS m,
         (least({MOST}, greatest({LEAST}, raw)) * parent + bad) / (least({MOST}, greatest({LEAST}, raw)) + n) AS mean
  FROM {name}_in, {name}_s
)"""


def _op5_sql() -> str:
    rules = "\n".join(
        f"    WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{}}'".format(v)
        for kind, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
        for v in [f"{kind} {h}{p}"]
    )
    return rf"""
WITH pg AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{UPPER.lower()}') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
lab AS (
  SELECT doc_id AS page_id, count(*) AS n,
         sum(CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id
),
hosts AS (
  SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
         coalesce(nullif(regexp_extract(host, '\.([^.]{{1,3}}\.[a-z]{{2}})$', 1), ''), regexp_extract(host, '([^.]*)$', 1)) AS suffix,
         coalesce(nullif(regexp_extract(host, '([^.]+\.[^.]{{1,3}}\.[a-z]{{2}})$', 1), ''),
                  nullif(regexp_extract(host, '([^.]+\.[^.]+)$', 1), ''), host) AS domain
  FROM pg LEFT JOIN lab USING (page_id) GROUP BY host
),
doms AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
sufs AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM doms GROUP BY ALL),
{_level_sql("s", "SELECT *, (SELECT CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) ELSE 0.0 END FROM sufs) AS parent FROM sufs", "suffix", "")},
{_level_sql("d", "SELECT doms.*, s.mean AS parent FROM doms JOIN s USING (suffix)", "suffix, domain", "")},
{_level_sql("h", "SELECT hosts.*, d.mean AS parent FROM hosts JOIN d USING (suffix, domain)", "host", "")},
low AS (SELECT host, greatest(0.0, mean - {Z} * sqrt(mean * (1 - mean) / (m + n + 1))) AS low FROM h),
judged AS (
  SELECT page_id, host, path, low, CASE
{rules}
    ELSE NULL END AS r
  FROM pg LEFT JOIN low USING (host)
)
SELECT page_id, host, path, split_part(r, ' ', 2) AS rule,
       coalesce(split_part(r, ' ', 1), CASE WHEN low > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""


OP5_SQL = _op5_sql()
