"""Gold: one row per repository and day, one per contributor and day.

Each is one grouped aggregate. Spark pre-aggregates on (group, distinct value) before
both shuffles, so a repository or contributor with a large share of all rows is
spread by the distinct column and arrives at its group already reduced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.functions import events as ev


def _of_type(*types: str) -> Column:
    return F.col("type").isin(*types) if len(types) > 1 else F.col("type") == types[0]


def _commits() -> Column:
    return F.coalesce(F.sum(F.when(_of_type("PushEvent"), F.col("commit_count"))), F.lit(0))


def _stamped(rows: DataFrame, aggregated_at: dt.datetime | None) -> DataFrame:
    if aggregated_at is None:
        return rows
    return rows.withColumn("aggregated_at", F.lit(aggregated_at).cast("timestamp"))


def repo_daily(silver: DataFrame, aggregated_at: dt.datetime | None = None) -> DataFrame:
    opened, closed = F.col("action") == "opened", F.col("action") == "closed"
    rows = (
        silver.where(F.col("repo_name").isNotNull())
        .groupBy("event_date", "repo_name")
        .agg(
            F.count_if(_of_type("PushEvent")).alias("push_count"),
            _commits().alias("total_commits"),
            F.count_if(_of_type("PullRequestEvent") & opened).alias("pr_opened"),
            F.count_if(_of_type("PullRequestEvent") & closed).alias("pr_closed"),
            F.count_if(_of_type("IssuesEvent") & opened).alias("issues_opened"),
            F.count_if(_of_type("WatchEvent")).alias("stars"),
            F.count_if(_of_type("ForkEvent")).alias("forks"),
            F.count_distinct("actor_login").alias("unique_contributors"),
            F.count("*").alias("total_events"),
        )
    )
    return _stamped(rows, aggregated_at)


def actor_daily(silver: DataFrame, aggregated_at: dt.datetime | None = None) -> DataFrame:
    rows = (
        silver.where(F.col("actor_login").isNotNull())
        .groupBy("event_date", "actor_login")
        .agg(
            F.count_if(_of_type("PushEvent")).alias("push_count"),
            _commits().alias("total_commits"),
            F.count_if(_of_type(*ev.PULL_REQUEST_TYPES)).alias("pr_count"),
            F.count_if(_of_type(*ev.ISSUE_TYPES)).alias("issue_count"),
            F.count_distinct("repo_name").alias("repos_touched"),
            F.count("*").alias("total_events"),
        )
    )
    return _stamped(rows, aggregated_at)


# A sketch of 2**SKETCH_BITS registers is off by 1.04 / 2**(SKETCH_BITS / 2) of the count (one standard
# error); estimates are promised within four of these.
SKETCH_BITS = 12
SKETCH_BOUND = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)


def contributor_sketches(silver: DataFrame, *also: str) -> DataFrame:
    """(event_date, repo_name, contributors): a sketch of the contributors of each repository and day.

    For streams, where an exact distinct count is not to be had, and for batches whose counts are to
    be merged later. Rows without a contributor count as none. `also` adds grouping columns.
    """
    return (
        silver.where(F.col("repo_name").isNotNull())
        .groupBy("event_date", "repo_name", *also)
        .agg(F.hll_sketch_agg("actor_login", SKETCH_BITS).alias("contributors"))
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per repository and day, from those of any number of batches."""
    return sketches.groupBy("event_date", "repo_name").agg(F.hll_union_agg("contributors").alias("contributors"))


def estimated(sketches: DataFrame) -> DataFrame:
    """The sketches' counts, within SKETCH_BOUND of the exact ones."""
    return sketches.withColumn("approx_contributors", F.hll_sketch_estimate("contributors")).drop("contributors")


def presented(gold: DataFrame) -> DataFrame:
    """Date order, busiest first; ties by key so that the order is total."""
    key = "repo_name" if "repo_name" in gold.columns else "actor_login"
    return gold.orderBy("event_date", F.desc("total_events"), key)
