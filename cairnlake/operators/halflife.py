"""Activity half-life of a repository after its first release."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_activity(silver: DataFrame) -> DataFrame:
    """(repo_name, event_date, activity, releases): one reduced row per repository-day."""
    return (
        silver.where("repo_name IS NOT NULL")
        .groupBy("repo_name", "event_date")
        .agg(
            F.count("*").alias("activity"),
            F.count_if(F.col("type") == "ReleaseEvent").alias("releases"),
        )
    )


def half_life(silver: DataFrame) -> DataFrame:
    """Days from a repository's peak to the first day at or below half of it.

    Counted from the first ReleaseEvent (events carry no version, so the first one
    stands for the first major one). The peak is the first day with the highest
    event count from then on. A day without events counts 0, so the half may be
    reached on the day after an active one; days after the end of the data do not
    count. `half_life_days` is NULL when the half is not reached.

    No day calendar is joined in: a gap shows as a next active day that is not
    tomorrow. The windows see one row per repository and day, and share a shuffle.
    """
    last_day = silver.agg(F.max("event_date")).scalar()
    repo = Window.partitionBy("repo_name")
    by_day = repo.orderBy("event_date")
    since_release = (
        daily_activity(silver)
        .withColumn(
            "release_date", F.min(F.when(F.col("releases") > 0, F.col("event_date"))).over(repo)
        )
        .where("event_date >= release_date")
    )
    peaked = (
        since_release.withColumn("peak", F.max("activity").over(repo))
        .withColumn(
            "peak_date",
            F.min(F.when(F.col("activity") == F.col("peak"), F.col("event_date"))).over(repo),
        )
        .withColumn("next_day", F.lead("event_date").over(by_day))
    )
    tomorrow = F.date_add("event_date", 1)
    silent_day = F.when(
        (F.col("next_day").isNull() & (tomorrow <= F.col("last_day")))
        | (F.col("next_day") > tomorrow),
        tomorrow,
    )
    low_day = F.when(F.col("activity") * 2 <= F.col("peak"), F.col("event_date"))
    return (
        peaked.where("event_date >= peak_date")
        .withColumn("last_day", last_day)
        .groupBy("repo_name", "release_date", "peak_date", "peak")
        .agg(F.min(F.least(silent_day, low_day)).alias("half_date"))
        .withColumn("half_life_days", F.datediff("half_date", "peak_date").cast("bigint"))
    )
