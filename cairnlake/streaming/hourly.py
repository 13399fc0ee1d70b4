"""Hourly event counts over a stream, with late arrivals flagged, and those left out counted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cairnlake.functions import events as ev
from cairnlake.operators import rollups

LATE_MICROS = 24 * 3_600_000_000


def hourly_counts(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """(hour_start, events, late_events); the same plan for batch and stream.

    With a watermark, state of hours older than it is dropped, and so are rows that
    arrive for them; choose it above the longest delay to be counted.
    """
    rows = events.withWatermark("created_at", watermark) if watermark else events
    lag = ev.lag_micros(F.col("ingested_at"), F.col("created_at"))
    return (
        rows.groupBy(F.window("created_at", "1 hour").alias("hour"))
        .agg(F.count("*").alias("events"), F.count_if(lag > LATE_MICROS).alias("late_events"))
        .select(F.col("hour.start").alias("hour_start"), "events", "late_events")
    )


def distinct_within(events: DataFrame, delay: str, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Stream rows with repeats of a key inside the delay left out.

    A key is remembered until the watermark has passed its first row's time by the delay, so state does
    not grow with the stream. A repeat whose time lies further back is kept, as is one that comes after
    the key was forgotten; a row older than the watermark is dropped.
    """
    return events.withWatermark("created_at", delay).dropDuplicatesWithinWatermark(list(keys))


def write_rows(rows: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append the stream's rows to Parquet; the sink's own log keeps a replayed micro-batch out."""
    return (
        rows.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_updates(counts: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch's changed hours to a folder of its own.

    A replayed micro-batch overwrites its folder, so the sink holds every update once.
    """

    def write(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_sketches(events: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Keep a contributor sketch per repository, day and micro-batch, in a folder per micro-batch.

    No state is held: the sketches of all micro-batches are merged when they are read. A replayed
    micro-batch overwrites its folder.
    """

    def write(rows: DataFrame, epoch: int) -> None:
        rollups.contributor_sketches(rows).write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def with_dropped(kept: DataFrame, total: DataFrame) -> DataFrame:
    """(hour_start, events, dropped): the counts that a watermark let through, and the rows it did not.

    `kept` are the counts under the watermark, `total` those of a second branch over the same stream
    whose watermark is the longest time for which rows are to be accounted for. An hour of which every
    row came too late has 0 events.
    """
    both = total.select("hour_start", F.col("events").alias("total")).join(
        kept.select("hour_start", "events"), "hour_start", "left"
    )
    events = F.coalesce("events", F.lit(0))
    return both.select("hour_start", events.alias("events"), (F.col("total") - events).alias("dropped"))


def run_by_arrival(
    rows: DataFrame, base: str, days: int, start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Let the rows arrive at a stream period by period of `ingested_at`, and run it after each.

    `start` is given the stream and starts a query of its own that stops when it has seen all there
    is (availableNow); its checkpoint carries state and watermark from one run to the next. The number
    of runs is the table's span in periods; no row passes through the driver.
    """
    spark = rows.sparkSession
    period = F.floor(F.unix_date(F.to_date("ingested_at")) / days)
    rows.withColumn("period", period).write.partitionBy("period").parquet(f"{base}/periods")
    waiting = spark.read.parquet(f"{base}/periods")
    for (number,) in waiting.select("period").distinct().orderBy("period").collect():
        arrived = waiting.where(F.col("period") == number).select(*rows.columns)
        arrived.write.mode("append").parquet(f"{base}/landing")
        start(spark.readStream.schema(rows.schema).parquet(f"{base}/landing")).awaitTermination()


def latest(updates: DataFrame) -> DataFrame:
    """The current counts: the last update of every hour."""
    newest = F.max_by(F.struct("events", "late_events"), "epoch")
    return (
        updates.groupBy("hour_start").agg(newest.alias("c")).select("hour_start", "c.*")
    )
