"""Report queries over bronze, silver, gold and the ledger.

Every top-k has a total order: the metric, then the keys.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions import events as ev

PRICE_PER_GB_MONTH = 0.023  # fixed value: object storage price in the cost report
MB, GB = 1 << 20, 1 << 30
DEFAULT_DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]  # fixed values: the default run
# The columns that the event search shows.
EXPLORER_COLUMNS = [
    "id", "type", "actor_login", "repo_name", "created_at",
    "action", "ref", "commit_count", "pr_number", "issue_number",
]


def present(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


# ---- frequencies ------------------------------------------------------------


def counts_by(
    df: DataFrame, column: str, name: str | None = None, drop_null: bool = False
) -> DataFrame:
    rows = df.where(F.col(column).isNotNull()) if drop_null else df
    return rows.groupBy(F.col(column).alias(name or column)).agg(F.count("*").alias("n"))


def with_share(counts: DataFrame, places: int = 6) -> DataFrame:
    """Percent of the total, which is one number of its own: no task sees all counted rows."""
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, places))


def first_records_by_type(bronze: DataFrame, first: int = 5000) -> DataFrame:
    head = bronze.select("row_pos", "type").orderBy("row_pos").limit(first)
    return head.groupBy(F.coalesce("type", F.lit("unknown")).alias("type")).agg(
        F.count("*").alias("n")
    )


def records_by_type(lines: DataFrame) -> DataFrame:
    """Raw lines by their type; a line without one, or that is no JSON, is unknown."""
    type_ = F.coalesce(F.get_json_object("value", "$.type"), F.lit("unknown"))
    return lines.groupBy(type_.alias("type")).agg(F.count("*").alias("n"))


def repos_starting(silver: DataFrame, text: str) -> DataFrame:
    """Events of every repository whose name starts with the text."""
    found = silver.where(ev.starts_with(F.col("repo_name"), text))
    return found.groupBy("repo_name").agg(F.count("*").alias("n"))


def hourly_traffic(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.hour("created_at").alias("hour")).agg(F.count("*").alias("events"))


def pull_request_actions(silver: DataFrame) -> DataFrame:
    pulls = silver.where(F.col("type") == "PullRequestEvent")
    return with_share(counts_by(pulls, "action", drop_null=True))


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:
    return with_share(counts_by(quarantine, "error_reason"))


def distinct_types(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("type").isNotNull()).select("type").distinct().orderBy("type")


# ---- top-k ------------------------------------------------------------------


def top(df: DataFrame, metric: str, keys: list[str], n: int, columns: list[str]) -> DataFrame:
    return df.orderBy(F.desc(metric), *keys).limit(n).select(*columns)


def top_repo_days(repo_daily: DataFrame, n: int = 10) -> DataFrame:
    return top(
        repo_daily, "total_events", ["repo_name", "event_date"], n,
        ["event_date", "repo_name", "total_events", "push_count", "stars", "forks"],
    )


def top_actor_days(actor_daily: DataFrame, n: int = 10) -> DataFrame:
    return top(
        actor_daily, "total_commits", ["actor_login", "event_date"], n,
        ["event_date", "actor_login", "total_commits", "push_count", "repos_touched"],
    )


def top_pushers(events: DataFrame, key: str, n: int = 10) -> DataFrame:
    pushes = (
        events.where(F.col("type") == "PushEvent").groupBy(key).agg(F.count("*").alias("pushes"))
    )
    return top(pushes, "pushes", [key], n, [key, "pushes"])


def top_starred(repo_daily: DataFrame, n: int = 200) -> DataFrame:
    return top(
        repo_daily.where("stars > 0"), "total_events", ["repo_name", "event_date"], n,
        ["event_date", "repo_name", "push_count", "stars", "forks", "total_events"],
    )


# ---- row views --------------------------------------------------------------


def repo_timeline(events: DataFrame, repo_name: str) -> DataFrame:
    return (
        events.where(F.col("repo_name") == repo_name)
        .select("id", "type", "actor_login", "created_at")
        .orderBy("created_at", "id")
    )


def explorer_matches(
    silver: DataFrame, event_type: str | None = None, actor: str = "", regex: bool = False
) -> DataFrame:
    rows = silver
    if event_type:
        rows = rows.where(F.col("type") == event_type)
    if actor:
        rows = rows.where(ev.contains(F.col("actor_login"), actor, regex))
    return rows.select(*present(rows, EXPLORER_COLUMNS))


def explorer_page(matches: DataFrame, n: int = 250) -> DataFrame:
    return matches.orderBy("created_at", "id", "type").limit(n)


def flag_bots(events: DataFrame) -> DataFrame:
    return events.withColumn("is_bot", ev.is_bot(F.col("actor_login")))


def late_events(silver: DataFrame, limit_hours: int = 24) -> DataFrame:
    """Events that reached the lake later than the limit, with their lag."""
    lag = ev.lag_micros(F.col("transformed_at"), F.col("created_at"))
    return (
        silver.select("id", "type", "created_at", "transformed_at", lag.alias("lag_micros"))
        .where(F.col("lag_micros") > limit_hours * 3_600_000_000)
    )


# ---- work done and outstanding ----------------------------------------------


def date_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from start to end, both included."""
    if dt.date.fromisoformat(end) < dt.date.fromisoformat(start):
        raise ValueError("the end date must not be before the start date")
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("day"))


def date_list(spark: SparkSession, dates: list[str] | None = None) -> DataFrame:
    """The given days, each once; without any, the default days."""
    rows = [(dt.date.fromisoformat(d),) for d in sorted(set(dates or DEFAULT_DAYS))]
    return spark.createDataFrame(rows, "day DATE")


def expected_files(days: DataFrame) -> DataFrame:
    hours = F.sequence(F.lit(0), F.lit(23))
    return days.select("day", F.explode(hours).alias("hour")).withColumn(
        "source_file", ev.hour_file_name(F.col("day"), F.col("hour"))
    )


def done(ledger: DataFrame) -> DataFrame:
    return ledger.where("status = 'done'")


def missing_hours(days: DataFrame, ledger: DataFrame) -> DataFrame:
    return expected_files(days).join(
        done(ledger).select("source_file"), "source_file", "left_anti"
    )


def pending_files(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    return listed.join(done(ledger).select("source_file"), "source_file", "left_anti")


def file_status(days: DataFrame, ledger: DataFrame) -> DataFrame:
    return (
        expected_files(days)
        .join(done(ledger).drop("batch_seq", "reason"), "source_file", "left")
        .select(
            "day",
            "hour",
            "source_file",
            F.coalesce("status", F.lit("pending")).alias("status"),
            "bronze_rows",
            "silver_rows",
            "quarantine_rows",
            "duplicate_rows",
            "ingested_at",
        )
    )


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Files and rows over everything done, with the last time something was ingested."""
    sums = ["bronze_rows", "silver_rows", "quarantine_rows", "duplicate_rows"]
    return done(ledger).agg(
        F.count("*").alias("files_done"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        F.max("ingested_at").alias("last_ingested"),
    )


def ledger_by_day(ledger: DataFrame, files_per_day: int = 24) -> DataFrame:
    is_done = F.col("status") == "done"
    return (
        ledger.groupBy(ev.file_date(F.col("source_file")).alias("day"))
        .agg(
            F.count_if(is_done).alias("files_done"),
            F.max(F.when(is_done, F.col("ingested_at"))).alias("last_ingested"),
            F.coalesce(F.sum(F.when(is_done, F.col("bronze_rows"))), F.lit(0)).alias("bronze_rows"),
            F.coalesce(F.sum(F.when(is_done, F.col("silver_rows"))), F.lit(0)).alias("silver_rows"),
        )
        .withColumn("files_expected", F.lit(files_per_day).cast("bigint"))
        .withColumn("complete", F.col("files_done") >= F.col("files_expected"))
    )


def freshness_by_day(ledger: DataFrame, now: dt.datetime) -> DataFrame:
    age = F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros("last_ingested")
    hours = age / F.lit(3_600_000_000)
    return (
        ledger_by_day(ledger)
        .where("files_done > 0")
        .select(
            "day",
            "files_done",
            "last_ingested",
            F.floor(hours).alias("hours_ago"),
            F.when(hours < 24, "Fresh").when(hours < 48, "Stale").otherwise("Old").alias("status"),
        )
    )


def table_totals(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    total = counted[0]
    for part in counted[1:]:
        total = total.unionByName(part)
    return total


# ---- storage and scans ------------------------------------------------------


def storage(files: DataFrame, table_of: Column) -> DataFrame:
    """Parquet files, bytes and monthly cost per table, from a file listing."""
    per_table = (
        files.where(F.col("path").endswith(".parquet"))
        .groupBy(table_of.alias("table_name"))
        .agg(F.count("*").alias("parquet_files"), F.sum("length").alias("bytes"))
    )
    return per_table.select(
        "table_name",
        "parquet_files",
        "bytes",
        (F.col("bytes") / MB).alias("size_mb"),
        (F.col("bytes") / GB * PRICE_PER_GB_MONTH).alias("monthly_cost"),
    )


def storage_total(per_table: DataFrame) -> DataFrame:
    return per_table.agg(
        F.sum("parquet_files").alias("parquet_files"),
        F.sum("bytes").alias("bytes"),
        F.sum("size_mb").alias("size_mb"),
        F.sum("monthly_cost").alias("monthly_cost"),
    )


def full_and_one_day(table: DataFrame, day: str) -> DataFrame:
    """The same count by type over the whole table and over one date partition."""
    one_day = table.where(F.col("event_date") == F.lit(day).cast("date"))
    return counts_by(table, "type").select(
        F.lit("full").alias("scan"), "type", "n"
    ).unionByName(counts_by(one_day, "type").select(F.lit("one_day").alias("scan"), "type", "n"))


def measured_scans(table: DataFrame, day: str) -> DataFrame:
    """What a count over the whole table and over one date has read, as the scans themselves counted it.

    `table` is a file source. Files, bytes and rows are the metrics of the executed scan nodes, so nothing
    is read a second time to measure it. percent_saved tells how many of the full scan's rows the date
    filter spared; millis is wall time.
    """
    one_day = table.where(F.col("event_date") == F.lit(day).cast("date"))
    rows = []
    for name, frame in (("full", table), ("one_day", one_day)):
        start = time.perf_counter()
        counted = frame.agg(F.count("type").alias("n"))
        counted.collect()  # one row
        millis = (time.perf_counter() - start) * 1000
        files, size, scanned = _scan_metrics(counted)
        whole = rows[0][3] if rows else scanned
        saved = round(100.0 * (whole - scanned) / whole, 6) if whole else 0.0
        rows.append((name, files, size, scanned, saved, millis))
    return table.sparkSession.createDataFrame(
        rows,
        "scan STRING, files_read BIGINT, bytes_read BIGINT, rows_scanned BIGINT, "
        "percent_saved DOUBLE, millis DOUBLE",
    )


def _scan_metrics(executed: DataFrame) -> tuple[int, int, int]:
    """(files, bytes, rows) that the file scans of a frame have read; it must have been run."""
    totals = dict.fromkeys(("numFiles", "filesSize", "numOutputRows"), 0)
    waiting = [executed._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif kind == "FileSourceScanExec":
            for name in totals:
                totals[name] += node.metrics().apply(name).value()
        else:
            children = node.children()
            waiting += [children.apply(i) for i in range(children.size())]
    return tuple(totals.values())


def scan_cost(table: DataFrame) -> DataFrame:
    """Files, bytes and rows a scan of `table` (a filtered file source) touches."""
    return (
        table.groupBy(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
        )
        .agg(F.count("*").alias("n"))
        .agg(
            F.count("*").alias("files_read"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("bytes_read"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_scanned"),
        )
    )
