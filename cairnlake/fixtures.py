"""Event rows with known faults, derived from the `events` table.

Every row of `events` becomes one bronze row. Faults (missing ids and types, broken
payloads, late and future arrivals) are assigned by arithmetic on the event id, and
some rows are given an exact copy in the same file. Nothing is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions import events as ev
from cairnlake.session import use_utc
from cairnlake.sources import raw

ROWS_PER_PART = 5_000_000

ID = """CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN ''
        WHEN event_id % 139 = 0 THEN 'None' ELSE CAST(event_id AS STRING) END"""

# The event types by event kind and event id modulo 3.
TYPES_OF_KIND = {
    "click": ["PushEvent", "CreateEvent", "DeleteEvent"],
    "purchase": ["PullRequestEvent", "PullRequestReviewEvent", "PullRequestReviewCommentEvent"],
    "error": ["IssuesEvent", "IssueCommentEvent", "CommitCommentEvent"],
    "view": ["WatchEvent", "ReleaseEvent", "GollumEvent"],
    "signup": ["ForkEvent", "MemberEvent", "PublicEvent"],
}

LOGIN = """CASE WHEN user_id % 37 = 5 THEN NULL
           WHEN user_id % 10 = 3 THEN concat('ci', CAST(user_id AS STRING), '[bot]')
           WHEN user_id % 10 = 4 THEN concat('Auto', CAST(user_id AS STRING), '-Bot')
           ELSE concat('user', CAST(user_id AS STRING)) END"""

PAYLOAD = """CASE WHEN event_id % 113 = 0 THEN '{"action":' WHEN event_id % 127 = 0 THEN '{}'
    ELSE concat('{"action":"', CASE event_id % 2 WHEN 0 THEN 'opened' ELSE 'closed' END,
      '","ref":"refs/heads/b', CAST(k AS STRING), '","ref_type":"branch","size":',
      CASE WHEN k % 11 = 0 THEN '"n/a"' ELSE CAST(k % 7 AS STRING) END,
      ',"number":', CAST(k AS STRING), ',"pull_request":{"number":', CAST(k + 1000 AS STRING),
      '},"issue":{"number":', CAST(k + 2000 AS STRING), '}}') END"""

INGESTED = """CASE WHEN event_id % 131 = 0 THEN created_at + INTERVAL 30 HOUR
              WHEN event_id % 137 = 0 THEN created_at - INTERVAL 1 HOUR
              ELSE created_at + INTERVAL 2 HOUR END"""


def _type_sql() -> str:
    kinds = " ".join(
        f"WHEN event_type = '{kind}' THEN element_at(array({', '.join(map(repr, types))}), "
        "CAST(event_id % 3 AS INT) + 1)"
        for kind, types in TYPES_OF_KIND.items()
    )
    return f"""CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN ''
        WHEN event_id % 109 = 0 THEN 'DownloadEvent' {kinds} END"""


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def bronze_from(events: DataFrame) -> DataFrame:
    """The fixture as stored bronze rows; works on batch and streaming frames.

    The copies come from an `explode` in the same pass, not from a second scan. A row lies at
    twice its event id, its copy right behind it, so positions never meet.
    """
    base = events.select(
        "event_id",
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )
    copies = F.when(F.col("event_id") % 41 == 0, F.array(F.lit(0), F.lit(1)))
    copies = copies.otherwise(F.array(F.lit(0)))
    return base.withColumn("copy", F.explode(copies)).select(
        F.expr(ID).alias("id"),
        F.expr(_type_sql()).alias("type"),
        F.expr(LOGIN).alias("actor_login"),
        F.col("user_id").cast("string").alias("actor_id"),
        F.expr("CASE WHEN k = 13 THEN NULL ELSE concat('org/repo', CAST(k AS STRING)) END").alias(
            "repo_name"
        ),
        F.col("k").cast("string").alias("repo_id"),
        "created_at",
        F.expr(PAYLOAD).alias("payload"),
        F.expr(INGESTED).alias("ingested_at"),
        ev.hour_file_name(F.to_date("created_at"), F.hour("created_at")).alias("source_file"),
        (F.col("event_id").cast("bigint") * 2 + F.col("copy")).alias("row_pos"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from(load_events(spark, sf_dir))


def sent_again(bronze: DataFrame) -> DataFrame:
    """The rows, and a second time those of every third repository 20 days later, with new times."""
    later = [F.lit(0), F.lit(20)]
    days = F.explode(F.when(F.col("repo_id").cast("int") % 3 == 0, F.array(*later)).otherwise(F.array(later[0])))
    moved = {c: F.col(c) + F.make_dt_interval("days") for c in ("created_at", "ingested_at")}
    return bronze.withColumn("days", days).withColumns(moved).drop("days")


def lines_from(bronze: DataFrame) -> DataFrame:
    """The rows written back as raw JSON lines (value, source_file, row_pos, ingested_at).

    The payload text is put in as it is, so a broken payload makes a broken line.
    """
    head = F.to_json(
        F.struct(
            "id",
            "type",
            F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login")).alias(
                "actor"
            ),
            F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
            F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
            F.lit(True).alias("public"),
        ),
        {"ignoreNullFields": "false"},
    )
    open_object = F.rtrim(head, F.lit("}"))
    return bronze.select(
        F.concat(open_object, F.lit(',"payload":'), "payload", F.lit("}")).alias("value"),
        "source_file",
        "row_pos",
        "ingested_at",
    )


def write_hour_files(lines: DataFrame, root: str) -> None:
    """Land the lines as gzip parts, one folder per hour named like an hourly file.

    Rows are dealt out by hour, so an hour is one part; one of more than ROWS_PER_PART rows is dealt out by
    block of positions as well and written by several tasks. Without the count, every hour of a long table
    would be cut into as many small parts as the table has blocks.
    """
    sizes = lines.groupBy("source_file").agg(F.count("*").alias("n"))
    large = [r.source_file for r in sizes.where(F.col("n") > ROWS_PER_PART).collect()]
    block = F.floor(F.col("row_pos") / ROWS_PER_PART)
    block = F.when(F.col("source_file").isNull() | F.col("source_file").isin(large), block).otherwise(0)
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        lines.repartition(tasks, "source_file", block)
        .sortWithinPartitions("source_file", "row_pos")
        .select("value", "source_file")
        .write.partitionBy("source_file")
        .option("compression", "gzip")
        .text(root)
    )


# Hours of every fifth day that are landed with a fault.
CUT_SHORT, NO_GZIP, WITHOUT_A_BYTE, UNDER_WAY = 3, 4, 5, 6


def land_with_faults(lines: DataFrame, root: str, spare: str) -> None:
    """Land the lines as hourly files, some of which are faulty; `spare` keeps those hours whole.

    The faulty hours are few by rule (four of every fifth day). Their bytes are copied between
    streams of the file system.
    """
    day, hour = ev.file_date(F.col("source_file")), ev.file_hour(F.col("source_file"))
    faulty = (F.dayofmonth(day) % 5 == 0) & hour.isin(CUT_SHORT, NO_GZIP, WITHOUT_A_BYTE, UNDER_WAY)
    write_hour_files(lines.where(~faulty), root)
    write_hour_files(lines.where(faulty), spare)
    spark = lines.sparkSession
    fs, streams = _file_system(spark, root), spark._jvm.org.apache.commons.io.IOUtils
    for name, hour_number, parts in _spare_hours(spark, spare):
        suffix = ".tmp" if hour_number == UNDER_WAY else ""
        target = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}{suffix}"), True)
        if hour_number == NO_GZIP:
            target.write(bytearray(b"<html>not found</html>\n"))
        elif hour_number != WITHOUT_A_BYTE:
            source = fs.open(parts[0].getPath())
            streams.copyLarge(source, target, 0, parts[0].getLen() // 2)
            source.close()
        target.close()


# Hour of every fifth day that is landed in two parts, of even and odd events, one later.
IN_HALVES = 7


def _in_halves() -> Column:
    day, hour = ev.file_date(F.col("source_file")), ev.file_hour(F.col("source_file"))
    return (F.dayofmonth(day) % 5 == 0) & (hour == IN_HALVES)


def land_first_halves(lines: DataFrame, root: str) -> None:
    """Land the lines as hourly files; of some hours the even events only, and the number of their parts."""
    write_hour_files(lines.where(~_in_halves()), root)
    halved, half = lines.where(_in_halves()), F.floor(F.col("row_pos") / 2) % 2
    spark = lines.sparkSession
    fs = _file_system(spark, root)
    stated = halved.groupBy("source_file").agg(F.count_distinct(half).alias("parts"))
    for hour in stated.collect():  # one of every fifth day
        place = f"{root}/source_file={hour.source_file}/{raw.PART_COUNT}"
        target = fs.create(spark._jvm.org.apache.hadoop.fs.Path(place), True)
        target.write(bytearray(f"{hour.parts}\n".encode()))
        target.close()
    _append_half(halved.where(half == 0), root)


def land_second_halves(lines: DataFrame, root: str) -> None:
    _append_half(lines.where(_in_halves() & (F.floor(F.col("row_pos") / 2) % 2 == 1)), root)


def _append_half(lines: DataFrame, root: str) -> None:
    """One more part for each hour of `lines`."""
    (
        lines.repartition("source_file")
        .sortWithinPartitions("source_file", "row_pos")
        .select("value", "source_file")
        .write.mode("append").partitionBy("source_file")
        .option("compression", "gzip")
        .text(root)
    )


def mend(spark: SparkSession, root: str, spare: str) -> None:
    """Land the hours that were cut short or no gzip again, whole: parts in a row are one gzip file."""
    fs, streams = _file_system(spark, root), spark._jvm.org.apache.commons.io.IOUtils
    for name, hour_number, parts in _spare_hours(spark, spare):
        if hour_number in (CUT_SHORT, NO_GZIP):
            target = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"), True)
            for part in parts:
                source = fs.open(part.getPath())
                streams.copyLarge(source, target)
                source.close()
            target.close()


def _file_system(spark: SparkSession, place: str):
    return spark._jvm.org.apache.hadoop.fs.Path(place).getFileSystem(spark._jsc.hadoopConfiguration())


def _spare_hours(spark: SparkSession, spare: str) -> list[tuple]:
    """(name, hour, parts by name) of the hours kept whole."""
    found: dict[str, list] = {}
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{spare}/source_file=*/*.gz")
    for status in _file_system(spark, spare).globStatus(pattern) or []:
        name = status.getPath().getParent().getName().removeprefix("source_file=")
        found.setdefault(name, []).append(status)
    return [
        (name, int(name.split("-")[3].split(".")[0]), sorted(parts, key=lambda p: p.getPath().getName()))
        for name, parts in found.items()
    ]


def ledger_from(audit: DataFrame) -> DataFrame:
    """A ledger over the fixture's files: the 07 hour of every fifth day is pending.

    A file counts as ingested two hours after its own hour began; its batch is its day.
    """
    day, hour = ev.file_date(F.col("source_file")), ev.file_hour(F.col("source_file"))
    pending = (hour == 7) & (F.dayofmonth(day) % 5 == 0)
    began = day.cast("timestamp") + F.make_dt_interval(F.lit(0), hour)
    done = ~pending
    return audit.select(
        F.when(done, F.dayofmonth(day)).cast("bigint").alias("batch_seq"),
        "source_file",
        F.when(pending, "pending").otherwise("done").alias("status"),
        F.when(done, began + F.expr("INTERVAL 2 HOUR")).alias("ingested_at"),
        *[
            F.when(done, F.col(c)).alias(c)
            for c in ("bronze_rows", "silver_rows", "quarantine_rows", "duplicate_rows")
        ],
        F.lit(None).cast("string").alias("reason"),
    )


def with_batches(silver: DataFrame) -> DataFrame:
    """Silver rows with the day of the month as their version."""
    return silver.withColumn("batch_seq", F.dayofmonth("created_at").cast("bigint"))


def committed_from(silver_with_batches: DataFrame) -> DataFrame:
    """One version per batch, committed at the midnight after its day."""
    return silver_with_batches.groupBy("batch_seq").agg(
        (F.max("event_date").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("committed_at"),
        F.count("*").alias("added_rows"),
    )
