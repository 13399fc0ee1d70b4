"""Bronze rows to silver, quarantine and duplicate counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnlake import schemas
from cairnlake.functions import events as ev

KEPT = ["id", "type", "actor_login", "actor_id", "repo_name", "repo_id", "created_at"]
WHOLE_TABLE_ORDER = ("file_date", "file_hour")


def classify(bronze: DataFrame) -> DataFrame:
    """Add `error_reason` (NULL when clean) and the payload members.

    Priority: malformed_record, missing_id, missing_type, malformed_payload.
    """
    corrupt = F.col("corrupt_record") if "corrupt_record" in bronze.columns else None
    malformed = ev.is_malformed_payload(F.col("payload"))
    reason = ev.error_reason(F.col("id"), F.col("type"), malformed, corrupt)
    return ev.with_payload(bronze).withColumn("error_reason", reason)


def clean_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("error_reason").isNull())


def rejected_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("error_reason").isNotNull())


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key.

    Filtering the row number to 1 lets Spark drop all but one row per key in each
    task before the shuffle, so a key with very many copies stays small.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_position", position).where("_position = 1").drop("_position")


def repeated_ids(classified: DataFrame) -> DataFrame:
    """(source_file, id, first_pos) of the ids that occur more than once in a file.

    A narrow aggregate: however often an id is repeated, it is one row here.
    """
    return (
        clean_rows(classified)
        .groupBy("source_file", "id")
        .agg(F.count("*").alias("n"), F.min("row_pos").alias("first_pos"))
        .where("n > 1")
        .drop("n")
    )


def silver(
    classified: DataFrame,
    transformed_at: Column | dt.datetime | None = None,
    per_file: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """Clean, deduplicated, typed events in silver column order.

    Duplicates are the later rows of an id inside one source file, or in the
    whole table when `per_file` is false. The payload is turned into typed columns
    ahead of the shuffle, which then moves those and not the JSON text. `keep`
    names further columns (lineage) to carry to the end. Inside an hour the order is that
    of its parts' names, where known, then of the rows in a part.
    """
    keep = keep or []
    stamp = F.lit(transformed_at) if isinstance(transformed_at, dt.datetime) else transformed_at
    stamp = F.current_timestamp() if stamp is None else stamp
    clean = clean_rows(classified)
    if not set(ev.PARSED) <= set(clean.columns):
        clean = ev.with_payload(clean)
    place = [c for c in ("source_part", "row_pos") if c in clean.columns]
    typed = clean.select(
        *KEPT,
        F.to_date("created_at").alias("event_date"),
        *[column.alias(name) for name, column in ev.payload_columns().items()],
        "ingested_at",
        stamp.cast("timestamp").alias("transformed_at"),
        "source_file",
        *place,
        *[c for c in keep if c not in ("source_file", *place)],
    )
    if per_file:
        first = keep_first(typed, ["source_file", "id"], place)
    else:
        dated = typed.withColumn("file_date", ev.file_date(F.col("source_file"))).withColumn(
            "file_hour", ev.file_hour(F.col("source_file"))
        )
        first = keep_first(dated, ["id"], [*WHOLE_TABLE_ORDER, *place])
    return first.select(*schemas.SILVER.fieldNames(), *keep)


def quarantine(
    classified: DataFrame,
    quarantined_at: Column | dt.datetime | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Rejected rows with the whole bronze row as JSON.

    For a line that was not JSON the record also holds that line's text.
    """
    stamp = F.lit(quarantined_at) if isinstance(quarantined_at, dt.datetime) else quarantined_at
    stamp = F.current_timestamp() if stamp is None else stamp
    members = [
        c
        for c in [*schemas.BRONZE.fieldNames(), "source_file", "row_pos", "corrupt_record"]
        if c in classified.columns
    ]
    return rejected_rows(classified).select(
        "source_file",
        F.col("id").alias("raw_id"),
        F.col("type").alias("raw_type"),
        F.to_json(F.struct(*members), {"ignoreNullFields": "false"}).alias("raw_record"),
        "error_reason",
        stamp.cast("timestamp").alias("quarantined_at"),
        *(keep or []),
    )


def replay(quarantined: DataFrame, fix=None) -> DataFrame:
    """Rebuild bronze rows from quarantined records, apply `fix`, classify again.

    `old_reason` is what the row was rejected for; `error_reason` is the new verdict.
    """
    shape = schemas.plus(
        schemas.BRONZE, "source_file STRING, row_pos BIGINT, corrupt_record STRING"
    )
    rows = quarantined.select(
        F.col("error_reason").alias("old_reason"), F.from_json("raw_record", shape).alias("row")
    ).select("old_reason", "row.*")
    return classify(fix(rows) if fix else rows)


def file_audit(classified: DataFrame) -> DataFrame:
    """Rows in and out per source file, and how many ids are repeated in it.

    Grouping by (file, id) first spreads a very large file over many tasks and
    counts repeated ids without moving any row.
    """
    clean_id = F.when(F.col("error_reason").isNull(), F.col("id"))
    by_id = classified.groupBy("source_file", clean_id.alias("clean_id")).agg(
        F.count("*").alias("n")
    )
    kept = F.count("clean_id")
    return by_id.groupBy("source_file").agg(
        F.sum("n").alias("bronze_rows"),
        kept.alias("silver_rows"),
        F.coalesce(F.sum(F.when(F.col("clean_id").isNull(), F.col("n"))), F.lit(0)).alias(
            "quarantine_rows"
        ),
        (F.coalesce(F.sum(F.when(F.col("clean_id").isNotNull(), F.col("n"))), F.lit(0)) - kept)
        .alias("duplicate_rows"),
        F.count_if(F.col("clean_id").isNotNull() & (F.col("n") > 1)).alias("repeated_ids"),
    )


def balanced(audit: DataFrame) -> DataFrame:
    total = F.col("silver_rows") + F.col("quarantine_rows") + F.col("duplicate_rows")
    return audit.withColumn("balanced", F.col("bronze_rows") == total)
