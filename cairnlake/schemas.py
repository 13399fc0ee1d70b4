"""One schema per table. Types are kept to string, bigint, date, timestamp, boolean."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "BOOLEAN": T.BooleanType(),
}


def _fields(spec: str) -> T.StructType:
    """Columns from "name TYPE [NOT NULL], ...", without needing a session."""
    fields = []
    for column in spec.split(","):
        name, type_name, *required = column.split()
        fields.append(T.StructField(name, _TYPES[type_name], not required))
    return T.StructType(fields)


BRONZE = _fields(
    "id STRING, type STRING, actor_login STRING, actor_id STRING, repo_name STRING, "
    "repo_id STRING, created_at TIMESTAMP, payload STRING, ingested_at TIMESTAMP"
)

# Lineage kept with every stored bronze row. `corrupt_record` is the whole line
# when the line is not a JSON object; `error_reason` is the verdict of the
# classification, so a quarantine scan can skip pages without rejected rows.
BRONZE_STORED = _fields(
    "id STRING, type STRING, actor_login STRING, actor_id STRING, repo_name STRING, "
    "repo_id STRING, created_at TIMESTAMP, payload STRING, ingested_at TIMESTAMP, "
    "source_file STRING, source_part STRING, row_pos BIGINT, corrupt_record STRING, "
    "error_reason STRING"
)

SILVER = _fields(
    "id STRING, type STRING, actor_login STRING, actor_id STRING, repo_name STRING, "
    "repo_id STRING, created_at TIMESTAMP, event_date DATE, action STRING, ref STRING, "
    "ref_type STRING, commit_count BIGINT, pr_number BIGINT, issue_number BIGINT, "
    "ingested_at TIMESTAMP, transformed_at TIMESTAMP"
)

QUARANTINE = _fields(
    "source_file STRING, raw_id STRING, raw_type STRING, raw_record STRING, "
    "error_reason STRING, quarantined_at TIMESTAMP"
)

REPO_DAILY = _fields(
    "event_date DATE NOT NULL, repo_name STRING NOT NULL, push_count BIGINT, "
    "total_commits BIGINT, pr_opened BIGINT, pr_closed BIGINT, issues_opened BIGINT, "
    "stars BIGINT, forks BIGINT, unique_contributors BIGINT, total_events BIGINT, "
    "aggregated_at TIMESTAMP"
)

ACTOR_DAILY = _fields(
    "event_date DATE NOT NULL, actor_login STRING NOT NULL, push_count BIGINT, "
    "total_commits BIGINT, pr_count BIGINT, issue_count BIGINT, repos_touched BIGINT, "
    "total_events BIGINT, aggregated_at TIMESTAMP"
)

LEDGER = _fields(
    "batch_seq BIGINT, source_file STRING, status STRING, ingested_at TIMESTAMP, "
    "bronze_rows BIGINT, silver_rows BIGINT, quarantine_rows BIGINT, "
    "duplicate_rows BIGINT, reason STRING"
)

CHECK_RESULTS = _fields(
    "run_at TIMESTAMP, layer STRING, check_no INT, check_name STRING, metric STRING, "
    "value BIGINT, outcome STRING, error STRING"
)


def plus(schema: T.StructType, spec: str) -> T.StructType:
    """The schema with the columns of a DDL string added at the end."""
    return T.StructType(schema.fields + _fields(spec).fields)


def describe(schema: T.StructType) -> list[tuple[int, str, str, bool]]:
    """(position, name, type, required) of every column, positions from 1."""
    return [
        (i, f.name, f.dataType.simpleString(), not f.nullable)
        for i, f in enumerate(schema.fields, start=1)
    ]
