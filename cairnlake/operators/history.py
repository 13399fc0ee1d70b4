"""Past versions of a table and changes of its schema.

A version is one committed batch. Rows carry their `batch_seq` as a partition
column, so reading as of a version is a partition filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_SLOTS = 256
# The columns of a sample of new rows.
SAMPLE_COLUMNS = ["id", "type", "actor_login", "repo_name", "created_at"]


class NoSuchVersion(LookupError):
    pass


# ---- versions ---------------------------------------------------------------


def versions(ledger: DataFrame, rows_column: str = "silver_rows") -> DataFrame:
    """(batch_seq, committed_at, added_rows) of every committed batch."""
    return (
        ledger.where("status = 'done'")
        .groupBy("batch_seq")
        .agg(
            F.max("ingested_at").alias("committed_at"),
            F.sum(rows_column).alias("added_rows"),
        )
    )


def version_history(committed: DataFrame, bucket_size: int = 4096) -> DataFrame:
    """Versions in order, with a running row total and an index from 0.

    The running sums are taken inside buckets of consecutive versions, then moved up by the total of
    the earlier buckets, which are summed in buckets of buckets in turn: no window holds more than
    `bucket_size` rows, whatever the length of the history (two at least: buckets of one row never get fewer).
    """
    bucket_size = max(2, bucket_size)
    numbered = committed.withColumn("position", F.col("batch_seq"))
    largest = committed.agg(F.max("batch_seq")).first()[0] or 0
    before = _sums_before(numbered.select("position", "added_rows", F.lit(1).alias("n")), largest, bucket_size)
    return committed.join(before, committed.batch_seq == before.position).select(
        F.col("versions_before").alias("idx"),
        "batch_seq",
        "committed_at",
        (F.col("rows_before") + F.col("added_rows")).alias("total_rows"),
        "added_rows",
    )


def _sums_before(rows: DataFrame, largest: int, size: int) -> DataFrame:
    """(position, rows_before, versions_before): sums over smaller positions, the largest of which is given."""
    rows = rows.withColumn("bucket", F.floor(F.col("position") / size))
    inside = Window.partitionBy("bucket").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"rows_before": "added_rows", "versions_before": "n"}
    found = rows.withColumns({name: F.coalesce(F.sum(c).over(inside), F.lit(0)) for name, c in sums.items()})
    if largest >= size:
        totals = rows.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in sums.values()))
        above = _sums_before(totals.withColumnRenamed("bucket", "position"), largest // size, size)
        above = above.withColumnsRenamed({"position": "bucket", **{c: f"outer_{c}" for c in sums}})
        found = found.join(above, "bucket").withColumns({c: F.col(c) + F.col(f"outer_{c}") for c in sums})
    return found.select("position", *sums)


def parse_instant(text: str) -> dt.datetime:
    """An ISO time as UTC. A given offset is honoured; without one it is UTC."""
    moment = dt.datetime.fromisoformat(text)
    return (moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)).astimezone(
        dt.timezone.utc
    )


def choose_version(
    committed: DataFrame, version: int | None = None, as_of: str | None = None
) -> int:
    """A version by number, or the latest at or before a time, or else the first."""
    if version is not None:
        chosen = committed.where(F.col("batch_seq") == version).agg(F.max("batch_seq"))
    elif as_of is not None:
        moment = F.lit(parse_instant(as_of)).cast("timestamp")
        chosen = committed.where(F.col("committed_at") <= moment).agg(F.max("batch_seq"))
    else:
        chosen = committed.agg(F.min("batch_seq"))
    found = chosen.first()[0]
    if found is None:
        raise NoSuchVersion(f"no version for version={version} as_of={as_of}")
    return found


def as_of(table: DataFrame, version: int) -> DataFrame:
    return table.where(F.col("batch_seq") <= version)


def growth(histories: dict[str, DataFrame], limit: int = 10) -> DataFrame:
    """Versions, rows and latest commit per table; flagged beyond `limit` versions."""
    parts = [
        committed.agg(
            F.count("*").alias("versions"),
            F.coalesce(F.sum("added_rows"), F.lit(0)).alias("current_rows"),
            F.max("committed_at").alias("latest_at"),
        ).select(
            F.lit(name).alias("table_name"),
            "versions",
            "current_rows",
            "latest_at",
            (F.col("versions") > limit).alias("needs_expiry"),
        )
        for name, committed in histories.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# ---- comparison -------------------------------------------------------------


def row_delta(table: DataFrame, version: int) -> DataFrame:
    """Rows before and after, from one pass over the partition column."""
    old = F.count_if(F.col("batch_seq") <= version)
    counted = table.agg(old.alias("before_rows"), F.count("*").alias("after_rows"))
    added = F.col("after_rows") - F.col("before_rows")
    percent = F.when(
        F.col("before_rows") > 0, F.round(added * 100.0 / F.col("before_rows"), 6)
    ).otherwise(0.0)
    return counted.select(
        "before_rows", "after_rows", added.alias("added_rows"), percent.alias("percent")
    )


def type_diff(before: DataFrame, after: DataFrame, top_n: int | None = None) -> DataFrame:
    """Full distributions of both versions side by side; absent types count 0."""

    def distribution(df: DataFrame, name: str) -> DataFrame:
        return (
            df.where("type IS NOT NULL")
            .groupBy(F.col("type").alias("event_type"))
            .agg(F.count("*").alias(name))
        )

    both = (
        distribution(before, "before_n")
        .join(distribution(after, "after_n"), "event_type", "full_outer")
        .na.fill(0, ["before_n", "after_n"])
        .withColumn("diff", F.col("after_n") - F.col("before_n"))
    )
    if top_n is not None:
        both = both.orderBy(
            F.desc(F.greatest("before_n", "after_n")), "event_type"
        ).limit(top_n)
    return both.orderBy("event_type")


def new_rows(before: DataFrame, after: DataFrame, key: str = "id") -> DataFrame:
    """Rows of `after` whose key is not in `before`; a NULL key counts as new.

    The known keys are reduced to one row each ahead of the shuffle the join uses. Rows
    without a key match nothing; they are dealt out over slots so that very many of
    them do not meet in one task. (Silver holds an id at most once per source file.)
    """
    slot = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*after.columns), F.lit(NULL_SLOTS)))
    known = before.where(F.col(key).isNotNull()).select(key).distinct()
    return (
        after.withColumn("_slot", F.coalesce(slot, F.lit(0)))
        .join(known.withColumn("_slot", F.lit(0).cast("bigint")), [key, "_slot"], "left_anti")
        .select(*after.columns)
    )


def rows_since(table: DataFrame, version: int, key: str = "id") -> DataFrame:
    """`new_rows` of the current table against a version of itself.

    Rows of the version are not new unless their key is NULL, so the left side
    reads later partitions and such rows only.
    """
    candidates = table.where((F.col("batch_seq") > version) | F.col(key).isNull())
    return new_rows(as_of(table, version), candidates, key)


def sample_rows(rows: DataFrame, n: int = 5) -> DataFrame:
    columns = [c for c in SAMPLE_COLUMNS if c in rows.columns]
    return rows.select(*columns).orderBy("created_at", "id").limit(n)


# ---- schema evolution -------------------------------------------------------


def add_column(schema: T.StructType, name: str, data_type: T.DataType) -> T.StructType:
    """The schema with one more optional column; unchanged when it is there already."""
    if name in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(name, data_type, True)])


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in schema order and type; those the frame lacks become typed NULLs."""

    def column(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in df.columns else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def append_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows together; a column only one side has is NULL on the other."""
    return old.unionByName(new, allowMissingColumns=True)
