"""Tables of the lake on shared storage, and the ledger that commits their batches.

Layout below the root, for the current generation g:

    gen=g/bronze/batch_seq=N          gen=g/quarantine/batch_seq=N
    gen=g/silver/batch_seq=N/event_date=D
    gen=g/repo_daily/event_date=D     gen=g/actor_daily/event_date=D
    gen=g/ledger, gen=g/gold_marks    generations, schemas, checks

Commit protocol (one writer at a time). A batch writes its rows under the number
after the last committed one, and is committed by the single ledger file appended
at the end. Rows of a crashed attempt therefore lie above the last committed number;
readers never look there and the next attempt overwrites them. Reading the table, or
any version of it, is a filter on the partition column and nothing else.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake import schemas
from cairnlake.operators import history
from cairnlake.session import use_utc
from cairnlake.sources.known_ids import KnownIds

VERSIONED = {
    "bronze": schemas.BRONZE_STORED,
    "silver": schemas.plus(schemas.SILVER, "source_file STRING"),
    "quarantine": schemas.QUARANTINE,
}
REPLACED = {"repo_daily": schemas.REPO_DAILY, "actor_daily": schemas.ACTOR_DAILY}
ROWS_PER_FILE = 5_000_000
_GENERATIONS = T.StructType([T.StructField("generation", T.LongType())])
_MARKS = T.StructType([T.StructField("batch_seq", T.LongType())])
_SCHEMAS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("schema_id", T.LongType()),
        T.StructField("definition", T.StringType()),
    ]
)


class ReadBackError(RuntimeError):
    pass


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at `path`, or a typed empty frame when there is none."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def write_verified(writer_input: DataFrame, path: str, partition_by: list[str]) -> int:
    """Write a batch folder and make sure that what is read back has the rows written."""
    spark = writer_input.sparkSession
    written = Observation()
    (
        writer_input.observe(written, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")  # a retry leaves nothing of the attempt before
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*partition_by)
        .parquet(path)
    )
    expected = written.get["n"]
    found = spark.read.schema(writer_input.schema).parquet(path).count()
    if found != expected:
        raise ReadBackError(f"{path}: wrote {expected} rows, read back {found}")
    return found


class Lake:
    """`id_buckets`: keep silver's ids bucketed as well, so that new rows are found without moving old ids."""

    def __init__(
        self, spark: SparkSession, root: str, generation: int | None = None, id_buckets: int | None = None
    ):
        self.spark = use_utc(spark)
        self.root = root.rstrip("/")
        self.generation = self._current_generation() if generation is None else generation
        self.id_buckets = id_buckets

    # ---- places ----

    def path(self, table: str) -> str:
        return f"{self.root}/gen={self.generation}/{table}"

    def batch_path(self, table: str, seq: int) -> str:
        return f"{self.path(table)}/batch_seq={seq}"

    @property
    def checks_path(self) -> str:
        return f"{self.root}/checks"

    # ---- generations: a full refresh builds beside the old data, then switches ----

    def _current_generation(self) -> int:
        path = f"{self.root}/generations"
        if not path_exists(self.spark, path):
            return 0
        known = self.spark.read.schema(_GENERATIONS).parquet(path)
        return known.agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]

    def next_generation(self) -> Lake:
        """An unused one: what a crashed refresh has left behind is never built upon."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/gen=*")
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(place)
        used = [int(f.getPath().getName().removeprefix("gen=")) for f in found or []]
        return Lake(self.spark, self.root, max([self._current_generation(), *used]) + 1, self.id_buckets)

    def make_current(self) -> None:
        row = self.spark.createDataFrame([(self.generation,)], _GENERATIONS)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/generations")

    # ---- ledger ----

    def ledger(self) -> DataFrame:
        return read_or_empty(self.spark, self.path("ledger"), schemas.LEDGER)

    def last_seq(self) -> int:
        if not path_exists(self.spark, self.path("ledger")):
            return 0
        done = self.ledger().where("status = 'done'")
        return done.agg(F.coalesce(F.max("batch_seq"), F.lit(0))).first()[0]

    def commit(self, rows: DataFrame) -> None:
        """Append ledger rows as one file: they become visible together or not at all."""
        history.align_to_schema(rows, schemas.LEDGER).repartition(1).write.mode(
            "append"
        ).parquet(self.path("ledger"))

    # ---- gold ----

    def gold_seq(self) -> int:
        """The version that both gold tables reflect; 0 before the first."""
        marks = read_or_empty(self.spark, self.path("gold_marks"), _MARKS)
        return marks.agg(F.coalesce(F.max("batch_seq"), F.lit(0))).first()[0]

    def mark_gold(self, seq: int) -> None:
        """Written after both gold tables, so a crash before it leaves gold owed."""
        mark = self.spark.createDataFrame([(seq,)], _MARKS)
        mark.coalesce(1).write.mode("append").parquet(self.path("gold_marks"))

    # ---- schemas ----

    def schema(self, table: str) -> T.StructType:
        default = {**VERSIONED, **REPLACED}[table]
        path = f"{self.root}/schemas"
        if not path_exists(self.spark, path):
            return default
        latest = (
            self.spark.read.schema(_SCHEMAS)
            .parquet(path)
            .where(F.col("table_name") == table)
            .agg(F.max_by("definition", "schema_id"))
            .first()[0]
        )
        return T.StructType.fromJson(json.loads(latest)) if latest else default

    def add_column(self, table: str, name: str, data_type: T.DataType) -> bool:
        """Add an optional column; no data file is touched. False when it exists already."""
        before = self.schema(table)
        after = history.add_column(before, name, data_type)
        if after == before:
            return False
        row = [(table, len(after.fields), json.dumps(after.jsonValue()))]
        self.spark.createDataFrame(row, _SCHEMAS).coalesce(1).write.mode("append").parquet(
            f"{self.root}/schemas"
        )
        return True

    # ---- reading ----

    def versioned(self, table: str, version: int | None = None) -> DataFrame:
        """All committed rows, or those as of a version, with lineage columns.

        Files written before a column was added give NULL for it.
        """
        schema = schemas.plus(self.schema(table), "batch_seq BIGINT")
        upto = self.last_seq() if version is None else min(version, self.last_seq())
        return history.as_of(read_or_empty(self.spark, self.path(table), schema), upto)

    def bronze(self, version: int | None = None) -> DataFrame:
        return self.versioned("bronze", version)

    def silver(self, version: int | None = None) -> DataFrame:
        return self.versioned("silver", version).drop("source_file", "batch_seq")

    def quarantine(self, version: int | None = None) -> DataFrame:
        return self.versioned("quarantine", version).drop("batch_seq")

    def head(self, table: str, n: int, version: int | None = None) -> DataFrame:
        """Any n rows of a versioned table, also of an earlier version of it."""
        return self.versioned(table, version).limit(n)

    @property
    def known_ids(self) -> KnownIds | None:
        return KnownIds(self.spark, self.path("silver_ids"), self.id_buckets) if self.id_buckets else None

    def new_rows(self, version: int) -> DataFrame:
        """Silver rows of later batches whose id was not there in `version` (or that have none)."""
        table = self.versioned("silver")
        if self.known_ids is None:
            return history.rows_since(table, version)
        return self.known_ids.unseen(table.where(F.col("batch_seq") > version), version)

    def gold(self, table: str) -> DataFrame:
        return read_or_empty(self.spark, self.path(table), self.schema(table))

    # ---- writing ----

    def write_batch(self, table: str, seq: int, rows: DataFrame) -> int:
        """Write one batch of a versioned table; replaces an uncommitted attempt."""
        aligned = history.align_to_schema(rows, self.schema(table))
        by = ["event_date"] if table == "silver" else []
        return write_verified(aligned, self.batch_path(table, seq), by)

    def replace(self, table: str, rows: DataFrame, only_touched_dates: bool = False) -> None:
        """Replace a gold table, or only the dates that `rows` contains.

        The rebalance hint lets Spark size the files: small dates share a task, a date
        with very many rows is split over several.
        """
        key = "repo_name" if table == "repo_daily" else "actor_login"
        (
            history.align_to_schema(rows, self.schema(table))
            .hint("rebalance", F.col("event_date"))
            .sortWithinPartitions("event_date", F.desc("total_events"), key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic" if only_touched_dates else "static")
            .option("maxRecordsPerFile", ROWS_PER_FILE)
            .partitionBy("event_date")
            .parquet(self.path(table))
        )

    # ---- storage ----

    def files(self) -> DataFrame:
        """(path, length) of every file of the current generation; no content is read."""
        return (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(f"{self.root}/gen={self.generation}")
            .select("path", "length")
        )


# ---- catalog ----------------------------------------------------------------


def ensure_namespace(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{location}'")


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str, partition_by=()
) -> None:
    """Create an external Parquet table unless there is one; never drops."""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    partitioned = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioned} "
        f"LOCATION '{location}'"
    )


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    rows = schemas.describe(spark.table(name).schema)
    return spark.createDataFrame(rows, "idx INT, column_name STRING, type STRING, required BOOLEAN")


def run_stamp() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)
