"""Raw hourly files: gzip, one JSON object per line."""

from __future__ import annotations

import datetime as dt
import re
import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions import events as ev

LINE_MEMBERS = ["id", "type", "actor", "repo", "created_at", "payload"]
DECLARED_SHAPE = (
    "id STRING, type STRING, actor STRUCT<id: STRING, login: STRING>, "
    "repo STRUCT<id: STRING, name: STRING>, created_at STRING, payload STRING, public BOOLEAN"
)
DECLARED_LINE = DECLARED_SHAPE + ", _corrupt_record STRING"
LINE_SHAPE = "value STRING, source_file STRING, source_part STRING, row_pos BIGINT"
# File in an hour's folder that states how many gzip parts belong to the hour.
PART_COUNT = "parts.count"
# Output of the gzip test held at a time.
INFLATED_AT_ONCE = 1 << 20


def list_files(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """(source_file, path, length) of every landed part; no content is read.

    `root` is the landing folder, or the places of single hours.

    An hour is landed as one file of that name, or as a folder of that name with
    several gzip parts, which lets one very large hour be read by many tasks.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(hour_of(F.col("path")).alias("source_file"), "path", "length")
        .where(F.col("source_file") != "")
    )


def stated_parts(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """(source_file, stated): the number of parts that an hour's folder states; NULL if it is no number.

    Whoever lands an hour in parts writes its count first, so that no part is ever there without it.
    """
    counts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", PART_COUNT)
    hour = F.regexp_extract(F.col("_metadata.file_path"), rf"[/=]{ev.HOUR_FILE}/[^/]*$", 1)
    found = counts.text(root).select(hour.alias("source_file"), F.trim("value").try_cast("long").alias("stated"))
    return found.where(F.col("source_file") != "").groupBy("source_file").agg(F.max("stated").alias("stated"))


def whole_hours(listed: DataFrame, stated: DataFrame) -> DataFrame:
    """`listed` without hours that state a number of parts and hold another one.

    Hours that state none, single files among them, are taken as they are.
    """
    parts = listed.groupBy("source_file").agg(F.count("*").alias("parts"))
    under_way = parts.join(stated, "source_file").where(~F.col("parts").eqNullSafe(F.col("stated")))
    return listed.join(under_way.select("source_file"), "source_file", "left_anti")


def hour_of(path: Column) -> Column:
    return F.regexp_extract(path, ev.HOUR_PLACE, 2)


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value, source_file, source_part, row_pos). A gzip part is one split, so positions
    taken at the scan follow the line order inside each part; parts follow their names."""
    scan = spark.read.option("recursiveFileLookup", "true").text(paths)
    return with_positions(scan)


def with_positions(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        hour_of(F.col("_metadata.file_path")).alias("source_file"),
        F.col("_metadata.file_name").alias("source_part"),
        F.monotonically_increasing_id().alias("row_pos"),
    )


def _with_members(lines: DataFrame) -> DataFrame:
    """The top-level members of every line, then those of its actor and repo."""
    return (
        lines.select("*", F.json_tuple("value", *LINE_MEMBERS).alias(*LINE_MEMBERS))
        .select("*", F.json_tuple("actor", "login", "id").alias("actor_login", "actor_id"))
        .select("*", F.json_tuple("repo", "name", "id").alias("repo_name", "repo_id"))
    )


def to_bronze(lines: DataFrame, ingested_at: Column | dt.datetime) -> DataFrame:
    """Flatten lines to bronze columns; lineage columns of `lines` are carried along.

    Every line yields a row. A line that is not JSON has NULL fields and its text in
    `corrupt_record`. An unreadable time is NULL. A payload that is absent, null or empty of
    its kind ("", [], 0, false) is {}.
    """
    stamp = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    carried = [c for c in lines.columns if c not in ("value", "ingested_at")]
    broken = ev.is_broken_json(F.col("value"), *LINE_MEMBERS)
    empty = F.col("payload").isNull() | F.col("payload").isin("", "[]", "0", "0.0", "false")
    return (
        _with_members(lines)
        .withColumn("corrupt_record", F.when(broken, F.col("value")))
        .select(
            "id",
            "type",
            "actor_login",
            "actor_id",
            "repo_name",
            "repo_id",
            F.try_to_timestamp("created_at").alias("created_at"),
            F.when(
                F.col("corrupt_record").isNull(),
                F.when(empty, F.lit("{}")).otherwise(F.col("payload")),
            ).alias("payload"),
            stamp.cast("timestamp").alias("ingested_at"),
            *carried,
            "corrupt_record",
        )
    )


def read_declared(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Scan with declared nested columns, `created_at` as a timestamp."""
    read = spark.read.option("recursiveFileLookup", "true").schema(DECLARED_LINE)
    return flatten_declared(read.json(paths))


def flatten_declared(raw: DataFrame) -> DataFrame:
    """Every line a row; one that does not fit has its text in `corrupt_record`, else NULLs."""
    fields = {
        "id": F.col("id"),
        "type": F.col("type"),
        "actor_login": F.col("actor.login"),
        "actor_id": F.col("actor.id"),
        "repo_name": F.col("repo.name"),
        "repo_id": F.col("repo.id"),
        "created_at": F.try_to_timestamp("created_at"),
        "payload": F.col("payload"),
        "public": F.col("public"),
    }
    fits = F.col("_corrupt_record").isNull()
    return raw.select(
        *[F.when(fits, value).alias(name) for name, value in fields.items()],
        F.col("_corrupt_record").alias("corrupt_record"),
    )


def preview(lines: DataFrame, n: int) -> DataFrame:
    """The first n records with their identity and top-level keys."""
    keys = F.array_join(F.json_object_keys("value"), ",")
    return _with_members(lines.orderBy("row_pos").limit(n)).select(
        "row_pos", "type", "id", "actor_login", "repo_name", "created_at",
        keys.alias("top_level_keys"),
    )


def first_lines(spark: SparkSession, root: str | list[str], n: int) -> DataFrame:
    """The first n lines landed, by date, hour, part and position; reads no more hours than needed.

    The listing names the hours in order. The first one is read, up to n lines of it, and twice as
    many hours each time while these are short of n lines: an hour with enough of them is one scan
    that stops early. What is read is bounded by n and by the hours needed, not by the landing.
    """
    listed = list_files(spark, root)
    day, hour = ev.file_date(F.col("source_file")), ev.file_hour(F.col("source_file"))
    hours = listed.select("source_file", day.alias("day"), hour.alias("hour")).distinct()
    wanted = 1
    while True:
        first = hours.orderBy("day", "hour", "source_file").limit(wanted)
        parts = listed.join(first, "source_file", "left_semi").select("source_file", "path").collect()
        if not parts:
            return spark.createDataFrame([], LINE_SHAPE)
        lines = read_lines(spark, [p.path for p in parts])
        if len({p.source_file for p in parts}) < wanted or lines.limit(n).count() >= n:
            break
        wanted *= 2
    if len(parts) == 1:
        return lines.limit(n)  # one part is one task, in the order of its lines
    place = [ev.file_date(F.col("source_file")), ev.file_hour(F.col("source_file"))]
    return lines.orderBy(*place, "source_file", "source_part", "row_pos").limit(n)


# ---- gzip integrity ---------------------------------------------------------


def zero_byte_files(
    spark: SparkSession, root: str | list[str], names: list[str] | None = None
) -> dict[str, str]:
    """The hours (of the named ones, if given) landed at or below `root` as a file without a byte.

    Spark's listings leave such files out, so the file system is asked, once a folder level.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = {}
    for place in [root] if isinstance(root, str) else root:
        for below in ("", "/*.json.gz", "/*/*.json.gz"):
            path = hadoop.Path(place.rstrip("/") + below)
            fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
            for status in fs.globStatus(path) or []:
                if status.isFile() and status.getLen() == 0:
                    found[status.getPath().getName()] = "empty file"
    whole = re.compile(ev.HOUR_FILE)
    return {n: f for n, f in found.items()
            if whole.fullmatch(n) and (names is None or n in names)}


class _Inflation:
    """Decompresses the gzip members of one file as its bytes come, keeping none of the output."""

    def __init__(self) -> None:
        self.member, self.fault = None, None

    def feed(self, data: bytes) -> None:
        while data and not self.fault:
            if self.member is None or self.member.eof:
                self.member = zlib.decompressobj(wbits=31)
            try:
                self.member.decompress(data, INFLATED_AT_ONCE)
            except zlib.error as exc:
                self.fault = f"bad gzip: {exc}"
            data = self.member.unused_data if self.member.eof else self.member.unconsumed_tail

    def finish(self) -> str | None:
        if self.fault is None and not (self.member and self.member.eof):
            self.fault = "truncated gzip"
        return self.fault


def _inflate_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, fault) of every faulty file among the lines of whole files, one file after another."""

    def lines() -> Iterator[tuple[str, int, bytes]]:
        for batch in batches:
            columns = batch.to_pydict()
            yield from zip(columns["path"], columns["size"], columns["line"])

    for (path, size), rows in groupby(lines(), key=itemgetter(0, 1)):
        inflation, fed = _Inflation(), 0
        for _, _, line in rows:
            data = b"\n" + line if fed else line
            # a first line may be empty, so what was fed is counted with its line end
            inflation.feed(data)
            fed += len(line) + 1
        if fed == size:  # the last byte ends a line
            inflation.feed(b"\n")
        fault = inflation.finish()
        if fault:
            yield pa.RecordBatch.from_pydict({"path": [path], "fault": [fault]})


def faulty_parts(spark: SparkSession, places: str | list[str]) -> DataFrame:
    """(source_file, path, fault) of the gzip parts in or below `places` that do not decompress whole.

    The text scan hands over the compressed bytes as they are: Hadoop's pass-through codec stands in
    for gzip, so a part is one split, of any size, and its lines reach the test in order and by the
    batch. No content passes through the driver. Files without a byte are not listed by Spark; see
    `zero_byte_files`.
    """
    compressed = (
        spark.read.option("recursiveFileLookup", "true")
        .option("io.compression.codecs", "org.apache.hadoop.io.compress.PassthroughCodec")
        # the shaded Hadoop client that Spark ships has moved this key along with its packages
        .option("io.compress.passthrough.extension", ".gz")
        .option("org.apache.hadoop.shaded.io.compress.passthrough.extension", ".gz")
        .option("lineSep", "\n")
        .text(places)
    )
    return (
        compressed.select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"),
            F.col("value").cast("binary").alias("line"),
        )
        .mapInArrow(_inflate_files, "path STRING, fault STRING")
        .select(hour_of(F.col("path")).alias("source_file"), "path", "fault")
        .where(F.col("source_file") != "")
    )


def gzip_faults(spark: SparkSession, files: DataFrame) -> DataFrame:
    """`faulty_parts` among the listed files of one batch."""
    paths = [r.path for r in files.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "source_file STRING, path STRING, fault STRING")
    return faulty_parts(spark, paths)
