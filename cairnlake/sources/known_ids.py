"""The ids of each batch, kept bucketed, so that a batch can be told from all of the past without moving it.

An anti-join with the whole history would shuffle every id ever seen. Here each batch's different ids
are written once into a table that is partitioned by batch and bucketed by id. Reading it, as of any
version, has the partitioning that the join wants: only the new rows are shuffled, into as many parts
as there are buckets.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KnownIds:
    """`path` lies in the lake; `buckets` is fixed when the first batch is written.

    Choose so many buckets that the ids of one fit a task: an id of 20 bytes and 1000 buckets hold
    some 10^10 ids in parts of 200 MB.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "known_ids_" + hashlib.md5(path.encode()).hexdigest()[:16]

    def table(self) -> DataFrame:
        """(id, batch_seq) of everything written, also by earlier sessions and by attempts that crashed."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(place)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (id STRING, batch_seq BIGINT) USING parquet "
            f"PARTITIONED BY (batch_seq) CLUSTERED BY (id) SORTED BY (id) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        return self.spark.table(self.name)

    def add(self, seq: int, rows: DataFrame) -> None:
        """The ids of a batch; replaces those of an attempt before. Rows without an id have none to keep."""
        ids = rows.where("id IS NOT NULL").select("id").distinct().repartition(self.buckets, "id")
        self.table()
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch_seq = {int(seq)}) SELECT id FROM {{ids}}", ids=ids
        )

    def as_of(self, version: int) -> DataFrame:
        return self.table().where(F.col("batch_seq") <= version).select("id")

    def unseen(self, rows: DataFrame, version: int) -> DataFrame:
        """Those of `rows` whose id no batch up to `version` has; a row without an id counts as unseen.

        Rows without an id match nothing and stay out of the shuffle, however many they are.
        """
        known = self.as_of(version).withColumnRenamed("id", "_known")
        with_id = rows.where("id IS NOT NULL").join(known, F.col("id") == F.col("_known"), "left_anti")
        return with_id.unionByName(rows.where("id IS NULL"))
