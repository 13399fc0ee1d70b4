"""Tables written to the cluster's shared folder, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.session import work_dir


def written(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """`df` as Parquet in a fresh folder below spark.checkpoint.dir, read again: lineage ends there."""
    path = work_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(columns: list[str], name: str) -> str:
    """`name`, with as many underscores before it as it takes to be none of `columns`."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def others(columns: list[str], *replaced: str) -> list[str]:
    """The columns but those that an operator puts anew."""
    return [c for c in columns if c.lower() not in {r.lower() for r in replaced}]


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for each node with an edge.

    `edges` has the columns a and b. Large-star and small-star rounds alternate until nothing moves;
    there are about as many as the logarithm of the longest path. Each node's smallest neighbour is
    aggregated in parts; it is joined back by node, so a hub's edges (two numbers each) are one key, which
    only Spark's adaptive skew join splits.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: neighbours that are larger go under the smallest one
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # those of the node itself follow from its own edges, seen from the other end
        large = large.distinct()
        # small star: the node and its smaller neighbours go under the smallest of these
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.where("a <> b").union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        state, before = _state(edges), state
        if state == before:
            break
    # every edge now leads straight to the smallest node of its component
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _state(edges: DataFrame):
    """The number of edges and an order-free sum over them."""
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mark).first())
