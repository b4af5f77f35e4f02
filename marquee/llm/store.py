"""Tables between the steps of an operator, in the shared folder that the
cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import checkpoint_dir


def packed(df: DataFrame, **extra: Column) -> DataFrame:
    """``df`` as one struct column ``doc`` beside the columns of an operator:
    whatever the input's columns are called, none can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"), *[v.alias(k) for k, v in extra.items()])


def unpacked(columns: list[str]) -> list[Column]:
    """The columns of a packed frame."""
    return [F.col(f"doc.`{c}`").alias(c) for c in columns]


class Scratch:
    """Parquet tables of one operator run; cuts lineage and is read as often
    as needed.  Tables that no result refers to are dropped at once, the
    others when the Python process ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/marquee-llm/{name}-{uuid.uuid4().hex[:12]}"
        atexit.register(self.drop)

    def save(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        try:
            jvm = self.spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        except Exception:          # the session has ended; the cluster clears its folder
            return


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (a, b): rows
    (node, component).  Large-star and small-star rounds until all components
    are stars; every round is a few aggregations over one row per link."""
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = edges.select("a", "b").where("a <> b").distinct()
    i = 0
    while True:
        # large star: every larger neighbour is hung on the smallest one
        near = both(links)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: smaller neighbours and the node itself are hung on the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        links = scratch.save(small, f"{name}-{i}")
        if i:
            scratch.drop(f"{name}-{i - 1}")
        i += 1
        # done when all are stars: each node hangs on one root, and no root hangs
        ends = links.select(F.col("a").alias("v"), F.lit(1).alias("hangs"), F.lit(0).alias("root")).unionByName(
            links.select(F.col("b").alias("v"), F.lit(0).alias("hangs"), F.lit(1).alias("root")))
        loose = ends.groupBy("v").agg(F.sum("hangs").alias("hangs"), F.max("root").alias("root"))
        if loose.where("hangs > 1 or hangs = 1 and root = 1").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
