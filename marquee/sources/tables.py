"""Access to the driver tables (one parquet dataset per table).

Reads are lazy: Catalyst prunes the columns a query uses and pushes its
filters into the parquet scan, so a two-column projection only reads two
columns at any scale.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from marquee.session import prepare

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

DEFAULT_SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    prepare(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Attribute access: ``t = Tables(spark, d); t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register_views(self) -> None:
        """Temp views with the table names, for SQL-text queries."""
        for n in TABLES:
            table(self.spark, self.sf_dir, n).createOrReplaceTempView(n)
