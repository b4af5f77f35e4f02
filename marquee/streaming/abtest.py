"""Streaming A/B test: moments of every micro-batch are kept as state.

``foreach_batch`` reduces a batch to at most two rows and overwrites the
batch's own folder, so a batch that is replayed after a failure counts
once.  ``results`` tests over the kept moments; nothing is held on the
driver, and a restarted query goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import abtest


class StreamingABTest:
    def __init__(self, spark: SparkSession, path: str, peace: int = 0, window: int = 0, method: str = "welch"):
        self.spark, self.path = spark, path.rstrip("/")
        self.peace, self.window, self.method = peace, window, method

    def foreach_batch(self, experiment: Column, value: Column):
        def run(batch: DataFrame, batch_id: int) -> None:
            rows = abtest.moments(batch, F.lit(batch_id).cast("long"), experiment, value)
            rows.drop("period").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/period={batch_id}")
        return run

    def moments(self) -> DataFrame:
        schema = "experiment boolean, n long, mean double, m2 double, period long"
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(self.path)

    def results(self) -> DataFrame:
        return abtest.test(self.moments(), self.peace, self.window, self.method)
