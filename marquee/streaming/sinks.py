"""Idempotent, at-least-once-safe sinks for ``foreachBatch``.

A micro-batch may be re-run after a failure.  Each batch is written to
its own folder (``_batch=<id>``) in overwrite mode, so a re-run replaces
its own output instead of appending a second copy.  With ``keys`` the
batch is also deduplicated against itself and against rows already in
the sink (anti join on the keys), which makes re-sent records (the
reference's reruns duplicated rows) land once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.relational import dedup_keep_first


def _existing(spark, path: str, fmt: str, batch_id: int) -> DataFrame | None:
    """Rows of other batches; None only where nothing was written yet: any
    other fault of reading must fail the batch, or copies would slip in."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(jpath) or not [s for s in fs.listStatus(jpath) if s.getPath().getName().startswith("_batch=")]:
        return None
    old = spark.read.format(fmt).load(path)
    if "_batch" in old.columns:
        old = old.where(F.col("_batch") != batch_id)
    return old


def idempotent_append(path: str, keys: list[str] | None = None, order: str | None = None, fmt: str = "parquet"):
    """foreachBatch function appending each batch exactly once per id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        out = batch
        if keys:
            out = dedup_keep_first(out, keys, order) if order else out.dropDuplicates(keys)
            old = _existing(spark, path, fmt, batch_id)
            if old is not None and set(keys) <= set(old.columns):
                out = out.join(old.select(*keys).distinct(), keys, "left_anti")
        (out.write.mode("overwrite").format(fmt)
         .save(os.path.join(path, f"_batch={batch_id}")))

    return write


def sql_per_batch(view: str, sql: str, path: str, fmt: str = "parquet"):
    """Run SQL over each micro-batch (temp view per batch), write the
    result idempotently."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.createOrReplaceTempView(view)
        res = batch.sparkSession.sql(sql)
        res.write.mode("overwrite").format(fmt).save(os.path.join(path, f"_batch={batch_id}"))

    return run
