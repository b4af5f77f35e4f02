"""File IO helpers: scratch locations and format round trips.

Scratch output goes under the shared checkpoint folder of the session
(``spark.checkpoint.dir``), never a machine-local temp folder, so every
executor sees the same files.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from marquee.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "marquee-io", f"{name}-{uuid.uuid4().hex[:12]}")


def round_trip(df: DataFrame, fmt: str, name: str | None = None, read_schema=None,
               write_options: dict | None = None, read_options: dict | None = None,
               partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` in ``fmt`` and read it back (lazily)."""
    spark = df.sparkSession
    path = scratch_path(spark, name or fmt)
    w = df.write.mode("overwrite").format(fmt).options(**(write_options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    r = spark.read.format(fmt).options(**(read_options or {}))
    if read_schema is not None:
        r = r.schema(read_schema)
    return r.load(path)


def _fault(name: str, content: bytes, fmt: str) -> str | None:
    """What keeps a file from being read to its end, if anything."""
    import gzip

    import pyarrow as pa
    try:
        if fmt == "parquet":
            import pyarrow.parquet as pq
            f = pq.ParquetFile(pa.BufferReader(content))
            for i in range(f.num_row_groups):
                f.read_row_group(i)
        elif fmt == "orc":
            import pyarrow.orc as orc
            f = orc.ORCFile(pa.BufferReader(content))
            for i in range(f.nstripes):
                f.read_stripe(i)
        elif name.endswith(".gz"):
            with gzip.GzipFile(fileobj=pa.PythonFile(pa.BufferReader(content))) as f:
                while f.read(1 << 20):
                    pass
    except Exception as e:
        return f"{type(e).__name__}: {str(e)[:200]}"
    return None


def file_report(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Rows (path, length, fault) of all files below ``path``; fault is NULL
    for files that can be read to their end.  Each file is one row of a Spark
    job, so a large folder is checked by many tasks."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            names = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([_fault(n, c.as_buffer().to_pybytes() if c.is_valid else b"", fmt) for n, c in zip(names, b.column(2))], pa.string())],
                names=["path", "length", "fault"])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", "content").mapInArrow(run, "path string, length long, fault string")


def read_sound(spark: SparkSession, path: str, fmt: str, schema=None) -> tuple[DataFrame, DataFrame]:
    """Rows of all files that can be read to their end, and the report of all.

    A broken file costs its own rows, all of them: none of its first rows
    come through.  The names of sound files go through the driver, as those
    of every read do."""
    report = file_report(spark, path, fmt).persist()
    sound = [r.path for r in report.where("fault is null").select("path").collect()]
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if not sound:
        if schema is None:
            raise ValueError(f"no file below {path} can be read")
        return spark.createDataFrame([], schema), report
    return r.load(sound), report
