"""Stream sources behind one switch.

``files`` (json / parquet / csv / text directories; new files only),
``rate`` and ``table`` work everywhere.  ``kafka`` needs the Kafka
connector jar on the cluster; without it a clear error is raised.
Sockets are not offered: a job must not open ports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class SourceUnavailable(RuntimeError):
    pass


def source(spark: SparkSession, kind: str, path: str | None = None, schema: StructType | str | None = None,
           fmt: str = "parquet", **options) -> DataFrame:
    r = spark.readStream
    if kind == "files":
        if schema is None and fmt != "text":
            raise ValueError("file streams need an explicit schema")
        r = r.format(fmt)
        if schema is not None:
            r = r.schema(schema)
        return r.options(**options).load(path)
    if kind == "rate":
        return r.format("rate").options(**options).load()
    if kind == "table":
        return r.options(**options).table(path)
    if kind == "kafka":
        try:
            return (r.format("kafka").option("subscribe", options.pop("topic", path))
                    .options(**options).load())
        except Exception as e:  # data source not on the classpath
            raise SourceUnavailable("the Kafka connector is not on the classpath; use kind='files'") from e
    raise ValueError(f"unknown source kind {kind!r}")
