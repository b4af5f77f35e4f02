"""Replacing part of a partitioned data set, or all of a table.

* ``overwrite_partitions`` — the partitions that the new rows fall into are
  replaced, all others keep their files;
* ``overwrite_where`` — rows that meet a condition go, the new rows come;
  only partitions that hold such rows or receive new ones are written;
* ``create_or_replace`` — a table's rows and schema change at once.

New files are staged under the data set (a folder whose name begins with
``_``, which readers skip) and moved when all are written.  The moves are
listed in a journal first: a writer that fails before it changes nothing,
one that fails after it is finished by ``recover``, which every later
replacement calls.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

JOURNAL = "journal.json"


class Folder:
    """Files below a path, in whatever store Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark._jvm
        self.fs = self._at("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._at(name))) if self.exists(name) else []

    def leaves(self, name: str, depth: int) -> list[str]:
        """Partition folders ``depth`` levels below, relative to ``name``."""
        found = [""]
        for _ in range(depth):
            found = [f"{f}/{n}".lstrip("/") for f in found for n in self.names(f"{name}/{f}".rstrip("/")) if "=" in n]
        return found

    def move(self, source: str, target: str) -> None:
        above = self._at(target).getParent()
        if not self.fs.exists(above):
            self.fs.mkdirs(above)
        if not self.fs.rename(self._at(source), self._at(target)):
            raise OSError(f"{source} cannot be moved to {target}")

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self._at(f"{name}.part"), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.move(f"{name}.part", name)            # readers see all of it or nothing

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


def _finish(folder: Folder, stage: str) -> None:
    """The moves of a journal, each done or already done."""
    plan = json.loads(folder.read(f"{stage}/{JOURNAL}"))
    for part in plan["old"]:
        trash = f"{stage}/old/{part}"
        if not folder.exists(trash) and folder.exists(part):
            folder.move(part, trash)
    for part in plan["new"]:
        if folder.exists(f"{stage}/new/{part}"):
            folder.move(f"{stage}/new/{part}", part)
    folder.delete(stage)


def recover(spark: SparkSession, path: str) -> None:
    """Finishes replacements that have a journal, drops those that have none."""
    folder = Folder(spark, path)
    for name in folder.names():
        if name.startswith("_replace-"):
            if folder.exists(f"{name}/{JOURNAL}"):
                _finish(folder, name)
            else:
                folder.delete(name)


def _replace(df: DataFrame, path: str, by: list[str], old: list[str] | None, fmt: str) -> None:
    """Writes ``df`` aside and then swaps the partitions it has, and ``old``,
    for the new ones."""
    folder = Folder(df.sparkSession, path)
    stage = f"_replace-{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).partitionBy(*by).save(f"{folder.path}/{stage}/new")
    new = [x for x in folder.leaves(f"{stage}/new", len(by)) if x]
    gone = sorted(set(new) | set(old or []))
    folder.write(f"{stage}/{JOURNAL}", json.dumps({"old": [x for x in gone if folder.exists(x)], "new": new}))
    _finish(folder, stage)


def overwrite_partitions(df: DataFrame, path: str, by: list[str], fmt: str = "parquet") -> None:
    """Replaces the partitions that ``df`` has rows for."""
    recover(df.sparkSession, path)
    _replace(df, path, by, None, fmt)


def overwrite_where(df: DataFrame, path: str, by: list[str], condition: str | Column, fmt: str = "parquet") -> None:
    """Deletes the rows for which ``condition`` is true and adds ``df``'s.

    Partitions without such rows, and without new ones, keep their files.
    A condition on partition columns alone deletes without reading rows of
    other partitions (the scan is pruned)."""
    spark = df.sparkSession
    recover(spark, path)
    now = spark.read.format(fmt).load(path)
    gone = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    fresh = df.select(*[F.col(f.name).cast(f.dataType) if f.name in by else F.col(f.name) for f in now.schema])
    # one row a partition: what a listing of the data set holds on the driver anyway
    hit = now.where(gone).select(*by).distinct()
    touched = hit.unionByName(fresh.select(*by)).distinct().collect()
    some = spark.createDataFrame(touched, hit.schema)
    match = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    on = reduce(Column.__and__, match)
    rest = now.where(~gone).alias("a").join(F.broadcast(some.alias("b")), on, "left_semi")
    folder = Folder(spark, path)
    # folders of touched partitions, by the files that hold them
    files = now.where(gone).select(F.regexp_replace(F.input_file_name(), "/[^/]*$", "").alias("f")).distinct().collect()
    old = {unquote("/".join(r.f.rstrip("/").split("/")[-len(by):])) for r in files}
    _replace(rest.unionByName(fresh), path, by, sorted(old), fmt)


def create_or_replace(df: DataFrame, name: str, location: str, by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Table ``name`` with the rows and schema of ``df``.

    The rows are written to a new version folder below ``location`` first; the
    catalog entry is changed when it is complete, then older versions go."""
    spark = df.sparkSession
    folder = Folder(spark, location)
    version = f"v-{uuid.uuid4().hex[:12]}"
    older = [n for n in folder.names() if n.startswith("v-")]
    writer = df.write.format(fmt)
    (writer.partitionBy(*by) if by else writer).save(f"{folder.path}/{version}")
    same = spark.catalog.tableExists(name) and spark.table(name).schema == spark.read.format(fmt).load(f"{folder.path}/{version}").schema
    if same and not by:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder.path}/{version}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=f"{folder.path}/{version}", source=fmt)
        if by:
            spark.catalog.recoverPartitions(name)
    for v in older:
        folder.delete(v)
