"""Session construction and the runtime settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import weakref
import zipfile

from pyspark.sql import SparkSession

# Runtime SQL settings that can be changed on a live session.  They are
# applied by ``prepare`` to whatever session the caller hands us (the
# driver builds its own), so results do not depend on who built it.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows to Python in batches of bounded bytes, however long the texts are
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}

_PREPARED: weakref.WeakSet = weakref.WeakSet()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply runtime settings and ship the package, once per session."""
    if spark not in _PREPARED:
        for k, v in RUNTIME_CONF.items():
            spark.conf.set(k, v)
        ship(spark)
        _PREPARED.add(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may run from another
    folder than the driver."""
    root = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(root) or any(f.endswith("/marquee-package.zip") for f in spark.sparkContext.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="marquee-ship-"), "marquee-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("marquee", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)


def build_session(master: str | None = None, app: str = "marquee",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session builder.  On a cluster, use the platform's
    session and call :func:`prepare` on it instead."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or int(os.environ.get("MARQUEE_SHUFFLE_PARTITIONS", "8"))
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.driver.memory", os.environ.get("MARQUEE_DRIVER_MEMORY", "16g"))
         .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(64 * 1024 * 1024)))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return prepare(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir`` (or an already-set context dir).
    Where nothing is configured, a scratch folder is made on a local master
    only; on a cluster executors would not see it, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="marquee-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
