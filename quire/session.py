"""Session helpers.

Library code never creates its own session; it receives one.  ``build_session``
exists for tests, the bench and command-line use.  ``checkpoint_dir`` reads the
shared directory the cluster names in ``spark.checkpoint.dir`` and only falls
back to a fresh local scratch directory when nothing is configured (tests).
"""
from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package expects.  They are runtime SQL confs, so
# they can be applied to a session created by someone else.
SQL_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A Python worker holds a few batches: rows may be whole texts or pages, so bytes bound them.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Partition overwrite replaces only the (date, language) slices a job writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Model output with a repeated key keeps the last value, as a JSON decoder does.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "quire", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    confs = dict(SQL_CONFS)
    confs.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("QUIRE_DRIVER_MEMORY", "16g"),
        # Paid or slow user functions must not run twice for the same row.
        "spark.speculation": "false",
        # Checkpoint files of row numbering / materialised steps are removed
        # once nothing references them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    })
    if shuffle_partitions:
        confs["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    confs.update(extra or {})
    for k, v in confs.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def apply_confs(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session and make sure
    the executors' Python workers can import this package."""
    for k, v in SQL_CONFS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked conf: keep the cluster's choice
            pass
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application (``addPyFile``).

    Python functions defined in the package (batch model calls, listing
    extraction, streaming state) are pickled by reference; executors import
    them, and read the package's text files, from the shipped archive.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="quire-pyfiles-"), "quire.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith((".py", ".txt")):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint directory of the cluster; a scratch dir only if unset."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="quire-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df):
    """Reliable checkpoint into the shared checkpoint directory.

    Used where a result must not be recomputed (paid model output) or where a
    plan must not be re-optimised through a deep expression chain.  Survives
    the loss of executors, unlike a local checkpoint or an in-memory cache.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
