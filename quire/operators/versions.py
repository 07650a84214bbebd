"""Outputs that change together: version folders and a pointer switched last.

A run writes all its outputs under a version's folder, which no reader knows
yet.  The pointer is a small JSON file that says which version holds which
slice; it is written under a fresh number and readers take the highest one, so
switching is one rename that either happens or does not, and two runs that
switch at once cannot both take a number.  Older pointers (and with them older
versions) stay until ``sweep``.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

#: The slice of an output that has no slices.
WHOLE = "all"


def new_version() -> str:
    return uuid.uuid4().hex


def folder(root: str, version: str, name: str) -> str:
    return f"{root.rstrip('/')}/versions/{version}/{name}"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, root: str) -> list[int]:
    p, fs = _path(spark, f"{root.rstrip('/')}/pointer")
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(int(n[:-len(".json")]) for n in names if n.endswith(".json") and n[:-len(".json")].isdigit())


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """Slice -> the version that holds it, by the newest pointer."""
    numbers = _pointers(spark, root)
    if not numbers:
        return {}
    text = "\n".join(r[0] for r in spark.read.text(f"{root.rstrip('/')}/pointer/{numbers[-1]:012d}.json").collect())
    return json.loads(text)


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether an output's folder holds data files (an output without rows has none)."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def switch(spark: SparkSession, root: str, changed: dict[str, str]) -> None:
    """Make the new versions of the given slices the current ones."""
    numbers = _pointers(spark, root)
    pointer = current(spark, root) | changed
    base = f"{root.rstrip('/')}/pointer"
    draft, fs = _path(spark, f"{base}/_{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(pointer, sort_keys=True).encode()))
    out.close()
    final, _ = _path(spark, f"{base}/{(numbers[-1] + 1 if numbers else 0):012d}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError("another run has switched the outputs meanwhile")


def sweep(spark: SparkSession, root: str) -> None:
    """Remove versions that the current pointer does not name, and older pointers."""
    held = set(current(spark, root).values())
    base, fs = _path(spark, f"{root.rstrip('/')}/versions")
    if fs.exists(base):
        for f in fs.listStatus(base):
            if f.getPath().getName() not in held:
                fs.delete(f.getPath(), True)
    for number in _pointers(spark, root)[:-1]:
        fs.delete(_path(spark, f"{root.rstrip('/')}/pointer/{number:012d}.json")[0], False)
