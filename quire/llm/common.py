"""Helpers shared by the training-data operators."""
from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_confs, checkpoint_dir, materialize  # noqa: F401

#: The C library's way to give free memory back, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
#: Rows of text that one Arrow batch may hold: bounds a Python worker's memory
#: whatever the texts' length.
ARROW_ROWS = 256
#: Bytes of text that the vectorised helpers take at a time; they need up to
#: some 100 bytes of memory for each.
CHUNK_BYTES = 512 << 10
#: Rows up to which a narrow (few numbers a row) table may be broadcast.
BROADCAST_ROWS = 400_000
#: Rows of a narrow table that are worth a task of their own.
TASK_ROWS = 20_000


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that every operator here expects."""
    apply_confs(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    checkpoint_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, limit: int = BROADCAST_ROWS, weight: Column | None = None) -> DataFrame:
    """``df`` (narrow, already materialised) with a broadcast hint where its
    counted rows are within the bound; beyond it the join stays a shuffle join.
    Rows that hold lists are counted by ``weight``, their length."""
    rows = df.count() if weight is None else df.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(df) if rows <= limit else df


def compact(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` (narrow, of ``rows`` rows at most, else counted) in no more
    partitions than its rows need: steps over small tables are then a few tasks
    and files each, however many partitions the session shuffles into."""
    rows = df.count() if rows is None else rows
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def free_shuffles(spark: SparkSession) -> None:
    """Ask the driver to drop shuffle files of finished steps whose frames are
    no longer referenced (their results are in the checkpoint folder)."""
    import gc
    import time
    for _ in range(2):          # the first round frees the proxies, the second what they held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def release_memory() -> None:
    """Give back what a worker's finished task has freed: allocators keep it for
    themselves, and workers live as long as their executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def chunked(batches: Iterable[pa.RecordBatch], text: str | list[str], size: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """Regroup Arrow batches into tables of about ``size`` bytes of text (one
    row at least), so vectorised work is long enough and memory stays bounded."""
    names = [text] if isinstance(text, str) else text
    hold: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        start = 0
        lens = [0] * batch.num_rows
        for n in names:
            col = batch.column(batch.schema.get_field_index(n))
            lens = [a + (len_ or 0) for a, len_ in zip(lens, pa.compute.binary_length(col).to_pylist(), strict=True)]
        for i, n_bytes in enumerate(lens):
            held += n_bytes
            if held >= size:
                hold.append(batch.slice(start, i + 1 - start))
                yield pa.Table.from_batches(hold)
                hold, held, start = [], 0, i + 1
        if start < batch.num_rows:
            hold.append(batch.slice(start))
    if hold:
        yield pa.Table.from_batches(hold)
    hold.clear()
    release_memory()


def drop_rows(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose key is in ``gone`` (materialised): by a
    broadcast of the keys within the bound, else by a shuffled anti join."""
    return docs.join(small(gone.select(key)), key, "left_anti").select(*docs.columns)
