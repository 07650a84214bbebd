"""An append-only table of finished model calls (M1-M3), so that no answer is
paid for twice.

A call is known by the hash of its label (what is asked, of which model) and
its prompt.  ``answered`` calls only the prompts that have no answer yet and
appends the new ones; each task's answers become part of the table when that
task ends (the writer commits by task, not by job), so a run that is killed
half-way has lost the calls of its running tasks and nothing else.  ``CALLS``
bounds the prompts of one task and so what one lost task repeats.

The table is a folder of Parquet files by label.  A prompt may stand in it
more than once (a failed call and its later answer, a task that ran twice):
``answers`` gives one row a prompt, a good answer before a failure, then the
newest.  Failed calls are asked again by the next run.

The folder must be one that the driver and all executors share.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ..sources.feed import path_exists

#: Prompts of one task at most (about): what a lost task may ask again.
CALLS = 200
HASH = "_ask_hash"
SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    (HASH, T.StringType()), ("response", T.StringType()), ("kind", T.StringType()), ("status", T.StringType()),
    ("attempts", T.IntegerType()), ("error", T.StringType()), ("called_at", T.TimestampType())]])
#: Task-by-task commit of Hadoop's file committer.
COMMIT_BY_TASK = ("mapreduce.fileoutputcommitter.algorithm.version", "2")


def ask_hash(label: str, prompt: Column | str) -> Column:
    """The key of a call: label and prompt, neither of which can run into the other."""
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.sha2(F.concat(F.sha2(F.lit(label), 256), p), 256)


def _folder(path: str, label: str) -> str:
    """A label's folder; labels are free text, so the folder has its letters and a hash."""
    import hashlib
    import re
    return f"{path.rstrip('/')}/{re.sub(r'[^A-Za-z0-9]+', '-', label)[:40]}-{hashlib.sha256(label.encode()).hexdigest()[:12]}"


def history(spark: SparkSession, path: str, label: str) -> DataFrame:
    """All rows of a label, in no order; none if nothing was called yet."""
    folder = _folder(path, label)
    if not path_exists(spark, folder):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(folder)


def answers(spark: SparkSession, path: str, label: str) -> DataFrame:
    """One row a prompt: ``(_ask_hash, response, kind, status, attempts, error)``."""
    rows = history(spark, path, label)
    worth = F.struct(F.col("status") == "ok", F.col("called_at"), F.col("response"), F.col("error"))
    fields = [f.name for f in SCHEMA if f.name not in (HASH, "called_at")]
    best = rows.groupBy(HASH).agg(F.max_by(F.struct(*fields), worth).alias("_a"))
    return best.select(HASH, *[F.col(f"_a.{f}").alias(f) for f in fields])


def unanswered(asked: DataFrame, path: str, label: str) -> DataFrame:
    """Rows of ``asked`` whose prompt has no good answer: an anti join on the
    hash alone (no answer is read)."""
    done = history(asked.sparkSession, path, label).where(F.col("status") == "ok").select(HASH)
    return asked.join(done, HASH, "left_anti")


def answered(asked: DataFrame, path: str, label: str, call: Callable[[DataFrame], DataFrame], calls: int = CALLS,
             tasks: int | None = None) -> DataFrame:
    """Answers for the distinct prompts ``asked`` (``_ask_hash, _ask``).

    ``call`` maps such rows to answer rows (``infer.batch_call``).  The open
    prompts are written down once, then dealt by hash into tasks of about
    ``calls`` prompts; ``tasks`` bounds how many of these run at a time (one
    wave of the table after the other)."""
    spark = asked.sparkSession
    todo = materialize(unanswered(asked, path, label))
    n = todo.count()
    parts = -(-n // calls)
    waves = -(-parts // tasks) if tasks else min(parts, 1)
    for wave in range(waves):
        rows = todo.where(F.pmod(F.xxhash64(HASH), F.lit(waves)) == wave) if waves > 1 else todo
        made = call(rows.repartition(min(parts, tasks or parts), HASH)).withColumn("called_at", F.current_timestamp())
        made.select(*SCHEMA.names).write.mode("append").option(*COMMIT_BY_TASK).parquet(_folder(path, label))
    return answers(spark, path, label)
