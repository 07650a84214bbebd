"""Model calls through the ledger: a killed run repeats no finished call."""
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from quire.operators import infer, ledger


class Killed(BaseException):
    """Not an answer's failure: the process dies."""


def _caller(log, kill=None, fail=()):
    """A model function that notes its calls in a file."""
    def call(prompt):
        if prompt == kill:
            time.sleep(3)
            raise Killed()
        with open(log, "a", encoding="utf-8") as f:
            f.write(prompt + "\n")
        if prompt in fail:
            raise RuntimeError("service unavailable")
        return json.dumps({"tldr": prompt.upper()})
    return call


def _calls(log):
    return sorted(open(log, encoding="utf-8").read().split()) if os.path.exists(log) else []


def _asked(spark, n):
    return spark.range(n).select(F.concat(F.lit("q"), F.col("id").cast("string")).alias("p"))


def _run(df, fn, path, **kw):
    return infer.call_rows(df, fn, F.col("p"), ledger_path=path, label="t", retries=0, sleep=lambda s: None, **kw)


def test_killed_run_is_resumed(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(ledger, "CALLS", 2)
    monkeypatch.setattr(ledger.answered, "__defaults__", (2, None))
    path = os.path.join(tmpdir_path, "ledger")
    first, second = os.path.join(tmpdir_path, "first"), os.path.join(tmpdir_path, "second")
    df = _asked(spark, 40)
    with pytest.raises(Exception):
        _run(df, _caller(first, kill="q7"), path).collect()
    kept = {r[ledger.HASH] for r in ledger.history(spark, path, "t").where("status = 'ok'").collect()}
    hashes = {r.p: r.h for r in df.select("p", ledger.ask_hash("t", "p").alias("h")).collect()}
    assert 0 < len(kept) < 40                                   # finished tasks are in the table, the job is not
    rows = {r.p: r for r in _run(df, _caller(second), path).collect()}
    assert len(rows) == 40 and all(json.loads(rows[p].response) == {"tldr": p.upper()} for p in rows)
    assert _calls(second) == sorted(p for p, h in hashes.items() if h not in kept)
    third = os.path.join(tmpdir_path, "third")
    assert _run(df, _caller(third), path).count() == 40 and _calls(third) == []


def test_failed_calls_are_asked_again_and_a_good_answer_wins(spark, tmpdir_path):
    path, a, b, c = (os.path.join(tmpdir_path, x) for x in ("ledger", "a", "b", "c"))
    df = _asked(spark, 6).union(_asked(spark, 3)).union(spark.createDataFrame([(None,)], "p string"))
    rows = _run(df, _caller(a, fail=("q1", "q2")), path).collect()
    assert len(rows) == 10 and sorted(r.p for r in rows if r.status == "error") == ["q1", "q1", "q2", "q2"]
    rows = _run(df, _caller(b, fail=("q2",)), path, partitions=1).collect()
    assert _calls(b) == ["q1", "q2"] and {r.p for r in rows if r.status == "error"} == {"q2"}
    _run(df, _caller(c, fail=("q1", "q2", "q3")), path).collect()
    assert _calls(c) == ["q2"]
    assert {r.p for r in _run(df, _caller(c), path).collect() if r.status != "ok"} == set()


def test_labels_keep_answers_apart(spark, tmpdir_path):
    path, log = os.path.join(tmpdir_path, "ledger"), os.path.join(tmpdir_path, "log")
    df = _asked(spark, 3)
    for label in ("model-a", "model-b/x", "model-a"):
        infer.call_rows(df, _caller(log), F.col("p"), ledger_path=path, label=label, retries=0).collect()
    assert _calls(log) == sorted(["q0", "q1", "q2"] * 2)


def test_waves_bound_what_runs_at_once(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(ledger.answered, "__defaults__", (3, None))
    path, log = os.path.join(tmpdir_path, "ledger"), os.path.join(tmpdir_path, "log")
    rows = _run(_asked(spark, 25), _caller(log), path, partitions=2).collect()
    assert len(rows) == 25 and len(_calls(log)) == 25
    assert _run(_asked(spark, 0), _caller(log), os.path.join(tmpdir_path, "none")).count() == 0
