"""Batch runs that end early, and counts over restarts."""

import json

import pytest

from checks import fixtures as X
from checks import queries as C
from rowmend import durable_counters, message_batches, read_recovered, run_batch
from rowmend.plans import recovery
from rowmend.sources import files, runs
from rowmend.streaming.job import write_batch

SF = "/root/testdata/sf0.001"


def written(spark, out):
    """Error rows there are, by sink; and recovered requests of finished runs."""
    errors = [spark.read.text(files.error_dir(f"{out}/{x}")).count() if runs.exists(spark, files.error_dir(f"{out}/{x}")) else 0 for x in ("bad", "lost")]
    recovered = read_recovered(spark, f"{out}/good")
    return (recovered.count() if recovered is not None else 0, *errors)


def go(spark, out):
    return run_batch(spark, C.text_dir(spark, SF), X.check_config(), f"{out}/good", f"{out}/bad", f"{out}/lost")


@pytest.mark.parametrize("sink", ["write_recovered", "write_errors", "finish"])
def test_a_run_that_ended_early_is_taken_up(spark, monkeypatch, sink):
    out = X.scratch_dir(spark)
    tried = []

    def ends(*args, **more):
        tried.append(args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(*((runs.Run, sink) if sink == "finish" else (recovery, sink)), ends)
        with pytest.raises(RuntimeError):
            go(spark, out)
    assert tried and runs.finished(spark, f"{out}/good") == {} and written(spark, out)[0] == 0
    counts = go(spark, out)
    assert sum(counts.values()) == 1000
    assert written(spark, out) == (counts["recovered"], counts["failed"], counts["unrecoverable"])
    assert list(runs.finished(spark, f"{out}/good").values()) == [counts]
    # a finished run is not taken up: the same job again is another run
    assert go(spark, out) == counts and len(runs.finished(spark, f"{out}/good")) == 2
    assert written(spark, out)[0] == 2 * counts["recovered"]


def test_unfinished_runs_are_dropped(spark, monkeypatch):
    out = X.scratch_dir(spark)
    with monkeypatch.context() as m:
        m.setattr(runs.Run, "finish", lambda *_: (_ for _ in ()).throw(RuntimeError()))
        with pytest.raises(RuntimeError):
            go(spark, out)
    assert written(spark, out)[1] > 0
    left = runs.drop_unfinished(spark, f"{out}/good", files.error_dir(f"{out}/bad"), files.error_dir(f"{out}/lost"))
    assert len(left) == 1 and written(spark, out) == (0, 0, 0)
    assert runs.drop_unfinished(spark, f"{out}/good") == []


def test_another_job_takes_up_nothing(spark):
    out = X.scratch_dir(spark)
    first = runs.start(spark, f"{out}/good", {"source": "a"})
    assert runs.start(spark, f"{out}/good/", {"source": "a"}).id == first.id
    assert runs.start(spark, f"{out}/good", {"source": "b"}).id != first.id
    first.finish(spark, {"recovered": 3})
    assert runs.finished(spark, f"{out}/good") == {first.id: {"recovered": 3}}
    assert runs.start(spark, f"{out}/good", {"source": "a"}).id != first.id
    assert read_recovered(spark, f"{out}/good") is None


def test_counts_are_filed_by_batch(spark):
    out = X.scratch_dir(spark)
    assert durable_counters(spark, out).first().asDict() == {"recovered": 0, "failed": 0, "unrecoverable": 0}
    done = C.outcomes(spark, SF).withColumn("err", C.F.struct("code"))
    once = write_batch(done, 0, out).groupBy("status").count().collect()
    for batch in (1, 1, 0):
        write_batch(done, batch, out)
    counts = durable_counters(spark, out).first().asDict()
    assert {r["status"]: 2 * r["count"] for r in once} == {s: n for s, n in counts.items() if n}
    assert json.dumps(counts)


@pytest.mark.parametrize("records,size", [(3, 100), (1, 1), (100, 10), (2, 0)])
def test_batches_are_full_and_bounded(spark, records, size):
    """As one record after the other would fill them, over Arrow batches as well; larger records are batches of their own."""
    texts = ["x" * n for n in (0, 5, 40, 60, 1, 200, 3, 3, 3, 3, 100, 0, 0, 99, 2)] + [None, "é" * 5]
    rows = [(i, i // 9 if i < 14 else None, t) for i, t in enumerate(texts)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        frame = spark.createDataFrame(rows, "i int, shard int, value string").coalesce(1)
        found = {r["i"]: r["batch"] for r in message_batches(frame, records, size, within="shard").collect()}
        one = [r["batch"] for r in message_batches(frame, records, size).orderBy("i").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for shards, got in ((True, found), (False, dict(enumerate(one)))):
        batch = held = count = 0
        for n, (i, shard, t) in enumerate(rows):
            b = len((t or "").encode())
            if shards and n and shard != rows[n - 1][1]:
                batch = held = count = 0
            elif count and (count + 1 > records or held + b > size):
                batch, held, count = batch + 1, 0, 0
            assert got[i] == batch
            held, count = held + b, count + 1
    assert message_batches(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        message_batches(frame, 0)
