"""Runs of the batch job: a folder for each in every sink, and one record, written last, that makes its outcomes count.

    <recovered>/_runs/<run>/started.json   what the run is for
    <recovered>/_runs/<run>/done.json      its counts; only runs with this file are finished
    <recovered>/run=<run>, <failed>/.../run=<run>, <unrecoverable>/.../run=<run>

A run that ended between two sinks has no record. The next run of the same job takes it up: it writes the same folders anew,
from the staged outcomes if those were complete, so each input line has its outcome once."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

LEDGER = "_runs"


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _at(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the job itself made."""
    where, files = _at(spark, path)
    files.delete(where, True)


def _children(spark: SparkSession, path: str) -> list[str]:
    where, files = _at(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(where)) if files.exists(where) else []


def _read(spark: SparkSession, path: str) -> dict[str, Any]:
    where, files = _at(spark, path)
    stream = files.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, value: dict[str, Any]) -> None:
    """The file is there whole or not at all."""
    (draft, files), (where, _) = _at(spark, f"{path}.draft"), _at(spark, path)
    stream = files.create(draft, True)
    stream.write(bytearray(json.dumps(value).encode()))
    stream.close()
    files.delete(where, False)
    if not files.rename(draft, where):
        raise OSError(f"could not write {path}")


@dataclass(frozen=True)
class Run:
    """One run of a job whose recovered records go below `recovered`."""

    id: str
    recovered: str
    taken_up: bool = False

    @property
    def record(self) -> str:
        return f"{self.recovered}/{LEDGER}/{self.id}"

    def folder(self, base: str) -> str:
        """The run's own folder in a sink."""
        return f"{base}/run={self.id}"

    def finish(self, spark: SparkSession, counts: dict[str, int]) -> None:
        """From here on the run's outcomes count."""
        _write(spark, f"{self.record}/done.json", counts)


def start(spark: SparkSession, recovered: str, job: dict[str, str]) -> Run:
    """The unfinished run of just this job (its input, configuration and sinks), or a new one.

    Two runs of one job must not be under way at once: the second would take up the first."""
    recovered = recovered.rstrip("/")
    digest = hashlib.sha256(json.dumps(job, sort_keys=True).encode()).hexdigest()
    for name in _children(spark, f"{recovered}/{LEDGER}"):
        found = Run(name, recovered, taken_up=True)
        if exists(spark, f"{found.record}/started.json") and not exists(spark, f"{found.record}/done.json"):
            if _read(spark, f"{found.record}/started.json")["job"] == digest:
                return found
    run = Run(uuid.uuid4().hex, recovered)
    _write(spark, f"{run.record}/started.json", {"job": digest} | job)
    return run


def finished(spark: SparkSession, recovered: str) -> dict[str, dict[str, int]]:
    """The counts of each finished run."""
    recovered = recovered.rstrip("/")
    records = {name: f"{recovered}/{LEDGER}/{name}/done.json" for name in _children(spark, f"{recovered}/{LEDGER}")}
    return {name: _read(spark, path) for name, path in records.items() if exists(spark, path)}


def drop_unfinished(spark: SparkSession, recovered: str, *bases: str) -> list[str]:
    """Delete what runs without a record left in the sinks, and their entries; gives their ids. No run may be under way."""
    recovered = recovered.rstrip("/")
    done = finished(spark, recovered)
    left = [Run(name, recovered) for name in _children(spark, f"{recovered}/{LEDGER}") if name not in done]
    for run in left:
        for base in (recovered, *bases):
            remove(spark, run.folder(base))
        remove(spark, run.record)
    return [run.id for run in left]


def read_recovered(spark: SparkSession, recovered: str) -> DataFrame | None:
    """Recovered requests of all finished runs with the run's id as `run`; None where no finished run recovered any."""
    runs = [Run(name, recovered.rstrip("/")) for name in finished(spark, recovered)]
    folders = [f for r in runs if exists(spark, f := r.folder(r.recovered)) and any(x.startswith("vendor_bucket=") for x in _children(spark, f))]
    return spark.read.option("basePath", recovered).parquet(*folders) if folders else None
