"""The whole job: lines in, three outcomes out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.variants import Sql, configure
from ..operators.decode import decode_events
from ..operators.outcomes import FAILED, RECOVERED, UNRECOVERABLE, classify, error_rows, metrics_frame, summary, summary_columns
from ..operators.recover import recover
from ..operators.requests import to_request
from ..sources import runs
from ..sources.files import default_error_bases, read_failed_events, to_stream_records, write_errors, write_recovered
from .config import Config, check_patterns

@dataclass(frozen=True)
class Reports:
    """What a job gives besides its three sinks, each written by a function that takes the frame.

    `metrics` gets the counters, named after `namespace` and `dimensions` (none
    without a namespace); `records` gets the rows for a message sink `topic`.
    """

    metrics: Callable[[DataFrame], None] | None = None
    namespace: str | None = None
    dimensions: Mapping[str, str] | None = None
    records: Callable[[DataFrame], None] | None = None
    topic: str | None = None

    def write(self, outcomes: DataFrame) -> None:
        if self.metrics is not None and self.namespace:
            self.metrics(metrics_frame(summary(outcomes), self.namespace, self.dimensions))
        if self.records is not None:
            self.records(to_stream_records(outcomes, self.topic))


STAGED = ("status", "request", "error_row", "err_code", "flows", "row_type")
#: What `stage` needs of an outcome.
OUTCOME = ("status", "request", "error_row", "err", "flows", "row_type")


def execute(
    lines: DataFrame, config: Config, column: str = "value", now: Sql = "current_timestamp()", zero_is_false: bool = False
) -> DataFrame:
    """Recover every line: adds `status`, `request` or `error_row`, and what led there.

    Narrow from end to end: no shuffle, no Python per row; the same for a batch
    and for a stream.
    """
    check_patterns(config, configure(lines.sparkSession))
    recovered = recover(decode_events(lines, column), config, zero_is_false)
    return error_rows(classify(to_request(recovered)), now)


def staging_base(spark: SparkSession) -> str:
    """The shared place the cluster names for checkpoints; without one there is no place to stage."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir, or give a staging folder that driver and executors share")
    return shared.rstrip("/")


def staging_dir(spark: SparkSession) -> str:
    """A new folder there."""
    return f"{staging_base(spark)}/rowmend-{uuid.uuid4().hex}"


def stage(events: DataFrame, path: str, take_up: bool = False) -> DataFrame:
    """Write outcomes once, filed by status, and read them back.

    Every sink then reads only its own part; a lost executor costs a re-read of
    files, never a second recovery of the input. With `take_up`, a folder that an
    earlier try has written whole is read as it is.
    """
    spark = events.sparkSession
    staged = events.withColumn("err_code", F.col("err")["code"]).select(*STAGED)
    if not (take_up and runs.exists(spark, f"{path}/_SUCCESS")):
        # Static: a status that a replay lacks must not keep the rows of the earlier try.
        writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
        writer.partitionBy("status").parquet(path)
    return spark.read.schema(staged.schema).parquet(path)


def run_batch(
    spark: SparkSession,
    source: str,
    config: Config,
    recovered: str,
    failed: str | None = None,
    unrecoverable: str | None = None,
    staging: str | None = None,
    reports: Reports | None = None,
) -> dict[str, int]:
    """Batch job over a folder of lines; gives the counts per outcome.

    The recovery is computed in one pass over the input. Counting the staged
    rows reads file footers only. Each sink gets a folder of this run, and the
    record that the run is finished comes last: after a failure at any point the
    same call takes the run up, with the staged outcomes if they were complete,
    and writes the same folders anew. Reports may then go out twice. The staged
    copy is removed at the end.
    """
    failed, unrecoverable = default_error_bases(source, failed, unrecoverable)
    job = {"source": source, "config": repr(config), "failed": failed, "unrecoverable": unrecoverable}
    run = runs.start(spark, recovered, job)
    where = f"{(staging or staging_base(spark)).rstrip('/')}/rowmend-{run.id}"
    outcomes = stage(execute(read_failed_events(spark, source), config), where, run.taken_up)
    counts = outcomes.agg(*summary_columns()).first().asDict()
    write_recovered(outcomes, run.folder(run.recovered), "overwrite", rows=counts[RECOVERED])
    for base, status in ((failed, FAILED), (unrecoverable, UNRECOVERABLE)):
        if counts[status]:
            write_errors(outcomes, base, status, "overwrite", run.id)
    if reports is not None:
        reports.write(outcomes)
    run.finish(spark, counts)
    runs.remove(spark, where)
    return {s: counts[s] for s in (RECOVERED, FAILED, UNRECOVERABLE)}
