"""The job as a stream of files."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.outcomes import FAILED, RECOVERED, STATUSES, UNRECOVERABLE, summary, summary_columns
from ..plans.config import Config
from ..plans.recovery import OUTCOME, Reports, execute, stage
from ..sources import runs
from ..sources.files import error_dir, stream_failed_events, write_recovered, write_text

COUNTERS = "outcomes"


def batch_paths(out: str, batch_id: int) -> dict[str, str]:
    """Folder of each outcome for one micro-batch; the id in the path makes a replay overwrite itself."""
    return {
        RECOVERED: f"{out}/{RECOVERED}/batch={batch_id}",
        FAILED: f"{error_dir(f'{out}/{FAILED}')}/batch={batch_id}",
        UNRECOVERABLE: f"{error_dir(f'{out}/{UNRECOVERABLE}')}/batch={batch_id}",
    }


def staged_dir(out: str) -> str:
    return f"{out}/_staged"


def write_batch(outcomes: DataFrame, batch_id: int, out: str, compression: str = "gzip") -> DataFrame:
    """Write the outcomes of one micro-batch, replacing an earlier try of the same batch; gives the staged outcomes.

    The batch is staged once next to its output and the three sinks read it
    from there, so a lost executor never repeats the recovery work. Batches of
    a query run one after the other, so they share one staging folder. Error
    rows are text files with this `compression` (`none` for plain ones).
    """
    paths = batch_paths(out, batch_id)
    staged = stage(outcomes, staged_dir(out))
    write_recovered(staged, paths[RECOVERED], "overwrite")
    for status in (FAILED, UNRECOVERABLE):
        rows = staged.filter(F.col("status") == status).select(F.col("error_row").alias("value"))
        write_text(rows, paths[status], "overwrite", compression)
    summary(staged).write.mode("overwrite").parquet(f"{counts_dir(out)}/batch={batch_id}")
    return staged


def counts_dir(out: str) -> str:
    return f"{out}/counts"


def durable_counters(spark: SparkSession, out: str) -> DataFrame:
    """One row of counts over all batches written below `out`.

    Each batch has one file of counts, which a replay replaces, so restarts and
    replays count once. The files hold a row each: their number is that of the batches."""
    columns = ", ".join(f"{s} BIGINT" for s in STATUSES)
    if runs.exists(spark, counts_dir(out)):
        filed = spark.read.schema(f"{columns}, batch BIGINT").parquet(counts_dir(out))
    else:
        filed = spark.createDataFrame([], columns)
    return filed.agg(*[F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias(s) for s in STATUSES])


def stream_recover(
    spark: SparkSession,
    source: str,
    config: Config,
    out: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    max_files_per_trigger: int | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    reports: Reports | None = None,
    compression: str = "gzip",
) -> StreamingQuery:
    """Recover a stream of files into three folders below `out`.

    `checkpoint` keeps which files were read; with the per-batch folders each
    input line has its outcome exactly once. The counts are observed in the
    same pass under the name `outcomes`. `on_batch` and `reports` get the staged
    outcomes of a micro-batch, so they repeat no recovery; these are removed when
    both have returned. Error rows go to text files with this `compression`.
    """
    lines = stream_failed_events(spark, source, max_files_per_trigger)
    # A micro-batch is handed over with every column it has, so those that are not staged are dropped before.
    outcomes = execute(lines, config).select(*OUTCOME).observe(COUNTERS, *summary_columns())

    def sink(batch: DataFrame, batch_id: int) -> None:
        staged = write_batch(batch, batch_id, out, compression)
        if reports is not None:
            reports.write(staged)
        if on_batch is not None:
            on_batch(staged, batch_id)
        runs.remove(spark, staged_dir(out))

    return (
        outcomes.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


class LiveCounters(StreamingQueryListener):
    """Running counts per outcome of one query, fed by the observed metrics of each micro-batch.

    Without the id of a query (`StreamingQuery.id`, as text) all queries that
    observe outcomes add up. `start` is what to count on from, such as the row of
    `durable_counters` after a restart. A batch that is tried again is seen again
    here; the filed counts are the ones to go by.
    """

    def __init__(self, query_id: str | None = None, start: Mapping[str, int] | None = None) -> None:
        self.query_id = query_id
        self.counts = dict.fromkeys(STATUSES, 0) | {s: start[s] for s in STATUSES if start}
        self._ended = threading.Event()

    def wait(self, seconds: float = 60) -> bool:
        """Wait until the counts of an ended query are complete; events arrive later than the query ends."""
        return self._ended.wait(seconds)

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        observed = event.progress.observedMetrics.get(COUNTERS)
        if observed is not None and self.query_id in (None, str(event.progress.id)):
            for status in STATUSES:
                self.counts[status] += observed[status] or 0

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        if self.query_id in (None, str(event.id)):
            self._ended.set()
