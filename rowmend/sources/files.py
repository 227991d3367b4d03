"""Reading failed events and writing outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import wire
from ..functions import variants as V
from ..functions.variants import Sql, configure
from ..operators.outcomes import FAILED, RECOVERED, UNRECOVERABLE, partition_key

#: Folders of recovered requests, rows that make a file of good size, and most tasks that write them.
VENDOR_BUCKETS = 64
ROWS_PER_FILE = 1_000_000
MOST_TASKS = 10_000

#: Rows of a compressed text file. One task reads such a file from end to end, so it must not hold all that another task wrote.
ROWS_PER_TEXT_FILE = 20_000

# --- sources ------------------------------------------------------------------


def read_failed_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One line per row, column `value`; compressed files are read by extension."""
    return configure(spark).read.text(path)


def stream_failed_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream of files."""
    reader = configure(spark).readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


# --- output paths -------------------------------------------------------------


def below(directory: Sql, name: str) -> Sql:
    """A folder in another, which may end in `/` or `/*` and have blanks around it."""
    bare = f"regexp_replace(replace({directory}, '*', ''), {V.quote('^' + chr(92) + 's+|' + chr(92) + 's+$')}, '')"
    return f"concat(regexp_replace({bare}, '/\\u0024', ''), {V.quote('/' + name)})"


def error_dir(base: str) -> str:
    """Folder of error rows under an output: named after their schema."""
    return f"{base}/{wire.BAD_ROW_VENDOR}.{wire.RECOVERY_ERROR}"


def error_bases(source: Sql, failed: Sql = "NULL", unrecoverable: Sql = "NULL") -> Sql:
    """struct<failed, unrecoverable>: where error rows go. As told, or else below the input; unrecoverable ones below a told failed folder."""
    return (
        f"named_struct('failed', coalesce({failed}, {below(source, 'unrecovered')}),"
        f" 'unrecoverable', coalesce({unrecoverable}, {below(f'coalesce({failed}, {source})', 'unrecoverable')}))"
    )


def default_error_bases(source: str, failed: str | None = None, unrecoverable: str | None = None) -> tuple[str, str]:
    """The rule for one job, on the driver."""
    told = [V.quote(x) if x else "CAST(NULL AS STRING)" for x in (source, failed, unrecoverable)]
    return tuple(SparkSession.active().range(1).select(F.expr(error_bases(*told)).alias("b")).first()["b"])


# --- sinks --------------------------------------------------------------------


def to_stream_records(events: DataFrame, topic: str | None = None) -> DataFrame:
    """Recovered requests as `key, value, headers`, the columns a message sink takes.

    The value is the request as JSON, the key spreads by content and the header
    tells that the record was recovered to `topic`.
    """
    value = F.to_json(F.col("request"))
    header = F.struct(F.lit(RECOVERED).alias("key"), F.lit(topic).cast("binary").alias("value"))
    return (
        events.filter(F.col("status") == RECOVERED)
        .withColumn("_text", value)
        .select(
            partition_key(F.col("_text")).alias("key"),
            F.col("_text").cast("binary").alias("value"),
            F.array(header).alias("headers"),
        )
    )


def recovered_records(events: DataFrame) -> DataFrame:
    """Recovered requests as columns, with their vendor and the folder number it is filed under.

    Vendors come from the paths of rejected traffic, so there may be any number
    of them. A folder for each would have no bound; a hash of the vendor has.
    """
    vendor = F.coalesce(F.get(F.split(F.col("request")["path"], "/"), F.lit(1)), F.lit(""))
    return (
        events.filter(F.col("status") == RECOVERED)
        .select("request.*", vendor.alias("vendor"))
        .withColumn("vendor_bucket", F.pmod(F.xxhash64("vendor"), F.lit(VENDOR_BUCKETS)).cast("int"))
    )


def write_recovered(events: DataFrame, path: str, mode: str = "append", rows: int | None = None) -> None:
    """Recovered requests to Parquet, VENDOR_BUCKETS folders at most.

    With the number of `rows`, a folder's rows are dealt to one task for each
    ROWS_PER_FILE of all rows, so files are neither small nor, for a vendor with
    most of the rows, written by one task.
    """
    records = recovered_records(events)
    if rows is not None:
        parts = max(1, -(-rows // ROWS_PER_FILE))
        salt = F.pmod(F.xxhash64(*records.columns), F.lit(parts))
        records = records.repartition(min(parts * VENDOR_BUCKETS, MOST_TASKS), "vendor_bucket", salt)
    records.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("vendor_bucket").parquet(path)


def write_text(rows: DataFrame, path: str, mode: str, compression: str = "gzip") -> None:
    """Lines in compressed files of bounded length: lines of JSON take many times the room that they need."""
    rows.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", ROWS_PER_TEXT_FILE).text(path)


def write_errors(events: DataFrame, base: str, status: str, mode: str = "append", run: str | None = None) -> None:
    """Error rows of one status to text below `base`, in the folder of the run if one is given."""
    if status not in (FAILED, UNRECOVERABLE):
        raise ValueError(f"no error rows for {status}")
    rows = events.filter(F.col("status") == status).select(F.col("error_row").alias("value"))
    rows.write.mode(mode).text(error_dir(base) + (f"/run={run}" if run else ""))
