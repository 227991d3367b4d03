"""Outcomes: recovered, failed, unrecoverable."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import wire
from ..functions import json_text as J
from ..functions import variants as V
from ..functions.variants import Sql

RECOVERED, FAILED, UNRECOVERABLE = "recovered", "failed", "unrecoverable"
STATUSES = (RECOVERED, FAILED, UNRECOVERABLE)

ERROR_SCHEMA = f"iglu:{wire.BAD_ROW_VENDOR}/{wire.RECOVERY_ERROR}/jsonschema/1-0-0"
VIOLATION_SCHEMA = f"iglu:{wire.BAD_ROW_VENDOR}/{wire.FORMAT_VIOLATION}/jsonschema/1-0-0"


def classify(events: DataFrame) -> DataFrame:
    """Add `status`."""
    code = F.col("err")["code"]
    return events.withColumn(
        "status",
        F.when(F.col("err").isNull(), RECOVERED)
        .when(code == "UnrecoverableBadRowType", UNRECOVERABLE)
        .otherwise(FAILED),
    )


@dataclass(frozen=True)
class Outcomes:
    recovered: DataFrame
    failed: DataFrame
    unrecoverable: DataFrame


def split_outcomes(events: DataFrame) -> Outcomes:
    """One frame per status. Stage the input first (`run_batch` does) or each frame recomputes it."""
    return Outcomes(*[events.filter(F.col("status") == s) for s in STATUSES])


def error_rows(events: DataFrame, now: Sql = "current_timestamp()") -> DataFrame:
    """Add `error_row`, the failed event to write for a row with an error (NULL otherwise).

    A readable line is wrapped as a recovery error, as it was read: its text is
    put in unchanged. Of a recovery error, the event inside is put in, in the
    order and with the digits it had, and the number of recoveries goes up by one
    (at the largest BIGINT it stays). A line that is no JSON, or holds a number that cannot be
    kept, becomes a format violation holding the line.
    """
    processor = (
        f"named_struct('artifact', {V.quote(wire.PROCESSOR_ARTIFACT)}, 'version', {V.quote(wire.PROCESSOR_VERSION)})"
    )
    stamp = f"date_format({now}, 'yyyy-MM-dd\\'T\\'HH:mm:ss.SSS\\'Z\\'')"
    inner = J.get("line", "data", "payload")
    original = f"CASE WHEN nested AND row_type IS NOT NULL THEN {inner} ELSE trim(line) END"
    flow_names = "CASE WHEN size(flows) > 0 THEN array_join(flows, ',') END"
    failed = f"named_struct('error', err.message, 'configName', {flow_names})"
    recoveries = "coalesce(try_add(coalesce(recoveries, 0L), 1L), recoveries)"
    head = f'{{"schema":"{ERROR_SCHEMA}","data":{{"processor":'
    wrapped = (
        f"concat({V.quote(head)}, to_json({processor}), ',\"failure\":', to_json({failed}),"
        f" ',\"payload\":', {original}, ',\"recoveries\":', {recoveries}, '}}}}')"
    )
    violation = (
        f"to_json(named_struct('schema', {V.quote(VIOLATION_SCHEMA)}, 'data', named_struct("
        f"'processor', {processor},"
        f" 'failure', named_struct('timestamp', {stamp}, 'loader', '', 'message', err.message),"
        " 'payload', line)))"
    )
    # A step may raise the same code, but only for a row whose type was read.
    return events.withColumn(
        "error_row",
        F.expr(
            f"CASE WHEN err.code = 'InvalidJsonFormat' AND row_type IS NULL THEN {violation}"
            f" WHEN err IS NOT NULL THEN {wrapped} END"
        ),
    )


def summary(events: DataFrame) -> DataFrame:
    """One row of counts; two-phase aggregation, so only partial counts are shuffled."""
    return events.agg(*summary_columns())


def summary_columns() -> list[Column]:
    """The counts as aggregates, for `summary` and for `observe` on a batch or stream."""
    return [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]


def metrics_frame(counts: DataFrame, namespace: str | None, dimensions: Mapping[str, str] | None = None) -> DataFrame:
    """Counters to publish: one row per count of `summary`; none without a namespace."""
    pairs = [F.lit(x) for kv in (dimensions or {}).items() for x in kv]
    tags = (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")
    named = F.array(*[F.struct(F.lit(s).alias("name"), F.col(s).cast("bigint").alias("value")) for s in STATUSES])
    rows = counts.select(F.explode(named).alias("m")).select(
        F.lit(namespace).cast("string").alias("namespace"),
        tags.alias("dimensions"),
        F.col("m")["name"].alias("name"),
        F.col("m")["value"].alias("value"),
    )
    return rows if namespace else rows.filter(F.lit(False))


def partition_key(record: Column) -> Column:
    """Key that spreads records by content."""
    return F.md5(record.cast("binary"))
