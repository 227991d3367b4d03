"""From one line of text to a typed failed event.

Columns added on the way:
  line        the text as read
  doc         its document (VARIANT, wrapped, see `variants.wrapped`)
  schema      schema key of the line
  nested      whether the line is a recovery error, that is, holds another failed event
  row_schema, row_type
              of the failed event that flows are matched on: the one inside when nested
  recoveries  earlier recoveries, 0 when none
  shape, payload
              payload shape and typed payload
  err         struct<code, message>, NULL while all is well
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import wire
from ..functions import variants as V
from ..functions.errors import Known, failure
from ..functions.schema_keys import schema_name
from ..functions.variants import Sql
from .payloads import COLLECTOR, ENRICHMENT, OTHER, RAW, loose_type, payload_struct, read_parts, read_record, shape_of

_KNOWN_SCHEMA = (
    "^iglu:"
    + re.escape(wire.BAD_ROW_VENDOR)
    + "/("
    + "|".join(wire.KNOWN_ROW_TYPES)
    + ")/jsonschema/[1-9][0-9]*-(0|[1-9][0-9]*)-(0|[1-9][0-9]*)$"
)


# Where the failed event is inside the wrapped document of a line.
_PLAIN = (0, "data")
_INNER = (0, "data", "payload", "data")


def row_get(*steps: str | int) -> Sql:
    """Value inside the failed event that flows are matched on."""
    return f"CASE WHEN nested THEN {V.get('doc', *_INNER, *steps)} ELSE {V.get('doc', *_PLAIN, *steps)} END"


def row_parts(shape: str, *steps: str | int) -> Sql:
    """The value there taken apart, see `loose_type`: straight out of the line, a VARIANT of it would be a copy."""

    def at(place: tuple[str | int, ...]) -> Sql:
        return V.get_as("doc", loose_type(shape), *place, *steps)

    return f"CASE WHEN nested THEN {at(_INNER)} ELSE {at(_PLAIN)} END"


def _is_failed_event(schema: Sql, data: Sql) -> Sql:
    return f"(coalesce({schema} RLIKE {V.quote(_KNOWN_SCHEMA)}, false) AND {data} IS NOT NULL)"


def parse_events(events: DataFrame, column: str = "value") -> DataFrame:
    """Parse lines and read the `{schema, data}` envelope of a known failed-event type."""
    parsed = events.withColumnRenamed(column, "line").withColumn("doc", F.expr(V.wrapped("line")))
    envelope = parsed.withColumns(
        {"_whole": F.expr(V.is_whole("doc", "line")), "schema": F.expr(V.get_string("doc", 0, "schema"))}
    )
    unknown = failure("InvalidDataFormat", "line", Known("Not a self-describing failed event of a known type"))
    known = _is_failed_event("schema", V.get("doc", *_PLAIN, "processor"))
    err = (
        f"CASE WHEN NOT _whole THEN {failure('InvalidJsonFormat', 'line')} WHEN NOT {known} THEN {unknown} END"
    )
    return envelope.withColumn("err", F.expr(err)).drop("_whole")


def unwrap_recovery_errors(events: DataFrame) -> DataFrame:
    """Look inside a recovery error for its failed event; other rows stand for themselves."""
    unwrapped = events.withColumn(
        "nested", F.expr(f"err IS NULL AND {schema_name('schema')} = '{wire.RECOVERY_ERROR}'")
    ).withColumns(
        {
            "row_schema": F.expr(
                f"CASE WHEN nested THEN {V.get_string('doc', 0, 'data', 'payload', 'schema')} ELSE schema END"
            ),
            "recoveries": F.expr(
                "CASE WHEN nested THEN"
                f" coalesce(try_cast({V.get('doc', 0, 'data', 'recoveries')} AS BIGINT), 0) ELSE 0 END"
            ),
        }
    )
    empty = failure("InvalidDataFormat", "line", Known("No failed event inside the recovery error"))
    known = _is_failed_event("row_schema", V.get("doc", *_INNER, "processor"))
    return unwrapped.withColumn("err", F.expr(f"CASE WHEN nested AND NOT {known} THEN {empty} ELSE err END"))


def decode_payloads(events: DataFrame) -> DataFrame:
    """Read the payload by row type; a row that does not fit its type is an error."""
    enriched = row_get("payload", "enriched")
    payload = (
        f"CASE shape WHEN '{COLLECTOR}' THEN {read_parts(row_parts(COLLECTOR, 'payload'), COLLECTOR)}"
        f" WHEN '{ENRICHMENT}' THEN {V.let(enriched, _read_enrichment)}"
        f" WHEN '{RAW}' THEN {V.let(row_get('payload'), read_record)}"
        f" WHEN '{OTHER}' THEN {payload_struct()} END"
    )
    typed = (
        events.withColumn("row_type", F.expr(f"CASE WHEN err IS NULL THEN {schema_name('row_schema')} END"))
        .withColumn("shape", F.expr(f"CASE WHEN row_type IS NOT NULL THEN {shape_of('row_type')} END"))
        .withColumn("payload", F.expr(payload))
    )
    fits = " AND ".join(
        [
            "payload IS NOT NULL",
            V.is_string(row_get("processor", "artifact")),
            V.is_string(row_get("processor", "version")),
            V.is_object(row_get("failure")),
        ]
    )
    unfit = failure("InvalidDataFormat", "line", Known("Fields do not fit the row type"))
    err = f"CASE WHEN err IS NULL AND NOT ({fits}) THEN {unfit} ELSE err END"
    return typed.withColumn("err", F.expr(V.opaque(err)))


def _read_enrichment(enriched: Sql) -> Sql:
    raw = read_parts(row_parts(ENRICHMENT, "payload", "raw"), ENRICHMENT, enriched)
    return f"CASE WHEN {V.is_object(enriched)} THEN {raw} END"


def decode_events(events: DataFrame, column: str = "value") -> DataFrame:
    """All of the above."""
    return decode_payloads(unwrap_recovery_errors(parse_events(events, column)))
