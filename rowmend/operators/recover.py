"""Recovery by row type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import wire
from ..functions import variants as V
from ..functions.codecs import b64_decode
from ..functions.errors import Known, failure
from ..functions.querystring import qs_clean, qs_pairs
from ..functions.variants import Sql
from ..plans.config import Config
from .conditions import match_flows
from .decode import row_get
from .payloads import COLLECTOR
from .requests import REQUEST_TYPE, collector_payload, request_failure
from .steps import apply_flows

# Fixed value: failure message of a record that was base64-encoded twice.
DOUBLY_ENCODED = r"error deserializing raw event: Unrecognized type \d*"

RECOVERABLE = (*wire.COLLECTOR_TYPES, *wire.ENRICHMENT_TYPES, wire.FORMAT_VIOLATION)


def refuse_unrecoverable(events: DataFrame) -> DataFrame:
    """Rows of a type that is never recovered; checked after a flow has matched."""
    types = ", ".join(V.quote(t) for t in RECOVERABLE)
    err = failure("UnrecoverableBadRowType", "row_type")
    return events.withColumn(
        "err", F.expr(f"CASE WHEN err IS NULL AND row_type NOT IN ({types}) THEN {err} ELSE err END")
    )


def failure_message() -> Sql:
    """Message of a format violation: text, or an object with the text as `error`."""
    return V.let(
        row_get("failure", "message"),
        lambda m: V.let(
            f"CASE WHEN {V.is_string(m)} THEN {m} ELSE {V.get(m, 'error')} END",
            lambda x: f"CASE WHEN {V.is_string(x)} THEN {V.string(x)} END",
        ),
    )


def repair_format_violations(events: DataFrame) -> DataFrame:
    """Read the raw record of a format violation and repair its querystring.

    The record is base64 of the request as JSON. A record encoded twice only
    loses the extra layer. Otherwise every parameter value is cleaned, which
    makes it decodable, and stored decoded; writing the request encodes it once.
    The result is a collector payload.
    """
    ours = f"err IS NULL AND row_type = '{wire.FORMAT_VIOLATION}'"
    event = "payload.event"
    as_request = V.let(
        V.parse("_record"),
        lambda v: f"CASE WHEN {V.is_object(v)} THEN try_cast({v} AS {REQUEST_TYPE}) END",
    )
    repaired = V.each(
        "_pairs", lambda p: f"named_struct('name', {p}.name, 'value', try_url_decode({qs_clean(f'{p}.value')}))"
    )
    typed = (
        f"CASE WHEN _request IS NULL THEN NULL WHEN _twice THEN {collector_payload('_request')}"
        f" WHEN _pairs IS NOT NULL THEN {collector_payload('_request', repaired)} END"
    )
    staged = (
        events.withColumn("_ours", F.expr(ours))
        .withColumns(
            {
                "_twice": F.expr(
                    f"_ours AND coalesce({failure_message()} RLIKE {V.quote(DOUBLY_ENCODED)}, false)"
                ),
                "_plain": F.expr(f"CASE WHEN _ours THEN {b64_decode(event)} END"),
            }
        )
        .withColumn("_record", F.expr(f"CASE WHEN _twice THEN {b64_decode('_plain')} ELSE _plain END"))
        .withColumn("_request", F.expr(as_request))
        .withColumn("_pairs", F.expr(f"CASE WHEN NOT _twice THEN {qs_pairs('_request.querystring')} END"))
        .withColumn("_typed", F.expr(typed))
    )

    def unexpected(data: Sql, reason: str) -> Sql:
        return failure("UnexpectedFieldFormat", data, Known("querystring"), Known("k1=v1&k2=v2"), Known(reason))

    no_base64 = failure("Base64Failure", event, Known("Data is not properly base64-encoded"))
    no_record = failure("InvalidDataFormat", "_record", Known("Not a collector request record"))
    querystring = "_request.querystring"
    err = (
        f"CASE WHEN NOT _ours THEN err WHEN _record IS NULL THEN {no_base64}"
        f" WHEN _request IS NULL THEN {no_record}"
        f" WHEN NOT _twice AND {querystring} IS NULL"
        f" THEN {unexpected(Known('empty payload line'), 'nullified querystring')}"
        f" WHEN NOT _twice AND _pairs IS NULL THEN {unexpected(querystring, 'empty')}"
        f" WHEN _typed IS NULL THEN {request_failure('_request')} END"
    )
    return staged.withColumns(
        {
            "err": F.expr(V.opaque(err)),
            "payload": F.expr("coalesce(_typed, payload)"),
            "shape": F.expr(f"CASE WHEN _typed IS NOT NULL THEN '{COLLECTOR}' ELSE shape END"),
        }
    ).drop("_ours", "_twice", "_plain", "_record", "_request", "_pairs", "_typed")


def recover(events: DataFrame, config: Config, zero_is_false: bool = False) -> DataFrame:
    """Match flows on decoded events and apply them; leaves the edited payload or an error."""
    matched = refuse_unrecoverable(match_flows(events, config))
    # Only configurations that speak of format violations need their repair in the plan.
    if any(f.row_type == wire.FORMAT_VIOLATION for f in config.flows):
        matched = repair_format_violations(matched)
    # The parsed line is not needed any more; dropping it keeps the rows of the steps small.
    return apply_flows(matched.drop("doc"), config, zero_is_false)
