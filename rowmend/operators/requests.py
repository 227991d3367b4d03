"""Collector requests: the form in which a recovered event re-enters its pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import wire
from ..functions import json_text as J
from ..functions import variants as V
from ..functions.errors import Known, failure
from ..functions.querystring import nvps_to_qs, qs_to_nvps
from ..functions.schema_keys import is_full_key, schema_name
from ..functions.variants import Sql
from .payloads import COLLECTOR, ENRICHMENT, is_uuid, lower_hex, payload_struct

# Fixed value: fields of a collector request record, in order.
REQUEST_FIELDS = {
    "schema": "STRING",
    "ipAddress": "STRING",
    "timestamp": "BIGINT",
    "encoding": "STRING",
    "collector": "STRING",
    "userAgent": "STRING",
    "refererUri": "STRING",
    "path": "STRING",
    "querystring": "STRING",
    "body": "STRING",
    "headers": "ARRAY<STRING>",
    "contentType": "STRING",
    "hostname": "STRING",
    "networkUserId": "STRING",
}
REQUEST_TYPE = "STRUCT<" + ", ".join(f"{n}: {t}" for n, t in REQUEST_FIELDS.items()) + ">"
_JSON = "'application/json'"
_SENDGRID, _IGLU = V.quote(wire.SENDGRID_VENDOR), V.quote(wire.IGLU_WEBHOOK_VENDOR)


def _request(**fields: Sql) -> Sql:
    """A request struct; fields that are not given are NULL."""
    given = {"schema": V.quote(wire.REQUEST_SCHEMA), **fields}
    typed = [f"'{n}', CAST({given.get(n, 'NULL')} AS {t})" for n, t in REQUEST_FIELDS.items()]
    return f"named_struct({', '.join(typed)})"


def _millis(text: Sql) -> Sql:
    return f"coalesce(unix_millis(try_cast({text} AS TIMESTAMP)), 0)"


def _rebuilt(**extra: Sql) -> Sql:
    """Request of the payload at hand; body, headers and content type only where given."""
    plain = {
        "ipAddress": "payload.ipAddress",
        "timestamp": _millis("payload.timestamp"),
        "encoding": "payload.encoding",
        "collector": "payload.collector",
        "userAgent": "payload.useragent",
        "refererUri": "payload.refererUri",
        "path": "concat('/', payload.vendor, '/', payload.version)",
        "querystring": nvps_to_qs("payload.pairs"),
        "hostname": "payload.hostname",
        "networkUserId": "payload.user",
    }
    return _request(**{**plain, **extra})


def _built(request: Sql) -> Sql:
    return f"named_struct('request', {request}, 'err', {V.NO_ERROR})"


def _refused(err: Sql) -> Sql:
    return f"named_struct('request', CAST(NULL AS {REQUEST_TYPE}), 'err', {err})"


def _uncoercible(reason: str, data: Sql) -> Sql:
    return _refused(failure("UncoerciblePayload", Known(reason), data))


def _webhook_parts() -> Sql:
    """struct<content, parsed, schema, data> of the self-describing parameter."""
    named = V.where("payload.pairs", lambda p: f"{p}.name = {V.quote(wire.SELF_DESCRIBING_PARAMETER)}")
    return V.let(
        f"{V.first(named)}.value",
        lambda content: V.let(
            V.wrapped(content),
            lambda w: (
                f"named_struct('content', {content}, 'parsed', {V.is_whole(w, content)},"
                f" 'schema', {V.get_string(w, 0, 'data', 'schema')},"
                f" 'data', CASE WHEN {V.is_whole(w, content)} THEN {J.get(content, 'data', 'data')} END)"
            ),
        ),
    )


def _of_webhook() -> Sql:
    """Webhook requests carry their self-describing parameter as a JSON body.

    One vendor gets a one-element array of the data with the schema name as
    `event`, the other the plain data and the schema as querystring.
    """

    def merged(w: Sql) -> Sql:
        event = f"concat('\"event\":', {J.quoted(schema_name(f'{w}.schema'))})"

        def in_object(fields: Sql) -> Sql:
            named = V.any_of(fields, lambda m: f"{J.key_of(m)} <=> 'event'")
            kept = V.each(fields, lambda m: f"CASE WHEN {J.key_of(m)} <=> 'event' THEN {event} ELSE {m} END")
            return J.object_of(f"CASE WHEN {named} THEN {kept} ELSE array_append({fields}, {event}) END")

        fields = f"CASE WHEN startswith({w}.data, '{{') THEN {J.members(f'{w}.data')} ELSE CAST(array() AS ARRAY<STRING>) END"
        return V.let(fields, in_object)

    def by_vendor(w: Sql) -> Sql:
        is_iglu = f"payload.vendor = {_IGLU}"
        request = _rebuilt(
            body=f"CASE WHEN {is_iglu} THEN {w}.data ELSE concat('[', {merged(w)}, ']') END",
            querystring=(
                f"CASE WHEN {is_iglu} THEN concat('schema=', {w}.schema) ELSE {nvps_to_qs('payload.pairs')} END"
            ),
            contentType=_JSON,
        )
        return (
            f"CASE WHEN {w}.content IS NULL THEN {_uncoercible('ue_pr parameter is empty', 'to_json(payload.pairs)')}"
            f" WHEN NOT {w}.parsed THEN {_uncoercible('ue_pr parameter is not JSON', f'{w}.content')}"
            f" WHEN {w}.schema IS NULL THEN {_uncoercible('no schema in ue_pr', f'{w}.content')}"
            f" WHEN {w}.data IS NULL THEN {_uncoercible('no data in ue_pr', f'{w}.content')}"
            f" WHEN NOT ({is_iglu}) AND NOT {is_full_key(f'{w}.schema')}"
            f" THEN {_uncoercible('invalid schema in ue_pr', f'{w}.content')}"
            f" ELSE {_built(request)} END"
        )

    return V.let(_webhook_parts(), by_vendor)


def to_request(events: DataFrame) -> DataFrame:
    """Add `request`, the collector request rebuilt from the payload; failures go to `err`."""
    collector = _built(_rebuilt(body="payload.body", headers="payload.headers", contentType="payload.contentType"))
    other = _refused(failure("UncocoerciblePayload", Known("Unsupported request format"), "coalesce(payload.event, '')"))
    built = (
        f"CASE WHEN err IS NOT NULL THEN NULL WHEN shape = '{COLLECTOR}' THEN {collector}"
        f" WHEN shape = '{ENRICHMENT}' AND payload.vendor IN ({_SENDGRID}, {_IGLU}) THEN {_of_webhook()}"
        f" WHEN shape = '{ENRICHMENT}' THEN {_built(_rebuilt())} ELSE {other} END"
    )
    return (
        events.withColumn("_built", F.expr(built))
        .withColumns({"request": F.expr("_built.request"), "err": F.expr(V.opaque("coalesce(err, _built.err)"))})
        .drop("_built")
    )


# --- the way back -------------------------------------------------------------


def split_path(path: Sql) -> Sql:
    """`/vendor/version` to struct<vendor, version>; other shapes give empty parts."""
    return V.let(
        f"split(rtrim('/', coalesce({path}, '')), '/')",
        lambda parts: (
            f"named_struct('vendor', CASE WHEN size({parts}) IN (2, 3) THEN {parts}[1] ELSE '' END,"
            f" 'version', CASE WHEN size({parts}) = 3 THEN {parts}[2] ELSE '' END)"
        ),
    )


def _stamp_fits(request: Sql) -> Sql:
    """Whether the timestamp is one that can be written: years 1 to 9999."""
    return f"coalesce({request}.timestamp BETWEEN -62135596800000 AND 253402300799999, true)"


def collector_payload(request: Sql, pairs: Sql | None = None) -> Sql:
    """Typed collector payload of a request struct; NULL when its querystring cannot be decoded or its timestamp not be written."""
    nvps = qs_to_nvps(f"{request}.querystring") if pairs is None else pairs
    millis = f"CASE WHEN {_stamp_fits(request)} THEN nullif({request}.timestamp, 0) END"
    stamp = f"date_format(timestamp_millis({millis}), 'yyyy-MM-dd\\'T\\'HH:mm:ss.SSS\\'Z\\'')"

    def build(s: Sql) -> Sql:
        built = payload_struct(
            vendor=f"{s}.at.vendor",
            version=f"{s}.at.version",
            pairs=f"{s}.nvps",
            contentType=f"{request}.contentType",
            body=f"{request}.body",
            collector=f"coalesce({request}.collector, '')",
            encoding=f"coalesce({request}.encoding, '')",
            hostname=f"{request}.hostname",
            timestamp=stamp,
            ipAddress=f"{request}.ipAddress",
            useragent=f"{request}.userAgent",
            refererUri=f"{request}.refererUri",
            headers=f"coalesce({request}.headers, CAST(array() AS ARRAY<STRING>))",
            user=f"CASE WHEN {is_uuid(f'{request}.networkUserId')} THEN {lower_hex(f'{request}.networkUserId')} END",
        )
        return f"CASE WHEN {s}.nvps IS NOT NULL AND {_stamp_fits(request)} THEN {built} END"

    return V.let(f"named_struct('at', {split_path(f'{request}.path')}, 'nvps', {nvps})", build)


def request_failure(request: Sql) -> Sql:
    """Why a request has no collector payload."""
    stamp = failure("InvalidDataFormat", f"CAST({request}.timestamp AS STRING)", Known("Timestamp out of range"))
    return f"CASE WHEN {_stamp_fits(request)} THEN {url_codec_failure(f'{request}.querystring')} ELSE {stamp} END"


def url_codec_failure(querystring: Sql) -> Sql:
    return failure("UrlCodecFailure", querystring, Known("Malformed percent escape"))


def from_request(requests: DataFrame) -> DataFrame:
    """Add `payload` (typed collector payload) and `err` for a frame with `request`."""
    return requests.withColumn("payload", F.expr(collector_payload("request"))).withColumn(
        "err", F.expr(f"CASE WHEN payload IS NULL THEN {request_failure('request')} END")
    )
