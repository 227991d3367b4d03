"""Payloads as typed columns.

All payload shapes share one struct, `payload`. Its fields are typed; only the
wide `enriched` record stays a VARIANT. Reading is strict: a payload that does
not fit its shape is no payload. Editing one field copies nothing but that
field, and an edit whose result does not fit the field's type is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from .. import wire
from ..functions import variants as V
from ..functions.querystring import NVPS_TYPE, as_nvps
from ..functions.variants import Sql

COLLECTOR, ENRICHMENT, RAW, OTHER = "collector", "enrichment", "raw", "other"

_UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


@dataclass(frozen=True)
class Field:
    """A payload field: our name, its name in each shape, its type and whether it must be there."""

    name: str
    collector: str
    raw_event: str
    kind: str = "text"
    required: bool = False

    def named(self, shape: str) -> str:
        return self.collector if shape == COLLECTOR else self.raw_event


# --- fixed values: payload fields of the collector and the enrichment shape ------
FIELDS = (
    Field("vendor", "vendor", "vendor", required=True),
    Field("version", "version", "version", required=True),
    Field("pairs", "querystring", "parameters", "pairs", True),
    Field("contentType", "contentType", "contentType"),
    Field("body", "body", "body"),
    Field("collector", "collector", "loaderName", required=True),
    Field("encoding", "encoding", "encoding", required=True),
    Field("hostname", "hostname", "hostname"),
    Field("timestamp", "timestamp", "timestamp", "time"),
    Field("ipAddress", "ipAddress", "ipAddress"),
    Field("useragent", "useragent", "useragent"),
    Field("refererUri", "refererUri", "refererUri"),
    Field("headers", "headers", "headers", "texts", True),
    Field("user", "networkUserId", "userId", "uuid"),
)

_SQL_TYPE = {"pairs": NVPS_TYPE, "texts": "ARRAY<STRING>"}
EVENT_FIELDS = {f.name: _SQL_TYPE.get(f.kind, "STRING") for f in FIELDS} | {"enriched": "VARIANT", "event": "STRING"}
PAYLOAD_TYPE = "STRUCT<" + ", ".join(f"{n}: {t}" for n, t in EVENT_FIELDS.items()) + ">"


def field_of(shape: str, name: str) -> Field | None:
    """Field that a shape calls `name` (the body of an enrichment payload is not a field)."""
    for field in FIELDS:
        if field.named(shape) == name and not (shape != COLLECTOR and name == "body"):
            return field
    return None


def is_uuid(text: Sql) -> Sql:
    return f"({text} RLIKE {V.quote(_UUID)})"


def lower_hex(text: Sql) -> Sql:
    """Lower case, skipping the costly general function for what is lower already."""
    return f"CASE WHEN {text} RLIKE '[A-F]' THEN lower({text}) ELSE {text} END"


def typed(v: Sql, field: Field) -> Sql:
    """struct<v, fit>: the field as its column type and whether the document had that type."""

    def pairs(value: Sql) -> Sql:
        return f"named_struct('v', {value}, 'fit', {value} IS NOT NULL)"

    def texts(items: Sql) -> Sql:
        item = V.fresh()
        fit = f"coalesce(forall({items}, {item} -> {V.is_string(item)}), false)"
        return f"named_struct('v', {V.each(items, V.string)}, 'fit', {fit})"

    def text(value: Sql) -> Sql:
        if field.kind == "uuid":
            fit, shown = is_uuid(value), lower_hex(value)
        elif field.kind == "time":
            fit, shown = f"try_cast({value} AS TIMESTAMP) IS NOT NULL", value
        else:
            fit, shown = "true", value
        return f"named_struct('v', {shown}, 'fit', {fit})"

    if field.kind == "pairs":
        return V.let(as_nvps(v), pairs)
    if field.kind == "texts":
        return V.let(V.as_array(v), texts)
    absent = f"named_struct('v', CAST(NULL AS STRING), 'fit', {'false' if field.required else 'true'})"
    unfit = "named_struct('v', CAST(NULL AS STRING), 'fit', false)"
    return V.let(
        v,
        lambda x: (
            f"CASE WHEN {V.is_string(x)} THEN {V.let(V.string(x), text)}"
            f" WHEN {V.missing_or_null(x)} THEN {absent} ELSE {unfit} END"
        ),
    )


def payload_struct(**fields: Sql) -> Sql:
    """A payload; fields that are not given are NULL."""
    parts = [f"'{n}', CAST({fields.get(n, 'NULL')} AS {t})" for n, t in EVENT_FIELDS.items()]
    return f"named_struct({', '.join(parts)})"


def _is_text(v: Sql, field: Field) -> Sql:
    """Whether a document fits a field of text, as `typed` tells; what fits and is no string reads as NULL."""
    return V.is_string(v) if field.required else f"({V.is_string(v)} OR {V.missing_or_null(v)})"


def _fields(shape: str) -> list[Field]:
    return [f for f in FIELDS if field_of(shape, f.named(shape))]


def loose_type(shape: str) -> str:
    """Type that a document of a shape is taken apart as, each field unchecked."""
    return "STRUCT<" + ", ".join(f"{f.named(shape)}: VARIANT" for f in _fields(shape)) + ">"


def read_event(v: Sql, shape: str, enriched: Sql = "NULL") -> Sql:
    """Typed payload of a collector payload or raw event, NULL when it does not fit."""
    return read_parts(f"try_cast({v} AS {loose_type(shape)})", shape, enriched)


def read_parts(parts: Sql, shape: str, enriched: Sql = "NULL") -> Sql:
    """`read_event` of a document that has been taken apart, see `loose_type`."""
    fields = _fields(shape)

    # Plain text takes no binding of its own; the other fields are checked and read together.
    plain = [f for f in fields if f.kind == "text"]
    others = [f for f in fields if f.kind != "text"]

    def check(s: Sql, t: Sql) -> Sql:
        fit = " AND ".join([*(_is_text(f"{s}.{f.named(shape)}", f) for f in plain), *(f"{t}.{f.name}.fit" for f in others)])
        texts = {f.name: V.string(f"{s}.{f.named(shape)}") for f in plain}
        values = texts | {f.name: f"{t}.{f.name}.v" for f in others}
        return f"CASE WHEN {fit} THEN {payload_struct(**values, enriched=enriched)} END"

    def read(s: Sql) -> Sql:
        checked = ", ".join(f"'{f.name}', {typed(f'{s}.{f.named(shape)}', f)}" for f in others)
        return f"CASE WHEN {s} IS NOT NULL THEN {V.let(f'named_struct({checked})', lambda t: check(s, t))} END"

    return V.let(parts, read)


def read_record(v: Sql) -> Sql:
    """Opaque record: a string, or an object holding it as `event`."""
    return V.let(
        f"coalesce({V.get(v, 'event')}, {v})",
        lambda e: f"CASE WHEN {V.is_string(e)} THEN {payload_struct(event=V.string(e))} END",
    )


def _among(value: Sql, names: tuple[str, ...]) -> Sql:
    return f"{value} IN ({', '.join(V.quote(n) for n in names)})"


def shape_of(row_type: Sql) -> Sql:
    """Payload shape of a row type."""
    return (
        f"CASE WHEN {_among(row_type, wire.COLLECTOR_TYPES)} THEN '{COLLECTOR}'"
        f" WHEN {_among(row_type, wire.ENRICHMENT_TYPES)} THEN '{ENRICHMENT}'"
        f" WHEN {_among(row_type, (wire.FORMAT_VIOLATION, wire.SIZE_VIOLATION))} THEN '{RAW}' ELSE '{OTHER}' END"
    )


def known_shape(row_type: str, repaired: bool) -> str:
    """`shape_of` for a row type known when the plan is built; `repaired` is past the record repair."""
    if row_type in wire.ENRICHMENT_TYPES:
        return ENRICHMENT
    if row_type in wire.COLLECTOR_TYPES or (repaired and row_type == wire.FORMAT_VIOLATION):
        return COLLECTOR
    return RAW if row_type in (wire.FORMAT_VIOLATION, wire.SIZE_VIOLATION) else OTHER


# --- fields as documents --------------------------------------------------------


def text_document(text: Sql) -> Sql:
    """A text field as a document: null when there is none."""
    return f"coalesce({V.of(text)}, {V.literal(None)})"


def field_document(field: Field) -> Sql:
    value = f"payload.{field.name}"
    return f"to_variant_object({value})" if field.kind in _SQL_TYPE else text_document(value)


def event_document(shape: str) -> Sql:
    """The whole payload as a document (collector payload or raw event)."""
    fields = [f for f in FIELDS if field_of(shape, f.named(shape))]
    parts = ", ".join(f"'{f.named(shape)}', payload.{f.name}" for f in fields)
    return f"to_variant_object(named_struct({parts}))"


def payload_document(shape: str) -> Sql:
    if shape == ENRICHMENT:
        return f"to_variant_object(named_struct('enriched', payload.enriched, 'raw', {event_document(shape)}))"
    if shape == COLLECTOR:
        return event_document(shape)
    return "to_variant_object(named_struct('event', payload.event))"


def any_payload_document() -> Sql:
    """`payload_document` by the shape of the row."""
    return (
        f"CASE shape WHEN '{COLLECTOR}' THEN {payload_document(COLLECTOR)}"
        f" WHEN '{ENRICHMENT}' THEN {payload_document(ENRICHMENT)} WHEN '{RAW}' THEN {payload_document(RAW)} END"
    )
