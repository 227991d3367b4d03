"""Paths into the typed payload.

The first segments of a path name a field of the payload struct. They are
resolved when the plan is built, so a read or an edit touches that one field
only; what lies below (documents inside pair values, the enriched record) is
left to the general path expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from ..functions import json_text as J
from ..functions import variants as V
from ..functions.errors import Known, failure
from ..functions.variants import Sql
from . import paths
from .paths import AtField, AtItem, AtMatches, AtPair, Leaf, Node
from .payloads import (
    COLLECTOR,
    ENRICHMENT,
    PAYLOAD_TYPE,
    Field,
    field_document,
    field_of,
    payload_document,
    read_event,
    text_document,
    typed,
)

ENRICHED = "enriched"
WHOLE = "*"


@dataclass(frozen=True)
class Place:
    """Where a path starts inside the payload struct: a field and what is left of the path."""

    slot: str
    node: Node | None
    field: Field | None = None


def locate(path: str, shape: str, previous: tuple[paths.Segment, ...] = ()) -> Place | None:
    """Field a path leads into; None when the shape has no such field."""
    return locate_node(paths.resolve(paths.tokenize(path), previous), shape)


def locate_node(node: Node | None, shape: str) -> Place | None:
    if shape not in (COLLECTOR, ENRICHMENT):
        return Place(WHOLE, node)
    if shape == ENRICHMENT and isinstance(node, AtField):
        if node.name == ENRICHED:
            return Place(ENRICHED, node.child)
        if node.name != "raw":
            return None
        if node.child is None:
            return Place(WHOLE, node)
        inner = node.child
    else:
        inner = node
    if inner is None or isinstance(inner, (AtItem, AtMatches)) or (shape == ENRICHMENT and inner is node):
        return Place(WHOLE, node)
    field = field_of(shape, inner.list_name if isinstance(inner, AtPair) else inner.name)
    if field is None or (field.kind != "pairs" and isinstance(inner, AtPair)):
        return None
    return Place(field.name, inner if isinstance(inner, AtPair) else inner.child, field)


# --- reading --------------------------------------------------------------------


def read(path_node: Node | None, shape: str) -> Sql:
    """Value at a path of the payload as VARIANT, SQL NULL when it is not there."""
    place = locate_node(path_node, shape)
    if place is None:
        return "CAST(NULL AS VARIANT)"
    if place.slot == WHOLE:
        return V.let(payload_document(shape), lambda d: paths.read(d, place.node))
    if place.slot == ENRICHED:
        return paths.read("payload.enriched", place.node)
    if place.field.kind == "pairs" and place.node is not None:
        return _read_pairs(place.node)
    document = field_document(place.field)
    return document if place.node is None else V.let(document, lambda d: paths.read(d, place.node))


def _read_pairs(node: Node) -> Sql:
    if isinstance(node, AtPair):
        named = V.where("payload.pairs", lambda p: f"{p}.name = {V.quote(node.name)}")
        if node.codec:
            return _read_text(f"{V.first(named)}.value", node.codec, node.child)
        documents = V.each(named, lambda p: text_document(f"{p}.value"))
        return paths.read_below(V.first(documents), node.child)
    if isinstance(node, AtItem):
        return V.let(
            f"try_element_at({V.each('payload.pairs', _pair_document)}, {node.index + 1})", lambda d: paths.read(d, node.child)
        )
    if not isinstance(node, AtMatches):
        return "CAST(NULL AS VARIANT)"

    def last(hits: Sql) -> Sql:
        values = V.each(hits, lambda p: _read_in_pair(p, node.child))
        return V.let(values, paths.last_of_all)

    return V.let(V.where("payload.pairs", lambda p: _pair_hit(p, node.where)), last)


def read_printed(path_node: Node | None, shape: str) -> Sql:
    """JSON text of the value at a path; inside an encoded pair value it is the text as it stands."""
    place = locate_node(path_node, shape)
    if place is not None and place.slot == ENRICHED:
        return paths.read_printed("payload.enriched", place.node)
    node = place.node if place is not None and place.field is not None and place.field.kind == "pairs" else None
    if isinstance(node, AtPair) and node.codec:
        named = V.where("payload.pairs", lambda p: f"{p}.name = {V.quote(node.name)}")
        return V.let(f"{V.first(named)}.value", lambda c: paths.encoded_as_text(c, node.codec, node.child))
    child = node.child if isinstance(node, AtMatches) else None
    if isinstance(child, AtField) and child.name == "value" and child.codec:
        hits = V.where("payload.pairs", lambda p: _pair_hit(p, node.where))
        values = V.each(hits, lambda p: V.let(f"{p}.value", lambda c: paths.encoded_as_text(c, child.codec, child.child)))
        return V.let(values, paths.last_of_all)
    return V.text(read(path_node, shape))


def _read_text(text: Sql, codec: str, child: Node | None) -> Sql:
    """Document inside an encoded text."""
    plain = paths.b64_decode(text) if codec == "base64" else text
    return paths.read_below(V.parse(plain), child)


def _read_in_pair(pair: Sql, child: Node | None) -> Sql:
    if isinstance(child, AtField) and child.name == "value":
        if child.codec:
            return _read_text(f"{pair}.value", child.codec, child.child)
        return paths.read_below(text_document(f"{pair}.value"), child.child)
    return V.let(_pair_document(pair), lambda d: paths.read(d, child))


def _pair_document(pair: Sql) -> Sql:
    return f"to_variant_object({pair})"


def _pair_hit(pair: Sql, where: paths.Where) -> Sql:
    if where.field in (("name",), ("value",)):
        seen = V.text(V.of(f"{pair}.{where.field[0]}"))
        return f"(coalesce({seen}, 'null') RLIKE {V.quote(where.regex)})"
    return paths.hit(_pair_document(pair), where)


# --- editing --------------------------------------------------------------------


def unreadable(what: str, document: Sql) -> Sql:
    return V.fail(failure("InvalidJsonFormat", f"concat({V.quote(what + ': ')}, {V.text(document)})"))


def _fail_as(err: Sql, kind: str) -> Sql:
    return f"named_struct('v', CAST(NULL AS {kind}), 'err', {err})"


def _checked(outcome: Sql, sql_type: str, read_back: Callable[[Sql], Sql], what: str) -> Sql:
    """Outcome over documents to an outcome over a column type; `read_back` gives struct<v, fit>."""

    def check(r: Sql) -> Sql:
        bad = failure("InvalidJsonFormat", f"concat({V.quote(what + ': ')}, {V.text(f'{r}.v')})")
        back = V.let(
            read_back(f"{r}.v"),
            lambda t: (
                f"CASE WHEN {t}.fit THEN named_struct('v', {t}.v, 'err', {V.NO_ERROR})"
                f" ELSE {_fail_as(bad, sql_type)} END"
            ),
        )
        return f"CASE WHEN {r}.err IS NOT NULL THEN {_fail_as(f'{r}.err', sql_type)} ELSE {back} END"

    return V.let(outcome, check)


_PAIR_VALUE = Field("value", "value", "value")
_PAIR_TYPE = "STRUCT<name: STRING, value: STRING>"


def edit(place: Place, shape: str, leaf: Leaf, missing: Sql) -> Sql:
    """New value of the field, as struct<v of the field's type, err>."""
    if place.slot == WHOLE:
        return _edit_whole(place.node, shape, leaf, missing)
    if place.slot == ENRICHED:
        changed = V.let("payload.enriched", lambda d: paths.edit(d, place.node, leaf, missing))
        return V.then(
            changed, lambda v: f"CASE WHEN {V.is_object(v)} THEN {V.ok(v)} ELSE {unreadable(ENRICHED, v)} END"
        )
    field = place.field
    if field.kind == "pairs" and isinstance(place.node, (AtPair, AtItem, AtMatches)):
        return _edit_pairs(place.node, field.named(shape), leaf, missing)
    changed = V.let(field_document(field), lambda d: paths.edit(d, place.node, leaf, missing))
    sql_type = {"pairs": "ARRAY<" + _PAIR_TYPE + ">", "texts": "ARRAY<STRING>"}.get(field.kind, "STRING")
    return _checked(changed, sql_type, lambda v: typed(v, field), field.named(shape))


def _edit_whole(node: Node | None, shape: str, leaf: Leaf, missing: Sql) -> Sql:
    """Edit of all of the payload (or of the raw event in it); gives a new payload struct."""
    def read_back(v: Sql) -> Sql:
        if shape == COLLECTOR:
            event = read_event(v, COLLECTOR)
        else:
            enriched = V.get(v, ENRICHED)
            event = f"CASE WHEN {V.is_object(enriched)} THEN {read_event(V.get(v, 'raw'), shape, enriched)} END"
        return V.let(event, lambda e: f"named_struct('v', {e}, 'fit', {e} IS NOT NULL)")

    changed = V.let(payload_document(shape), lambda d: paths.edit(d, node, leaf, missing))
    return _checked(changed, PAYLOAD_TYPE, read_back, "payload")


def _edit_pairs(node: Node, list_name: str, leaf: Leaf, missing: Sql) -> Sql:
    """Edit pairs found by name, place or filter; the others are kept as they are."""
    list_type = f"ARRAY<{_PAIR_TYPE}>"

    def in_value(pair: Sql, change: Leaf) -> Sql:
        changed = V.let(text_document(f"{pair}.value"), change)
        new_value = _checked(changed, "STRING", lambda v: typed(v, _PAIR_VALUE), list_name)
        return V.let(
            new_value,
            lambda r: (
                f"CASE WHEN {r}.err IS NOT NULL THEN {_fail_as(f'{r}.err', _PAIR_TYPE)} ELSE"
                f" named_struct('v', named_struct('name', {pair}.name, 'value', {r}.v), 'err', {V.NO_ERROR}) END"
            ),
        )

    def in_encoded(pair: Sql, codec: str, child: Node | None) -> Sql:
        no_text = J.fail(failure("InvalidJsonFormat", V.quote("null")))
        inside = V.let(f"{pair}.value", lambda c: f"CASE WHEN {c} IS NULL THEN {no_text} ELSE {paths.encoded_text(c, codec, child, leaf, missing)} END")
        return V.let(
            inside,
            lambda r: (
                f"CASE WHEN {r}.err IS NOT NULL THEN {_fail_as(f'{r}.err', _PAIR_TYPE)} ELSE"
                f" named_struct('v', named_struct('name', {pair}.name, 'value', {r}.v), 'err', {V.NO_ERROR}) END"
            ),
        )

    def in_pair(pair: Sql, child: Node | None) -> Sql:
        if isinstance(child, AtField) and child.name == "value":
            if child.codec:
                return in_encoded(pair, child.codec, child.child)
            return in_value(pair, paths.below(child.child, leaf, missing))
        whole = V.let(_pair_document(pair), lambda d: paths.edit(d, child, leaf, missing))

        def read_back(v: Sql) -> Sql:
            parts = (
                f"named_struct('n', {typed(V.get(v, 'name'), Field('name', 'name', 'name', required=True))},"
                f" 'x', {typed(V.get(v, 'value'), _PAIR_VALUE)})"
            )
            return V.let(
                parts,
                lambda t: f"named_struct('v', named_struct('name', {t}.n.v, 'value', {t}.x.v), 'fit', {t}.n.fit AND {t}.x.fit)",
            )

        return _checked(whole, _PAIR_TYPE, read_back, list_name)

    absent = missing
    pair, i, position = V.fresh(), V.fresh("i"), V.fresh()
    if isinstance(node, AtPair):
        wanted = f"{i} = {position} - 1"
        if node.codec:
            outcome = in_encoded(pair, node.codec, node.child)
        else:
            outcome = in_value(pair, paths.below(node.child, leaf, missing))
        if node.last:
            absent = failure(
                "InvalidDataFormat", V.text("to_variant_object(payload.pairs)"), Known(f"Cannot access field {list_name}")
            )
    elif isinstance(node, AtItem):
        wanted, outcome = f"{i} = {node.index}", in_pair(pair, node.child)
    else:
        wanted, outcome = _pair_hit(pair, node.where), in_pair(pair, node.child)
    results = f"transform(payload.pairs, ({pair}, {i}) -> CASE WHEN {wanted} THEN {outcome} END)"
    if isinstance(node, AtPair):
        named = V.each("payload.pairs", lambda p: f"{p}.name")
        found_at = f"array_position({named}, {V.quote(node.name)})"
        results = f"element_at(transform(array({found_at}), {position} -> {results}), 1)"

    def collect(found: Sql) -> Sql:
        old, at = V.fresh(), V.fresh("i")
        rebuilt = f"transform(payload.pairs, ({old}, {at}) -> coalesce({found}[{at}].v, {old}))"
        failed = V.first(V.where(found, lambda r: f"{r}.err IS NOT NULL")) + ".err"
        return (
            f"CASE WHEN NOT {V.any_of(found, lambda r: f'{r} IS NOT NULL')} THEN {_fail_as(absent, list_type)}"
            f" WHEN {V.any_of(found, lambda r: f'{r}.err IS NOT NULL')} THEN {_fail_as(failed, list_type)}"
            f" ELSE named_struct('v', {rebuilt}, 'err', {V.NO_ERROR}) END"
        )

    return V.let(results, collect)
