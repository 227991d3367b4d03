"""What a step does to one value: replace, remove, cast, add.

Each function takes a VARIANT expression and gives an outcome struct<v, err>. Its
`_text` twin takes JSON text and gives an outcome over text, in which what is not
changed keeps the order of its keys and the digits of its numbers.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from .. import wire
from ..functions import json_text as J
from ..functions import variants as V
from ..functions.codecs import b64_decode
from ..functions.errors import Known, failure
from ..functions.variants import Sql

CAST_TYPES = ("String", "Numeric", "Boolean", "Array")


def json_value(value: Any) -> Any:
    """Configured value as plain JSON, refusing what JSON cannot hold."""
    return json.loads(json.dumps(value, allow_nan=False))


@dataclass(frozen=True)
class Param:
    """A configured scalar that differs from row to row: its kind (`kind_of`), and expressions of its JSON text and, for a
    string, of what it holds. Steps of many flows that differ in their values alone become one step with these."""

    kind: str
    text: Sql
    content: Sql = "NULL"


def kind_of(value: Any) -> str:
    """JSON type of a configured value: n null, b boolean, d number, s string, a array, o object."""
    if isinstance(value, Param):
        return value.kind
    if value is None:
        return "n"
    kinds = ((bool, "b"), ((int, float), "d"), (str, "s"), (list, "a"))
    return next((kind for types, kind in kinds if isinstance(value, types)), "o")


def _text(value: Any) -> Sql:
    return value.text if isinstance(value, Param) else Known(V.literal_text(value))


def _quoted_text(value: Any) -> Sql:
    return value.text if isinstance(value, Param) else V.quote(V.literal_text(value))


def _content(value: Any) -> Sql:
    return value.content if isinstance(value, Param) else V.quote(value)


def _literal(value: Any) -> Sql:
    if not isinstance(value, Param):
        return V.literal(value)
    return V.of(value.content) if value.kind == "s" else f"try_parse_json({value.text})"


# --- replace ------------------------------------------------------------------


def replacement_failure(data: Sql, value: Any, match: str | Param | None) -> Sql:
    shown = match.content if isinstance(match, Param) else Known("full field contents" if match is None else match)
    return failure("ReplacementFailure", shown, _text(value), data)


def replaced(current: Sql, value: Any, match: str | Param | None = None) -> Sql:
    """New value for `current`, by its JSON type.

    Text (and null, taken as empty text): a string value is put in for every
    match, or for everything without `match`; any other value puts its JSON text.
    Number, boolean: only a value of the same type. Array: an array replaces it,
    or, with `match`, is appended to the elements that do not match. Object and
    array otherwise: the rule for text on their JSON text, read back.
    """

    def by_type(kind: Sql) -> Sql:
        content = f"CASE WHEN {kind} = 's' THEN {V.string(current)} ELSE '' END"
        cases = [
            f"WHEN {kind} IN ('s', 'n') THEN {_in_string(content, value, match)}",
            f"WHEN {kind} = 'a' THEN {_in_array(current, value, match)}",
            f"WHEN {kind} = 'o' THEN {_in_text(current, 'o', value, match)}",
        ]
        if kind_of(value) in ("b", "d"):
            cases.append(f"WHEN {kind} = '{kind_of(value)}' THEN {V.ok(_literal(value))}")
        return f"CASE {' '.join(cases)} ELSE {V.fail(replacement_failure(V.text(current), value, match))} END"

    return V.let(V.kind(current), by_type)


def _substituted(content: Sql, value: Any, match: str | Param | None) -> Sql:
    if kind_of(value) != "s":
        return _quoted_text(value)
    return _content(value) if match is None else f"regexp_replace({content}, {_content(match)}, {_content(value)})"


def _in_string(content: Sql, value: Any, match: str | Param | None) -> Sql:
    """Content that spells the name of a base64 field is taken as base64 and then is no JSON."""
    names = ", ".join(V.quote(n) for n in wire.BASE64_FIELDS)
    longest = max(len(n) for n in wire.BASE64_FIELDS)

    def change(c: Sql) -> Sql:
        return (
            f"CASE WHEN octet_length({c}) > {longest} OR lower({c}) NOT IN ({names}) THEN {V.ok(V.of(_substituted(c, value, match)))}"
            f" WHEN {b64_decode(c)} IS NULL THEN"
            f" {V.fail(failure('Base64Failure', c, Known('Data is not properly base64-encoded')))}"
            f" ELSE {V.fail(failure('InvalidJsonFormat', c))} END"
        )

    return V.let(content, change)


def _in_text(current: Sql, kind: str, value: Any, match: str | Param | None) -> Sql:
    """Rewrite the JSON text of an array or object and read it back as the same type."""

    def read_back(new_text: Sql) -> Sql:
        other = V.fail(replacement_failure(V.text(current), value, match))
        return V.let(
            V.parse(new_text),
            lambda v: (
                f"CASE WHEN {v} IS NULL THEN {V.fail(failure('InvalidJsonFormat', new_text))}"
                f" WHEN {V.kind(v)} = '{kind}' THEN {V.ok(v)} ELSE {other} END"
            ),
        )

    return V.let(_substituted(V.text(current), value, match), read_back)


def _in_array(current: Sql, value: Any, match: str | Param | None) -> Sql:
    if isinstance(value, list):
        if match is None:
            return V.ok(V.literal(value))
        kept = V.where(V.as_array(current), lambda e: f"NOT ({V.text(e)} RLIKE {_content(match)})")
        return V.ok(f"to_variant_object(concat({kept}, {V.as_array(V.literal(value))}))")
    if match is None:
        return V.ok(f"to_variant_object(array({_literal(value)}))")
    return _in_text(current, "a", value, match)


def replaced_text(current: Sql, value: Any, match: str | Param | None = None) -> Sql:
    """`replaced` on JSON text."""
    other = J.fail(replacement_failure(current, value, match))

    def by_type(first: Sql) -> Sql:
        content = f"coalesce({J.string(current)}, '')"
        cases = [
            f"WHEN {first} IN ('\"', 'n') THEN {J.printed(_in_string(content, value, match))}",
            f"WHEN {first} = '[' THEN {_in_array_text(current, value, match, other)}",
            f"WHEN {first} = '{{' THEN {_in_json_text(current, '{', value, match, other)}",
        ]
        if kind_of(value) in ("b", "d"):
            cases.append(f"WHEN {first} {'IN' if kind_of(value) == 'b' else 'NOT IN'} ('t', 'f') THEN {V.ok(_quoted_text(value))}")
        return f"CASE {' '.join(cases)} ELSE {other} END"

    return V.let(J.starts(current), by_type)


def _in_json_text(current: Sql, first: str, value: Any, match: str | Param | None, other: Sql) -> Sql:
    """Rewrite the text of an array or object; it must still be one."""

    def read_back(new_text: Sql) -> Sql:
        bad = J.fail(failure("InvalidJsonFormat", new_text))
        kept = V.let(J.compact(new_text), lambda t: f"CASE WHEN startswith({t}, '{first}') THEN {V.ok(t)} ELSE {other} END")
        return f"CASE WHEN {V.parse(new_text)} IS NULL THEN {bad} ELSE {kept} END"

    return V.let(_substituted(current, value, match), read_back)


def _in_array_text(current: Sql, value: Any, match: str | Param | None, other: Sql) -> Sql:
    if isinstance(value, list):
        if match is None:
            return V.ok(V.quote(V.literal_text(value)))
        kept = V.where(J.members(current), lambda e: f"NOT ({e} RLIKE {_content(match)})")
        return V.ok(J.array_of(f"concat({kept}, {_texts(value)})"))
    if match is None:
        return V.ok(J.array_of(f"array({_quoted_text(value)})"))
    return _in_json_text(current, "[", value, match, other)


def _texts(values: list[Any]) -> Sql:
    return f"CAST(array({', '.join(V.quote(V.literal_text(x)) for x in values)}) AS ARRAY<STRING>)"


# --- cast ---------------------------------------------------------------------


def cast_failure(data: Sql, from_type: str, to_type: str) -> Sql:
    return failure("CastFailure", data, Known(from_type), Known(to_type))


def casted(current: Sql, from_type: str, to_type: str, zero_is_false: bool = False) -> Sql:
    """Value cast to another JSON type.

    Anything but an array can be wrapped in one and everything has a text,
    whatever `from_type` says. Otherwise `from_type` must be the type at hand:
    numbers become true (with `zero_is_false`, 0 becomes false), booleans 1 or 0,
    text the number it spells.
    """

    def refused() -> Sql:
        return V.fail(cast_failure(V.text(current), from_type, to_type))

    def only(test: Sql, outcome: Sql) -> Sql:
        return f"CASE WHEN {V.kind(current)} {test} THEN {outcome} ELSE {refused()} END"

    def number(n: Sql) -> Sql:
        # A double that JSON cannot hold is written as null.
        return (
            f"CASE WHEN {n} IS NULL THEN {refused()}"
            f" WHEN isnan({n}) OR abs({n}) = double('Infinity') THEN {V.ok(V.literal(None))}"
            f" ELSE {V.ok(V.of(n))} END"
        )

    if to_type == "Array":
        return only("<> 'a'", V.ok(f"to_variant_object(array({current}))"))
    if to_type == "String":
        return V.ok(V.of(V.text(current)))
    if (from_type, to_type) == ("Numeric", "Boolean"):
        return only("= 'd'", V.ok(V.of(f"(CAST({current} AS DOUBLE) <> 0)" if zero_is_false else "true")))
    if (from_type, to_type) == ("Boolean", "Numeric"):
        return only("= 'b'", V.ok(V.of(f"CASE WHEN CAST({current} AS BOOLEAN) THEN 1 ELSE 0 END")))
    if (from_type, to_type) == ("String", "Numeric"):
        return only("= 's'", V.let(f"try_cast({V.string(current)} AS DOUBLE)", number))
    return refused()


def casted_text(current: Sql, from_type: str, to_type: str, zero_is_false: bool = False) -> Sql:
    """`casted` on JSON text."""
    if to_type == "Array":
        refused = J.fail(cast_failure(current, from_type, to_type))
        return f"CASE WHEN startswith({current}, '[') THEN {refused} ELSE {V.ok(J.array_of(f'array({current})'))} END"
    if to_type == "String":
        return V.ok(J.quoted(current))
    return V.let(f"try_parse_json({current})", lambda v: J.printed(casted(v, from_type, to_type, zero_is_false)))


# --- add ----------------------------------------------------------------------


def addition_failure(path: str, value: Any) -> Sql:
    return failure("AdditionFailure", _text(value), Known(path), Known("the payload"))


def added(current: Sql, value: Any) -> Sql:
    """Value merged into `current`: AND, sum, append, concatenate or merge keys; null is replaced.

    A value of another type adds nothing (for booleans it counts as false).
    """
    kind_given = kind_of(value)
    truth = f"({_quoted_text(value)} = 'true')" if kind_given == "b" else "false"
    number = f"CAST({_quoted_text(value)} AS DOUBLE)" if kind_given == "d" else "0.0D"
    suffix = _content(value) if kind_given == "s" else "''"
    new_items = V.as_array(V.literal(value if isinstance(value, list) else []))
    new_fields = value if isinstance(value, dict) else {}

    def merged() -> Sql:
        if not new_fields:
            return current
        key, old = V.fresh("k"), V.fresh()
        names = ", ".join(V.quote(n) for n in new_fields)
        kept = f"map_filter({V.as_map(current)}, ({key}, {old}) -> {key} NOT IN ({names}))"
        return f"to_variant_object(map_concat({kept}, {V.as_map(V.literal(new_fields))}))"

    def by_type(kind: Sql) -> Sql:
        return V.ok(
            f"CASE {kind} WHEN 'n' THEN {_literal(value)}"
            f" WHEN 'b' THEN {V.of(f'(CAST({current} AS BOOLEAN) AND {truth})')}"
            f" WHEN 'd' THEN {V.of(f'(CAST({current} AS DOUBLE) + {number})')}"
            f" WHEN 's' THEN {V.of(f'concat({V.string(current)}, {suffix})')}"
            f" WHEN 'a' THEN to_variant_object(concat({V.as_array(current)}, {new_items}))"
            f" ELSE {merged()} END"
        )

    return V.let(V.kind(current), by_type)


def added_text(current: Sql, value: Any) -> Sql:
    """`added` on JSON text; of an object's keys those that are there keep their places."""
    items = _texts(value if isinstance(value, list) else [])
    new_fields = value if isinstance(value, dict) else {}

    def merged(fields: Sql) -> Sql:
        named = {k: V.quote(f"{V.literal_text(k)}:{V.literal_text(x)}") for k, x in new_fields.items()}
        cases = " ".join(f"WHEN {V.quote(k)} THEN {x}" for k, x in named.items())
        kept = V.each(fields, lambda m: f"CASE {J.key_of(m)} {cases} ELSE {m} END")
        absent = [f"CASE WHEN NOT {V.any_of(fields, lambda m, k=k: f'{J.key_of(m)} <=> {V.quote(k)}')} THEN {x} END" for k, x in named.items()]
        return J.object_of(f"concat({kept}, array_compact(array({', '.join(absent)})))")

    def by_type(first: Sql) -> Sql:
        scalar = V.let(f"try_parse_json({current})", lambda v: J.printed(added(v, value)))
        return (
            f"CASE {first} WHEN '[' THEN {V.ok(J.array_of(f'concat({J.members(current)}, {items})'))}"
            f" WHEN '{{' THEN {V.ok(V.let(J.members(current), merged) if new_fields else current)}"
            f" WHEN 'n' THEN {V.ok(_quoted_text(value))} ELSE {scalar} END"
        )

    return V.let(J.starts(current), by_type)
