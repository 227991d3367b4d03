"""Expressions over VARIANT.

The engine keeps every dynamic document as one VARIANT column and edits it with
built-in functions only. SQL NULL always means "not there"; a JSON null is a
VARIANT null and is *not* SQL NULL. All the places where VARIANT differs from
plain JSON text are handled in this module.

Functions here and in the modules next to it take and give Spark SQL expression
text. Rewrites nest deeply, and one `F.expr` per column builds such a plan in
milliseconds where thousands of single `Column` calls take seconds.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

Sql = str

ERROR_TYPE = "STRUCT<code: STRING, message: STRING>"
NO_ERROR = f"CAST(NULL AS {ERROR_TYPE})"

# Numbers that a VARIANT does not hold as written: more than 38 digits, many digits with an exponent, or out of range.
_HARD_NUMBER = r"[0-9.]{39,}|[0-9.]{18,}[eE]|[eE][+-]?0*(3[0-9]{2}|[4-9][0-9]{2}|[1-9][0-9]{3,})"

# Every hard number has this in it. One class to test at each character, so that text without is passed over quickly.
_MAYBE_HARD = r"[0-9](?:[0-9.]{17}|[eE][+-]?[0-9]{3})"

# Marks the end of a wrapped document, see `parse`.
_END = "\u0002end-of-document"

_names = itertools.count()


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the results depend on: UTC timestamps, last duplicate key wins."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


_ESCAPES = {"\\": "\\\\", "'": "\\'", "$": "\\u0024", "\n": "\\n", "\r": "\\r", "\t": "\\t"}


def quote(text: str) -> Sql:
    """String constant; `$` is escaped because the parser substitutes variables."""
    return "'" + "".join(_ESCAPES.get(c, c if c >= " " else f"\\u{ord(c):04x}") for c in text) + "'"


def fresh(prefix: str = "x") -> str:
    """A lambda variable name that is used nowhere else."""
    return f"{prefix}_{next(_names)}"


def let(value: Sql, body: Callable[[Sql], Sql]) -> Sql:
    """Evaluate `value` once and use it any number of times in `body`.

    Without it a nested rewrite would repeat its input at every level and the
    expression would grow exponentially with the depth of the path. (The last
    function of a fold over nothing: a `transform` of one element would copy what
    comes out of it, once more at every level.)
    """
    name, old, item = fresh(), fresh("a"), fresh()
    return f"aggregate(array(), {value}, ({old}, {item}) -> {old}, {name} -> {body(name)})"


def first(items: Sql) -> Sql:
    """First element, NULL when there is none."""
    return f"try_element_at({items}, 1)"


def opaque(value: Sql) -> Sql:
    """The same value, as one the optimizer does not move.

    A filter on an outcome would otherwise be pushed through every stage below
    it and take a copy of all their expressions along, many times over.
    """
    return f"CASE WHEN spark_partition_id() >= 0 THEN {value} END"


def each(items: Sql, body: Callable[[Sql], Sql]) -> Sql:
    name = fresh()
    return f"transform({items}, {name} -> {body(name)})"


def where(items: Sql, test: Callable[[Sql], Sql]) -> Sql:
    name = fresh()
    return f"filter({items}, {name} -> {test(name)})"


def any_of(items: Sql, test: Callable[[Sql], Sql]) -> Sql:
    name = fresh()
    return f"exists({items}, {name} -> {test(name)})"


def wrapped(text: Sql) -> Sql:
    """Lenient parse of JSON text as the first element of an array.

    `try_parse_json` ignores anything after the first value, so the text is
    wrapped with an end marker that must come out as the second element, see
    `is_whole`. A document is best left in its wrapping: taking a VARIANT out of
    another one copies it.
    """
    return f"try_parse_json(concat('[', {text}, {quote(',' + json.dumps(_END) + ']')}))"


def keeps_numbers(text: Sql) -> Sql:
    """Whether every number in JSON text comes out of a VARIANT with its value.

    The text is searched as a whole first, for less than a hard number. Only
    where that is found are strings taken out, escapes before them, and is the
    rest searched for one.
    """
    hard = quote(_HARD_NUMBER)
    bare = f"regexp_replace(regexp_replace({text}, {quote(chr(92) * 2 + '.')}, ''), {quote(chr(34) + '[^' + chr(34) + ']*' + chr(34))}, '')"
    return f"NOT ({text} RLIKE {quote(_MAYBE_HARD)} AND {bare} RLIKE {hard})"


def is_whole(w: Sql, text: Sql) -> Sql:
    """Whether wrapped text was exactly one JSON value, with no number that would be altered."""
    # Only text with this escape in it can hold an end marker of its own, after which another element may come.
    marked = f"contains({text}, {quote(json.dumps(_END[0])[1:-1])})"
    alone = f"(NOT {marked} OR variant_get({w}, '\\u0024[2]', 'variant') IS NULL)"
    return f"(variant_get({w}, '\\u0024[1]', 'string') <=> {quote(_END)} AND {alone} AND {keeps_numbers(text)})"


def parse(text: Sql) -> Sql:
    """JSON text to VARIANT; SQL NULL when the text is not exactly one JSON value or holds a number that would be altered."""
    return let(text, lambda t: let(wrapped(t), lambda w: f"CASE WHEN {is_whole(w, t)} THEN {get(w, 0)} END"))


def is_json(text: Sql) -> Sql:
    """Whether `parse` gives a value; takes none out of the wrapped document, which would copy it."""
    return let(text, lambda t: let(wrapped(t), lambda w: is_whole(w, t)))


def literal_text(value: Any) -> str:
    """Compact JSON text of a configured value."""
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def literal(value: Any) -> Sql:
    """A JSON value as a VARIANT constant.

    Built from casts, which the optimizer folds; `parse_json` of a constant
    would be parsed again for every row.
    """
    if value is None:
        return "variant_get(to_variant_object(named_struct('n', CAST(NULL AS STRING))), '\\u0024.n', 'variant')"
    if isinstance(value, bool):
        return f"CAST({str(value).lower()} AS VARIANT)"
    if isinstance(value, int):
        return f"CAST({value if abs(value) < 2**31 else f'{value}L' if abs(value) < 2**63 else f'{value}BD'} AS VARIANT)"
    if isinstance(value, float):
        shown = repr(value)
        return f"CAST({shown + ('D' if 'e' in shown else 'BD')} AS VARIANT)"
    if isinstance(value, str):
        return f"CAST({quote(value)} AS VARIANT)"
    if isinstance(value, list):
        items = f"array({', '.join(literal(x) for x in value)})" if value else "CAST(array() AS ARRAY<VARIANT>)"
        return f"to_variant_object({items})"
    fields = ", ".join(f"{quote(k)}, {literal(x)}" for k, x in value.items())
    return f"to_variant_object({f'map({fields})' if value else 'CAST(map() AS MAP<STRING, VARIANT>)'})"


def text(v: Sql) -> Sql:
    """Compact JSON text of a VARIANT (strings keep their quotes)."""
    return f"to_json({v})"


def of(value: Sql) -> Sql:
    """A scalar as VARIANT."""
    return f"CAST({value} AS VARIANT)"


def string(v: Sql) -> Sql:
    """Content of a VARIANT string."""
    return f"CAST({v} AS STRING)"


def is_string(v: Sql) -> Sql:
    return f"(schema_of_variant({v}) <=> 'STRING')"


def prints_as_written(v: Sql) -> Sql:
    """Whether a VARIANT's text is the one it was read from: anything but arrays, objects and numbers with more than digits."""
    return f"(schema_of_variant({v}) IN ('STRING', 'BOOLEAN', 'VOID', 'BIGINT'))"


def missing_or_null(v: Sql) -> Sql:
    return f"({v} IS NULL OR is_variant_null({v}))"


def kind(v: Sql) -> Sql:
    """One-letter JSON type: n null, b boolean, d number, s string, a array, o object."""
    return let(
        f"schema_of_variant({v})",
        lambda t: (
            f"CASE WHEN {t} = 'STRING' THEN 's' WHEN startswith({t}, 'OBJECT') THEN 'o'"
            f" WHEN startswith({t}, 'ARRAY') THEN 'a' WHEN {t} = 'BOOLEAN' THEN 'b' WHEN {t} = 'VOID' THEN 'n'"
            f" WHEN {t} IS NOT NULL THEN 'd' END"
        ),
    )


def as_array(v: Sql) -> Sql:
    """ARRAY<VARIANT>, NULL for anything but a JSON array."""
    return f"try_cast({v} AS ARRAY<VARIANT>)"


def as_map(v: Sql) -> Sql:
    """MAP<STRING, VARIANT>, NULL for anything but a JSON object."""
    return f"try_cast({v} AS MAP<STRING, VARIANT>)"


def is_object(v: Sql) -> Sql:
    """Whether a VARIANT is an object; asks for one field only, so nothing is copied."""
    return f"(try_cast({v} AS STRUCT<x: VARIANT>) IS NOT NULL)"


def items_or_none(v: Sql) -> Sql:
    """Elements of an array; an empty array for anything else."""
    return f"coalesce({as_array(v)}, CAST(array() AS ARRAY<VARIANT>))"


def _path(steps: tuple[str | int, ...]) -> Sql:
    """Plain steps as a path; every key is quoted so any name is safe."""
    return quote("$" + "".join(f"[{s}]" if isinstance(s, int) else f'["{s}"]' for s in steps))


def get(v: Sql, *steps: str | int) -> Sql:
    """Value at plain steps as VARIANT."""
    return f"variant_get({v}, {_path(steps)}, 'variant')" if steps else v


def get_as(v: Sql, sql_type: str, *steps: str | int) -> Sql:
    """`try_cast` of the value at plain steps, without a VARIANT of its own on the way."""
    return f"try_variant_get({v}, {_path(steps)}, {quote(sql_type)})"


def get_string(v: Sql, *steps: str | int) -> Sql:
    """The string at plain steps; NULL when missing or of another type."""
    return let(get(v, *steps), lambda x: f"CASE WHEN {is_string(x)} THEN {string(x)} END")


def put(v: Sql, steps: tuple[str | int, ...], new: Sql) -> Sql:
    """Document with the value at plain steps exchanged; the steps must lead somewhere."""
    if not steps:
        return new
    old = fresh()
    if isinstance(steps[0], int):
        at = fresh("i")
        inner = put(old, steps[1:], new)
        rebuilt = f"transform({as_array(v)}, ({old}, {at}) -> CASE WHEN {at} = {steps[0]} THEN {inner} ELSE {old} END)"
    else:
        key = fresh("k")
        inner = put(old, steps[1:], new)
        rebuilt = (
            f"transform_values({as_map(v)}, ({key}, {old}) ->"
            f" CASE WHEN {key} = {quote(steps[0])} THEN {inner} ELSE {old} END)"
        )
    return f"to_variant_object({rebuilt})"


# --- outcomes: struct<v VARIANT, err STRUCT<code, message>> ---------------------


def ok(v: Sql) -> Sql:
    return f"named_struct('v', {v}, 'err', {NO_ERROR})"


def error(code: str, message: Sql) -> Sql:
    return f"named_struct('code', {quote(code)}, 'message', {message})"


def fail(err: Sql) -> Sql:
    return f"named_struct('v', CAST(NULL AS VARIANT), 'err', {err})"


def then(outcome: Sql, on_value: Callable[[Sql], Sql]) -> Sql:
    """Feed the value of an outcome to the next stage, or keep its error."""
    return let(outcome, lambda r: f"CASE WHEN {r}.err IS NOT NULL THEN {r} ELSE {on_value(f'{r}.v')} END")
