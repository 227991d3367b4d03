"""Querystrings and name-value pair lists."""

from __future__ import annotations

import re

from .. import wire
from . import variants as V
from .variants import Sql

NVPS_TYPE = "ARRAY<STRUCT<name: STRING, value: STRING>>"

_KEPT = "[A-Za-z0-9" + re.escape(wire.QUERY_UNRESERVED_MARKS + wire.QUERY_RESERVED) + "]"
# An escape, a run of characters that may stay, or one character to encode.
_UNIT = "(?s)(%[0-9A-Fa-f]{2}|" + _KEPT + "+|.)"
_STAYS = "^(%[0-9A-Fa-f]{2}|" + _KEPT + "+)$"
_ALL_STAY = "^(?:%[0-9A-Fa-f]{2}|" + _KEPT + "++)*+" + r"\z"


def _pair(name: Sql, value: Sql) -> Sql:
    return f"named_struct('name', {name}, 'value', {value})"


def qs_pairs(qs: Sql) -> Sql:
    """Leading `k=v` pairs of a querystring, raw, in order, one per name.

    Reading stops at the first part without `=`; the value may hold `=`; of a
    repeated name the last value counts, at the place of the first.
    NULL when no pair could be read.
    """

    def leading(parts: Sql) -> Sql:
        flags = V.each(parts, lambda p: f"contains({p}, '=')")
        return V.let(
            f"array_position({flags}, false)",
            lambda bad: f"CASE WHEN {bad} = 0 THEN {parts} ELSE slice({parts}, 1, CAST({bad} AS INT) - 1) END",
        )

    def pairs(parts: Sql) -> Sql:
        return V.each(
            parts, lambda p: _pair(f"substring_index({p}, '=', 1)", f"substring({p}, instr({p}, '=') + 1)")
        )

    def last_wins(found: Sql) -> Sql:
        names = f"array_distinct({V.each(found, lambda p: f'{p}.name')})"

        # Sorted by name and place, each pair that no other of its name follows is the last one, and with its first
        # place it goes back into the order of first places: linear but for two sorts.
        def by_name(order: str) -> Sql:
            at = V.fresh("i")
            p = V.fresh()
            return f"transform({found}, ({p}, {at}) -> named_struct('n', {p}.name, 'i', {order}{at}, 'v', {p}.value))"

        def picked(ns: Sql) -> Sql:
            ups, downs = f"array_sort({by_name('')})", f"array_sort({by_name('-')})"

            def heads(items: Sql) -> Sql:
                x, at = V.fresh(), V.fresh("i")
                return f"filter({items}, ({x}, {at}) -> {at} = 0 OR {items}[{at} - 1].n <> {x}.n)"

            both = V.let(ups, heads), V.let(downs, heads)
            a, b = V.fresh(), V.fresh()
            placed = f"zip_with({both[0]}, {both[1]}, ({a}, {b}) -> named_struct('i', {a}.i, 'name', {a}.n, 'value', {b}.v))"
            return V.each(f"array_sort({placed})", lambda p: _pair(f"{p}.name", f"{p}.value"))

        return (
            f"CASE WHEN size({found}) > 0 THEN"
            f" {V.let(names, lambda ns: f'CASE WHEN size({ns}) = size({found}) THEN {found} ELSE {picked(ns)} END')}"
            " END"
        )

    return V.let(f"split({qs}, '&')", lambda parts: V.let(pairs(leading(parts)), last_wins))


def qs_params(qs: Sql) -> Sql:
    """Querystring parameters as MAP<STRING, STRING>; NULL when there is none."""
    return f"map_from_entries({qs_pairs(qs)})"


def qs_clean(value: Sql) -> Sql:
    """Percent-encode what a querystring value must not hold; the rest is kept."""

    def cleaned(v: Sql) -> Sql:
        units = V.each(
            f"regexp_extract_all({v}, {V.quote(_UNIT)}, 1)",
            lambda u: f"CASE WHEN {u} RLIKE {V.quote(_STAYS)} THEN {u} ELSE url_encode({u}) END",
        )
        # most values are clean, which one pass tells
        return f"CASE WHEN {v} RLIKE {V.quote(_ALL_STAY)} THEN {v} ELSE array_join({units}, '') END"

    return V.let(value, cleaned)


def qs_to_nvps(qs: Sql) -> Sql:
    """Querystring to pairs with decoded values; NULL when a value cannot be decoded.

    `a` and `a=` give a NULL value, `=v` an empty name, `=` an empty pair; a
    part with two separators is dropped. A NULL querystring is an empty list.
    """

    def fields(part: Sql) -> Sql:
        return f"split(rtrim('=', {part}), '=')"

    def read(part: Sql) -> Sql:
        def by_size(f: Sql) -> Sql:
            return (
                f"CASE WHEN size({f}) = 1 AND {f}[0] = '' THEN {_pair(chr(39) * 2, chr(39) * 2)}"
                f" WHEN size({f}) = 1 THEN {_pair(f'{f}[0]', 'CAST(NULL AS STRING)')}"
                f" WHEN size({f}) = 2 THEN {_pair(f'{f}[0]', f'try_url_decode({f}[1])')} END"
            )

        return V.let(fields(part), by_size)

    def undecodable(part: Sql) -> Sql:
        return V.let(fields(part), lambda f: f"(size({f}) = 2 AND try_url_decode(get({f}, 1)) IS NULL)")

    parts = V.where(f"split(coalesce({qs}, ''), '&')", lambda p: f"{p} <> ''")
    return V.let(
        parts,
        lambda ps: (
            f"CASE WHEN NOT {V.any_of(ps, undecodable)} THEN"
            f" CAST({V.where(V.each(ps, read), lambda p: f'{p} IS NOT NULL')} AS {NVPS_TYPE}) END"
        ),
    )


def nvps_to_qs(nvps: Sql) -> Sql:
    """Pairs to a querystring with encoded values; a NULL value is written empty."""
    shown = V.each(nvps, lambda p: f"concat({p}.name, '=', url_encode(coalesce({p}.value, '')))")
    return f"array_join({shown}, '&')"


def as_nvps(v: Sql) -> Sql:
    """VARIANT to pairs: an array of `{name, value?}` or an object of scalars.

    Object values become text. NULL when the document is neither, or when any
    member does not fit.
    """

    def from_array(pairs: Sql) -> Sql:
        def unfit(p: Sql) -> Sql:
            value = f"{p}.value"
            return f"(NOT {V.is_string(f'{p}.name')} OR NOT ({V.missing_or_null(value)} OR {V.is_string(value)}))"

        def typed(p: Sql) -> Sql:
            return _pair(V.string(f"{p}.name"), V.string(f"{p}.value"))

        return f"CASE WHEN NOT {V.any_of(pairs, unfit)} THEN {V.each(pairs, typed)} END"

    def from_object(entries: Sql) -> Sql:
        nested = V.any_of(entries, lambda e: f"{V.kind(f'{e}.value')} IN ('a', 'o')")

        def typed(e: Sql) -> Sql:
            value = f"{e}.value"
            shown = (
                f"CASE WHEN is_variant_null({value}) THEN NULL"
                f" WHEN {V.is_string(value)} THEN {V.string(value)} ELSE {V.text(value)} END"
            )
            return _pair(f"{e}.key", shown)

        return f"CASE WHEN NOT {nested} THEN {V.each(entries, typed)} END"

    return V.let(
        v,
        lambda d: (
            "CAST("
            + V.let(
                f"try_cast({d} AS ARRAY<STRUCT<name: VARIANT, value: VARIANT>>)",
                lambda items: (
                    f"CASE WHEN {items} IS NOT NULL THEN {from_array(items)}"
                    f" ELSE {V.let(f'map_entries({V.as_map(d)})', from_object)} END"
                ),
            )
            + f" AS {NVPS_TYPE})"
        ),
    )
