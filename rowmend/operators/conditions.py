"""Conditions and flow matching."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V
from ..functions.errors import failure
from ..functions.schema_keys import schema_matches
from ..functions.variants import Sql
from ..plans.config import Compare, Condition, Config, Matcher, Regex, Size
from . import access, paths
from .payloads import OTHER, known_shape

_MAX_INT = 2**31 - 1


def equals(path: str, value: Any, document: Sql = "document") -> Column:
    """Same JSON type and equal; false when the path is missing."""
    return F.expr(holds(Condition(path, Compare(value)), document))


def matches(path: str, regex: str, document: Sql = "document") -> Column:
    """The pattern occurs in the JSON text at the path (a string keeps its quotes)."""
    return F.expr(holds(Condition(path, Regex(regex)), document))


def size_is(
    path: str, eq: int | None = None, gt: int | None = None, lt: int | None = None, document: Sql = "document"
) -> Column:
    """Size of a string, array or (rounded up) number at the path."""
    given = [(op, n) for op, n in (("eq", eq), ("gt", gt), ("lt", lt)) if n is not None]
    if len(given) != 1:
        raise ValueError("give exactly one of eq, gt, lt")
    return F.expr(holds(Condition(path, Size(*given[0])), document))


def holds(condition: Condition, document: Sql = "document") -> Sql:
    value = paths.read(document, condition.path)
    if isinstance(condition.matcher, Regex):
        printed = paths.read_printed(document, condition.path)
        return accepts_text(condition.matcher, V.let(value, lambda v: _as_written(v, printed)))
    return accepts(condition.matcher, value)


def _as_written(value: Sql, printed: Sql) -> Sql:
    """JSON text of a value: the VARIANT's own where that is the same, else `printed`, which costs more."""
    return f"CASE WHEN {V.prints_as_written(value)} THEN {V.text(value)} WHEN {value} IS NOT NULL THEN {printed} END"


def all_of(conditions: list[Column]) -> Column:
    """All hold; an empty list does."""
    together = F.lit(True)
    for condition in conditions:
        together = together & condition
    return together


def accepts(matcher: Matcher, value: Sql) -> Sql:
    """A matcher on a value; a missing value (SQL NULL) is refused."""
    if isinstance(matcher, Regex):
        return accepts_text(matcher, V.text(value))
    if isinstance(matcher, Compare):
        test = _equal(value, matcher.value)
    else:
        test = _size(value, matcher)
    return f"coalesce(({test}), false)"


def accepts_text(matcher: Regex, text: Sql) -> Sql:
    """A pattern on the JSON text of a value; a missing one (SQL NULL) is refused."""
    return f"coalesce({text} RLIKE {V.quote(matcher.regex)}, false)"


def _equal(value: Sql, expected: Any) -> Sql:
    """Equal as JSON: numbers by value, arrays and objects along the configured value, whatever the order of keys."""

    def same(v: Sql) -> Sql:
        if isinstance(expected, list):
            return V.let(V.as_array(v), lambda a: _all(len(expected), a, [(str(i + 1), x) for i, x in enumerate(expected)]))
        if isinstance(expected, dict):
            return V.let(V.as_map(v), lambda m: _all(len(expected), m, [(V.quote(k), x) for k, x in expected.items()]))
        if expected is None:
            return f"is_variant_null({v})"
        if isinstance(expected, str):
            return f"{V.is_string(v)} AND {V.string(v)} = {V.quote(expected)}"
        same_text = f"{V.text(v)} = {V.text(V.literal(expected))}"
        if isinstance(expected, bool):
            return same_text
        # A number written with an exponent is held as a double and has another text.
        return (
            f"({same_text} OR (schema_of_variant({v}) = 'DOUBLE'"
            f" AND CAST({v} AS DOUBLE) = double('{float(expected)!r}')))"
        )

    return V.let(value, same)


def _all(size: int, container: Sql, wanted: list[tuple[Sql, Any]]) -> Sql:
    """The container has that size, and what it holds at each place equals what is wanted there."""
    tests = [f"coalesce({_equal(f'try_element_at({container}, {at})', x)}, false)" for at, x in wanted]
    return " AND ".join([f"coalesce(size({container}) = {size}, false)", *tests])


def _size(value: Sql, size: Size) -> Sql:
    sign = {"eq": "=", "gt": ">", "lt": "<"}[size.op]

    # Text counts in UTF-16 units, numbers count as their ceiling.
    def measured(v: Sql) -> Sql:
        return (
            f"CASE {V.kind(v)} WHEN 's' THEN octet_length(encode({V.string(v)}, 'UTF-16BE')) div 2"
            f" WHEN 'a' THEN size({V.as_array(v)})"
            f" WHEN 'd' THEN least(ceil(CAST({v} AS DOUBLE)), {_MAX_INT}) END"
        )

    return f"{V.let(value, measured)} {sign} {size.limit}"


# --- flows --------------------------------------------------------------------


def _condition_value(path: str, row_type: str, printed: bool = False) -> Sql:
    """Value a condition of a flow for `row_type` looks at: in the typed payload, or in the row around it.

    With `printed`, its JSON text: as it stands in the line or in the encoded document that it is in."""
    segments = paths.tokenize(path)
    shape = known_shape(row_type, repaired=False)
    if segments and segments[0] == paths.Name("payload") and shape != OTHER:
        return (access.read_printed if printed else access.read)(paths.resolve(segments[1:], (segments[0],)), shape)
    node = paths.compile_path(path)
    if printed:
        plain = paths.AtField("data", None, node)
        nested = paths.AtField("data", None, paths.AtField("payload", None, plain))
        return f"CASE WHEN nested THEN {paths.read_text('line', nested)} ELSE {paths.read_text('line', plain)} END"
    outer = paths.AtItem(0, paths.AtField("data", None, node))
    inner = paths.AtItem(
        0, paths.AtField("data", None, paths.AtField("payload", None, paths.AtField("data", None, node)))
    )
    return f"CASE WHEN nested THEN {paths.read('doc', inner)} ELSE {paths.read('doc', outer)} END"


#: Flows in one word of a bitset.
_WORD = 62


def _bits(flows: Iterable[int], count: int) -> Sql:
    """A set of flows as words of bits: a constant."""
    words = [0] * max(1, -(-count // _WORD))
    for f in flows:
        words[f // _WORD] |= 1 << f % _WORD
    return f"array({', '.join(f'{w}L' for w in words)})"


def _both(sets: list[Sql]) -> Sql:
    """The flows in all of the sets."""
    out = sets[0]
    for other in sets[1:]:
        a, b = V.fresh(), V.fresh()
        out = f"zip_with({out}, {other}, ({a}, {b}) -> {a} & {b})"
    return out


def _is_indexed(matcher: Matcher) -> bool:
    """Whether values that the matcher accepts have one key."""
    return isinstance(matcher, Compare) and not isinstance(matcher.value, (list, dict))


def _key(value: Sql) -> Sql:
    """A text that equal scalars share, of any numeric type; NULL for arrays, objects and what is missing."""

    def by_type(t: Sql) -> Sql:
        return (
            f"CASE WHEN {t} = 'STRING' THEN concat('s', {V.string(value)}) WHEN {t} = 'VOID' THEN 'n'"
            f" WHEN {t} = 'DOUBLE' THEN concat('d', CAST(CAST({value} AS DOUBLE) + 0.0D AS STRING))"
            f" WHEN {t} IS NOT NULL AND NOT startswith({t}, 'OBJECT') AND NOT startswith({t}, 'ARRAY')"
            f" THEN concat('x', {V.text(value)}) END"
        )

    return V.let(f"schema_of_variant({value})", by_type)


def _keys_of(expected: Any) -> list[tuple[Any, Sql]]:
    """Keys of a configured scalar, each as something to tell keys apart by and as a constant. A number that is held as a
    double has another key than one that is not."""
    if expected is None:
        return [("n", "'n'")]
    if isinstance(expected, str):
        return [("s" + expected, V.quote("s" + expected))]
    exact = f"concat('x', {V.text(V.literal(expected))})"
    if isinstance(expected, bool):
        return [(("b", expected), exact)]
    double = float(expected) + 0.0
    keys = [(("d", double), f"concat('d', CAST(double('{double!r}') AS STRING))")]
    # a number that is configured with an exponent is a double itself, with the text of one
    return [(("x", expected), exact), *keys]


def _looked_up(value: Sql, tests: dict[int, list[Any]], count: int) -> Sql:
    """Flows that the value lets through: one look into a constant table from keys to sets of flows, whatever their number.

    `tests`: for each flow that compares this value, what with (all must be equal to it)."""
    free = [f for f in range(count) if f not in tests]
    accepted: dict[Any, tuple[Sql, set[int]]] = {}
    for flow, wanted in tests.items():
        common = set.intersection(*[{k for k, _ in _keys_of(w)} for w in wanted])
        for k, constant in _keys_of(wanted[0]):
            if k in common:
                accepted.setdefault(k, (constant, set()))[1].add(flow)
    keys = f"array({', '.join(c for c, _ in accepted.values())})" if accepted else "CAST(array() AS ARRAY<STRING>)"
    sets = f"array({', '.join([_bits(free, count), *(_bits([*free, *s], count) for _, s in accepted.values())])})"
    return f"element_at({sets}, CAST(coalesce(array_position({keys}, {_key(value)}), 0) AS INT) + 1)"


def match_flows(events: DataFrame, config: Config) -> DataFrame:
    """Find all flows of a row: schema pattern fits and every condition holds.

    Adds `matched ARRAY<INT>` (places of the matched flows in the configuration, in order) and
    `flows ARRAY<STRING>` (their names). A row without a flow is an error.

    A decision table: each distinct condition path is read once per row, and only for rows whose schema some flow using it
    accepts. What flows compare it with is a constant table from values to sets of flows; only patterns and sizes are
    tested one by one, equal ones once. The sets are intersected as bits. So the plan grows with the distinct paths and
    patterns, and not with the flows.
    """
    count = len(config.flows)
    fits = {p: f"_fits{i}" for i, p in enumerate(config.patterns)}
    staged = events
    if fits:
        staged = staged.withColumns(
            {c: F.expr(f"err IS NULL AND {schema_matches('row_schema', p)}") for p, c in fits.items()}
        )
    wanted: dict[tuple[str, str], list[str]] = {}
    compared: dict[tuple[str, str], dict[int, list[Any]]] = {}
    tested: dict[tuple[tuple[str, str], str], tuple[Matcher, set[int]]] = {}
    for i, flow in enumerate(config.flows):
        for condition in flow.conditions:
            matcher = condition.matcher
            key = (condition.path, flow.row_type)
            users = wanted.setdefault(key, [])
            if flow.pattern not in users:
                users.append(flow.pattern)
            if _is_indexed(matcher):
                compared.setdefault(key, {}).setdefault(i, []).append(matcher.value)
            else:
                tested.setdefault((key, repr(matcher)), (matcher, set()))[1].add(i)
    values = {key: f"_value{i}" for i, key in enumerate(wanted)}
    if values:
        staged = staged.withColumns(
            {
                values[key]: F.expr(
                    f"CASE WHEN {' OR '.join(fits[u] for u in users)} THEN {_condition_value(*key)} END"
                )
                for key, users in wanted.items()
            }
        )
    texts = {key: f"_text{i}" for i, key in enumerate(dict.fromkeys(k for (k, _), (m, _) in tested.items() if isinstance(m, Regex)))}
    if texts:
        staged = staged.withColumns({c: F.expr(_as_written(values[key], _condition_value(*key, printed=True))) for key, c in texts.items()})
    of_pattern = {p: [i for i, f in enumerate(config.flows) if f.pattern == p] for p in config.patterns}
    # patterns of different row types fit no common row, others may: a set for each
    sets = [f"CASE WHEN {c} THEN {_bits(range(count), count)} ELSE {_bits(set(range(count)) - set(of_pattern[p]), count)} END" for p, c in fits.items()]
    sets += [_looked_up(values[key], tests, count) for key, tests in compared.items()]
    for (key, _), (matcher, users) in tested.items():
        holds_here = accepts_text(matcher, texts[key]) if isinstance(matcher, Regex) else accepts(matcher, values[key])
        sets.append(f"CASE WHEN {holds_here} THEN {_bits(range(count), count)} ELSE {_bits(set(range(count)) - users, count)} END")
    bitsets = {f"_set{i}": sql for i, sql in enumerate(sets)}
    if bitsets:
        staged = staged.withColumns({c: F.expr(sql) for c, sql in bitsets.items()})
        each = V.fresh("i")
        # bound first: as a column it would be inlined and worked out anew for every flow
        found = V.let(
            _both(list(bitsets)),
            lambda s: f"filter(sequence(0, {count - 1}), {each} -> (shiftright({s}[{each} div {_WORD}], {each} % {_WORD}) & 1L) = 1L)",
        )
    else:
        found = "CAST(array() AS ARRAY<INT>)"
    names = f"CAST(array({', '.join(V.quote(f.name) for f in config.flows)}) AS ARRAY<STRING>)"
    place = V.fresh("i")
    no_flow = failure("FailedToMatchConfiguration", "row_schema")
    return (
        staged.withColumn("matched", F.expr(V.opaque(found)))
        .withColumn("flows", F.expr(V.opaque(f"transform(matched, {place} -> {names}[{place}])")))
        .withColumn("err", F.expr(V.opaque(f"CASE WHEN err IS NULL AND size(matched) = 0 THEN {no_flow} ELSE err END")))
        .drop(*fits.values(), *values.values(), *texts.values(), *bitsets)
    )
