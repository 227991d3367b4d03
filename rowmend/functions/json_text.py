"""Expressions over JSON text that keep what they do not touch: the order of keys and the digits of numbers.

A VARIANT prints its keys sorted and its numbers anew, so a document that has to
come out again is not taken through one. Its text is cut into tokens once; a
place in it is a span of tokens, found in one pass over them, and an edit puts
new text between what stands before and after the span. Blanks between tokens
go; nothing else changes.

Text of few levels, as nearly all is, is cut into the members of its containers
on the way to the place only, each a match of one regular expression, and what
lies beside the way is never cut into tokens.

The text must be one JSON value, which `variants.parse` tells.
"""

from __future__ import annotations

from collections.abc import Callable

from . import variants as V
from .variants import Sql

# A value with the key before it and the comma after it, an opening bracket with its key, or a closing one with its comma.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_KEY = f"{_STRING}:"
_BLANK = r"[ \n\r\t]"
_BETWEEN = rf'^{_BLANK}|[\[{{,:"]{_BLANK}|{_BLANK}[\]}},:"]|{_BLANK}$'
_TOKEN = rf'(?:{_KEY})?+(?:{_STRING}|[^\[\]{{}},":]++|[\[{{])(?<![\[{{]),?+|(?:{_KEY})?+[\[{{]|[\]}}],?+'

# Containers within each other that `_MEMBER` reads through; deeper text is taken by its tokens.
_LEVELS = 8


def _container(levels: int) -> str:
    below = f"|{_container(levels - 1)}" if levels > 1 else ""
    return rf'[\[{{](?:[^\[\]{{}}"]++|{_STRING}{below})*+[\]}}]'


# A value of few levels, and one with the key before it and the comma after it.
_VALUE = rf'(?:{_STRING}|[^\[\]{{}},":]++|{_container(_LEVELS)})'
_MEMBER = f"(?:{_KEY})?+{_VALUE},?+"

# Text with so few opening brackets, those in strings included, that it has few enough levels: two classes, no alternatives.
_FEW_BRACKETS = rf"^[^\[{{]*+(?:[\[{{][^\[{{]*+){{0,{_LEVELS}}}+\z"

# What stands between the key and the comma of a member.
_BARE = rf"(?s)^(?:{_KEY})?+(.*[^,])"

# A count of elements that no index reaches.
_NOWHERE = -(1 << 30)

Steps = tuple[str | int, ...]


def compact(text: Sql) -> Sql:
    """The text without blanks between tokens. Where none is next to a bracket, comma, colon or quote there are none."""
    without = f"regexp_replace({text}, {V.quote(f'({_STRING})|{_BLANK}++')}, '\\u00241')"
    # most texts hold no blank at all, which one class tells
    return f"CASE WHEN {text} RLIKE {V.quote(_BLANK)} AND {text} RLIKE {V.quote(_BETWEEN)} THEN {without} ELSE {text} END"


def tokens(text: Sql) -> Sql:
    return _cut(compact(text))


def _cut(text: Sql) -> Sql:
    return f"regexp_extract_all({text}, {V.quote(_TOKEN)}, 0)"


def _is_flat(text: Sql) -> Sql:
    """Whether compact text has few enough levels to be cut into members."""
    return f"({text} RLIKE {V.quote(_FEW_BRACKETS)} OR {text} RLIKE {V.quote(f'^{_VALUE}' + chr(92) + 'z')})"


def _parts(text: Sql) -> Sql:
    """Members of a flat container, each with the key before it and the comma after it."""
    return f"regexp_extract_all(substring({text}, 2, char_length({text}) - 2), {V.quote(_MEMBER)}, 0)"


def joined(items: Sql) -> Sql:
    return f"array_join({items}, '')"


def _opens(x: Sql) -> Sql:
    return f"(endswith({x}, '{{') OR endswith({x}, '['))"


def _closes(x: Sql) -> Sql:
    return f"(startswith({x}, '}}') OR startswith({x}, ']'))"


def _last(x: Sql) -> Sql:
    """Whether no comma follows."""
    return f"NOT endswith({x}, ',')"


def bare(token: Sql) -> Sql:
    """A value's text without the key before it and the comma after it."""
    return f"regexp_extract({token}, {V.quote(_BARE)}, 1)"


def key_of(member: Sql) -> Sql:
    """Key of an object's member."""
    return V.string(f"try_parse_json(regexp_extract({member}, {V.quote(f'^({_STRING}):')}, 1))")


def _is_key(x: Sql, name: str) -> Sql:
    plain = f"startswith({x}, {V.quote(V.literal_text(name) + ':')})"
    # a key may be written with escapes
    return f"({plain} OR (contains({x}, {V.quote(chr(92))}) AND {key_of(x)} <=> {V.quote(name)}))"


def found(items: Sql, steps: Steps) -> Sql:
    """struct with s and e, the first and last token of the value at plain steps; e is 0 where there is none.

    One pass. d: containers open; m: steps taken, whose containers are open; c: elements before this one in the array
    that the next step is in. Of a key that comes twice the last one counts."""
    acc, x = V.fresh("a"), V.fresh()
    at = {n: f"{acc}.{n}" for n in "idmcse"}
    wanted = [f"{at['c']} = {s}" if isinstance(s, int) else _is_key(x, s) for s in steps]
    here = f"CASE {at['m']} {' '.join(f'WHEN {n} THEN {w}' for n, w in enumerate(wanted))} END"
    inside = f"CASE WHEN endswith({x}, '[') THEN 0 ELSE {_NOWHERE} END"

    def state(**changed: Sql) -> Sql:
        changed = {"i": f"{at['i']} + 1"} | changed
        return "named_struct(" + ", ".join(f"'{n}', {changed.get(n, at[n])}" for n in "idmcse") + ")"

    counted = f"CASE WHEN {_last(x)} THEN {at['c']} ELSE {at['c']} + 1 END"
    back = f"{at['d']} - 1"
    merge = (
        f"CASE WHEN {_closes(x)} THEN CASE"
        # the value that was found ends, or a neighbour of it does
        f" WHEN {back} = {at['m']} + 1 THEN {state(d=back, c=counted, e=f'CASE WHEN {at["e"]} = 0 AND {at["s"]} > 0 THEN {at["i"]} ELSE {at["e"]} END')}"
        # the container of the last step ends
        f" WHEN {back} = {at['m']} AND {at['m']} > 0 THEN {state(d=back, m=f'{at["m"]} - 1', c=str(_NOWHERE))}"
        f" ELSE {state(d=back)} END"
        f" WHEN {at['d']} = {at['m']} + 1 AND {here} THEN CASE"
        f" WHEN {at['m']} + 1 < {len(steps)} THEN CASE WHEN {_opens(x)}"
        f" THEN {state(d=f'{at["d"]} + 1', m=f'{at["m"]} + 1', c=inside, s='0', e='0')} ELSE {state(c=counted, s='0', e='0')} END"
        f" WHEN {_opens(x)} THEN {state(d=f'{at["d"]} + 1', s=at['i'], e='0')}"
        f" ELSE {state(c=counted, s=at['i'], e=at['i'])} END"
        f" WHEN {_opens(x)} THEN {state(d=f'{at["d"]} + 1', c=f'CASE WHEN {at["d"]} = 0 THEN {inside} ELSE {at["c"]} END')}"
        f" WHEN {at['d']} = {at['m']} + 1 THEN {state(c=counted)} ELSE {state()} END"
    )
    start = f"named_struct('i', 1, 'd', 0, 'm', 0, 'c', {_NOWHERE}, 's', 0, 'e', 0)"
    return f"aggregate({items}, {start}, ({acc}, {x}) -> {merge})"


def at_span(items: Sql, span: Sql) -> Sql:
    """Text of the value at a span."""
    return bare(joined(f"slice({items}, {span}.s, {span}.e - {span}.s + 1)"))


def around(items: Sql, span: Sql) -> tuple[Sql, Sql]:
    """The text before and after the value at a span."""
    key = f"regexp_extract({items}[{span}.s - 1], {V.quote('^' + _KEY)}, 0)"
    comma = f"CASE WHEN {_last(f'{items}[{span}.e - 1]')} THEN '' ELSE ',' END"
    before = joined(f"slice({items}, 1, {span}.s - 1)")
    after = joined(f"slice({items}, {span}.e + 1, size({items}))")
    return f"concat({before}, {key})", f"concat({comma}, {after})"


def _member(text: Sql, step: str | int) -> Sql:
    """The member of a flat value at one step, NULL where there is none. Of a key that comes twice the last one counts."""
    if isinstance(step, int):
        return f"CASE WHEN startswith({text}, '[') THEN get({_parts(text)}, {step}) END"
    x = V.fresh()
    named = f"filter({_parts(text)}, {x} -> {_is_key(x, step)})"
    return f"CASE WHEN startswith({text}, '{{') THEN try_element_at({named}, -1) END"


def _get_flat(text: Sql, steps: Steps) -> Sql:
    for step in steps:
        text = V.let(text, lambda t, step=step: bare(_member(t, step)))
    return text


def get(text: Sql, *steps: str | int) -> Sql:
    """Text of the value at plain steps, NULL where there is none."""
    if not steps:
        return compact(text)

    def by_tokens(t: Sql) -> Sql:
        return V.let(_cut(t), lambda ts: V.let(found(ts, steps), lambda f: f"CASE WHEN {f}.e > 0 THEN {at_span(ts, f)} END"))

    return V.let(compact(text), lambda t: f"CASE WHEN {_is_flat(t)} THEN {_get_flat(t, steps)} ELSE {by_tokens(t)} END")


def _place(before: Sql, value: Sql, after: Sql) -> Sql:
    return f"named_struct('b', {before}, 'v', {value}, 'a', {after})"


def _place_flat(text: Sql, steps: Steps) -> Sql:
    """`place` in flat text."""
    step, *more = steps

    def in_parts(parts: Sql) -> Sql:
        x, i = V.fresh(), V.fresh("i")
        if isinstance(step, int):
            position = f"CASE WHEN startswith({text}, '[') AND size({parts}) > {step} THEN {step + 1} END"
        else:
            hits = f"transform({parts}, ({x}, {i}) -> CASE WHEN {_is_key(x, step)} THEN {i} + 1 END)"
            position = f"CASE WHEN startswith({text}, '{{') THEN array_max({hits}) END"
        return V.let(position, lambda n: f"CASE WHEN {n} IS NOT NULL THEN {V.let(f'{parts}[{n} - 1]', lambda m: at(parts, n, m))} END")

    def at(parts: Sql, n: Sql, member: Sql) -> Sql:
        key = "''" if isinstance(step, int) else f"regexp_extract({member}, {V.quote('^' + _KEY)}, 0)"
        before = f"concat(substring({text}, 1, 1), {joined(f'slice({parts}, 1, {n} - 1)')}, {key})"
        comma = f"CASE WHEN {_last(member)} THEN '' ELSE ',' END"
        after = f"concat({comma}, {joined(f'slice({parts}, {n} + 1, size({parts}))')}, right({text}, 1))"
        value = bare(member)
        if not more:
            return _place(before, value, after)

        def outer(p: Sql) -> Sql:
            return f"CASE WHEN {p} IS NOT NULL THEN {_place(f'concat({before}, {p}.b)', f'{p}.v', f'concat({p}.a, {after})')} END"

        return V.let(V.let(value, lambda v: _place_flat(v, tuple(more))), outer)

    return V.let(_parts(text), in_parts)


def place(text: Sql, steps: Steps) -> Sql:
    """The value at plain steps of compact text, and what stands before and after it; NULL where there is none."""

    def by_tokens(items: Sql) -> Sql:
        def at(f: Sql) -> Sql:
            before, after = around(items, f)
            return f"CASE WHEN {f}.e > 0 THEN {_place(before, at_span(items, f), after)} END"

        return V.let(found(items, steps), at)

    return f"CASE WHEN {_is_flat(text)} THEN {_place_flat(text, steps)} ELSE {V.let(_cut(text), by_tokens)} END"


def edit_at(text: Sql, steps: Steps, change: Callable[[Sql], Sql], missing: Sql) -> Sql:
    """Outcome of `change` on the value at plain steps, put back into the text."""
    if not steps:
        return change(compact(text))

    def at_place(p: Sql) -> Sql:
        done = V.then(V.let(f"{p}.v", change), lambda new: V.ok(f"concat({p}.b, {new}, {p}.a)"))
        return f"CASE WHEN {p} IS NOT NULL THEN {done} ELSE {fail(missing)} END"

    return V.let(compact(text), lambda t: V.let(place(t, steps), at_place))


def members(text: Sql) -> Sql:
    """Texts of the elements of an array, or of the members of an object with their keys; none for anything else."""
    acc, x = V.fresh("a"), V.fresh()
    kind = "STRUCT<i: INT, d: INT, s: INT, out: ARRAY<STRUCT<s: INT, e: INT>>>"

    def state(d: Sql, s: Sql, out: Sql) -> Sql:
        return f"named_struct('i', {acc}.i + 1, 'd', {d}, 's', {s}, 'out', {out})"

    def with_span(s: Sql) -> Sql:
        return f"array_append({acc}.out, named_struct('s', {s}, 'e', {acc}.i))"

    merge = (
        f"CASE WHEN {_closes(x)} THEN {state(f'{acc}.d - 1', f'{acc}.s', f'CASE WHEN {acc}.d = 2 THEN {with_span(f"{acc}.s")} ELSE {acc}.out END')}"
        f" WHEN {_opens(x)} THEN {state(f'{acc}.d + 1', f'CASE WHEN {acc}.d = 1 THEN {acc}.i ELSE {acc}.s END', f'{acc}.out')}"
        f" WHEN {acc}.d = 1 THEN {state('1', f'{acc}.s', with_span(f'{acc}.i'))}"
        f" ELSE {state(f'{acc}.d', f'{acc}.s', f'{acc}.out')} END"
    )
    none = f"CAST(named_struct('i', 1, 'd', 0, 's', 0, 'out', array()) AS {kind})"

    def cut(t: Sql) -> Sql:
        spans = f"aggregate({t}, {none}, ({acc}, {x}) -> CAST({merge} AS {kind})).out"
        one = V.fresh()
        return f"transform({spans}, {one} -> rtrim(',', {joined(f'slice({t}, {one}.s, {one}.e - {one}.s + 1)')}))"

    def flat(t: Sql) -> Sql:
        opens = f"(startswith({t}, '{{') OR startswith({t}, '['))"
        listed = V.each(_parts(t), lambda x: f"CASE WHEN {_last(x)} THEN {x} ELSE left({x}, char_length({x}) - 1) END")
        return f"CASE WHEN {opens} THEN {listed} ELSE CAST(array() AS ARRAY<STRING>) END"

    return V.let(compact(text), lambda t: f"CASE WHEN {_is_flat(t)} THEN {flat(t)} ELSE {V.let(_cut(t), cut)} END")


def array_of(items: Sql) -> Sql:
    return f"concat('[', array_join({items}, ','), ']')"


def object_of(items: Sql) -> Sql:
    return f"concat('{{', array_join({items}, ','), '}}')"


def starts(text: Sql) -> Sql:
    """First character of a compact text, which tells its type: quote, n, t, f, [, { or that of a number."""
    return f"substring({text}, 1, 1)"


def string(text: Sql) -> Sql:
    """Content of a JSON string, NULL for any other value."""
    return f"CASE WHEN startswith({text}, '\"') THEN {V.string(f'try_parse_json({text})')} END"


def quoted(content: Sql) -> Sql:
    """Text of a JSON string."""
    return V.text(V.of(content))


def fail(err: Sql) -> Sql:
    return f"named_struct('v', CAST(NULL AS STRING), 'err', {err})"


def printed(outcome: Sql) -> Sql:
    """Outcome over a VARIANT as one over its text."""
    return V.let(outcome, lambda r: f"named_struct('v', {V.text(f'{r}.v')}, 'err', {r}.err)")
