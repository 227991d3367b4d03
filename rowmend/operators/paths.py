"""JSON paths compiled to expressions.

A path is known when the plan is built, so it is resolved once, on the driver,
to a chain of nodes and each node becomes part of one expression. Two
expressions can be made from a chain: `read` (used by conditions) and `edit`
(used by steps, giving a new document or an error).

Some field names imply an encoding: pairs are addressed by name, JSON kept as
text is edited in its text, base64 is decoded and encoded again. Within such a
text nothing but the place itself changes, see `functions.json_text`.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from .. import wire
from ..functions import json_text as J
from ..functions import variants as V
from ..functions.codecs import b64_decode, b64_encode
from ..functions.errors import Known, failure
from ..functions.variants import Sql

Leaf = Callable[[Sql], Sql]


@dataclass(frozen=True)
class Change:
    """What is done at a path: to a VARIANT, and to JSON text. Each gives an outcome over what it takes."""

    value: Leaf
    text: Leaf

    def __call__(self, value: Sql) -> Sql:
        return self.value(value)


def text_change(leaf: Leaf) -> Leaf:
    """The change on JSON text; one that knows VARIANTs only goes through one."""
    if isinstance(leaf, Change):
        return leaf.text
    return lambda text: V.let(f"try_parse_json({text})", lambda v: J.printed(leaf(v)))


_TOKEN = re.compile(
    r"\[\?\(@\.(?P<field>[A-Za-z0-9._-]+)=~(?P<regex>.+?)\)\](?=\.|$)"
    r"|\[(?P<item>[0-9]+)\]"
    r"|(?P<name>[A-Za-z0-9_-]+)"
)


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    index: int


@dataclass(frozen=True)
class Where:
    field: tuple[str, ...]
    regex: str

    def selects_name(self, names: tuple[str, ...]) -> bool:
        return "name" in self.field and self.regex in names


Segment = Name | Item | Where


def tokenize(path: str) -> list[Segment]:
    """`$.raw.parameters.[?(@.name=~ue_pr)].value` to segments; other characters are skipped."""
    found: list[Segment] = []
    for token in _TOKEN.finditer(path):
        if token["field"] is not None:
            found.append(Where(tuple(token["field"].split(".")), token["regex"]))
        elif token["item"] is not None:
            found.append(Item(int(token["item"])))
        else:
            found.append(Name(token["name"]))
    return found


def is_special(flags: tuple[str, ...], name: str, previous: tuple[Segment, ...] = ()) -> bool:
    """Whether a field carries the encoding listed in `flags`.

    It does when its own name says so, when a plain segment before it does, or
    when a filter before it selects exactly that name.
    """
    if name.lower() in flags:
        return True
    return any(
        (isinstance(p, Name) and p.name in flags) or (isinstance(p, Where) and p.selects_name(flags))
        for p in previous
    )


# --- nodes --------------------------------------------------------------------


@dataclass(frozen=True)
class AtField:
    name: str
    codec: str | None
    child: "Node | None"


@dataclass(frozen=True)
class AtItem:
    index: int
    child: "Node | None"


@dataclass(frozen=True)
class AtMatches:
    where: Where
    child: "Node | None"


@dataclass(frozen=True)
class AtPair:
    list_name: str
    name: str
    codec: str | None
    child: "Node | None"
    last: bool


@dataclass(frozen=True)
class Many:
    """Several edits of one text, one after the other: where, what, and the error of a path that leads nowhere."""

    edits: "tuple[tuple[Node | None, Leaf, Sql], ...]"


Node = AtField | AtItem | AtMatches | AtPair | Many


def resolve(segments: list[Segment], previous: tuple[Segment, ...] = ()) -> Node | None:
    """Decide, segment by segment, how to step into the document."""
    if not segments:
        return None
    head, rest = segments[0], segments[1:]
    if isinstance(head, Where):
        return AtMatches(head, resolve(rest, previous + (head,)))
    if isinstance(head, Item):
        return AtItem(head.index, resolve(rest, previous + (head,)))
    if is_special(wire.BASE64_FIELDS, head.name, previous):
        return AtField(head.name, "base64", resolve(rest))
    if head.name.lower() in wire.NVP_FIELDS and rest and isinstance(rest[0], Name):
        name, tail = rest[0].name, rest[1:]
        if is_special(wire.BASE64_FIELDS, name, previous):
            return AtPair(head.name, name, "base64", resolve(tail), not tail)
        if is_special(wire.JSON_TEXT_FIELDS, name, previous):
            return AtPair(head.name, name, "json", resolve(tail), not tail)
        return AtPair(head.name, name, None, resolve(tail, previous + (head, rest[0])), not tail)
    if is_special(wire.JSON_TEXT_FIELDS, head.name, previous):
        return AtField(head.name, "json", resolve(rest))
    return AtField(head.name, None, resolve(rest, previous + (head,)))


def compile_path(path: str) -> Node | None:
    return resolve(tokenize(path))


# --- shared pieces ------------------------------------------------------------


def _node(path: "str | Node | None") -> Node | None:
    return compile_path(path) if isinstance(path, str) else path


def hit(element: Sql, where: Where) -> Sql:
    """A filter looks at the JSON text of a field; a missing field reads as null."""
    seen = V.text(V.get(element, *where.field))
    return f"(coalesce({seen}, 'null') RLIKE {V.quote(where.regex)})"


def _named(pair: Sql, name: str) -> Sql:
    return f"({V.get_string(pair, 'name')} <=> {V.quote(name)})"


# --- reading ------------------------------------------------------------------


def read(document: Sql, path: str | Node | None) -> Sql:
    """Value at a path as VARIANT, SQL NULL when it is not there.

    Through a filter the last matching element decides, and all matching
    elements must have the rest of the path.
    """
    node = _node(path)
    steps: list[str | int] = []
    while node is not None:
        if isinstance(node, AtItem):
            steps.append(node.index)
        elif isinstance(node, AtField):
            steps.append(node.name)
            if node.codec:
                return read_encoded(V.get(document, *steps), node.codec, node.child)
        elif isinstance(node, AtPair):
            return _read_pair(V.get(document, *steps, node.list_name), node)
        else:
            return V.let(V.get(document, *steps), lambda d: _read_matches(d, node))
        node = node.child
    return V.get(document, *steps)


def read_below(value: Sql, child: Node | None) -> Sql:
    return value if child is None else V.let(value, lambda d: read(d, child))


def read_encoded(value: Sql, codec: str, child: Node | None) -> Sql:
    content = V.let(value, lambda x: f"CASE WHEN {V.is_string(x)} THEN {V.string(x)} END")
    return read_below(V.parse(b64_decode(content) if codec == "base64" else content), child)


def _read_pair(pairs: Sql, node: AtPair) -> Sql:
    named = V.where(V.as_array(pairs), lambda p: _named(p, node.name))
    value = V.get(V.first(named), "value")
    return read_encoded(value, node.codec, node.child) if node.codec else read_below(value, node.child)


def last_of_all(values: Sql) -> Sql:
    """The last value, where no one is missing."""
    return f"CASE WHEN size({values}) > 0 AND NOT {V.any_of(values, lambda v: f'{v} IS NULL')} THEN element_at({values}, -1) END"


def _read_matches(document: Sql, node: AtMatches) -> Sql:
    def last(items: Sql) -> Sql:
        hits = V.where(items, lambda e: hit(e, node.where))
        return V.let(hits if node.child is None else V.each(hits, lambda e: read(e, node.child)), last_of_all)

    return V.let(
        V.items_or_none(document),
        lambda items: f"CASE WHEN size({items}) > 0 THEN {last(items)} ELSE {read(document, node.child)} END",
    )


# --- editing ------------------------------------------------------------------


def edit(document: Sql, path: str | Node | None, leaf: Leaf, missing: Sql) -> Sql:
    """Document with `leaf` applied at a path, as an outcome struct<v, err>.

    `leaf` maps the value there to an outcome, `missing` is the error of a path
    that leads nowhere. Plain steps are taken together: one extraction on the
    way down, one nested rebuild on the way up.
    """
    node = _node(path)
    steps: list[str | int] = []
    change = leaf
    while node is not None:
        if isinstance(node, AtMatches):
            change = _matches_change(node, leaf, missing)
            break
        if isinstance(node, AtItem):
            steps.append(node.index)
        elif isinstance(node, AtPair):
            steps.append(node.list_name)
            change = _pair_change(node, leaf, missing)
            break
        else:
            steps.append(node.name)
            if node.codec:
                change = encoded_change(node.codec, node.child, leaf, missing)
                break
        node = node.child

    def at_value(value: Sql) -> Sql:
        rebuilt = V.then(change(value), lambda new: V.ok(V.put(document, tuple(steps), new)))
        return f"CASE WHEN {value} IS NULL THEN {V.fail(missing)} ELSE {rebuilt} END"

    return V.let(V.get(document, *steps), at_value) if steps else change(document)


def below(child: Node | None, leaf: Leaf, missing: Sql) -> Leaf:
    return leaf if child is None else lambda value: edit(value, child, leaf, missing)


def encoded_change(codec: str, child: Node | None, leaf: Leaf, missing: Sql) -> Leaf:
    """Decode, edit the text inside, encode."""

    def change(value: Sql) -> Sql:
        inside = V.let(V.string(value), lambda content: encoded_text(content, codec, child, leaf, missing))
        no_text = V.fail(failure("InvalidJsonFormat", V.text(value)))
        done = V.let(inside, lambda r: f"named_struct('v', {V.of(f'{r}.v')}, 'err', {r}.err)")
        return f"CASE WHEN {V.is_string(value)} THEN {done} ELSE {no_text} END"

    return change


def encoded_text(content: Sql, codec: str, child: Node | None, leaf: Leaf, missing: Sql) -> Sql:
    """Outcome, over text, of a change in the document that an encoded content holds."""

    def in_text(plain: Sql) -> Sql:
        bad = J.fail(failure("InvalidJsonFormat", plain))
        return f"CASE WHEN NOT {V.is_json(plain)} THEN {bad} ELSE {edit_text(plain, child, leaf, missing)} END"

    def in_base64(plain: Sql) -> Sql:
        bad = J.fail(failure("Base64Failure", content, Known("Data is not properly base64-encoded")))
        done = V.then(in_text(plain), lambda new: V.ok(b64_encode(new)))
        return f"CASE WHEN {plain} IS NULL THEN {bad} ELSE {done} END"

    return V.let(b64_decode(content), in_base64) if codec == "base64" else in_text(content)


# --- editing and reading JSON text ------------------------------------------------


def edit_text(text: Sql, node: Node | None, leaf: Leaf, missing: Sql) -> Sql:
    """`edit` of JSON text (one whole value): an outcome over text, in which all but the place edited stays as it is."""
    if isinstance(node, Many):
        (child, change, gone), *rest = node.edits
        done = edit_text(text, child, change, gone)
        return V.then(done, lambda new: edit_text(new, Many(tuple(rest)), leaf, missing)) if rest else done
    steps: list[str | int] = []
    change = text_change(leaf)
    while node is not None:
        if isinstance(node, AtMatches):
            change = _matches_in_text(node, leaf, missing)
            break
        if isinstance(node, AtItem):
            steps.append(node.index)
        elif isinstance(node, AtPair):
            steps.append(node.list_name)
            change = _pair_in_text(node, leaf, missing)
            break
        else:
            steps.append(node.name)
            if node.codec:
                change = _encoded_in_text(node.codec, node.child, leaf, missing)
                break
        node = node.child
    return J.edit_at(text, tuple(steps), lambda value: V.let(value, change), missing)


def _encoded_in_text(codec: str, child: Node | None, leaf: Leaf, missing: Sql) -> Leaf:
    def change(value: Sql) -> Sql:
        def inside(content: Sql) -> Sql:
            done = V.then(encoded_text(content, codec, child, leaf, missing), lambda new: V.ok(J.quoted(new)))
            return f"CASE WHEN {content} IS NULL THEN {J.fail(failure('InvalidJsonFormat', value))} ELSE {done} END"

        return V.let(J.string(value), inside)

    return change


def _below_in_text(child: Node | None, leaf: Leaf, missing: Sql) -> Leaf:
    return text_change(leaf) if child is None else lambda value: edit_text(value, child, leaf, missing)


def _name_in_text(pair: Sql) -> Sql:
    return V.let(J.get(pair, "name"), J.string)


def _pair_in_text(node: AtPair, leaf: Leaf, missing: Sql) -> Leaf:
    change = _encoded_in_text(node.codec, node.child, leaf, missing) if node.codec else _below_in_text(node.child, leaf, missing)

    def by_name(value: Sql) -> Sql:
        reason = Known(f"Cannot access field {node.list_name}")
        unknown = failure("InvalidDataFormat", value, reason) if node.last else missing

        def in_pairs(pairs: Sql, position: Sql) -> Sql:
            pair, i = V.fresh(), V.fresh("i")
            edited = J.edit_at(f"{pairs}[{position} - 1]", ("value",), lambda v: V.let(v, change), missing)
            return V.then(
                edited,
                lambda new: V.ok(J.array_of(f"transform({pairs}, ({pair}, {i}) -> CASE WHEN {i} = {position} - 1 THEN {new} ELSE {pair} END)")),
            )

        def in_list(pairs: Sql) -> Sql:
            hits = V.each(pairs, lambda p: f"({_name_in_text(p)} <=> {V.quote(node.name)})")
            return V.let(
                f"CAST(coalesce(array_position({hits}, true), 0) AS INT)",
                lambda n: f"CASE WHEN {n} = 0 THEN {J.fail(unknown)} ELSE {in_pairs(pairs, n)} END",
            )

        return V.let(_items_in_text(value), in_list)

    return by_name


def _items_in_text(value: Sql) -> Sql:
    return f"CASE WHEN startswith({value}, '[') THEN {J.members(value)} ELSE CAST(array() AS ARRAY<STRING>) END"


def hit_text(element: Sql, where: Where) -> Sql:
    return f"(coalesce({J.get(element, *where.field)}, 'null') RLIKE {V.quote(where.regex)})"


def _matches_in_text(node: AtMatches, leaf: Leaf, missing: Sql) -> Leaf:
    inner = _below_in_text(node.child, leaf, missing)

    def change(document: Sql) -> Sql:
        def results(items: Sql) -> Sql:
            return V.each(
                f"CASE WHEN size({items}) = 0 THEN array({document}) ELSE {items} END",
                lambda e: f"CASE WHEN size({items}) = 0 OR {hit_text(e, node.where)} THEN {inner(e)} END",
            )

        def collect(items: Sql, found: Sql) -> Sql:
            failed = V.first(V.where(found, lambda r: f"{r}.err IS NOT NULL"))
            element, i = V.fresh(), V.fresh("i")
            rebuilt = J.array_of(f"transform({items}, ({element}, {i}) -> coalesce({found}[{i}].v, {element}))")
            return (
                f"CASE WHEN NOT {V.any_of(found, lambda r: f'{r} IS NOT NULL')} THEN {J.fail(missing)}"
                f" WHEN {V.any_of(found, lambda r: f'{r}.err IS NOT NULL')} THEN {failed}"
                f" WHEN size({items}) = 0 THEN {found}[0] ELSE {V.ok(rebuilt)} END"
            )

        return V.let(_items_in_text(document), lambda items: V.let(results(items), lambda found: collect(items, found)))

    return change


def read_text(text: Sql, path: str | Node | None) -> Sql:
    """`read` of JSON text (one whole value): the text at the path as it stands, NULL when it is not there."""
    node = _node(path)
    steps: list[str | int] = []
    while node is not None:
        if isinstance(node, AtItem):
            steps.append(node.index)
        elif isinstance(node, AtField):
            steps.append(node.name)
            if node.codec:
                return V.let(V.let(J.get(text, *steps), J.string), lambda c, n=node: encoded_as_text(c, n.codec, n.child))
        elif isinstance(node, AtPair):
            return _read_pair_text(J.get(text, *steps, node.list_name), node)
        else:
            return V.let(J.get(text, *steps), lambda d, n=node: _read_matches_text(d, n))
        node = node.child
    return J.get(text, *steps)


def encoded_as_text(content: Sql, codec: str, child: Node | None) -> Sql:
    """Text at a path of the document that an encoded content holds."""
    return V.let(
        b64_decode(content) if codec == "base64" else content,
        lambda plain: f"CASE WHEN {V.is_json(plain)} THEN {read_text(plain, child)} END",
    )


def _read_pair_text(pairs: Sql, node: AtPair) -> Sql:
    def value_of(items: Sql) -> Sql:
        named = V.where(items, lambda p: f"({_name_in_text(p)} <=> {V.quote(node.name)})")
        value = J.get(V.first(named), "value")
        if node.codec:
            return V.let(V.let(value, J.string), lambda c: encoded_as_text(c, node.codec, node.child))
        return value if node.child is None else V.let(value, lambda v: read_text(v, node.child))

    return V.let(pairs, lambda list_: V.let(_items_in_text(list_), value_of))


def _read_matches_text(document: Sql, node: AtMatches) -> Sql:
    def last(items: Sql) -> Sql:
        hits = V.where(items, lambda e: hit_text(e, node.where))
        return V.let(hits if node.child is None else V.each(hits, lambda e: read_text(e, node.child)), last_of_all)

    return V.let(
        _items_in_text(document),
        lambda items: f"CASE WHEN size({items}) > 0 THEN {last(items)} ELSE {read_text(document, node.child)} END",
    )


def read_printed(document: Sql, path: str | Node | None) -> Sql:
    """JSON text of the value at a path of a VARIANT. Below the first encoded text on the way it is the text as it stands."""
    node = _node(path)
    steps: list[str | int] = []
    while node is not None:
        if isinstance(node, AtItem):
            steps.append(node.index)
        elif isinstance(node, AtField):
            steps.append(node.name)
            if node.codec:
                return _encoded_printed(V.get(document, *steps), node.codec, node.child)
        elif isinstance(node, AtPair):
            named = V.where(V.as_array(V.get(document, *steps, node.list_name)), lambda p, n=node: _named(p, n.name))
            value = V.get(V.first(named), "value")
            if node.codec:
                return _encoded_printed(value, node.codec, node.child)
            return V.let(value, lambda v, n=node: read_printed(v, n.child))
        else:
            return V.let(V.get(document, *steps), lambda d, n=node: _matches_printed(d, n))
        node = node.child
    return V.text(V.get(document, *steps))


def _encoded_printed(value: Sql, codec: str, child: Node | None) -> Sql:
    content = V.let(value, lambda x: f"CASE WHEN {V.is_string(x)} THEN {V.string(x)} END")
    return V.let(content, lambda c: encoded_as_text(c, codec, child))


def _matches_printed(document: Sql, node: AtMatches) -> Sql:
    def last(items: Sql) -> Sql:
        values = V.each(V.where(items, lambda e: hit(e, node.where)), lambda e: read_printed(e, node.child))
        return V.let(values, last_of_all)

    return V.let(
        V.items_or_none(document),
        lambda items: f"CASE WHEN size({items}) > 0 THEN {last(items)} ELSE {read_printed(document, node.child)} END",
    )


def _pair_change(node: AtPair, leaf: Leaf, missing: Sql) -> Leaf:
    """Edit the value of the first pair with a name; works on the list of pairs."""
    if node.codec:
        change = encoded_change(node.codec, node.child, leaf, missing)
    else:
        change = below(node.child, leaf, missing)

    def in_pairs(pairs: Sql, position: Sql) -> Sql:
        def at_value(value: Sql) -> Sql:
            def rebuilt(new: Sql) -> Sql:
                pair, i = V.fresh(), V.fresh("i")
                return V.ok(
                    f"to_variant_object(transform({pairs}, ({pair}, {i}) ->"
                    f" CASE WHEN {i} = {position} - 1 THEN {V.put(pair, ('value',), new)} ELSE {pair} END))"
                )

            return f"CASE WHEN {value} IS NULL THEN {V.fail(missing)} ELSE {V.then(change(value), rebuilt)} END"

        return V.let(V.get(f"{pairs}[{position} - 1]", "value"), at_value)

    def by_name(value: Sql) -> Sql:
        if node.last:
            reason = Known(f"Cannot access field {node.list_name}")
            unknown = V.fail(failure("InvalidDataFormat", V.text(value), reason))
        else:
            unknown = V.fail(missing)

        def in_list(pairs: Sql) -> Sql:
            hits = V.each(pairs, lambda p: _named(p, node.name))
            return V.let(
                f"CAST(coalesce(array_position({hits}, true), 0) AS INT)",
                lambda n: f"CASE WHEN {n} = 0 THEN {unknown} ELSE {in_pairs(pairs, n)} END",
            )

        return V.let(V.as_array(value), in_list)

    return by_name


def _matches_change(node: AtMatches, leaf: Leaf, missing: Sql) -> Leaf:
    """Every matching element is edited; a document that is no filled array stands for itself."""
    inner = below(node.child, leaf, missing)

    def change(document: Sql) -> Sql:
        def results(items: Sql) -> Sql:
            return V.each(
                f"CASE WHEN size({items}) = 0 THEN array({document}) ELSE {items} END",
                lambda e: f"CASE WHEN size({items}) = 0 OR {hit(e, node.where)} THEN {inner(e)} END",
            )

        def collect(items: Sql, found: Sql) -> Sql:
            failed = V.first(V.where(found, lambda r: f"{r}.err IS NOT NULL"))
            element, i = V.fresh(), V.fresh("i")
            rebuilt = f"to_variant_object(transform({items}, ({element}, {i}) -> coalesce({found}[{i}].v, {element})))"
            return (
                f"CASE WHEN NOT {V.any_of(found, lambda r: f'{r} IS NOT NULL')} THEN {V.fail(missing)}"
                f" WHEN {V.any_of(found, lambda r: f'{r}.err IS NOT NULL')} THEN {failed}"
                f" WHEN size({items}) = 0 THEN {found}[0] ELSE {V.ok(rebuilt)} END"
            )

        return V.let(
            V.items_or_none(document), lambda items: V.let(results(items), lambda found: collect(items, found))
        )

    return change
