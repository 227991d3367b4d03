"""Steps: rewrites of one place in a document, and chains of them.

A chain is a list of projections, one per step, that hand on the document and
the first error. Nesting the rewrites in one expression instead would copy the
document expression into every place that mentions it.
"""

from __future__ import annotations

import dataclasses
import itertools
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V
from ..functions.errors import Known
from ..functions.variants import Sql
from ..plans.config import Add, Cast, Compare, Config, Flow, Remove, Replace, Step
from . import access, edits
from .paths import AtPair, Change, Leaf, Many, edit
from .payloads import EVENT_FIELDS, known_shape, payload_struct

_STATE = "_state"


def _change(step: Step, zero_is_false: bool) -> tuple[Change, Sql]:
    """What a step does to the value at its path, and its error for a path that leads nowhere."""
    if isinstance(step, Remove):
        step = Replace(step.path, "", step.match)
    if isinstance(step, Replace):
        missing = edits.replacement_failure(Known(step.path), step.value, step.match)
        change = Change(lambda x: edits.replaced(x, step.value, step.match), lambda x: edits.replaced_text(x, step.value, step.match))
        return change, missing
    if isinstance(step, Cast):
        missing = edits.cast_failure(Known(step.path), step.from_type, step.to_type)
        kinds = (step.from_type, step.to_type, zero_is_false)
        return Change(lambda x: edits.casted(x, *kinds), lambda x: edits.casted_text(x, *kinds)), missing
    change = Change(lambda x: edits.added(x, step.value), lambda x: edits.added_text(x, step.value))
    return change, edits.addition_failure(step.path, step.value)


# --- steps on any VARIANT column ------------------------------------------------


def apply_steps(
    frame: DataFrame, steps: list[Step] | tuple[Step, ...], column: str = "document", zero_is_false: bool = False
) -> DataFrame:
    """Apply steps in order to a VARIANT column; the first error of a row ends its chain (column `err`)."""
    err = "err" if "err" in frame.columns else V.NO_ERROR
    staged = frame.withColumn(_STATE, F.expr(f"named_struct('v', {column}, 'err', {err})"))
    for step in steps:
        change, missing = _change(step, zero_is_false)
        outcome = V.let(
            edit(f"{_STATE}.v", step.path, change, missing),
            lambda r: f"CASE WHEN {r}.err IS NULL THEN {r} ELSE named_struct('v', {_STATE}.v, 'err', {r}.err) END",
        )
        staged = staged.withColumn(_STATE, F.expr(f"CASE WHEN {_STATE}.err IS NULL THEN {outcome} ELSE {_STATE} END"))
    return staged.withColumns({column: F.expr(f"{_STATE}.v"), "err": F.expr(f"{_STATE}.err")}).drop(_STATE)


# --- steps on the typed payload -------------------------------------------------


def apply_flows(events: DataFrame, config: Config, zero_is_false: bool = False) -> DataFrame:
    """Apply to each row the steps of all its matched flows, in configured order.

    A flow starts in the round after the last step of the flows before it that
    may match the same row. Flows of different row types, and flows that compare
    one path with different values, cannot, so they share rounds: the number of
    projections is that of the longest chain, not of all steps together. Within a
    round, steps that differ in their values alone are one expression whose values
    come from a constant map by the flow that the row matched, so the plan grows
    with the different operations and paths, not with the flows. Steps that follow
    each other into one encoded document open it once.
    """
    rounds: list[list[tuple[str, int, Step | Together]]] = []
    ends: list[int] = []
    chains = [_chain(f.steps, f.row_type) for f in config.flows]
    for i, flow in enumerate(config.flows):
        start = max((end for end, other in zip(ends, config.flows) if not exclusive(flow, other)), default=0)
        ends.append(start + len(chains[i]))
        rounds += [[] for _ in range(ends[-1] - len(rounds))]
        for n, step in enumerate(chains[i]):
            rounds[start + n].append((flow.row_type, i, step))
    for round_ in rounds:
        events = _advance(events, round_, zero_is_false)
    return events


# --- steps as data ----------------------------------------------------------------


@dataclasses.dataclass(frozen=True)
class Together:
    """Steps of one flow into the document that one pair holds, in their order."""

    steps: tuple[Step, ...]


def _document(step: Step, row_type: str) -> tuple[str, ...] | None:
    """The encoded document that a step edits within, by the pair that holds it."""
    place = access.locate(step.path, known_shape(row_type, repaired=True))
    node = place.node if place is not None and place.field is not None else None
    return (node.list_name, node.name, node.codec) if isinstance(node, AtPair) and node.codec and node.child is not None else None


def _chain(steps: tuple[Step, ...], row_type: str) -> list[Step | Together]:
    """The steps, with those next to each other that edit one encoded document put together: it is decoded and encoded once.

    Order and the first error stay: a step sees what the one before has made, and none runs after one that failed. A row that
    fails keeps the document as it was before all of them; its error row is made from the line."""
    out: list[Step | Together] = []
    for document, some in itertools.groupby(steps, lambda s: _document(s, row_type)):
        listed = tuple(some)
        out += [Together(listed)] if document and len(listed) > 1 else listed
    return out


def _alike(step: Step | Together) -> tuple[Any, ...]:
    """What steps must share to become one: the operation, the path and all that shapes the expression. Values may differ."""
    if isinstance(step, Together):
        return Together, *map(_alike, step.steps)
    if isinstance(step, Cast):
        return Cast, step.path, step.from_type, step.to_type
    value = "" if isinstance(step, Remove) else step.value
    kind = edits.kind_of(value)
    shape = kind if kind in ("s", "d", "b") else V.literal_text(value)
    return type(step), step.path, kind, shape, getattr(step, "match", None) is None


def _by_flow(flows: list[int], texts: list[str], pick: Sql) -> Sql:
    """The text that belongs to the flow that was picked: one constant map, however many flows there are."""
    entries = ", ".join(f"{f}, {V.quote(t)}" for f, t in zip(flows, texts, strict=True))
    return f"element_at(map({entries}), {pick})"


def _merged(flows: list[int], steps: list[Step] | list[Together], pick: Sql, n: str) -> tuple[Step | Together, dict[str, Sql]]:
    """One step for all of them, and the columns, numbered n, that hold its values; those that do not differ stay constants."""
    if isinstance(steps[0], Together):
        parts = [_merged(flows, list(some), pick, f"{n}_{k}") for k, some in enumerate(zip(*(s.steps for s in steps), strict=True))]
        return Together(tuple(step for step, _ in parts)), {name: sql for _, columns in parts for name, sql in columns.items()}
    columns: dict[str, Sql] = {}
    params: dict[str, edits.Param] = {}
    for field in ("value", "match"):
        values = [getattr(s, field, None) for s in steps]
        texts = [V.literal_text(v) for v in values]
        if len(set(texts)) > 1:
            kind, text, held = edits.kind_of(values[0]), f"_{field}{n}", f"_{field}_held{n}"
            columns[text] = _by_flow(flows, texts, pick)
            if kind == "s":
                columns[held] = _by_flow(flows, values, pick)
            params[field] = edits.Param(kind, text, held if kind == "s" else "NULL")
    return dataclasses.replace(steps[0], **params) if params else steps[0], columns


def exclusive(a: Flow, b: Flow) -> bool:
    """Whether no row can match both: of different types, or one path compared with different values."""
    if a.row_type != b.row_type:
        return True
    compared = {c.path: c.matcher.value for c in a.conditions if isinstance(c.matcher, Compare)}
    return any(
        isinstance(c.matcher, Compare) and c.path in compared and c.matcher.value != compared[c.path] for c in b.conditions
    )


def apply_payload_steps(events: DataFrame, steps: list[Step], row_type: str, zero_is_false: bool = False) -> DataFrame:
    """Apply steps to the typed payload of rows of one type, whatever flows they match."""
    none = "CAST(array() AS ARRAY<INT>)"
    staged = events.withColumn("matched", F.expr(f"CASE WHEN row_type <=> {V.quote(row_type)} THEN array(0) ELSE {none} END"))
    for step in steps:
        staged = _advance(staged, [(row_type, 0, step)], zero_is_false)
    return staged


def _advance(events: DataFrame, round_: list[tuple[str, int, Step | Together]], zero_is_false: bool) -> DataFrame:
    """One step per row type, on rows that matched its flow and have no error yet. No row has steps of two flows in one round."""
    groups: dict[tuple[Any, ...], list[tuple[int, Step | Together]]] = {}
    for row_type, flow, step in round_:
        groups.setdefault((row_type, *_alike(step)), []).append((flow, step))
    results: dict[str, Sql] = {}
    by_slot: dict[str, list[str]] = {}
    picks: dict[str, Sql] = {}
    values: dict[str, Sql] = {}
    for n, (key, members) in enumerate(groups.items()):
        row_type, name = key[0], f"_result{n}"
        flows = [f for f, _ in members]
        if len(members) == 1:
            step, is_for = members[0][1], f"array_contains(matched, {flows[0]})"
        else:
            pick = f"_pick{n}"
            picks[pick] = f"try_element_at(array_intersect(matched, array({', '.join(map(str, flows))})), 1)"
            step, columns = _merged(flows, [s for _, s in members], pick, str(n))
            is_for = f"{pick} IS NOT NULL"
            values |= columns
        shape = known_shape(row_type, repaired=True)
        first, *more = step.steps if isinstance(step, Together) else (step,)
        change, missing = _change(first, zero_is_false)
        place = access.locate(first.path, shape)
        if more:
            inside = [(access.locate(s.path, shape).node.child, *_change(s, zero_is_false)) for s in (first, *more)]
            place = dataclasses.replace(place, node=dataclasses.replace(place.node, child=Many(tuple(inside))))
        if place is None:
            outcome = V.fail(missing)
        else:
            outcome = access.edit(place, shape, change, missing)
            by_slot.setdefault(place.slot, []).append(name)
        results[name] = f"CASE WHEN err IS NULL AND {is_for} THEN {outcome} END"
    for made in (picks, values):
        if made:
            events = events.withColumns({name: F.expr(sql) for name, sql in made.items()})

    def chosen(slot: str, kept: Sql) -> Sql:
        done = [f"WHEN {r} IS NOT NULL AND {r}.err IS NULL THEN {r}.v" for r in by_slot[slot]]
        return f"CASE {' '.join(done)} ELSE {kept} END"

    fields = {n: chosen(n, f"payload.{n}") if n in by_slot else f"payload.{n}" for n in EVENT_FIELDS}
    # A row that no step of the round is for keeps its payload as it is, not a copy of it.
    touched = " OR ".join(f"{r} IS NOT NULL" for r in results)
    payload = f"CASE WHEN payload IS NOT NULL AND ({touched}) THEN {payload_struct(**fields)} ELSE payload END"
    if access.WHOLE in by_slot:
        payload = chosen(access.WHOLE, payload)
    return (
        events.withColumns({name: F.expr(sql) for name, sql in results.items()})
        .withColumns(
            {
                "payload": F.expr(payload),
                "err": F.expr(V.opaque(f"coalesce(err, {', '.join(f'{r}.err' for r in results)})")),
            }
        )
        .drop(*results, *picks, *values)
    )



def edit_path(frame: DataFrame, path: str, change: Leaf, missing: Sql, column: str = "document") -> DataFrame:
    """Apply any expression at a path of a VARIANT column; an error is left in `err`."""
    return (
        frame.withColumn(_STATE, F.expr(edit(column, path, change, missing)))
        .withColumns({column: F.expr(f"coalesce({_STATE}.v, {column})"), "err": F.expr(f"{_STATE}.err")})
        .drop(_STATE)
    )


def replace(frame: DataFrame, path: str, value: Any, match: str | None = None, column: str = "document") -> DataFrame:
    return apply_steps(frame, [Replace(path, value, match)], column)


def remove(frame: DataFrame, path: str, match: str | None = None, column: str = "document") -> DataFrame:
    return apply_steps(frame, [Remove(path, match)], column)


def cast(
    frame: DataFrame, path: str, from_: str, to: str, column: str = "document", zero_is_false: bool = False
) -> DataFrame:
    return apply_steps(frame, [Cast(path, from_, to)], column, zero_is_false)


def add(frame: DataFrame, path: str, value: Any, column: str = "document") -> DataFrame:
    return apply_steps(frame, [Add(path, value)], column)
