"""Recovery configuration: schema patterns to flows of conditions and steps.

The configuration is small and is read on the driver; everything in it ends up
as constants inside the plan.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from ..functions.schema_keys import SchemaPattern
from ..operators.edits import CAST_TYPES, json_value
from .patterns import is_exponential

_FLOW_NAME = re.compile(r"^[a-zA-Z0-9]+(-[a-zA-Z0-9]+)*-?$")


class ConfigError(ValueError):
    """The configuration does not have the expected structure."""


@dataclass(frozen=True)
class Compare:
    value: Any


@dataclass(frozen=True)
class Regex:
    regex: str


@dataclass(frozen=True)
class Size:
    op: str  # eq, gt or lt
    limit: int


Matcher = Compare | Regex | Size


@dataclass(frozen=True)
class Condition:
    path: str
    matcher: Matcher


@dataclass(frozen=True)
class Replace:
    path: str
    value: Any
    match: str | None = None


@dataclass(frozen=True)
class Remove:
    path: str
    match: str | None = None


@dataclass(frozen=True)
class Cast:
    path: str
    from_type: str
    to_type: str


@dataclass(frozen=True)
class Add:
    path: str
    value: Any


Step = Replace | Remove | Cast | Add


@dataclass(frozen=True)
class Flow:
    pattern: str
    name: str
    conditions: tuple[Condition, ...] = ()
    steps: tuple[Step, ...] = ()

    @property
    def row_type(self) -> str:
        """Row type this flow is for; a pattern has no wildcard in its name."""
        key = SchemaPattern.parse(self.pattern)
        return key.name if key else ""


@dataclass(frozen=True)
class Config:
    flows: tuple[Flow, ...]

    @property
    def patterns(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(f.pattern for f in self.flows))


def check_patterns(config: Config, spark: SparkSession) -> None:
    """Compile every regular expression with the engine that will run it, and hold replacements against its groups.

    What does not compile raises `ConfigError` here, on the driver, and not in a
    task; so does a pattern that one line could hold a task with for ever. Paths
    that name nothing are refused as well.
    """
    java = spark._jvm.java.util.regex.Pattern

    def compiled(regex: str, where: str) -> Any:
        try:
            found = java.compile(regex)
        except Exception as e:
            raise ConfigError(f"{where}: not a pattern: {regex}") from e
        if is_exponential(regex):
            raise ConfigError(f"{where}: matching may take exponential time: {regex}")
        return found

    def path(text: str, where: str) -> None:
        segments = _path_parts(text)
        if not segments:
            raise ConfigError(f"{where}: names nothing: {text}")
        for regex in segments:
            if regex is not None:
                compiled(regex, where)

    for flow in config.flows:
        for condition in flow.conditions:
            path(condition.path, f"{flow.name}, condition")
            if isinstance(condition.matcher, Regex):
                compiled(condition.matcher.regex, f"{flow.name}, {condition.path}")
        for step in flow.steps:
            where = f"{flow.name}, {step.path}"
            path(step.path, where)
            if isinstance(step, (Replace, Remove)) and step.match is not None:
                found = compiled(step.match, where)
                value = step.value if isinstance(step, Replace) else ""
                if isinstance(value, str):
                    _check_replacement(value, found.matcher("").groupCount(), step.match, where)


def _check_replacement(value: str, groups: int, regex: str, where: str) -> None:
    """A `$` has to name a group of the pattern, a backslash has to stand before the character it escapes."""
    at = 0
    while at < len(value):
        if value[at] == "\\":
            if at + 1 == len(value):
                raise ConfigError(f"{where}: the value ends in a backslash")
            at += 2
        elif value[at] == "$":
            rest = value[at + 1 :]
            named = re.match(r"\{([A-Za-z][A-Za-z0-9]*)\}", rest)
            if named and f"(?<{named[1]}>" not in regex or not named and not (rest[:1].isascii() and rest[:1].isdigit() and int(rest[0]) <= groups):
                raise ConfigError(f"{where}: `$` names no group of {regex}")
            at += 2
        else:
            at += 1


def _path_parts(text: str) -> list[str | None]:
    """One item per segment of a path: its regular expression, if it filters."""
    from ..operators.paths import Where, tokenize

    return [s.regex if isinstance(s, Where) else None for s in tokenize(text)]


def load_config(text: str) -> Config:
    """Configuration from its JSON text `{schema, data: {pattern: [flow, ...]}}`."""
    try:
        document = json.loads(text)
    except json.JSONDecodeError as e:
        raise ConfigError(f"not JSON: {e}") from e
    body = _member(document, "data", dict, "$")
    _member(document, "schema", str, "$")
    flows: list[Flow] = []
    for pattern, listed in body.items():
        if SchemaPattern.parse(pattern) is None:
            raise ConfigError(f"not a schema pattern: {pattern}")
        if not isinstance(listed, list):
            raise ConfigError(f"{pattern}: expected a list of flows")
        flows += [_flow(pattern, f, f"{pattern}[{i}]") for i, f in enumerate(listed)]
    return Config(tuple(flows))


def _member(owner: Any, name: str, kind: type | tuple[type, ...], where: str) -> Any:
    if not isinstance(owner, dict) or name not in owner:
        raise ConfigError(f"{where}: missing {name}")
    if not isinstance(owner[name], kind) or (kind is int and isinstance(owner[name], bool)):
        raise ConfigError(f"{where}.{name}: wrong type")
    return owner[name]


def _flow(pattern: str, spec: Any, where: str) -> Flow:
    name = _member(spec, "name", str, where)
    if not _FLOW_NAME.match(name):
        raise ConfigError(f"{where}.name: letters, digits and single dashes only")
    return Flow(
        pattern,
        name,
        tuple(
            _condition(c, f"{where}.conditions[{i}]")
            for i, c in enumerate(_member(spec, "conditions", list, where))
        ),
        tuple(_step(s, f"{where}.steps[{i}]") for i, s in enumerate(_member(spec, "steps", list, where))),
    )


def _condition(spec: Any, where: str) -> Condition:
    if _member(spec, "op", str, where) != "Test":
        raise ConfigError(f"{where}.op: expected Test")
    value = _member(spec, "value", dict, where)
    path = _member(spec, "path", str, where)
    if "regex" in value:
        return Condition(path, Regex(_member(value, "regex", str, where)))
    if "size" in value:
        size = _member(value, "size", dict, where)
        for op in ("eq", "gt", "lt"):
            if op in size:
                return Condition(path, Size(op, _member(size, op, int, where)))
        raise ConfigError(f"{where}.value.size: expected eq, gt or lt")
    if "value" in value:
        return Condition(path, Compare(json_value(value["value"])))
    raise ConfigError(f"{where}.value: expected regex, size or value")


def _step(spec: Any, where: str) -> Step:
    op = _member(spec, "op", str, where)
    path = _member(spec, "path", str, where)
    match = spec.get("match")
    if match is not None and not isinstance(match, str):
        raise ConfigError(f"{where}.match: wrong type")
    if op == "Remove":
        return Remove(path, match)
    if op == "Cast":
        from_type, to_type = _member(spec, "from", str, where), _member(spec, "to", str, where)
        if from_type not in CAST_TYPES or to_type not in CAST_TYPES:
            raise ConfigError(f"{where}: cast types are {', '.join(CAST_TYPES)}")
        return Cast(path, from_type, to_type)
    if op not in ("Replace", "Add"):
        raise ConfigError(f"{where}.op: unknown step {op}")
    if "value" not in spec:
        raise ConfigError(f"{where}: missing value")
    value = json_value(spec["value"])
    return Replace(path, value, match) if op == "Replace" else Add(path, value)
