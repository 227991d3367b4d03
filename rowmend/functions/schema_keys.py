"""Schema keys: `iglu:vendor/name/format/model-revision-addition`."""

from __future__ import annotations

import re
from dataclasses import dataclass

from .variants import Sql, let, quote

# Fixed value: the pattern of a schema key whose version parts may be `*`.
SCHEMA_KEY = r"^iglu:([a-zA-Z0-9_.-]+)/([a-zA-Z0-9_-]+)/([a-zA-Z0-9_-]+)/([0-9]+|\*)-([0-9]+|\*)-([0-9]+|\*)$"
# Fixed value: the pattern of a complete schema key.
FULL_KEY = r"^iglu:[a-zA-Z0-9_.-]+/[a-zA-Z0-9_-]+/[a-zA-Z0-9_-]+/[1-9][0-9]*-(0|[1-9][0-9]*)-(0|[1-9][0-9]*)$"

PARTS = ("vendor", "name", "format", "model", "revision", "addition")


@dataclass(frozen=True)
class SchemaPattern:
    vendor: str
    name: str
    format: str
    model: str
    revision: str
    addition: str

    @staticmethod
    def parse(uri: str) -> "SchemaPattern | None":
        found = re.match(SCHEMA_KEY, uri)
        return SchemaPattern(*found.groups()) if found else None


def schema_key(uri: Sql) -> Sql:
    """The six parts as a struct; NULL when the text is not a schema key."""
    # A key that fits has no other `/` than those between its parts, and no `-` in its version but two.
    def parts(s: Sql) -> Sql:
        named = [f"'{p}', {s}[{i}]" for i, p in enumerate(PARTS[:3])]
        versions = let(f"split({s}[3], '-')", lambda v: "named_struct(" + ", ".join([*named, *(f"'{p}', {v}[{i}]" for i, p in enumerate(PARTS[3:]))]) + ")")
        return versions

    return f"CASE WHEN {uri} RLIKE {quote(SCHEMA_KEY)} THEN {let(f"split(substring({uri}, 6), '/')", parts)} END"


def is_full_key(uri: Sql) -> Sql:
    return f"coalesce({uri} RLIKE {quote(FULL_KEY)}, false)"


def schema_name(uri: Sql) -> Sql:
    """Name part, NULL when the text is not a schema key."""
    return f"nullif(regexp_extract({uri}, {quote(SCHEMA_KEY)}, 2), '')"


def schema_matches(uri: Sql, pattern: str) -> Sql:
    """Whether a schema key fits a configured pattern; `*` on either side fits any version part.

    The pattern is known when the plan is built, so the test is one regular
    expression. A malformed pattern or key never matches.
    """
    key = SchemaPattern.parse(pattern)
    if key is None:
        return "false"
    head = "/".join(re.escape(p) for p in (key.vendor, key.name, key.format))
    versions = "-".join(
        r"([0-9]+|\*)" if part == "*" else rf"({part}|\*)" for part in (key.model, key.revision, key.addition)
    )
    return f"coalesce({uri} RLIKE {quote(f'^iglu:{head}/{versions}$')}, false)"


def schema_keys_match(left: Sql, right: Sql) -> Sql:
    """The same rule for two columns."""

    def compare(s: Sql) -> Sql:
        a, b = f"{s}.a", f"{s}.b"
        same = [f"{a}.{p} = {b}.{p}" for p in PARTS[:3]]
        fits = [f"({a}.{p} = {b}.{p} OR {a}.{p} = '*' OR {b}.{p} = '*')" for p in PARTS[3:]]
        return f"coalesce({' AND '.join(same + fits)}, false)"

    return let(f"named_struct('a', {schema_key(left)}, 'b', {schema_key(right)})", compare)
