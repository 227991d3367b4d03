"""Errors as expressions: a code and the message text that goes with it."""

from __future__ import annotations

from .. import wire
from . import variants as V


class Known(str):
    """Message part known when the plan is built (any other part is an expression)."""


def failure(code: str, *parts: str) -> V.Sql:
    """struct<code, message> with the message of `code` filled in."""
    template = wire.MESSAGES[code]
    shown = tuple(p.replace("%", "%%") if isinstance(p, Known) else "%s" for p in parts)
    filled = template % shown
    open_parts = [p for p in parts if not isinstance(p, Known)]
    if not open_parts:
        return V.error(code, V.quote(filled.replace("%%", "%")))
    return V.error(code, f"format_string({V.quote(filled)}, {', '.join(open_parts)})")
