"""Base64 text codec."""

from __future__ import annotations

from .variants import Sql, let


def b64_decode_bytes(encoded: Sql) -> Sql:
    """Bytes of standard or url-safe base64, padding optional; NULL when malformed."""
    return let(
        encoded,
        lambda e: (
            f"CASE WHEN {e} RLIKE '^[A-Za-z0-9+/_-]*={{0,2}}\\u0024'"
            f" THEN try_to_binary(replace(replace({e}, '-', '+'), '_', '/'), 'base64') END"
        ),
    )


def b64_decode(encoded: Sql) -> Sql:
    """Text of base64; invalid UTF-8 becomes the replacement character."""
    return f"make_valid_utf8(CAST({b64_decode_bytes(encoded)} AS STRING))"


def b64_encode(plain: Sql) -> Sql:
    """Standard alphabet, padded, on a single line. (`replace` looks for bytes; `translate` makes a string of each character.)"""
    return f"replace(base64(CAST({plain} AS BINARY)), '\\r\\n', '')"
