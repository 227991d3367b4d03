"""Secret scans: all rules in one byte pass of a combined minimal automaton."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.automaton import Rule, Scanner
from llm.columns import flat, over_chunks

#: The three base rules.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=\-]", least_body=6, any_case=True),
    Rule("access", "AKIA", "[A-Z0-9]", least=20),
    Rule("hex", "", "[0-9a-f]", least=24),
)
#: Rules beyond the base: prefixed tokens of code hosts and chat services, and signed web tokens.
MORE = (
    Rule("host_token", "gh[pousr]_", "[A-Za-z0-9]", least_body=36),
    Rule("chat_token", "xox[abprs]-", r"[A-Za-z0-9\-]", least_body=20),
    Rule("web_token", "eyJ", r"[A-Za-z0-9_.\-]", least=60),
)
RULES = BASE + MORE


@functools.cache
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(list(rules))


def _spans(texts: pa.Array, scan: Scanner) -> list[list[tuple[int, int, int]]]:
    """(start, rule, end) in code points for each row, by start, then rule."""
    data, offsets = flat(texts)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    before: dict[int, np.ndarray] = {}
    for i, found in enumerate(scan.find(data, offsets)):
        for row, start, end, _ in found:
            if row not in before:
                own = data[offsets[row] : offsets[row + 1]]
                before[row] = np.r_[0, np.cumsum((own & 0xC0) != 0x80)]
            spans[row].append((int(before[row][start]), i, int(before[row][end])))
    return [sorted(x) for x in spans]


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key, spans array<struct<kind, start, end>> for every row, in code points, ordered by start, then by the rules' order.

    Null and empty texts have no spans. A text of any length is read whole; repeated rows come out once each. Spans of
    one rule do not overlap, those of different rules may."""
    kind = next(t for n, t in docs.dtypes if n == key)
    scan = scanner(rules)  # compiled once here, sent with the tasks

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        spans = _spans(chunk.column("text"), scan)
        return {"key": chunk.column("key"), "spans": [[{"kind": rules[i].name, "start": a, "end": b} for a, i, b in x] for x in spans]}

    out = over_chunks(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), ["key", "text"], work, f"key {kind}, spans array<struct<kind:string,start:long,end:long>>")
    return out.withColumnRenamed("key", key)


def secret_digests(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the base kinds, the base spans' SHA-256, and all spans as text."""

    def listed(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"

    base = "filter(spans, s -> s.kind IN ('assign', 'access', 'hex'))"
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{r.name}')) AS BIGINT) AS n_{r.name}") for r in BASE]
    return find_secrets(docs).select("doc_id", *counts, F.expr(f"sha2({listed(base)}, 256) AS base_sha256"), F.expr(f"{listed('spans')} AS spans"))


def redact_secrets(docs: DataFrame, mark: str = "<{}>") -> DataFrame:
    """The same rows and columns; each run of overlapping spans in `text` becomes a mark that names its first kind.

    Rows without a finding, null texts too, come out as they were."""
    names = docs.columns
    scan = scanner(RULES)

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        texts = chunk.column("text")
        found = _spans(texts, scan)
        if any(found):
            new = texts.to_pylist()
            for row, spans in enumerate(found):
                if not spans:
                    continue
                text, parts, at = new[row], [], 0
                for start, i, end in spans:
                    if start >= at:
                        parts += [text[at:start], mark.format(RULES[i].name)]
                    at = max(at, end)
                new[row] = "".join([*parts, text[at:]])
            texts = pa.array(new, texts.type)
        return {n: texts if n == "text" else chunk.column(n) for n in names}

    return over_chunks(docs, names, work, docs.schema)
