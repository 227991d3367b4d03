"""Records for a message sink in batches of bounded number and size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: What a sink of small messages takes in one request.
MOST_RECORDS, MOST_BYTES = 500, 4 << 20


class _Filling:
    """The batch that is being filled, from row to row."""

    def __init__(self, most_records: int, most_bytes: int) -> None:
        self.most_records, self.most_bytes = most_records, most_bytes
        self.batch = self.count = self.held = 0

    def restart(self) -> None:
        self.batch = self.count = self.held = 0

    def numbers(self, sizes: np.ndarray) -> np.ndarray:
        """The batch of each of the next records. One step for each batch, not for each record."""
        ends, out, at = np.cumsum(sizes), np.empty(len(sizes), np.int64), 0
        while at < len(sizes):
            before = int(ends[at - 1]) if at else 0
            fit = int(np.searchsorted(ends, before + self.most_bytes - self.held, "right"))
            to = min(at + self.most_records - self.count, fit)
            if to <= at and not self.count:
                to = at + 1  # larger than a batch may be: it is one by itself
            if to > at:
                out[at:to] = self.batch
                self.count += to - at
                self.held += int(ends[to - 1]) - before
                at = to
            if at < len(sizes):
                self.batch += 1
                self.count = self.held = 0
        return out


def message_batches(records: DataFrame, most_records: int = MOST_RECORDS, most_bytes: int = MOST_BYTES, column: str = "value", within: str | None = None) -> DataFrame:
    """Add `batch`: the records in their order, each in the batch of the one before while that holds `most_records` and
    `most_bytes` of `column` at most; a record that is larger makes a batch of its own.

    Within each partition as it is, so nothing is shuffled; numbers start at 0 in each, and with `within` wherever that
    column changes. A null has no bytes."""
    if most_records < 1:
        raise ValueError("a batch holds one record at least")
    shape = T.StructType([*records.schema.fields, T.StructField("batch", T.LongType())])

    def number(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filling, last = _Filling(most_records, most_bytes), None
        for some in rows:
            sizes = pc.fill_null(pc.binary_length(some.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = [0, some.num_rows]
            if within is not None and some.num_rows:
                keys = some.column(within)
                changed = pc.fill_null(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)), False).to_numpy(zero_copy_only=False)
                nulls = pc.is_null(keys).to_numpy(zero_copy_only=False)
                cuts = [0, *(np.flatnonzero(changed | (nulls[1:] != nulls[:-1])) + 1).tolist(), some.num_rows]
            found = [np.zeros(0, np.int64)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if within is not None and b > a:
                    key = (some.column(within)[a].as_py(),)
                    if key != last:
                        filling.restart()
                    last = key
                found.append(filling.numbers(sizes[a:b]))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(np.concatenate(found))], names=[*some.schema.names, "batch"])

    return records.mapInArrow(number, shape)
