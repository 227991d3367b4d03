"""Arrow text columns as flat byte arrays, and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of text that a task works on at once. A longer text makes a chunk of its own.
CHUNK_BYTES = 4 << 20


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `limit` bytes of text each; every row comes once, in order."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if end > start:
                yield batch.slice(start, end - start)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and the n + 1 offsets of the rows in it. Null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, index, data = texts.buffers()
    offsets = np.frombuffer(index, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(texts: pa.Array) -> list[str]:
    return [x or "" for x in texts.to_pylist()]


def over_chunks(docs: DataFrame, columns: list[str], work: Callable[[pa.RecordBatch], dict[str, object]], schema: str | T.StructType, limit: int = CHUNK_BYTES) -> DataFrame:
    """`work` over chunks of the named columns with about `limit` bytes of text, within the partitions that there are: no shuffle.

    It gets a record batch and gives one array or list for each column of `schema`, in that order."""
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(shape)
        for chunk in chunks(batches, limit=limit):
            made = work(chunk)
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(made.values(), kinds, strict=True)], schema=kinds)
        pa.default_memory_pool().release_unused()  # the worker lives on; what it no longer holds goes back

    return docs.select(*columns).mapInArrow(run, shape)


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Only where that is unset and there is no
    cluster, as in tests, a local one."""
    context = spark.sparkContext
    top = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not top:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        top = context.getCheckpointDir()
    return f"{top}/{uuid.uuid4().hex}"


def staged(frame: DataFrame) -> DataFrame:
    """The frame written as Parquet to the shared folder and read again: what follows starts from that file.

    Files stay until the cluster clears its checkpoint folder, as the result is read after this returns."""
    path = shared_dir(frame.sparkSession)
    frame.write.parquet(path)
    # The finished job's shuffle files go when the driver next collects its garbage; asking for that keeps the disk small.
    frame.sparkSession.sparkContext._jvm.System.gc()
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """Names for columns of our own beside those of `docs`: as wanted, with underscores before them while a column has that name."""
    taken, out = {x.lower() for x in docs.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def partitions(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(a: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """a[s : s + l] of all (s, l), one after the other."""
    total = int(lengths.sum())
    if not total:
        return a[:0]
    ends = np.cumsum(lengths)
    return a[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]
