"""What the stream and the lines of the checks leave on disk; the rows stay as they were."""

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from checks import queries as C
from rowmend import load_config, stream_recover
from rowmend.operators.outcomes import STATUSES
from rowmend.plans.recovery import stage
from rowmend.sources import files, runs
from rowmend.streaming.job import durable_counters

NO_FLOWS = load_config(json.dumps({"schema": "iglu:com.acme/r/jsonschema/1-0-0", "data": {}}))


def parts(folder):
    return sorted(p for p in Path(folder).rglob("part-*") if p.suffix != ".crc")


def events(spark, folder, n):
    kinds = ["view", "click", "error", "purchase", "signup"]
    rows = spark.range(n).selectExpr(
        "id AS event_id", "timestamp_seconds(id) AS ts", "id % 7 AS user_id", f"array({', '.join(map(repr, kinds))})[id % 5] AS event_type",
        "id / 2.0D AS value", "concat('{\"k\": ', id % 99, '}') AS props",
    )
    rows.write.parquet(f"{folder}/events.parquet")


@pytest.mark.parametrize("compression", [None, "none"])
def test_error_rows_of_a_stream_are_small_files(spark, tmp_path, monkeypatch, compression):
    monkeypatch.setattr(files, "ROWS_PER_TEXT_FILE", 100, raising=False)
    texts = [f'{{"schema":"no schema {i}","data":{{"payload":"é\\\\n{"x" * 300}"}}}}' for i in range(350)] + ["no json", ""]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(texts) + "\n")
    told = {} if compression is None else {"compression": compression}
    stream_recover(spark, str(tmp_path / "in"), NO_FLOWS, f"{tmp_path}/o", f"{tmp_path}/c", **told).awaitTermination()
    written = parts(files.error_dir(f"{tmp_path}/o/failed"))
    assert {p.name.endswith(".txt.gz") for p in written} == {compression is None}
    found = [(gzip.decompress(p.read_bytes()) if compression is None else p.read_bytes()).decode().splitlines() for p in written]
    assert max(map(len, found)) <= 100
    rows = [json.loads(x)["data"]["payload"] for some in found for x in some]
    assert sorted(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in rows) == sorted(texts)
    assert durable_counters(spark, f"{tmp_path}/o").first().asDict() == {"recovered": 0, "failed": 352, "unrecoverable": 0}
    size = sum(p.stat().st_size for p in written)
    assert (size < 350 * 300 / 4) == (compression is None)


def test_staged_outcomes_last_as_long_as_their_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.txt").write_text("no json\n{}\n")
    seen = []
    stream_recover(
        spark, str(tmp_path / "in"), NO_FLOWS, f"{tmp_path}/o", f"{tmp_path}/c", max_files_per_trigger=1,
        on_batch=lambda staged, batch: seen.append((batch, staged.count(), len(parts(tmp_path / "o" / "_staged")) > 0)),
    ).awaitTermination()
    assert seen == [(0, 2, True), (1, 2, True)]
    assert not (tmp_path / "o" / "_staged").exists()
    assert spark.read.text(files.error_dir(f"{tmp_path}/o/failed")).count() == 4


def test_lines_of_a_stream_are_stored_once_and_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "_written", {})
    monkeypatch.setattr(files, "ROWS_PER_TEXT_FILE", 30, raising=False)
    events(spark, tmp_path, 400)
    expected = sorted(r["value"] for r in X.bad_rows(spark, str(tmp_path)).collect())
    counts = {r["status"]: r["n"] for r in C.QUERIES["stream_recover"](spark, str(tmp_path)).collect()}
    assert sum(counts.values()) == 400 and set(counts) == set(STATUSES)
    assert [name for _, _, name in C._written] == ["text"]
    written = parts(C.text_dir(spark, str(tmp_path)))
    assert written and all(p.name.endswith(".txt.gz") for p in written)
    found = [gzip.decompress(p.read_bytes()).decode().splitlines() for p in written]
    assert max(map(len, found)) <= 30
    assert sorted(x for some in found for x in some) == expected
    # lines that are there already are not made again
    del C._written[next(iter(C._written))]
    C.lines(spark, str(tmp_path))
    monkeypatch.setattr(X, "bad_rows", None)
    assert sorted(r["value"] for r in spark.read.text(C.text_dir(spark, str(tmp_path))).collect()) == expected


def test_staged_outcomes_are_packed(spark, tmp_path):
    rows = spark.range(5).select(
        F.lit("failed").alias("status"), F.struct(F.lit("p").alias("path")).alias("request"), F.col("id").cast("string").alias("error_row"),
        F.struct(F.lit("C").alias("code")).alias("err"), F.array(F.lit("f")).alias("flows"), F.lit("t").alias("row_type"),
    )
    assert sorted(r["error_row"] for r in stage(rows, f"{tmp_path}/s").collect()) == list("01234")
    assert runs.exists(spark, f"{tmp_path}/s/_SUCCESS") and all(".zstd." in p.name for p in parts(tmp_path / "s"))
