"""Headline timings as one JSON line. Lines are written to text once; each query then reads that text."""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as X
from rowmend import configure, decode_events, execute, match_flows, parse_events
from rowmend.operators.steps import apply_flows, apply_payload_steps
from rowmend.plans.config import Config, Replace, load_config
from rowmend.plans.recovery import stage

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def planned(make: Callable[[], DataFrame]) -> float:
    """Seconds to build a frame and plan it, without running it."""
    start = time.perf_counter()
    make()._jdf.queryExecution().executedPlan()
    return round(time.perf_counter() - start, 3)


def many_flows(count: int) -> Config:
    """Flows of two steps for one row type, told apart by the vendor."""
    flows = [
        {
            "name": f"flow{i}",
            "conditions": [{"op": "Test", "path": "$.payload.raw.vendor", "value": {"value": f"vendor{i}"}}],
            "steps": [
                {"op": "Replace", "path": "$.raw.refererUri", "value": f"to{i}"},
                {"op": "Replace", "path": "$.raw.parameters.cx.data.[1].schema", "value": f"s{i}"},
            ],
        }
        for i in range(count)
    ]
    data = {X.schema_of("schema_violations", "*-*-*"): flows}
    return load_config(json.dumps({"schema": "iglu:com.acme/bench/jsonschema/1-0-0", "data": data}))


def timed(frame: DataFrame) -> float:
    """Median time of writing a frame nowhere, after one warm-up run."""
    seconds = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds[1:])


def main() -> None:
    spark = session()
    source = f"{X.scratch_dir(spark)}/lines"
    X.bad_rows(spark, SF_DIR).select("value").repartition(int(CPUS)).write.text(source)
    lines = spark.read.text(source)
    count = lines.count()
    config = X.check_config()
    decoded = decode_events(lines)

    def step(path: str, row_type: str) -> DataFrame:
        return apply_payload_steps(decoded, [Replace(path, "new")], row_type).drop("doc")

    def flow_of(steps: int) -> DataFrame:
        """Steps at as many places of one base64 document."""
        places = ("[1].schema", "[0].schema", "[0].data.id", "[1].data.k", "[1].data.zero")
        listed = [{"op": "Cast" if "data." in p else "Replace", "path": f"$.raw.parameters.cx.data.{p}", "from": "String", "to": "String", "value": "new"} for p in places[:steps]]
        data = {X.schema_of("schema_violations", "*-*-*"): [{"name": "cx", "conditions": [], "steps": listed}]}
        flows = load_config(json.dumps({"schema": "iglu:com.acme/bench/jsonschema/1-0-0", "data": data}))
        return apply_flows(match_flows(decoded, flows), flows).select("payload", "err")

    frames = {
        "parse_envelope": parse_events(lines).select("schema", "err"),
        "match_flows": match_flows(decoded, config).select("flows", "err"),
        "replace_plain": step("$.raw.refererUri", "schema_violations"),
        "replace_filter": step("$.raw.parameters.[?(@.name=~ue_pr)].value.data.data.k", "schema_violations"),
        "replace_base64": step("$.raw.parameters.cx.data.[1].schema", "schema_violations"),
        "one_step_in_cx": flow_of(1),
        "five_steps_in_cx": flow_of(5),
        "full_job": execute(lines, config).select("status", "request", "error_row"),
    }
    seconds = {name: round(timed(frame), 3) for name, frame in frames.items()}
    def whole(used: Config) -> DataFrame:
        return execute(lines, used).select("status", "request", "error_row")

    planning = {"full_job": planned(lambda: whole(config))}
    for flows in (5, 20, 40):
        used = many_flows(flows)
        planning[f"flows_{flows}"] = planned(lambda used=used: whole(used))
        seconds[f"flows_{flows}"] = round(timed(whole(used)), 3)
    start = time.perf_counter()
    staged = stage(execute(lines, config), X.scratch_dir(spark))
    staged.groupBy("status").agg(F.count("*")).collect()
    seconds["full_job_staged"] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "full_job_seconds",
                "value": seconds["full_job"],
                "unit": "sec",
                "queries": seconds,
                "planning": planning,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "lines": count,
                "lines_per_second": round(count / seconds["full_job"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
