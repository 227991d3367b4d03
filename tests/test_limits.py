"""Input and configuration at the edges: nothing may end the job or change what no step touches."""

import json

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from rowmend import ConfigError, execute, load_config
from rowmend.functions import variants as V
from rowmend.operators import conditions as C
from rowmend.operators.steps import exclusive
from rowmend.plans.recovery import stage
from rowmend.streaming.job import write_batch

VIOLATIONS = X.schema_of("schema_violations", "*-*-*")


def config(*flows):
    listed = [{"name": f"f{i}", "conditions": c, "steps": s} for i, (c, s) in enumerate(flows)]
    return load_config(json.dumps({"schema": "iglu:com.acme/r/jsonschema/1-0-0", "data": {VIOLATIONS: listed}}))


@pytest.mark.parametrize(
    "text,kept",
    [
        ('{"a":1.50}', True),
        ('{"a":1e400}', False),
        ('{"a":-1E-0400}', False),
        ('{"a":' + "1" * 50 + "}", False),
        ('{"a":0.' + "1" * 45 + "}", False),
        ('{"a":1234567890123456789012e5}', False),
        ('{"a":"1e400, ' + "2" * 60 + '"}', True),
        ('{"a":"\\"1e400\\""}', True),
        ('{"a":"x\\\\","b":1e400}', False),
        ("[1e40]", True),
    ],
)
def test_numbers_are_kept_or_refused(spark, text, kept):
    row = spark.createDataFrame([(text,)], "x string").select(F.expr(V.parse("x")).isNotNull()).first()
    assert row[0] is kept


def test_error_rows_hold_the_line_as_it_was(spark):
    line = '{"schema":"%s","data":{"z":1.50,"processor":{"version":"1","artifact":"a"},"payload":{},"failure":{}, "a":1E2}}' % X.schema_of("mystery", "1-0-0")
    known = line.replace("mystery", "size_violation")
    done = execute(spark.createDataFrame([(known,)], "value string"), config()).select("error_row").first()[0]
    assert f'"payload":{known},' in done
    assert json.loads(done)["data"]["recoveries"] == 1


def test_recoveries_at_the_maximum(spark):
    inner = '{"schema":"%s","data":{"processor":{"version":"1","artifact":"a"},"payload":{},"failure":{}}}' % X.schema_of("size_violation", "1-0-0")
    lines = [
        '{"schema":"%s","data":{"processor":{"version":"1","artifact":"a"},"failure":{},"payload":%s,"recoveries":%d}}' % (X.schema_of("recovery_error", "1-0-0"), inner, n)
        for n in (2**31 - 1, 2**63 - 1)
    ]
    rows = execute(spark.createDataFrame([(x,) for x in lines], "value string"), config()).select("error_row").collect()
    assert sorted(json.loads(r[0])["data"]["recoveries"] for r in rows) == [2**31, 2**63 - 1]


@pytest.mark.parametrize(
    "conditions,steps",
    [
        ([{"op": "Test", "path": "$.payload", "value": {"regex": "("}}], []),
        ([{"op": "Test", "path": "$.", "value": {"regex": "a"}}], []),
        ([{"op": "Test", "path": "$.a.[?(@.b=~[)].c", "value": {"regex": "a"}}], []),
        ([], [{"op": "Replace", "path": "$.vendor", "match": "a", "value": "cost $"}]),
        ([], [{"op": "Replace", "path": "$.vendor", "match": "(a)", "value": "$9"}]),
        ([], [{"op": "Replace", "path": "$.vendor", "match": "a", "value": "end\\"}]),
        ([], [{"op": "Replace", "path": "$.vendor", "match": "(?<x>a)", "value": "${y}"}]),
        ([], [{"op": "Remove", "path": "$.vendor", "match": "*"}]),
    ],
)
def test_bad_patterns_are_refused_on_the_driver(spark, conditions, steps):
    with pytest.raises(ConfigError):
        execute(spark.createDataFrame([], "value string"), config((conditions, steps)))


def test_good_replacements_are_not(spark):
    steps = [{"op": "Replace", "path": "$.vendor", "match": m, "value": v} for m, v in [("(a)", "$1$0"), ("(?<x>a)", "${x}"), ("a", "\\$"), ("a", "plain")]]
    execute(spark.createDataFrame([], "value string"), config(([], steps)))


@pytest.mark.parametrize(
    "document,expected,same",
    [
        ({"k": 10.0}, {"k": 10}, True),
        ({"b": [1, {"c": None}], "a": "x"}, {"a": "x", "b": [1, {"c": None}]}, True),
        ([1, 2], [2, 1], False),
        ([1], [1, 1], False),
        ({"a": 1}, {"a": 1, "b": None}, False),
        ({"a": "1"}, {"a": 1}, False),
        ({}, {}, True),
        ([], {}, False),
        (3, [3], False),
    ],
)
def test_compare_goes_by_value(spark, document, expected, same):
    text = json.dumps({"v": document}).replace("10.0", "1e1")
    frame = spark.createDataFrame([(text,)], "x string").select(F.expr(V.parse("x")).alias("document"))
    assert frame.select(C.equals("$.v", expected)).first()[0] is same


def test_exclusive_flows_share_rounds():
    step = [{"op": "Replace", "path": "$.vendor", "value": "x"}]
    test = lambda path, value: [{"op": "Test", "path": path, "value": {"value": value}}]
    a, b, c, d = config((test("$.v", 1), step), (test("$.v", 2), step), (test("$.w", 1), step), (test("$.v", 1.0), step)).flows
    assert exclusive(a, b) and not exclusive(a, c) and not exclusive(a, d)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_replay_with_fewer_statuses(spark, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        lines = X.bad_rows(spark, "/root/testdata/sf0.001").select("value").limit(60)
        done = stage(execute(lines, X.check_config()), X.scratch_dir(spark)).withColumn("err", F.struct(F.col("err_code").alias("code")))
        out = X.scratch_dir(spark)
        failed = done.where("status = 'failed'")
        assert failed.count()
        write_batch(failed, 0, out)
        write_batch(done.where("status = 'recovered'"), 1, out)
        kept = spark.read.text(f"{out}/failed/*/batch=0").count(), spark.read.text(f"{out}/failed/*/batch=1").count()
        assert kept == (failed.count(), 0)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
