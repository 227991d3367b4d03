"""JSON text: places found and exchanged without touching the rest."""

import base64
import json
import random

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from rowmend import execute, load_config
from rowmend.functions import json_text as J
from rowmend.functions import variants as V


class Digits(str):
    """A number by its digits."""


def load(text):
    return json.loads(text, parse_float=Digits, parse_int=Digits)


def dump(value):
    if isinstance(value, Digits):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{dump(x)}" for k, x in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(dump, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


SCALARS = ["1", "1.50", "-2.0", "1e5", '"a"', '""', '"x,y"', r'"q\"[{:,"', r'"\\"', "true", "null", '"é:"', "1" * 50 + ".10"]


def made(rng, depth=0):
    kind = rng.random()
    if depth > 3 or kind < 0.35:
        return rng.choice(SCALARS)
    if kind < 0.65:
        return "[" + ",".join(made(rng, depth + 1) for _ in range(rng.randint(0, 4))) + "]"
    keys = rng.sample(["b", "a", "z", "data", "a b", "é", 'q"t'], rng.randint(0, 5))
    return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{made(rng, depth + 1)}" for k in keys) + "}"


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(1)
    return [made(rng) for _ in range(400)]


def walk(value, steps):
    for s in steps:
        if not isinstance(value, list if isinstance(s, int) else dict) or (s >= len(value) if isinstance(s, int) else s not in value):
            return None, False
        value = value[s]
    return value, True


@pytest.mark.parametrize("steps", [("a",), ("b", "a"), (0,), (1, "data"), ("data", 1, "z"), ('q"t',), ("é", 0), (2, 0, 1)])
def test_places(spark, documents, steps):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(documents)], "i int, t string")
    edited = V.let(J.edit_at("t", steps, lambda _: V.ok("'NEW'"), V.error("gone", "'m'")), lambda r: f"coalesce({r}.v, {r}.err.code)")
    for r in frame.select("i", F.expr(J.get("t", *steps)).alias("found"), F.expr(edited).alias("edited")).collect():
        document = load(documents[r["i"]])
        value, there = walk(document, steps)
        assert r["found"] == (dump(value) if there else None)
        if there:
            walk(document, steps[:-1])[0][steps[-1]] = Digits("NEW")
        assert r["edited"] == (dump(document) if there else "gone")


def test_members(spark, documents):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(documents)], "i int, t string")
    for r in frame.select("i", F.expr(J.members("t")).alias("members")).collect():
        v = load(documents[r["i"]])
        listed = [dump(x) for x in v] if isinstance(v, list) else [dump({k: x})[1:-1] for k, x in v.items()] if isinstance(v, dict) else []
        assert r["members"] == listed


@pytest.mark.parametrize(
    "text,steps,found",
    [
        ('{"a":1,"a":2.0}', ("a",), "2.0"),  # the last of equal keys
        ('{"a":{"b":1},"a":{"c":2}}', ("a", "b"), None),
        (r'{"a":1.50}', ("a",), "1.50"),
        (' { "x" : [ 1 , { "k" : "a b" } ] } ', ("x", 1), '{"k":"a b"}'),
        ("[[1,2],[3,4]]", (1, 0), "3"),
        ('{"0":1}', (0,), None),
        ("[1]", ("0",), None),
        ("7", ("a",), None),
        ("[]", (0,), None),
        ('{"a":[]}', ("a",), "[]"),
        ('{"a":{"b":"}"},"c":1}', ("a", "b"), '"}"'),
    ],
)
def test_odd_places(spark, text, steps, found):
    assert spark.createDataFrame([(text,)], "t string").select(F.expr(J.get("t", *steps))).first()[0] == found


def test_long_text(spark):
    big = json.dumps({"items": [{"n": i, "s": "x" * 50} for i in range(3000)], "last": Digits("1")})
    row = spark.createDataFrame([(big,)], "t string").select(F.expr(J.get("t", "items", 2999, "n")), F.expr(f"size({J.members(J.get('t', 'items'))})")).first()
    assert tuple(row) == ("2999", 3000)


def test_a_job_keeps_what_it_does_not_touch(spark):
    """Through the typed payload: pairs by name and by filter, base64 and text; and a condition on the text as written."""
    doc = '{"z":1.50,"schema":"s","data":[{"k":"b","a":2.0},{"k":"c","a":1e5}],"b":null}'
    flows = [
        {
            "name": "edit",
            "conditions": [{"op": "Test", "path": "$.payload.raw.parameters.cx.data.[0]", "value": {"regex": '^[{]"k":"b","a":2[.]0'}}],
            "steps": [
                {"op": "Replace", "path": "$.raw.parameters.cx.data.[1].k", "value": "new"},
                {"op": "Replace", "path": "$.raw.parameters.[?(@.name=~ue_pr)].value.data.[?(@.k=~b)].a", "value": 7},
            ],
        },
        {"name": "never", "conditions": [{"op": "Test", "path": "$.failure", "value": {"regex": '^[{]"a"'}}], "steps": []},
        {"name": "seen", "conditions": [{"op": "Test", "path": "$.failure", "value": {"regex": '^[{]"z":2[.]0,"a":1[}]$'}}], "steps": []},
    ]
    config = load_config(json.dumps({"schema": "iglu:com.acme/r/jsonschema/1-0-0", "data": {X.schema_of("schema_violations", "*-*-*"): flows}}))
    raw = {
        "vendor": "com.acme", "version": "v1", "loaderName": "l", "encoding": "UTF-8", "headers": [],
        "parameters": [{"name": "cx", "value": base64.b64encode(doc.encode()).decode()}, {"name": "ue_pr", "value": doc}],
    }
    line = '{"schema":"%s","data":{"processor":{"artifact":"a","version":"1"},"failure":{"z":2.0, "a":1},"payload":{"enriched":{},"raw":%s}}}'
    done = execute(spark.createDataFrame([(line % (X.schema_of("schema_violations", "1-0-0"), json.dumps(raw)),)], "value string"), config)
    row = done.select("flows", "payload.pairs", "err").first()
    assert row["err"] is None and row["flows"] == ["edit", "seen"]
    assert base64.b64decode(row["pairs"][0]["value"]).decode() == doc.replace('"c"', '"new"')
    assert row["pairs"][1]["value"] == doc.replace("2.0", "7")
