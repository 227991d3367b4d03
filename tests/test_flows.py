"""The flow decision table, steps as data, and patterns that a job refuses."""

import json

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from rowmend import ConfigError, decode_events, execute, load_config, match_flows
from rowmend.plans.patterns import is_exponential

VIOLATIONS = X.schema_of("schema_violations", "*-*-*")


def line(**raw):
    event = {"vendor": "com.acme", "version": "v1", "loaderName": "l", "encoding": "UTF-8", "headers": [], "parameters": [{"name": "co", "value": '{"z":1.50,"n":3,"a":"x"}'}]} | raw
    data = {"processor": {"artifact": "a", "version": "1"}, "failure": {}, "payload": {"enriched": {"v": "VALUE"}, "raw": event}}
    return json.dumps({"schema": X.schema_of("schema_violations", "1-0-0"), "data": data})


def config(flows):
    return load_config(json.dumps({"schema": "iglu:com.acme/r/jsonschema/1-0-0", "data": {VIOLATIONS: flows}}))


def flow(name, conditions, steps=()):
    return {"name": name, "conditions": [{"op": "Test", "path": p, "value": v} for p, v in conditions], "steps": list(steps)}


VALUES = [None, True, False, 0, 1, 1.0, 1.5, -1, 100, 1e2, 1e22, 10**20, "1", "", "null", "x", [], [1], {}, {"a": 1}]


def test_values_find_their_flows(spark):
    """Every value against every other: as one table, and as single conditions do."""
    flows = config([flow(f"f{i}", [("$.payload.enriched.v", {"value": v})]) for i, v in enumerate(VALUES)])
    texts = [json.dumps(v) for v in VALUES] + ["1.50", "100.0", "1E2", "-0.0", "0e5"]
    rows = spark.createDataFrame([(i, line().replace('"VALUE"', t)) for i, t in enumerate(texts)], "i int, value string")
    found = {r["i"]: set(r["flows"]) for r in match_flows(decode_events(rows), flows).select("i", "flows").collect()}
    for i, t in enumerate(texts):
        v = json.loads(t)
        same = {f"f{j}" for j, w in enumerate(VALUES) if v == w and isinstance(v, bool) == isinstance(w, bool)}
        assert found[i] == same, t


def test_many_flows_of_several_conditions(spark):
    flows = [flow(f"v{i}", [("$.payload.raw.vendor", {"value": f"vendor{i % 40}"}), ("$.payload.raw.version", {"value": f"v{i % 3}"})]) for i in range(150)]
    flows += [flow("twice", [("$.payload.raw.vendor", {"value": "vendor1"}), ("$.payload.raw.vendor", {"value": "vendor2"})]), flow("pattern", [("$.payload.raw.vendor", {"regex": "7\"$"})]), flow("size", [("$.payload.raw.version", {"size": {"eq": 2}})]), flow("all", [])]
    rows = spark.createDataFrame([(i, line(vendor=f"vendor{i}", version=f"v{j}")) for i in (0, 1, 2, 7, 39, 99) for j in (0, 1, 22)], "i int, value string")
    for r in match_flows(decode_events(rows), config(flows)).select("payload.vendor", "payload.version", "flows", "err").collect():
        wanted = [f"v{i}" for i in range(150) if r["vendor"] == f"vendor{i % 40}" and r["version"] == f"v{i % 3}"]
        wanted += ["pattern"] * r["vendor"].endswith("7") + ["size"] * (len(r["version"]) == 2) + ["all"]
        assert r["flows"] == wanted and r["err"] is None


def test_steps_that_differ_in_their_values(spark):
    """One expression for the steps of all flows does what each flow's own would."""
    at = "$.raw.parameters.co"
    made = {
        "replace": lambda i: {"op": "Replace", "path": f"{at}.a", "value": f"to$1{i}", "match": f"(x|{i})"},
        "whole": lambda i: {"op": "Replace", "path": "$.raw.hostname", "value": f"host{i}"},
        "number": lambda i: {"op": "Replace", "path": f"{at}.n", "value": i},
        "add": lambda i: {"op": "Add", "path": f"{at}.n", "value": i},
        "text": lambda i: {"op": "Add", "path": f"{at}.a", "value": f"-{i}"},
        "remove": lambda i: {"op": "Remove", "path": "$.raw.useragent", "match": f"agent{i}"},
        "fails": lambda i: {"op": "Replace", "path": f"{at}.z", "value": f"no{i}"},
    }
    for name, step in made.items():
        flows = [flow(f"f{i}", [("$.payload.raw.vendor", {"value": f"vendor{i}"})], [step(i)]) for i in range(5)]
        rows = spark.createDataFrame([(line(vendor=f"vendor{i}", useragent=f"my agent{i} agent0", hostname="h"),) for i in range(5)], "value string")
        shown = ["payload.vendor", "payload.pairs", "payload.hostname", "payload.useragent", F.col("err.code").alias("code"), F.col("err.message").alias("message")]
        together = {r["vendor"]: r for r in execute(rows, config(flows)).select(*shown).collect()}
        for i in range(5):
            alone = execute(rows.where(F.contains("value", F.lit(f"vendor{i}"))), config([flows[i]])).select(*shown).first()
            assert together[f"vendor{i}"] == alone, name
            assert (alone["code"] is not None) == (name == "fails"), (name, alone)


def test_the_plan_does_not_grow_with_the_flows(spark):
    def size(n):
        flows = [flow(f"f{i}", [("$.payload.raw.vendor", {"value": f"vendor{i}"})], [{"op": "Replace", "path": "$.raw.refererUri", "value": f"to{i}"}]) for i in range(n)]
        plan = execute(spark.createDataFrame([("",)], "value string"), config(flows))._jdf.queryExecution().optimizedPlan()
        return plan.toString().count("_result"), plan.toString().count("Project")

    assert size(4) == size(60)


@pytest.mark.parametrize(
    "pattern,slow",
    [
        ("(a+)+$", True), ("(a*)*b", True), ("(a|ab|b)*c", True), ("(a|aa)+$", True), (r"(\w+\s?)+$", True), ("^(([a-z])+.)+[A-Z]([a-z])+$", True), ("(x+x+)+y", True), ("(.*)*=", True),
        ("(a+)+", False), ("a+$", False), ("([a-z]+,)*$", False), ("(ab|cd)*e", False), ("^https://example[.]com/(.+)$", False), ("(?:a++)+$", False), ("(?>a+)+$", False), ("[0-9]+[.]?[0-9]*$", False),
        ("(a{1,3}){1,3}$", False), (".*a.*b", False), (r"\p{L}+", False), ("(", False), ("(e|page)", False), ('"(?:[^"\\\\]|\\\\.)*"', False), ("", False), ("(é+ü?)+$", True),
    ],
)
def test_exponential_patterns(pattern, slow):
    assert is_exponential(pattern) is slow


def test_a_job_with_an_exponential_pattern_never_starts(spark):
    frame = spark.createDataFrame([("{}",)], "value string")
    step = {"op": "Remove", "path": "$.raw.useragent", "match": "(a+)+$"}
    for flows in ([flow("slow", [("$.payload.raw.vendor", {"regex": "(a+)+$"})])], [flow("slow", [], [step])], [flow("slow", [("$.x.[?(@.n=~(a+)+b)].c", {"value": 1})])]):
        with pytest.raises(ConfigError, match="slow.*exponential"):
            execute(frame, config(flows))


def test_steps_into_one_document_are_as_if_one_by_one(spark):
    """Steps that open a document once, against the same steps parted by one that changes nothing in between."""
    at = "$.raw.parameters.co"
    between = {"op": "Add", "path": "$.raw.version", "value": ""}
    steps = {
        "edit": {"op": "Replace", "path": f"{at}.a", "value": "new"},
        "again": {"op": "Replace", "path": f"{at}.a", "value": "$1$1", "match": "(n)"},
        "cast": {"op": "Cast", "path": f"{at}.a", "from": "String", "to": "Array"},
        "in cast": {"op": "Replace", "path": f"{at}.a.[0]", "value": "deep"},
        "add": {"op": "Add", "path": f"{at}.n", "value": 4},
        "gone": {"op": "Replace", "path": f"{at}.none.x", "value": 1},
        "fails": {"op": "Replace", "path": f"{at}.z", "value": "text"},
        "other": {"op": "Replace", "path": "$.raw.hostname", "value": "h"},
    }
    chains = [["edit", "again", "cast", "in cast", "add"], ["edit", "cast", "again"], ["add", "gone", "fails"], ["add", "fails", "gone"], ["edit", "other", "again", "add"], ["cast", "cast"], ["in cast", "edit"]]
    shown = ["payload.pairs", "payload.hostname", F.col("err.code").alias("code"), F.col("err.message").alias("message")]
    for params in (None, [{"name": "co", "value": "no json"}], [{"name": "x", "value": "1"}]):
        rows = spark.createDataFrame([(line(**({"parameters": params} if params else {})),)], "value string")
        for chain in chains:
            listed = [steps[x] for x in chain]
            apart = [y for x in listed for y in (x, between)]
            once, each = (execute(rows, config([flow("f", [], some)])).select(*shown).first() for some in (listed, apart))
            assert (once["code"], once["message"]) == (each["code"], each["message"]), chain
            assert once["code"] or once == each, chain  # of a failed row the line is what counts
            assert params or ("gone" in chain or "fails" in chain or chain in (["cast", "cast"], ["in cast", "edit"])) == (once["code"] is not None), (chain, once)


def test_chains_of_many_flows(spark):
    """Flows that each open the document once share one expression, with values of their own at every step."""
    at = "$.raw.parameters.co"
    flows = [
        flow(f"f{i}", [("$.payload.raw.vendor", {"value": f"vendor{i}"})], [{"op": "Replace", "path": f"{at}.a", "value": f"a{i}"}, {"op": "Add", "path": f"{at}.n", "value": i}, {"op": "Replace", "path": f"{at}.a", "value": "b", "match": f"a{i}"}])
        for i in range(4)
    ]
    rows = spark.createDataFrame([(line(vendor=f"vendor{i}"),) for i in range(4)], "value string")
    done = execute(rows, config(flows))
    assert done._jdf.queryExecution().optimizedPlan().toString().count("AS _result") <= 1
    assert {r["vendor"]: r["pairs"][0]["value"] for r in done.select("payload.vendor", "payload.pairs").collect()} == {f"vendor{i}": '{"z":1.50,"n":%s.0,"a":"b"}' % (3 + i) for i in range(4)}
