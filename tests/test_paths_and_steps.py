"""The path language and the steps on single documents."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from rowmend.functions import variants as V
from rowmend.operators import edits, paths
from rowmend.operators.conditions import equals, matches, size_is
from rowmend.operators.steps import apply_steps
from rowmend.plans.config import Add, Cast, ConfigError, Remove, Replace, load_config


def b64(value):
    return base64.b64encode(json.dumps(value).encode()).decode()


def run(spark, document, *steps):
    frame = spark.createDataFrame([(json.dumps(document),)], "x string").select(F.expr(V.parse("x")).alias("document"))
    row = apply_steps(frame, steps).select(F.expr(V.text("document")), "err.code").first()
    return row[1] or json.loads(row[0])


@pytest.mark.parametrize(
    "document,path,expected",
    [
        ({"depth": {"two": {"three": None}}}, "$.depth.two.three", None),
        ({"rows": [[1, 2], [3, 4]]}, "rows.[1].[0]", 3),
        ({"rows": [1]}, "rows.[1]", None),
        ({"cx": b64([{"n": 1}, {"n": 2}])}, "cx.[1].n", 2),
        ({"co": "[10, 20, 30]"}, "co.[2]", 30),
        ({"querystring": [{"name": "color", "value": "red"}, {"name": "size", "value": "9"}]}, "querystring.size", "9"),
        ({"cx": b64({"querystring": [{"name": "color", "value": "red"}]})}, "$.cx.querystring.color", "red"),
        ({"querystring": [{"name": "ue_pr", "value": '{"price": {"eur": 12}}'}]}, "querystring.ue_pr.price.eur", 12),
        ({"list": [{"name": "ue_pr", "value": '{"price": {"eur": 12}}'}]}, "list.[?(@.name=~ue_pr)].value.price.eur", 12),
        ({"a": [{"s": "x1", "v": 1}, {"s": "x2", "v": 2}, {"s": "y", "v": 3}]}, "a.[?(@.s=~x)].v", 2),
        ({"a": [{"s": "x1", "v": 1}, {"s": "x2"}]}, "a.[?(@.s=~x)].v", None),
        ({"a": {"v": 5}}, "a.[?(@.s=~x)].v", 5),
        ({"a": [[{"k": "p", "v": 1}], [{"k": "q", "v": 2}]]}, "a.[?(@.z=~null)].[?(@.k=~q)].v", None),
        ({"a": 1}, "b.c", None),
    ],
)
def test_read(spark, document, path, expected):
    frame = spark.createDataFrame([(json.dumps(document),)], "x string").select(F.expr(V.parse("x")).alias("d"))
    text = frame.select(F.expr(V.text(paths.read("d", path)))).first()[0]
    assert (None if text is None else json.loads(text)) == expected


@pytest.mark.parametrize(
    "path,encoded",
    [
        ("cx", True),
        ("payload.CX", True),
        ("cx.data.schema", True),
        ("context.data", False),
        ("list.[?(@.name=~cx)].value", True),
        ("list.[?(@.name=~cx|co)].value", False),
        ("list.[?(@.kind=~cx)].value", False),
        ("list.[3].value", False),
    ],
)
def test_special_names(path, encoded):
    *before, last = paths.tokenize(path)
    assert paths.is_special(("cx", "ue_px"), last.name, tuple(before)) is encoded


def test_tokens():
    where = paths.Where(("data", "navigationStart"), "([0-9]+)")
    assert paths.tokenize("$.cx.data.[?(@.data.navigationStart=~([0-9]+))].data.[2].x_y-z") == [
        paths.Name("cx"), paths.Name("data"), where, paths.Name("data"), paths.Item(2), paths.Name("x_y-z"),
    ]
    two = paths.tokenize("a.[?(@.x=~b)].[?(@.y=~c)]")
    assert [s.regex for s in two if isinstance(s, paths.Where)] == ["b", "c"]


def test_edits_reach_every_kind_of_place(spark):
    cx = {"schema": "s", "data": [{"schema": "A", "data": {"n": 0}}, {"schema": "B", "data": {"n": 1}}]}
    done = run(spark, {"parameters": [{"name": "cx", "value": b64(cx)}]}, Replace("parameters.cx.data.[?(@.schema=~B)].data.n", 7))
    assert json.loads(base64.b64decode(done["parameters"][0]["value"]))["data"][1]["data"]["n"] == 7
    done = run(spark, {"contexts": json.dumps(cx)}, Cast("contexts.data.[1].data.n", "Numeric", "String"))
    assert json.loads(done["contexts"])["data"][1]["data"]["n"] == "1"
    both = run(spark, {"a": [{"s": "x1"}, {"s": "x2"}, {"s": "y"}]}, Replace("a.[?(@.s=~x)].s", "z"))
    assert both == {"a": [{"s": "z"}, {"s": "z"}, {"s": "y"}]}


@pytest.mark.parametrize(
    "value,step,expected",
    [
        ("abc", Replace("v", "X", "(?U)^.*$"), "X"),
        ("abc", Replace("v", "<$1>", "(b)"), "a<b>c"),
        ("abc", Replace("v", []), "[]"),
        ("", Replace("v", "X", "(?U)^.*$"), "X"),
        ("cx", Replace("v", "X"), "InvalidJsonFormat"),
        ("ue_px", Replace("v", "X"), "Base64Failure"),
        (None, Replace("v", "X"), "X"),
        (1, Replace("v", 2), 2),
        (1, Replace("v", "2"), "ReplacementFailure"),
        (True, Replace("v", False, "x"), False),
        (["a", "b"], Replace("v", ["c"], "a"), ["b", "c"]),
        (["a", "b"], Replace("v", "c"), ["c"]),
        (["a"], Replace("v", "[1]", "^.*$"), [1]),
        (["a"], Replace("v", "{}", "^.*$"), "ReplacementFailure"),
        ({"a": 1}, Replace("v", {"b": 2}), {"b": 2}),
        ({"a": 1}, Replace("v", '$1,"b":2}', r"^(.*)\}$"), {"a": 1, "b": 2}),
        ({"a": 1}, Replace("v", "{"), "InvalidJsonFormat"),
        ("abc", Remove("v", "b"), "ac"),
        (["a"], Remove("v"), [""]),
        (5, Remove("v"), "ReplacementFailure"),
        (0, Cast("v", "Numeric", "Boolean"), True),
        (True, Cast("v", "Boolean", "Numeric"), 1),
        ("24", Cast("v", "String", "Numeric"), 24.0),
        ("x", Cast("v", "String", "Numeric"), "CastFailure"),
        ("NaN", Cast("v", "String", "Numeric"), None),
        ([1], Cast("v", "Array", "Boolean"), "CastFailure"),
        ([1], Cast("v", "Array", "Array"), "CastFailure"),
        ("a", Cast("v", "String", "Array"), ["a"]),
        ("a", Cast("v", "String", "String"), '"a"'),
        ("a", Add("v", "-b"), "a-b"),
        ("a", Add("v", 1), "a"),
        (1, Add("v", 1.5), 2.5),
        (True, Add("v", "x"), False),
        (None, Add("v", {"a": 1}), {"a": 1}),
        ([1], Add("v", [2]), [1, 2]),
        ({"a": 1, "b": 1}, Add("v", {"a": 2, "c": 3}), {"a": 2, "b": 1, "c": 3}),
    ],
)
def test_steps(spark, value, step, expected):
    done = run(spark, {"v": value}, step)
    assert (done["v"] if isinstance(done, dict) else done) == expected


def test_first_error_ends_the_chain(spark):
    assert run(spark, {"v": "a"}, Replace("v", "b"), Replace("w", "c"), Cast("v", "Array", "Boolean")) == "ReplacementFailure"
    assert run(spark, {"v": "a"}) == {"v": "a"}


def test_conditions(spark):
    document = {"s": "añ😀", "n": 2.1, "a": [1, 2], "z": None, "e": 1e3, "o": {"b": 1, "a": [None]}}
    frame = spark.createDataFrame([(json.dumps(document, ensure_ascii=False),)], "x string")
    frame = frame.select(F.expr(V.parse("x")).alias("document"))
    true = [
        equals("s", "añ😀"), equals("n", 2.1), equals("a", [1, 2]), equals("z", None), equals("e", 1000),
        equals("o", {"a": [None], "b": 1}), matches("s", '^"a'), size_is("s", eq=4), size_is("n", eq=3), size_is("a", lt=3),
    ]
    false = [equals("q", None), equals("s", 1), equals("z", "null"), matches("q", ".*"), size_is("z", lt=5), size_is("o", lt=5)]
    assert list(frame.select(*true).first()) == [True] * len(true)
    assert list(frame.select(*false).first()) == [False] * len(false)


@pytest.mark.parametrize(
    "flows",
    [
        "x",
        [{"name": "a b", "conditions": [], "steps": []}],
        [{"name": "a", "conditions": [{"op": "Test", "path": "x", "value": {}}], "steps": []}],
        [{"name": "a", "conditions": [], "steps": [{"op": "Nope", "path": "x"}]}],
        [{"name": "a", "conditions": [], "steps": [{"op": "Cast", "path": "x", "from": "String", "to": "Date"}]}],
        [{"name": "a", "conditions": [], "steps": [{"op": "Replace", "path": "x"}]}],
    ],
)
def test_bad_configurations_are_refused(flows):
    with pytest.raises(ConfigError):
        load_config(json.dumps({"schema": "s", "data": {"iglu:a/b/jsonschema/1-0-0": flows}}))


def test_values_must_be_json():
    with pytest.raises(ValueError):
        edits.json_value(float("nan"))
