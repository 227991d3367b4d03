"""Codecs, querystrings and schema keys on fixed cases."""

from urllib.parse import quote_plus

from pyspark.sql import functions as F

from rowmend.functions import codecs, schema_keys
from rowmend.functions import querystring as Q
from rowmend.functions import variants as V


def column(spark, sql, inputs, kind="string"):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in frame.select("i", F.expr(sql).alias("y")).orderBy("i").select("y").collect()]


def test_base64(spark):
    text = "What does 2 + 2.1 equal?? ~ 4"
    coded = ["V2hhdCBkb2VzIDIgKyAyLjEgZXF1YWw/PyB+IDQ=", "V2hhdCBkb2VzIDIgKyAyLjEgZXF1YWw_PyB-IDQ", "é", "abcde", "YWJjCg=="]
    assert column(spark, codecs.b64_decode("x"), coded) == [text, text, None, None, "abc\n"]
    long = "x" * 500 + "é"
    assert column(spark, codecs.b64_decode(codecs.b64_encode("x")), [long, ""]) == [long, ""]


def test_parse_takes_one_value_only(spark):
    texts = ['{"a":1}', '{"a":1} x', '{"a":1}}', "5", "", "null", '{"a":1,"a":2}', "[1],[2]", '{"a":1}]']
    parsed = column(spark, V.text(V.parse("x")), texts)
    assert parsed == ['{"a":1}', None, None, "5", None, "null", '{"a":2}', None, None]


def test_clean_pair_by_pair(spark):
    raw = "q=a<b>c&empty=&path=/x/y?z&quote=\"hi\"&pipe=1|2&hat=^&plus=1+1&last=~ok"
    expected = {
        "q": "a%3Cb%3Ec",
        "empty": "",
        "path": "/x/y%3Fz",
        "quote": "%22hi%22",
        "pipe": "1%7C2",
        "hat": "%5E",
        "plus": "1+1",
        "last": "~ok",
    }
    cleaned = V.each(Q.qs_pairs("x"), lambda p: f"named_struct('n', {p}.name, 'v', {Q.qs_clean(f'{p}.value')})")
    assert {p["n"]: p["v"] for p in column(spark, cleaned, [raw])[0]} == expected


def test_many_repeated_names_keep_the_first_place_and_the_last_value(spark):
    raw = "b=1&a=1&" + "&".join(f"n{i % 50}={i}" for i in range(3000)) + "&a=2"
    pairs = [tuple(p) for p in column(spark, Q.qs_pairs("x"), [raw])[0]]
    assert pairs == [("b", "1"), ("a", "2"), *((f"n{i}", str(2950 + i)) for i in range(50))]


def test_clean_is_decodable(spark):
    texts = ["100%", "%7b%zz", "é😀", "a b\nc", "\\ ^ | `"]
    kept = ":/#[]@!$&'()*+,;=-._~"
    for text, cleaned in zip(texts, column(spark, Q.qs_clean("x"), texts)):
        if "%7b" not in text:
            assert cleaned == quote_plus(text, safe=kept)
    assert column(spark, f"try_url_decode({Q.qs_clean('x')})", texts)[0] == "100%"


def test_pairs_edge_forms(spark):
    forms = ["", "=", "a", "a=", "=v", "a=b=c", "a=1&a=2", "a=%zz", "a==", "a=b=", None]
    pairs = [None if r is None else [tuple(p) for p in r] for r in column(spark, Q.qs_to_nvps("x"), forms)]
    assert pairs == [
        [],
        [("", "")],
        [("a", None)],
        [("a", None)],
        [("", "v")],
        [],
        [("a", "1"), ("a", "2")],
        None,
        [("a", None)],
        [("a", "b")],
        [],
    ]
    params = column(spark, Q.qs_params("x"), ["x=1&b&c=2", "a=1&a=2", "b&a=1", "a=b=c"])
    assert params == [{"x": "1"}, {"a": "2"}, None, {"a": "b=c"}]


def test_nvps_from_documents(spark):
    docs = ['{"n":"v","o":1,"p":true}', '{"n":[1,2,3]}', '{"n":{"o":"p"}}', '[{"name":"a"}]', '[{"name":1}]', "5", "[1]"]
    rows = column(spark, Q.as_nvps(V.parse("x")), docs)
    assert [None if r is None else [tuple(p) for p in r] for r in rows] == [
        [("n", "v"), ("o", "1"), ("p", "true")],
        None,
        None,
        [("a", None)],
        None,
        None,
        None,
    ]


def test_round_trip_of_pairs(spark):
    qs = ["a=1&b=x%20y&c=%7B%7D", "e=%C3%A9"]
    assert column(spark, Q.nvps_to_qs(Q.qs_to_nvps("x")), qs) == ["a=1&b=x+y&c=%7B%7D", "e=%C3%A9"]


def test_schema_patterns(spark):
    uris = ["iglu:a.b/n/jsonschema/1-0-2", "iglu:a.b/n/jsonschema/2-0-2", "iglu:axb/n/jsonschema/1-0-2", "a/n", None]
    assert column(spark, schema_keys.schema_matches("x", "iglu:a.b/n/jsonschema/1-*-*"), uris) == [True, False, False, False, False]
    assert column(spark, schema_keys.schema_matches("x", "nonsense"), uris) == [False] * 5
    assert column(spark, schema_keys.schema_keys_match("x", "'iglu:a.b/n/jsonschema/*-0-2'"), uris) == [True, True, False, False, False]


def test_constants_need_no_quoting(spark):
    odd = "a$b ${x} '\"\\ \n\t é"
    assert column(spark, V.string(V.literal(odd)), [""]) == [odd]
    value = {"k": [None, True, 1, 1.5, "x"], "e": {}}
    assert column(spark, V.text(V.literal(value)), [""]) == ['{"e":{},"k":[null,true,1,1.5,"x"]}']
