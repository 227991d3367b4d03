"""What an expression or a job must not do per row; the results stay as they were."""

import base64
import json

from pyspark.sql import functions as F

from checks import fixtures as X
from rowmend import load_config, stream_recover
from rowmend.functions import codecs
from rowmend.functions import json_text as J
from rowmend.functions import querystring as Q
from rowmend.functions import variants as V
from rowmend.operators.decode import row_parts
from rowmend.operators.payloads import COLLECTOR, loose_type, read_event
from rowmend.streaming import job
from rowmend.plans.recovery import OUTCOME


def column(spark, sql, inputs):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in frame.select("i", F.expr(sql).alias("y")).orderBy("i").select("y").collect()]


def test_base64_makes_no_string_of_each_character(spark):
    plain = "~~??>>" * 300
    safe = base64.urlsafe_b64encode(plain.encode()).decode()
    assert column(spark, codecs.b64_decode("x"), [safe, safe.rstrip("="), None]) == [plain, plain, None]
    assert column(spark, codecs.b64_encode("x"), [plain, None]) == [base64.b64encode(plain.encode()).decode(), None]
    assert "translate" not in codecs.b64_decode("x") + codecs.b64_encode("x")


def test_is_json_where_parse_gives_a_value(spark):
    end = json.dumps(V._END)
    texts = ["1", "null", "", None, '{"a":1} x', "[1],[2]", f"1,{end}", f"[{end}]", end, f"{end},{end}", "1" * 40]
    parsed = column(spark, f"{V.parse('x')} IS NOT NULL", texts)
    assert parsed == column(spark, V.is_json("x"), texts)
    assert parsed == [True, True, False, False, False, False, False, True, True, False, False]


def test_stream_hands_over_what_is_staged_only(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("no json\n{}\n")
    seen = []
    write = job.write_batch
    monkeypatch.setattr(job, "write_batch", lambda batch, *more: seen.append(batch.columns) or write(batch, *more))
    config = load_config(json.dumps({"schema": "iglu:com.acme/r/jsonschema/1-0-0", "data": {}}))
    stream_recover(spark, str(tmp_path / "in"), config, f"{tmp_path}/o", f"{tmp_path}/c").awaitTermination()
    assert seen == [list(OUTCOME)]
    assert job.durable_counters(spark, f"{tmp_path}/o").first()["failed"] == 2


_DEEP = '{"a":' * 9 + '[1,{"b":"x"}]' + "}" * 9
_TEXTS = [
    '{"a":{"b":1.50},"c":[],"a":{"x":"}","b":[2,"]"]}}',
    '{"\\u0061":{"b":0},"d":"a\\":"}',
    '{ "a" : [ {"b":1} , {"b" : "y, z"} ] , "b":null}',
    '[["a",{"a":1}],{"a":{"b":{}}}]',
    '{"a":{"b":1},"a":2}',
    '"a"',
    "{}",
    "[]",
    "7",
    None,
    _DEEP,
    '{"a":{"b":' + _DEEP + "}}",
]
_PLACES = [("a",), ("a", "b"), ("a", 1, "b"), (1, "a"), (0,), (0, 1), ("a",) * 9 + (1, "b")]


def _all_of(text):
    """Value, edit and members, for texts with many and few levels."""
    edits = [J.edit_at(text, p, lambda v: f"named_struct('v', concat('<', {v}, '>'), 'err', {V.NO_ERROR})", V.error("Gone", "'no'")) for p in _PLACES]
    return f"to_json(struct({', '.join([*(J.get(text, *p) for p in _PLACES), *edits, J.members(text)])}))"


def test_members_are_found_where_tokens_are(spark, monkeypatch):
    by_members = column(spark, _all_of("x"), _TEXTS)
    monkeypatch.setattr(J, "_is_flat", lambda text: "false")
    assert by_members == column(spark, _all_of("x"), _TEXTS)
    assert by_members[0].startswith('{"col1":"{\\"x\\":\\"}\\",\\"b\\":[2,\\"]\\"]}","col2":"[2,\\"]\\"]"')


def test_flat_text_is_not_cut_into_tokens(spark, monkeypatch):
    monkeypatch.setattr(J, "_cut", lambda text: "CAST(raise_error('cut into tokens') AS ARRAY<STRING>)")
    assert len(column(spark, _all_of("x"), _TEXTS[:9])) == 9


def test_lines_of_a_small_file_are_the_work_of_all_cores(spark, tmp_path):
    kinds = ["view", "click", "error", "purchase", "signup"]
    events = spark.range(400).selectExpr(
        "id AS event_id", "timestamp_seconds(id) AS ts", "id % 7 AS user_id", f"array({', '.join(map(repr, kinds))})[id % 5] AS event_type",
        "id / 2.0D AS value", "concat('{\"k\": ', id % 9, '}') AS props",
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    lines = X.bad_rows(spark, str(tmp_path))
    rows = lines.withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r["event_id"] for r in rows) == list(range(400)) and all(r["value"] for r in rows)
    assert len({r["task"] for r in rows}) == spark.sparkContext.defaultParallelism


def test_a_bound_value_is_not_copied(spark):
    twice = V.let("x", lambda a: V.let(f"concat({a}, {a})", lambda b: f"coalesce(concat({b}, {a}), 'none')"))
    assert column(spark, twice, ["y", None]) == ["yyy", "none"]
    assert "transform" not in twice


def test_plain_text_fields_are_read_without_bindings(spark):
    whole = {"vendor": "v", "version": "1", "querystring": [], "collector": "c", "encoding": "e", "headers": []}
    texts = [whole, whole | {"hostname": "h"}, whole | {"hostname": None}, whole | {"hostname": 5}, whole | {"vendor": None}, {"vendor": "v"}, whole | {"body": {}}]
    sql = read_event("try_parse_json(x)", COLLECTOR)
    read = column(spark, sql, [json.dumps(t) for t in texts])
    assert [r and (r["vendor"], r["hostname"], r["body"]) for r in read] == [("v", None, None), ("v", "h", None), ("v", None, None), None, None, None, None]
    # one for the document, one for its checked fields, those of pairs, headers, timestamp and user
    assert sum(sql.count(form) for form in ("aggregate(array(", "element_at(transform(array(")) < 14


def test_text_of_few_brackets_needs_no_search_for_levels(spark, monkeypatch):
    shallow = ['{"a":{"b":[1,"]]]"]}}', "[" * 8 + "]" * 8, '"[[[["', '{"a":",","b":"x,"}']
    deep = ["[" * 9 + "]" * 9, '{"a":"' + "{" * 9 + '"}']
    assert column(spark, J._is_flat("x"), [*shallow, *deep, None]) == [True] * 4 + [False, True, None]
    monkeypatch.setattr(J, "_VALUE", "no value")
    assert column(spark, J._is_flat("x"), [*shallow, *deep]) == [True] * 4 + [False, False]


def test_a_member_is_bared_in_one_match(spark):
    members = ['"a":1,', '"a":"b,",', '"a:":{"x":[1,2]}', '"b,"', '"a":"\\n:",', "2.50,", "{},", "", ",", None]
    assert column(spark, J.bare("x"), members) == ["1", '"b,"', '{"x":[1,2]}', '"b,"', '"\\n:"', "2.50", "{}", "", "", None]
    assert "rtrim" not in J.bare("x")


def test_a_clean_querystring_value_is_not_taken_apart(spark, monkeypatch):
    values = ["a%20b", "", "plain", "50% off", "x\n", "%", "\U0001f600a", None]
    assert column(spark, Q.qs_clean("x"), values) == ["a%20b", "", "plain", "50%25+off", "x%0A", "%25", "%F0%9F%98%80a", None]
    monkeypatch.setattr(Q, "_UNIT", "(q)")
    assert column(spark, Q.qs_clean("x"), values)[:3] == ["a%20b", "", "plain"]


def test_a_payload_is_taken_apart_in_the_line(spark):
    lines = ['{"p":{"vendor":"v","headers":[]}}', '{"p":null}', '{"p":[1]}', '{"p":"x"}', "{}"]
    copied = f"try_cast({V.get('v', 'p')} AS {loose_type(COLLECTOR)})"
    direct = V.get_as("v", loose_type(COLLECTOR), "p")
    frame = spark.createDataFrame([(x,) for x in lines], "x string").select(F.expr("try_parse_json(x)").alias("v"))
    rows = frame.select(F.expr(f"to_json({copied})"), F.expr(f"to_json({direct})")).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows] and rows[0][0] and rows[2][0] is None
    assert "'variant')" not in row_parts(COLLECTOR, "payload")
