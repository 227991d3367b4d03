"""Failed events derived from the `events` table, in Spark and as SQL.

Every event becomes one line of a failed-event file. The row type and the faults
in it depend on the event id alone, so the expected result of every operator can
be stated in SQL over the same table.
"""

from __future__ import annotations

import json
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmend import wire
from rowmend.functions import variants as V
from rowmend.plans.config import Config, load_config
from rowmend.plans.recovery import staging_dir

CLICK = "iglu:com.acme/click/jsonschema/1-0-0"
CLICK_FIXED = "iglu:com.acme/click/jsonschema/1-0-1"
PAGE_CONTEXT = "iglu:com.acme/web_page/jsonschema/1-0-0"
TIMING_CONTEXT = "iglu:com.acme/timing/jsonschema/1-0-0"
DOUBLE_MESSAGE = "error deserializing raw event: Unrecognized type 67"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder to stage a check in; where the session names no shared one, as in tests, below a local one."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rowmend-"))
    return staging_dir(spark)


def schema_of(row_type: str, version: str) -> str:
    return f"iglu:{wire.BAD_ROW_VENDOR}/{row_type}/jsonschema/{version}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return V.configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly to one task for each core.

    A file of small rows is read by few tasks: at most one for each of its row groups, and a table of a few MB has one. A
    failed-event line takes many times the bytes of its event, so what is made of events would be the work of those few.
    """
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with the values everything else is built from."""
    h = F.md5(F.col("event_id").cast("string"))
    vendor = (
        F.when(F.col("event_type") == "purchase", wire.SENDGRID_VENDOR)
        .when(F.col("event_type") == "signup", wire.IGLU_WEBHOOK_VENDOR)
        .otherwise("com.acme")
    )
    uuid = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return spread(table(spark, sf_dir, "events")).select(
        "event_id",
        (F.col("event_id") % 8).alias("kind"),
        F.col("event_type").alias("et"),
        F.col("user_id").alias("uid"),
        F.col("value").alias("val"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("iso"),
        h.alias("h"),
        vendor.alias("vendor"),
        F.concat(F.lit("app-"), F.col("user_id") % 10).alias("aid"),
        F.when(F.col("event_id") % 13 == 0, F.lit("no-uuid")).otherwise(uuid).alias("uuid"),
    )


def _struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _b64(text: Column) -> Column:
    return F.replace(F.base64(text.cast("binary")), F.lit("\r\n"), F.lit(""))


def _pair(name: str, value: Column) -> Column:
    return _struct(name=F.lit(name), value=value.cast("string"))


def unstruct(schema: Column | None = None) -> Column:
    """Self-describing event, JSON text (`ue_pr`)."""
    return F.to_json(
        _struct(
            schema=F.lit("iglu:com.acme/unstruct_event/jsonschema/1-0-0"),
            data=_struct(
                schema=F.concat(F.lit("iglu:com.acme/"), F.col("et"), F.lit("/jsonschema/1-0-0")),
                data=_struct(k=F.col("k"), value=F.col("val"), user_id=F.col("uid")),
            ),
        )
    )


def contexts() -> Column:
    """Two contexts, JSON text (`cx` holds it as base64)."""
    items = F.array(
        F.to_json(_struct(schema=F.lit(PAGE_CONTEXT), data=_struct(id=F.col("h")))),
        F.to_json(_struct(schema=F.lit(TIMING_CONTEXT), data=_struct(k=F.col("k"), zero=F.lit(0)))),
    )
    return F.concat(
        F.lit('{"schema":"iglu:com.acme/contexts/jsonschema/1-0-0","data":['), F.array_join(items, ","), F.lit("]}")
    )


def has_unstruct() -> Column:
    return F.col("event_id") % 11 != 0


def pair_list() -> Column:
    unstruct_pair = F.when(has_unstruct(), F.array(_pair("ue_pr", unstruct()))).otherwise(
        F.array().cast("array<struct<name:string,value:string>>")
    )
    head = F.array(_pair("e", F.lit("ue")), _pair("page", F.col("et")), _pair("aid", F.col("aid")))
    return F.concat(head, unstruct_pair, F.array(_pair("cx", _b64(contexts()))))


def pair_object() -> Column:
    """The same as an object; `note` is null, and every fortieth row has a nested value."""
    scalar = F.to_json(
        _struct(
            e=F.lit("ue"),
            page=F.col("et"),
            aid=F.col("aid"),
            n=F.col("k"),
            flag=F.col("k") % 2 == 0,
            note=F.lit(None).cast("string"),
            ue_pr=F.when(has_unstruct(), unstruct()),
            cx=_b64(contexts()),
        ),
        {"ignoreNullFields": "false"},
    )
    without_null_event = F.when(has_unstruct(), scalar).otherwise(F.replace(scalar, F.lit('"ue_pr":null,'), F.lit("")))
    nested = F.replace(without_null_event, F.lit('"note":null'), F.lit('"note":[1]'))
    text = F.when(F.col("event_id") % 40 == 1, nested).otherwise(without_null_event)
    return F.parse_json(text)


def raw_event(parameters: Column) -> Column:
    return _struct(
        vendor=F.col("vendor"),
        version=F.lit("v1"),
        parameters=parameters,
        loaderName=F.lit("loader"),
        encoding=F.lit("UTF-8"),
        hostname=F.lit("collector.example.com"),
        timestamp=F.col("iso"),
        ipAddress=F.concat(F.lit("10.0.0."), F.col("uid") % 250),
        useragent=F.concat(F.lit("agent/"), F.col("et")),
        refererUri=F.concat(F.lit("https://example.com/"), F.col("et")),
        headers=F.array(F.concat(F.lit("X-K: "), F.col("k"))),
        userId=F.col("uuid"),
    )


def collector_payload() -> Column:
    return _struct(
        vendor=F.col("vendor"),
        version=F.lit("v1"),
        querystring=F.array(_pair("e", F.lit("pv")), _pair("page", F.col("et")), _pair("aid", F.col("aid"))),
        contentType=F.lit("text/plain"),
        body=F.concat(F.lit("k="), F.col("k")),
        collector=F.lit("collector"),
        encoding=F.lit("UTF-8"),
        hostname=F.lit("collector.example.com"),
        timestamp=F.col("iso"),
        ipAddress=F.concat(F.lit("10.0.0."), F.col("uid") % 250),
        useragent=F.concat(F.lit("agent/"), F.col("et")),
        headers=F.array(F.concat(F.lit("X-K: "), F.col("k"))),
        networkUserId=F.col("uuid"),
    )


def record() -> Column:
    """Raw request record as JSON text."""
    broken = F.concat(
        F.lit("e=<"), F.col("et"), F.lit(">&pv=p|q ^r&k=\\"), F.col("k"), F.lit("\\&k=50% off&aid="), F.col("aid")
    )
    querystring = F.when(F.col("event_id") % 5 != 0, F.when(F.col("event_id") % 11 == 0, "novalue").otherwise(broken))
    plain = F.concat(F.lit("e=pv&page="), F.col("et"), F.lit("&empty=&aid="), F.col("aid"))
    double = F.when(F.col("event_id") % 5 != 0, F.when(F.col("event_id") % 11 == 0, "novalue").otherwise(plain))
    return F.to_json(
        _struct(
            schema=F.lit(wire.REQUEST_SCHEMA),
            ipAddress=F.concat(F.lit("10.0.0."), F.col("uid") % 250),
            timestamp=F.unix_millis(F.col("iso").cast("timestamp")),
            encoding=F.lit("UTF-8"),
            collector=F.lit("collector"),
            path=F.concat(F.lit("/"), F.col("vendor"), F.lit("/v1")),
            querystring=F.when(F.col("event_id") % 16 == 12, double).otherwise(querystring),
            hostname=F.lit("collector.example.com"),
            networkUserId=F.col("uuid"),
        )
    )


def encoded_record() -> Column:
    once = _b64(record())
    return (
        F.when(F.col("event_id") % 7 == 0, "*** not base64 ***")
        .when(F.col("event_id") % 16 == 12, _b64(once))
        .otherwise(once)
    )


def _envelope(row_type: str, version: str, failure: Column, payload: Column, **more: Column) -> Column:
    processor = _struct(artifact=F.lit("fixture-enrich"), version=F.lit("1.0.0"))
    return _struct(
        schema=F.lit(schema_of(row_type, version)),
        data=_struct(processor=processor, failure=failure, payload=payload, **more),
    )


def bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`event_id, value`: one failed-event line per event."""
    failure = _struct(
        timestamp=F.col("iso"),
        messages=F.array(
            _struct(
                schemaKey=F.concat(F.lit("iglu:com.acme/"), F.col("et"), F.lit("/jsonschema/1-0-0")),
                error=F.lit("rejected"),
            )
        ),
    )
    enriched = _struct(
        app_id=F.lit("app"),
        domain_userid=F.concat(F.lit("d"), F.col("uid")),
        value=F.col("val"),
        contexts=contexts(),
    )
    violation = _envelope(
        wire.SCHEMA_VIOLATIONS, "2-0-0", failure, _struct(enriched=enriched, raw=raw_event(pair_list()))
    )
    message = F.when(F.col("event_id") % 16 == 12, DOUBLE_MESSAGE).otherwise("malformed querystring")
    size = _struct(timestamp=F.col("iso"), maximumAllowedSizeBytes=F.lit(50), actualSizeBytes=F.col("k"))
    stray = F.concat(
        F.lit('{"schema":"'),
        F.when(F.col("event_id") % 32 == 15, schema_of("loader_parsing_error", "1-0-0")).otherwise(
            schema_of("mystery", "1-0-0")
        ),
        F.lit('","data":{"processor":{"artifact":"a","version":"1"},"failure":{},"payload":"x"}}'),
    )
    lines = {
        0: F.to_json(violation),
        1: F.to_json(
            _envelope(
                wire.ENRICHMENT_FAILURES, "1-0-0", failure, _struct(enriched=enriched, raw=raw_event(pair_object()))
            )
        ),
        2: F.to_json(_envelope(wire.ADAPTER_FAILURES, "1-0-0", failure, collector_payload())),
        3: F.to_json(_envelope(wire.TRACKER_PROTOCOL_VIOLATIONS, "1-0-0", failure, collector_payload())),
        4: F.to_json(
            _envelope(
                wire.FORMAT_VIOLATION,
                "1-0-0",
                _struct(timestamp=F.col("iso"), loader=F.lit("loader"), message=message),
                _struct(event=encoded_record()),
            )
        ),
        5: F.to_json(_envelope(wire.SIZE_VIOLATION, "1-0-0", size, _struct(event=F.col("h")))),
        6: F.to_json(
            _envelope(
                wire.RECOVERY_ERROR,
                "1-0-0",
                _struct(error=F.lit("earlier failure")),
                violation,
                recoveries=F.lit(1) + F.col("event_id") % 3,
            )
        ),
        7: F.when(F.col("event_id") % 16 == 7, F.concat(F.lit('{"schema": "'), F.col("et"))).otherwise(stray),
    }
    line = F.when(F.lit(False), F.lit(""))
    for kind, text in lines.items():
        line = line.when(F.col("kind") == kind, text)
    return facts(spark, sf_dir).select("event_id", line.alias("value"))


def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`event_id, et, k, uid, val, payload`: one JSON value `v` of each type in turn."""
    text = (
        F.when(F.col("event_id") % 6 == 0, F.lit("null"))
        .when(F.col("event_id") % 6 == 1, (F.col("k") % 2 == 0).cast("string"))
        .when(F.col("event_id") % 6 == 2, F.col("val").cast("string"))
        .when(F.col("event_id") % 6 == 3, F.concat(F.lit('"'), F.col("et"), F.lit('"')))
        .when(F.col("event_id") % 6 == 4, F.concat(F.lit("["), F.col("k"), F.lit(","), F.col("uid"), F.lit("]")))
        .otherwise(F.concat(F.lit('{"k":'), F.col("k"), F.lit(',"t":"'), F.col("et"), F.lit('"}')))
    )
    return facts(spark, sf_dir).select(
        "event_id", "et", "k", "uid", "val", F.parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).alias("payload")
    )


def raw_querystrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`id, qs`: querystrings of pages, broken ones built from events, and edge forms built from events."""
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), "page_id").alias("id"),
        F.when(F.contains("url", F.lit("?")), F.regexp_extract("url", r"\?([^#]*)", 1)).alias("qs"),
    )
    events = facts(spark, sf_dir)
    broken = events.select(
        F.concat(F.lit("e"), "event_id").alias("id"),
        F.concat(F.lit("e=<"), "et", F.lit(">&pv=p|q ^r&k=\\"), "k", F.lit("`")).alias("qs"),
    )
    edge = F.array(*[F.lit(x) for x in EDGE_QUERYSTRINGS])
    edges = events.select(
        F.concat(F.lit("x"), "event_id").alias("id"),
        F.replace(F.element_at(edge, (F.col("event_id") % len(EDGE_QUERYSTRINGS) + 1).cast("int")), F.lit("E"), "et").alias(
            "qs"
        ),
    )
    return pages.unionAll(broken).unionAll(edges)


# `E` stands for the event type.
EDGE_QUERYSTRINGS = ("", "=", "E", "a=", "=E", "a=b=E", "a=1&a=E", "a=E%20b&c&d=2", "x=E&&y=%7B&z", "a==", "a=E==")

RAW_QS_SQL = """
qs AS (
  SELECT 'p' || page_id AS id, CASE WHEN contains(url, '?') THEN regexp_extract(url, '\\?([^#]*)', 1) END AS qs
  FROM pages
  UNION ALL
  SELECT 'e' || event_id, 'e=<' || et || '>&pv=p|q ^r&k=\\' || k || '`' FROM f
  UNION ALL
  SELECT 'x' || event_id, replace(list_extract([""" + ", ".join(f"'{x}'" for x in EDGE_QUERYSTRINGS) + f"""],
    CAST(event_id % {len(EDGE_QUERYSTRINGS)} + 1 AS BIGINT)), 'E', et) FROM f
)"""

FACTS_SQL = f"""
f AS (
  SELECT event_id, event_id % 8 AS kind, event_type AS et, user_id AS uid, value AS val,
    CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso, epoch_us(ts) // 1000 AS ms,
    md5(CAST(event_id AS VARCHAR)) AS h,
    CASE event_type WHEN 'purchase' THEN '{wire.SENDGRID_VENDOR}'
      WHEN 'signup' THEN '{wire.IGLU_WEBHOOK_VENDOR}' ELSE 'com.acme' END AS vendor,
    'app-' || (user_id % 10) AS aid,
    event_id % 11 <> 0 AS has_ue,
    CASE WHEN event_id % 13 = 0 THEN 'no-uuid' ELSE
      regexp_replace(md5(CAST(event_id AS VARCHAR)), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')
      END AS uuid
  FROM events
)"""


def with_facts(body: str, *more: str) -> str:
    return "WITH " + ",".join([FACTS_SQL, *more]) + "\n" + body


# --- the configuration the checks run -----------------------------------------


def _test(path: str, **value: object) -> dict:
    return {"op": "Test", "path": path, "value": value}


def _flow(name: str, conditions: list[dict], steps: list[dict]) -> dict:
    return {"name": name, "conditions": conditions, "steps": steps}


_EVENT_SCHEMA = "$.payload.raw.parameters.ue_pr.data.schema"
_TIMING = "[?(@.schema=~com.acme/timing)]"

CONFIG_JSON = json.dumps(
    {
        "schema": "iglu:com.acme/recoveries/jsonschema/4-0-0",
        "data": {
            schema_of(wire.SCHEMA_VIOLATIONS, "*-*-*"): [
                _flow(
                    "fix-schema",
                    [_test(_EVENT_SCHEMA, value=CLICK)],
                    [
                        {
                            "op": "Replace",
                            "path": "$.raw.parameters.[?(@.name=~ue_pr)].value",
                            "match": CLICK,
                            "value": CLICK_FIXED,
                        }
                    ],
                ),
                _flow(
                    "purchase-price",
                    [_test("$.payload.raw.vendor", regex="com.sendgrid")],
                    [
                        {"op": "Replace", "path": "$.raw.parameters.ue_pr.data.data.k", "value": 1000},
                        {"op": "Add", "path": "$.raw.parameters.[?(@.name=~ue_pr)].value.data.data", "value": {"price": "on request"}},
                    ],
                ),
                _flow("signup-as-is", [_test("$.payload.raw.vendor", value=wire.IGLU_WEBHOOK_VENDOR)], []),
                _flow(
                    "view-timing",
                    [_test(_EVENT_SCHEMA, regex="/view/"), _test("$.failure.messages.[0].schemaKey", regex="view")],
                    [
                        {
                            "op": "Cast",
                            "path": f"$.raw.parameters.cx.data.{_TIMING}.data.zero",
                            "from": "Numeric",
                            "to": "Boolean",
                        },
                        {"op": "Add", "path": "$.raw.parameters.cx.data.[1].data.k", "value": 1},
                    ],
                ),
                _flow(
                    "view-page",
                    [_test(_EVENT_SCHEMA, regex="/view/")],
                    [{"op": "Replace", "path": "$.raw.parameters.page", "value": "Viewed"}],
                ),
            ],
            schema_of(wire.ENRICHMENT_FAILURES, "1-0-*"): [
                _flow(
                    "enrich-tidy",
                    [_test("$.processor.artifact", regex="enrich\"$"), _test("$.processor.version", size={"gt": 4})],
                    [
                        {
                            "op": "Replace",
                            "path": "$.raw.refererUri",
                            "match": "^https://example[.]com/(.+)$",
                            "value": "https://docs.example.org/from/$1",
                        },
                        {"op": "Remove", "path": "$.raw.parameters.aid", "match": "[0-9]+"},
                        {"op": "Cast", "path": f"$.raw.parameters.cx.data.{_TIMING}.data.zero", "from": "Numeric", "to": "String"},
                        {"op": "Replace", "path": "$.raw.parameters.cx.data.[1].data.zero", "match": "^0$", "value": "none"},
                    ],
                ),
                _flow("never", [_test("$.processor.version", size={"lt": 5})], []),
            ],
            schema_of(wire.ADAPTER_FAILURES, "1-0-*"): [
                _flow(
                    "click-page",
                    [_test("$.payload.querystring.[?(@.name=~page)].value", value="click")],
                    [{"op": "Replace", "path": "$.querystring.page", "value": "fixed-click"}],
                ),
                _flow(
                    "view-all",
                    [_test("$.payload.querystring.page", value="view")],
                    [
                        {
                            "op": "Replace",
                            "path": "$.querystring",
                            "value": [{"name": "e", "value": "pv"}, {"name": "page", "value": "All pages"}],
                        }
                    ],
                ),
                _flow(
                    "error-time",
                    [_test("$.payload.querystring.page", value="error")],
                    [{"op": "Replace", "path": "$.timestamp", "value": "yesterday"}],
                ),
                _flow(
                    "purchase-add",
                    [_test("$.payload.querystring.page", value="purchase")],
                    [{"op": "Add", "path": "$.querystring", "value": [{"name": "added", "value": "1"}]}],
                ),
                _flow(
                    "signup-cast",
                    [_test("$.payload.querystring.page", value="signup")],
                    [{"op": "Cast", "path": "$.vendor", "from": "String", "to": "Array"}],
                ),
            ],
            schema_of(wire.TRACKER_PROTOCOL_VIOLATIONS, "1-*-*"): [
                _flow(
                    "mid-failure",
                    [_test("$.payload.querystring.page", value="purchase")],
                    [
                        {"op": "Replace", "path": "$.useragent", "value": "x"},
                        {"op": "Replace", "path": "$.nope", "value": "y"},
                        {"op": "Replace", "path": "$.hostname", "value": "z"},
                    ],
                ),
                _flow("blank-host", [], [{"op": "Remove", "path": "$.hostname"}]),
            ],
            schema_of(wire.FORMAT_VIOLATION, "1-0-0"): [_flow("passthrough", [], [])],
            schema_of(wire.SIZE_VIOLATION, "1-0-0"): [
                _flow("too-large", [_test("$.failure.actualSizeBytes", size={"gt": 50})], [])
            ],
        },
    }
)


def check_config() -> Config:
    return load_config(CONFIG_JSON)


_IN_VIOLATIONS = "kind IN (0, 6)"

# Outcome of every event under that configuration: `code` is NULL when recovered.
OUTCOME_SQL = f"""
o AS (
  SELECT *, CASE WHEN code IS NULL THEN 'recovered'
      WHEN code = 'UnrecoverableBadRowType' THEN 'unrecoverable' ELSE 'failed' END AS status
  FROM (
    SELECT *, CASE
      WHEN event_id % 16 = 7 THEN 'InvalidJsonFormat'
      WHEN event_id % 32 = 31 THEN 'InvalidDataFormat'
      WHEN kind = 7 THEN 'FailedToMatchConfiguration'
      WHEN kind IN (0, 1, 2, 3, 6) AND event_id % 13 = 0 THEN 'InvalidDataFormat'
      WHEN kind = 1 AND event_id % 40 = 1 THEN 'InvalidDataFormat'
      WHEN {_IN_VIOLATIONS} AND et = 'error' THEN 'FailedToMatchConfiguration'
      WHEN {_IN_VIOLATIONS} AND et IN ('click', 'view') AND NOT has_ue THEN 'FailedToMatchConfiguration'
      WHEN {_IN_VIOLATIONS} AND et = 'purchase' AND NOT has_ue THEN 'ReplacementFailure'
      WHEN {_IN_VIOLATIONS} AND et = 'signup' AND NOT has_ue THEN 'UncoerciblePayload'
      WHEN kind = 1 AND et IN ('purchase', 'signup') AND NOT has_ue THEN 'UncoerciblePayload'
      WHEN kind = 2 AND et IN ('error', 'signup') THEN 'InvalidJsonFormat'
      WHEN kind = 3 AND et = 'purchase' THEN 'ReplacementFailure'
      WHEN kind = 4 AND event_id % 7 = 0 THEN 'Base64Failure'
      WHEN kind = 4 AND event_id % 16 <> 12 AND (event_id % 5 = 0 OR event_id % 11 = 0) THEN 'UnexpectedFieldFormat'
      WHEN kind = 5 AND k > 50 THEN 'UnrecoverableBadRowType'
      WHEN kind = 5 THEN 'FailedToMatchConfiguration'
    END AS code
    FROM f
  )
)"""


def with_outcomes(body: str, *more: str) -> str:
    return with_facts(body, OUTCOME_SQL, *more)
