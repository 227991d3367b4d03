"""One query per operator, each with the SQL that states its expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmend import wire
from rowmend.functions import codecs, schema_keys, variants as V
from rowmend.functions import querystring as Q
from rowmend.operators import conditions as C
from rowmend.operators import outcomes as O
from rowmend.operators import paths, steps as T
from rowmend.operators.decode import decode_events, parse_events, unwrap_recovery_errors
from rowmend.operators.recover import recover, refuse_unrecoverable, repair_format_violations
from rowmend.operators.requests import from_request, to_request
from rowmend.plans.recovery import execute
from rowmend.sources import files
from rowmend.sources.batches import message_batches
from rowmend.streaming.job import LiveCounters, durable_counters, stream_recover, write_batch

from . import fixtures as X
from .fixtures import with_facts, with_outcomes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


# --- shared inputs, written once per session --------------------------------------

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    V.configure(spark)
    if key not in _written:
        path = f"{X.scratch_dir(spark)}/{name}"
        make().write.parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`event_id, value`: the failed-event lines."""
    return _once(spark, sf_dir, "lines", lambda: X.bad_rows(spark, sf_dir))


def text_dir(spark: SparkSession, sf_dir: str) -> str:
    """Folder of compressed text files with the lines; these are not stored a second time for it."""
    key = (spark.sparkContext.applicationId, sf_dir, "text")
    if key not in _written:
        path = f"{X.scratch_dir(spark)}/text"
        made = lines(spark, sf_dir) if (*key[:2], "lines") in _written else X.bad_rows(spark, sf_dir)
        files.write_text(made.select("value"), path, "error")
        _written[key] = path
    return _written[key]


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every line under the check configuration."""

    def make() -> DataFrame:
        done = execute(lines(spark, sf_dir), X.check_config())
        return done.withColumn("code", F.col("err")["code"]).select(
            "event_id", "status", "code", "request", "error_row", "flows", "row_type", "recoveries", "line"
        )

    return _once(spark, sf_dir, "outcomes", make)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`event_id, document`: the payload part of every line, as it stands."""
    return lines(spark, sf_dir).select(
        "event_id", F.expr(V.let(V.wrapped("value"), lambda w: V.get(w, 0, "data", "payload"))).alias("document")
    )


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.json_values(spark, sf_dir).withColumnRenamed("payload", "document")


def _string(sql: str) -> str:
    return f"CAST({sql} AS STRING)"


# --- sources and sinks -------------------------------------------------------------

_ROW_TYPE_SQL = f"""CASE kind WHEN 0 THEN '{wire.SCHEMA_VIOLATIONS}' WHEN 1 THEN '{wire.ENRICHMENT_FAILURES}'
  WHEN 2 THEN '{wire.ADAPTER_FAILURES}' WHEN 3 THEN '{wire.TRACKER_PROTOCOL_VIOLATIONS}'
  WHEN 4 THEN '{wire.FORMAT_VIOLATION}' WHEN 5 THEN '{wire.SIZE_VIOLATION}' WHEN 6 THEN '{wire.RECOVERY_ERROR}'
  ELSE CASE WHEN event_id % 16 = 7 THEN NULL WHEN event_id % 32 = 15 THEN 'loader_parsing_error' ELSE 'mystery' END END"""
_BY_TYPE_SQL = with_facts(f"SELECT {_ROW_TYPE_SQL} AS row_type, count(*) AS n FROM f GROUP BY 1")


def _count_by_type(read: DataFrame) -> DataFrame:
    named = parse_events(read).withColumn("row_type", F.expr(schema_keys.schema_name("schema")))
    return named.groupBy("row_type").agg(F.count("*").alias("n"))


@check("read_failed_events", _BY_TYPE_SQL)
def _(spark, sf_dir):
    return _count_by_type(files.read_failed_events(spark, text_dir(spark, sf_dir)))


@check("stream_failed_events", _BY_TYPE_SQL)
def _(spark, sf_dir):
    where = X.scratch_dir(spark)
    stream = files.stream_failed_events(spark, text_dir(spark, sf_dir))
    started = stream.writeStream.format("parquet").option("checkpointLocation", f"{where}/c").trigger(availableNow=True)
    started.start(f"{where}/out").awaitTermination()
    return _count_by_type(spark.read.parquet(f"{where}/out"))


_USER_SQL = "CASE WHEN uuid = 'no-uuid' THEN NULL ELSE uuid END"


@check(
    "stream_records",
    with_outcomes(
        f"SELECT {_USER_SQL} AS network_user_id, '/' || vendor || '/v1' AS path, true AS key_fits,"
        " 'recovered' AS header, 'good-topic' AS topic FROM o WHERE status = 'recovered'"
    ),
)
def _(spark, sf_dir):
    value = F.col("value").cast("string")
    return files.to_stream_records(outcomes(spark, sf_dir), "good-topic").select(
        F.get_json_object(value, "$.networkUserId").alias("network_user_id"),
        F.get_json_object(value, "$.path").alias("path"),
        (F.col("key") == F.md5("value")).alias("key_fits"),
        F.col("headers")[0]["key"].alias("header"),
        F.col("headers")[0]["value"].cast("string").alias("topic"),
    )


@check("recovered_sink", with_outcomes("SELECT vendor, count(*) AS n FROM o WHERE status = 'recovered' GROUP BY 1"))
def _(spark, sf_dir):
    where = f"{X.scratch_dir(spark)}/recovered"
    files.write_recovered(outcomes(spark, sf_dir), where)
    return spark.read.parquet(where).groupBy("vendor").agg(F.count("*").alias("n"))


_LEAD = r"^(Failed to [a-z]+|Unable to [a-z]+|Supplied data|Failed to properly)"
_LEAD_SQL = """CASE code WHEN 'InvalidJsonFormat' THEN 'Failed to parse' WHEN 'InvalidDataFormat' THEN 'Failed to create'
  WHEN 'FailedToMatchConfiguration' THEN 'Failed to load' WHEN 'ReplacementFailure' THEN 'Failed to replace'
  WHEN 'UncoerciblePayload' THEN 'Unable to coerce' WHEN 'Base64Failure' THEN 'Failed to properly'
  WHEN 'UnexpectedFieldFormat' THEN 'Supplied data' WHEN 'UnrecoverableBadRowType' THEN 'Failed to recover' END"""


def _written_errors(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    base = X.scratch_dir(spark)
    files.write_errors(outcomes(spark, sf_dir), base, status)
    message = F.coalesce(
        F.get_json_object("value", "$.data.failure.error"), F.get_json_object("value", "$.data.failure.message")
    )
    return (
        spark.read.text(files.error_dir(base))
        .select(
            F.expr(schema_keys.schema_name("get_json_object(value, '\\u0024.schema')")).alias("row_type"),
            F.regexp_extract(message, _LEAD, 1).alias("lead"),
        )
        .groupBy("row_type", "lead")
        .agg(F.count("*").alias("n"))
    )


def _errors_sql(status: str) -> str:
    return with_outcomes(
        f"SELECT CASE WHEN event_id % 16 = 7 THEN '{wire.FORMAT_VIOLATION}' ELSE '{wire.RECOVERY_ERROR}' END AS row_type,"
        f" {_LEAD_SQL} AS lead, count(*) AS n FROM o WHERE status = '{status}' GROUP BY 1, 2"
    )


@check("failed_sink", _errors_sql("failed"))
def _(spark, sf_dir):
    return _written_errors(spark, sf_dir, O.FAILED)


@check("unrecoverable_sink", _errors_sql("unrecoverable"))
def _(spark, sf_dir):
    return _written_errors(spark, sf_dir, O.UNRECOVERABLE)


@check(
    "output_paths",
    """SELECT page_id, u || '/unrecovered' AS failed, u || '/unrecoverable' AS unrecoverable,
         u || '/bad' AS told_failed, u || '/bad/unrecoverable' AS below_failed
       FROM (SELECT page_id, regexp_replace(url, '/$', '') AS u FROM pages)""",
)
def _(spark, sf_dir):
    pages = X.table(spark, sf_dir, "pages").withColumn("u", F.regexp_replace("url", "/$", ""))
    bases = pages.select(
        "page_id",
        F.expr(files.error_bases("concat(' ', u, '/*')")).alias("beside"),
        F.expr(files.error_bases("url", "concat(u, '/bad')")).alias("told"),
    )
    return bases.select("page_id", "beside.*", F.col("told.failed").alias("told_failed"), F.col("told.unrecoverable").alias("below_failed"))


_BATCH_RECORDS, _BATCH_BYTES = 7, 12_000


@check(
    "message_batches",
    f"""WITH RECURSIVE r AS (SELECT doc_id, doc_id % 16 AS shard, octet_length(encode(text)) AS n, row_number() OVER (PARTITION BY doc_id % 16 ORDER BY doc_id) AS i FROM documents),
        walk AS (SELECT doc_id, shard, i, 0 AS batch, 1 AS held, n AS bytes FROM r WHERE i = 1
          UNION ALL SELECT r.doc_id, r.shard, r.i, CASE WHEN held + 1 > {_BATCH_RECORDS} OR bytes + n > {_BATCH_BYTES} THEN batch + 1 ELSE batch END,
            CASE WHEN held + 1 > {_BATCH_RECORDS} OR bytes + n > {_BATCH_BYTES} THEN 1 ELSE held + 1 END,
            CASE WHEN held + 1 > {_BATCH_RECORDS} OR bytes + n > {_BATCH_BYTES} THEN n ELSE bytes + n END
          FROM walk JOIN r ON r.shard = walk.shard AND r.i = walk.i + 1)
        SELECT doc_id, shard, CAST(batch AS BIGINT) AS batch FROM walk""",
)
def _(spark, sf_dir):
    """Records of a message sink by shard, in batches of at most so many records and bytes."""
    records = X.table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 16).alias("shard"), F.col("text").alias("value"))
    in_order = records.repartition("shard").sortWithinPartitions("shard", "doc_id")
    return message_batches(in_order, _BATCH_RECORDS, _BATCH_BYTES, within="shard").select("doc_id", "shard", "batch")


# --- parse and decode --------------------------------------------------------------


@check(
    "parse_line",
    with_facts(
        """SELECT 'event' AS source, event_id % 16 <> 7 AS ok, count(*) AS n FROM f GROUP BY ALL
        UNION ALL SELECT 'props', json_valid(props), count(*) FROM events GROUP BY ALL
        UNION ALL SELECT 'props and more', json_valid(props || ' x'), count(*) FROM events GROUP BY ALL
        UNION ALL SELECT 'document', json_valid(text), count(*) FROM documents GROUP BY ALL"""
    ),
)
def _(spark, sf_dir):
    props = X.table(spark, sf_dir, "events").select("props")
    texts = (
        lines(spark, sf_dir)
        .select(F.lit("event").alias("source"), "value")
        .unionAll(props.select(F.lit("props"), "props"))
        .unionAll(props.select(F.lit("props and more"), F.concat("props", F.lit(" x"))))
        .unionAll(X.table(spark, sf_dir, "documents").select(F.lit("document"), "text"))
    )
    return (
        texts.select("source", F.expr(f"{V.parse('value')} IS NOT NULL").alias("ok"))
        .groupBy("source", "ok")
        .agg(F.count("*").alias("n"))
    )


_ENVELOPE_CODE_SQL = (
    "CASE WHEN event_id % 16 = 7 THEN 'InvalidJsonFormat' WHEN event_id % 32 = 31 THEN 'InvalidDataFormat' END"
)


@check(
    "decode_envelope",
    with_facts(f"SELECT event_id, {_ROW_TYPE_SQL} AS row_type, {_ENVELOPE_CODE_SQL} AS code FROM f"),
)
def _(spark, sf_dir):
    return parse_events(lines(spark, sf_dir)).select(
        "event_id",
        F.expr(schema_keys.schema_name("schema")).alias("row_type"),
        F.col("err")["code"].alias("code"),
    )


@check(
    "unwrap_recovery_error",
    with_facts(
        f"""SELECT event_id, CASE WHEN kind = 6 THEN '{wire.SCHEMA_VIOLATIONS}' ELSE {_ROW_TYPE_SQL} END AS inner_type,
        CASE WHEN kind = 6 THEN 1 + event_id % 3 ELSE 0 END AS recoveries FROM f"""
    ),
)
def _(spark, sf_dir):
    return unwrap_recovery_errors(parse_events(lines(spark, sf_dir))).select(
        "event_id",
        F.expr(schema_keys.schema_name("row_schema")).alias("inner_type"),
        F.col("recoveries").cast("bigint").alias("recoveries"),
    )


_URI_SQL = """u AS (
  SELECT event_id, et, k, CASE WHEN k % 11 = 0 THEN 'iglu:com.acme/' || et ELSE 'iglu:com.acme/' || et || '/jsonschema/'
    || (k % 5) || '-' || (k % 3) || '-' || CASE WHEN k % 7 = 0 THEN '*' ELSE CAST(k AS VARCHAR) END END AS uri FROM f)"""


def _uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.concat(F.lit("iglu:com.acme/"), "et")
    k = F.col("k")
    addition = F.when(k % 7 == 0, "*").otherwise(k.cast("string"))
    full = F.concat(head, F.lit("/jsonschema/"), k % 5, F.lit("-"), k % 3, F.lit("-"), addition)
    return X.facts(spark, sf_dir).select("event_id", "et", F.when(k % 11 == 0, head).otherwise(full).alias("uri"))


@check(
    "schema_key",
    with_facts(
        """SELECT event_id, CASE WHEN ok THEN 'com.acme' END AS vendor, CASE WHEN ok THEN et END AS name,
        CASE WHEN ok THEN 'jsonschema' END AS format, CASE WHEN ok THEN CAST(k % 5 AS VARCHAR) END AS model,
        CASE WHEN ok THEN CAST(k % 3 AS VARCHAR) END AS revision,
        CASE WHEN ok THEN CASE WHEN k % 7 = 0 THEN '*' ELSE CAST(k AS VARCHAR) END END AS addition
        FROM (SELECT *, k % 11 <> 0 AS ok FROM f)"""
    ),
)
def _(spark, sf_dir):
    keyed = _uris(spark, sf_dir).withColumn("key", F.expr(schema_keys.schema_key("uri")))
    return keyed.select("event_id", *[F.col("key")[p].alias(p) for p in schema_keys.PARTS])


@check(
    "schema_match",
    with_facts(
        """SELECT event_id, k % 11 <> 0 AND et = 'click' AS any_click,
        k % 11 <> 0 AND et = 'view' AND k % 5 = 1 AS view_one,
        k % 11 <> 0 AND et = 'view' AND k % 5 = 1 AND k % 3 = 0 AND (k = 51 OR k % 7 = 0) AS view_exact,
        false AS malformed, k % 11 <> 0 AND et = 'signup' AND (k % 5 = 2) AS column_pattern
        FROM f""",
    ),
)
def _(spark, sf_dir):
    fits = lambda p: F.expr(schema_keys.schema_matches("uri", p))
    return _uris(spark, sf_dir).select(
        "event_id",
        fits("iglu:com.acme/click/jsonschema/*-*-*").alias("any_click"),
        fits("iglu:com.acme/view/jsonschema/1-*-*").alias("view_one"),
        fits("iglu:com.acme/view/jsonschema/1-0-51").alias("view_exact"),
        fits("com.acme/view").alias("malformed"),
        F.expr(schema_keys.schema_keys_match("uri", "'iglu:com.acme/signup/jsonschema/2-*-*'")).alias("column_pattern"),
    )


# The documents inside the pairs, as text.
_UE_PR_SQL = (
    """('{"schema":"iglu:com.acme/unstruct_event/jsonschema/1-0-0","data":{"schema":"iglu:com.acme/' || et || '/jsonschema/1-0-0","data":{"k":'"""
    """ || k || ',"value":' || val || ',"user_id":' || uid || '}}}')"""
)
_CX_SQL = (
    f"""to_base64(encode('{{"schema":"iglu:com.acme/contexts/jsonschema/1-0-0","data":[{{"schema":"{X.PAGE_CONTEXT}","data":{{"id":"' || h"""
    f""" || '"}}}},{{"schema":"{X.TIMING_CONTEXT}","data":{{"k":' || k || ',"zero":0}}}}]}}'))"""
)


@check(
    "nvp_decode",
    with_facts(
        f"""SELECT event_id, kind, name, value FROM (
          SELECT event_id, kind, unnest(['e', 'page', 'aid', 'cx']) AS name, unnest(['ue', et, aid, {_CX_SQL}]) AS value FROM f WHERE kind = 0
          UNION ALL SELECT event_id, kind, unnest(['e', 'page', 'aid', 'n', 'flag', 'note', 'cx']),
            unnest(['ue', et, aid, CAST(k AS VARCHAR), CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END, NULL, {_CX_SQL}])
          FROM f WHERE kind = 1 AND event_id % 40 <> 1
          UNION ALL SELECT event_id, kind, 'ue_pr', {_UE_PR_SQL} FROM f WHERE has_ue AND (kind = 0 OR kind = 1 AND event_id % 40 <> 1)
          UNION ALL SELECT event_id, kind, 'failure', NULL FROM f
          WHERE kind NOT IN (0, 1) OR (kind = 1 AND event_id % 40 = 1))"""
    ),
)
def _(spark, sf_dir):
    pairs = documents(spark, sf_dir).select(
        "event_id",
        (F.col("event_id") % 8).alias("kind"),
        F.expr(Q.as_nvps(V.get("document", "raw", "parameters"))).alias("pairs"),
    )
    failure = F.expr(f"CAST(array(named_struct('name', 'failure', 'value', NULL)) AS {Q.NVPS_TYPE})")
    return (
        pairs.select("event_id", "kind", F.explode(F.coalesce("pairs", failure)).alias("p"))
        .select("event_id", "kind", F.col("p")["name"].alias("name"), F.col("p")["value"].alias("value"))
    )


@check(
    "base64_decode",
    "SELECT doc_id, true AS same, true AS url_safe, NOT regexp_full_match(text, '[A-Za-z0-9+/_-]*={0,2}') AS refused"
    " FROM documents",
)
def _(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").withColumn("coded", F.expr(codecs.b64_encode("text")))
    safe = "rtrim('=', translate(coded, '+/', '-_'))"
    return docs.select(
        "doc_id",
        F.expr(f"{codecs.b64_decode('coded')} = text").alias("same"),
        F.expr(f"{codecs.b64_decode(safe)} = text").alias("url_safe"),
        F.expr(f"{codecs.b64_decode('text')} IS NULL").alias("refused"),
    )


@check("base64_encode", "SELECT doc_id, md5(to_base64(encode(text))) AS coded FROM documents")
def _(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select("doc_id", F.expr(f"md5({codecs.b64_encode('text')})").alias("coded"))


_PARTS_SQL = """parts AS (SELECT id, string_split(qs, '&') AS ps FROM qs),
good AS (SELECT id, CASE WHEN b = 0 THEN ps ELSE ps[1:b - 1] END AS ps FROM (
  SELECT id, ps, coalesce(list_position(list_transform(ps, lambda p: contains(p, '=')), false), 0) AS b FROM parts)),
pairs AS (SELECT id, name, max_by(value, i) AS value FROM (
  SELECT id, i, split_part(ps[i], '=', 1) AS name, substr(ps[i], strpos(ps[i], '=') + 1) AS value
  FROM (SELECT id, ps, unnest(range(1, len(ps) + 1)) AS i FROM good)) GROUP BY 1, 2)"""


@check("querystring_params", with_facts("SELECT id, name, value FROM pairs", X.RAW_QS_SQL, _PARTS_SQL))
def _(spark, sf_dir):
    read = X.raw_querystrings(spark, sf_dir).withColumn("params", F.expr(Q.qs_params("qs")))
    return read.select("id", F.explode("params").alias("name", "value"))


_CLEAN_SQL = """array_to_string(list_transform(regexp_extract_all({x}, '(?s)(%[0-9A-Fa-f]{{2}}|.)'), lambda c:
  CASE WHEN length(c) = 3 OR regexp_full_match(c, '[A-Za-z0-9_.~:/#\\[\\]@!$&''()*+,;=-]') THEN c
  ELSE replace(url_encode(c), '%20', '+') END), '')"""


@check(
    "querystring_clean",
    with_facts(
        f"""SELECT id, {_CLEAN_SQL.format(x='value')} AS cleaned FROM (
          SELECT 'd' || doc_id AS id, text AS value FROM documents
          UNION ALL SELECT 'e' || event_id, '<' || et || '> 50% off %7e |x^y` \\' || k || '\\' FROM f)"""
    ),
)
def _(spark, sf_dir):
    texts = X.table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("text").alias("value"))
    built = X.facts(spark, sf_dir).select(
        F.concat(F.lit("e"), "event_id"),
        F.concat(F.lit("<"), "et", F.lit("> 50% off %7e |x^y` \\"), "k", F.lit("\\")),
    )
    return texts.unionAll(built).select("id", F.expr(Q.qs_clean("value")).alias("cleaned"))


_NVPS_SQL = """cut AS (SELECT id, p, rtrim(p, '=') AS t, string_split(rtrim(p, '='), '=') AS xs
  FROM (SELECT id, unnest(string_split(coalesce(qs, ''), '&')) AS p FROM qs) WHERE p <> ''),
nvps AS (SELECT id, CASE WHEN t = '' THEN '' ELSE xs[1] END AS name,
  CASE WHEN t = '' THEN '' WHEN len(xs) = 2 THEN url_decode(replace(xs[2], '+', ' ')) END AS value
  FROM cut WHERE t = '' OR len(xs) <= 2)"""


@check("querystring_to_nvps", with_facts("SELECT id, name, value FROM nvps", X.RAW_QS_SQL, _NVPS_SQL))
def _(spark, sf_dir):
    read = X.raw_querystrings(spark, sf_dir).select("id", F.explode(F.expr(Q.qs_to_nvps("qs"))).alias("p"))
    return read.select("id", F.col("p")["name"].alias("name"), F.col("p")["value"].alias("value"))


@check(
    "nvps_to_querystring",
    with_facts(
        "SELECT event_id, 'e={' || et || '}&v=' || replace(url_encode('{' || et || '} a+b=' || val), '%20', '+')"
        " || '&none=' AS qs FROM f"
    ),
)
def _(spark, sf_dir):
    pairs = (
        "array(named_struct('name', 'e={', 'value', ''), named_struct('name', 'v', 'value', concat('{', et, '} a+b=', val)),"
        " named_struct('name', 'none', 'value', CAST(NULL AS STRING)))"
    )
    built = Q.nvps_to_qs(pairs)
    return X.facts(spark, sf_dir).select(
        "event_id", F.expr(f"replace({built}, 'e={{=', concat('e={{', et, '}}'))").alias("qs")
    )


# --- predicates ------------------------------------------------------------------


@check(
    "compare",
    with_facts(
        """SELECT event_id, event_id % 6 = 0 AS is_null, event_id % 6 = 1 AND k % 2 = 0 AS is_true,
        event_id % 6 = 2 AND val = 12.5 AS is_number, event_id % 6 = 3 AND et = 'click' AS is_click,
        event_id % 6 = 4 AND k = 7 AND uid = 3 AS is_array, event_id % 6 = 5 AND k = 7 AND et = 'view' AS is_object,
        false AS is_missing FROM f"""
    ),
)
def _(spark, sf_dir):
    return values(spark, sf_dir).select(
        "event_id",
        C.equals("$.v", None).alias("is_null"),
        C.equals("$.v", True).alias("is_true"),
        C.equals("$.v", 12.5).alias("is_number"),
        C.equals("$.v", "click").alias("is_click"),
        C.equals("$.v", [7, 3]).alias("is_array"),
        C.equals("$.v", {"t": "view", "k": 7}).alias("is_object"),
        C.equals("$.w", None).alias("is_missing"),
    )


@check(
    "regular_expression",
    with_facts(
        """SELECT event_id, coalesce(regexp_matches(t, 'i[ce]'), false) AS letters, regexp_matches(t, '^"') AS quoted,
        regexp_matches(t, '^[0-9]+[.]?[0-9]*$') AS numeric, regexp_matches(t, 'null') AS is_null, false AS is_missing FROM (
        SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'null' WHEN 1 THEN CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END
          WHEN 2 THEN CAST(val AS VARCHAR) WHEN 3 THEN '"' || et || '"' WHEN 4 THEN '[' || k || ',' || uid || ']'
          ELSE '{"k":' || k || ',"t":"' || et || '"}' END AS t FROM f)"""
    ),
)
def _(spark, sf_dir):
    return values(spark, sf_dir).select(
        "event_id",
        C.matches("$.v", "i[ce]").alias("letters"),
        C.matches("$.v", '^"').alias("quoted"),
        C.matches("$.v", "^[0-9]+[.]?[0-9]*$").alias("numeric"),
        C.matches("$.v", "null").alias("is_null"),
        C.matches("$.w", ".*").alias("is_missing"),
    )


@check(
    "size",
    with_facts(
        """SELECT event_id, coalesce(n = 5, false) AS five, coalesce(n > 5, false) AS more, coalesce(n < 5, false) AS less
        FROM (SELECT event_id, CASE event_id % 6 WHEN 2 THEN ceil(val) WHEN 3 THEN length(et) WHEN 4 THEN 2 END AS n FROM f)"""
    ),
)
def _(spark, sf_dir):
    return values(spark, sf_dir).select(
        "event_id",
        C.size_is("$.v", eq=5).alias("five"),
        C.size_is("$.v", gt=5).alias("more"),
        C.size_is("$.v", lt=5).alias("less"),
    )


@check(
    "all_conditions",
    with_facts(
        """SELECT event_id, true AS none_given, event_id % 6 = 3 AND et IN ('click', 'view') AND length(et) < 5 AS all_hold,
        false AS missing_path FROM f"""
    ),
)
def _(spark, sf_dir):
    return values(spark, sf_dir).select(
        "event_id",
        C.all_of([]).alias("none_given"),
        C.all_of([C.matches("$.v", '^"(click|view)"$'), C.size_is("$.v", lt=5)]).alias("all_hold"),
        C.all_of([C.matches("$.v", "."), C.matches("$.w", ".")]).alias("missing_path"),
    )


_DECODED_SQL = "NOT (event_id % 13 = 0 AND kind IN (0, 1, 2, 3, 6)) AND NOT (kind = 1 AND event_id % 40 = 1)"
_FLOWS_SQL = f"""flows AS (SELECT event_id, kind, flow FROM (
  SELECT event_id, kind, unnest(list_filter([
    CASE WHEN kind IN (0, 6) AND has_ue AND et = 'click' THEN 'fix-schema' END,
    CASE WHEN kind IN (0, 6) AND et = 'purchase' THEN 'purchase-price' END,
    CASE WHEN kind IN (0, 6) AND et = 'signup' THEN 'signup-as-is' END,
    CASE WHEN kind IN (0, 6) AND has_ue AND et = 'view' THEN 'view-timing' END,
    CASE WHEN kind IN (0, 6) AND has_ue AND et = 'view' THEN 'view-page' END,
    CASE WHEN kind = 1 THEN 'enrich-tidy' END,
    CASE WHEN kind = 2 THEN CASE et WHEN 'click' THEN 'click-page' WHEN 'view' THEN 'view-all' WHEN 'error' THEN 'error-time'
      WHEN 'purchase' THEN 'purchase-add' ELSE 'signup-cast' END END,
    CASE WHEN kind = 3 AND et = 'purchase' THEN 'mid-failure' END,
    CASE WHEN kind = 3 THEN 'blank-host' END,
    CASE WHEN kind = 4 THEN 'passthrough' END,
    CASE WHEN kind = 5 AND k > 50 THEN 'too-large' END], lambda x: x IS NOT NULL)) AS flow
  FROM f WHERE {_DECODED_SQL}))"""


@check("match_flows", with_facts("SELECT event_id, flow FROM flows", _FLOWS_SQL))
def _(spark, sf_dir):
    matched = C.match_flows(decode_events(lines(spark, sf_dir)), X.check_config())
    return matched.select("event_id", F.explode("flows").alias("flow"))


@check(
    "no_flow",
    with_facts(
        f"""SELECT CASE WHEN kind = 6 THEN '{wire.SCHEMA_VIOLATIONS}' ELSE {_ROW_TYPE_SQL} END AS row_type, count(*) AS n FROM f
        WHERE event_id % 16 <> 7 AND event_id % 32 <> 31 AND {_DECODED_SQL}
        AND event_id NOT IN (SELECT event_id FROM flows) GROUP BY 1""",
        _FLOWS_SQL,
    ),
)
def _(spark, sf_dir):
    matched = C.match_flows(decode_events(lines(spark, sf_dir)), X.check_config())
    unmatched = matched.filter(F.col("err")["code"] == "FailedToMatchConfiguration")
    return unmatched.groupBy("row_type").agg(F.count("*").alias("n"))


# --- paths -------------------------------------------------------------------------


def _edited(frame: DataFrame, path: str, value: str, *shown: str) -> DataFrame:
    """Replace at a path, then read other paths; also the error code."""
    changed = T.replace(frame, path, value)
    columns = [
        F.expr(_string(paths.read("document", p))).alias(f"seen_{i}") for i, p in enumerate(shown)
    ]
    return changed.select("event_id", *columns, F.col("err")["code"].alias("code"))


@check(
    "path_field",
    with_facts(
        """SELECT event_id, CASE WHEN kind IN (0, 1) THEN 'new-host' END AS seen_0,
        CASE WHEN kind IN (0, 1) THEN 'agent/' || et END AS seen_1, CASE WHEN kind IN (0, 1) THEN 'd' || uid END AS seen_2,
        CASE WHEN event_id % 16 <> 7 AND kind NOT IN (0, 1) OR event_id % 16 = 7 THEN 'ReplacementFailure' END AS code FROM f"""
    ),
)
def _(spark, sf_dir):
    return _edited(
        documents(spark, sf_dir), "$.raw.hostname", "new-host", "$.raw.hostname", "$.raw.useragent", "$.enriched.domain_userid"
    )


@check(
    "path_item",
    with_facts(
        """SELECT event_id, CASE WHEN kind = 0 THEN 'e' END AS seen_0, CASE WHEN kind = 0 THEN 'changed' END AS seen_1,
        CASE WHEN kind = 0 THEN 'aid' END AS seen_2, CASE WHEN kind <> 0 THEN 'ReplacementFailure' END AS code FROM f"""
    ),
)
def _(spark, sf_dir):
    shown = [f"$.raw.parameters.[{i}].name" for i in range(3)]
    return _edited(documents(spark, sf_dir), "$.raw.parameters.[1].name", "changed", *shown)


@check(
    "path_filter",
    with_facts(
        """SELECT event_id, CASE WHEN kind IN (2, 3) THEN 'changed' END AS seen_0,
        CASE WHEN kind IN (2, 3) THEN 'changed' END AS seen_1, CASE WHEN kind IN (2, 3) THEN aid END AS seen_2,
        CASE WHEN kind NOT IN (2, 3) THEN 'ReplacementFailure' END AS code FROM f"""
    ),
)
def _(spark, sf_dir):
    shown = [f"$.querystring.[{i}].value" for i in range(3)]
    return _edited(documents(spark, sf_dir), '$.querystring.[?(@.name=~"(e|page)")].value', "changed", *shown)


@check(
    "path_nvp",
    with_facts(
        """SELECT event_id, CASE WHEN kind IN (2, 3) THEN 'changed' END AS page, CASE WHEN kind IN (2, 3) THEN aid END AS aid,
        CASE WHEN kind NOT IN (2, 3) THEN CASE WHEN kind IN (0, 1, 4, 5, 6, 7) THEN 'ReplacementFailure' END END AS code,
        CASE WHEN kind IN (2, 3) THEN 'InvalidDataFormat' ELSE 'ReplacementFailure' END AS unknown FROM f"""
    ),
)
def _(spark, sf_dir):
    changed = T.replace(documents(spark, sf_dir), "$.querystring.page", "changed").withColumnRenamed("err", "err_page")
    unknown = T.replace(changed.withColumn("kept", F.col("document")), "$.querystring.nope", "x")
    return unknown.select(
        "event_id",
        F.expr(_string(paths.read("kept", "$.querystring.page"))).alias("page"),
        F.expr(_string(paths.read("kept", "$.querystring.aid"))).alias("aid"),
        F.col("err_page")["code"].alias("code"),
        F.col("err")["code"].alias("unknown"),
    )


@check(
    "path_base64",
    with_facts(
        f"""SELECT event_id, CASE WHEN kind = 0 THEN h END AS seen_0, CASE WHEN kind = 0 THEN 'changed' END AS seen_1,
        CASE WHEN kind = 0 THEN CAST(k AS VARCHAR) END AS seen_2, CASE WHEN kind <> 0 THEN 'ReplacementFailure' END AS code
        FROM f"""
    ),
)
def _(spark, sf_dir):
    cx = "$.raw.parameters.cx.data"
    return _edited(
        documents(spark, sf_dir), f"{cx}.[1].schema", "changed", f"{cx}.[0].data.id", f"{cx}.[1].schema", f"{cx}.[1].data.k"
    )


@check(
    "path_json_text",
    with_facts(
        """SELECT event_id, CASE WHEN kind IN (0, 1) THEN h END AS seen_0, CASE WHEN kind IN (0, 1) THEN 'changed' END AS seen_1,
        CASE WHEN kind IN (0, 1) THEN CAST(k AS VARCHAR) END AS seen_2,
        CASE WHEN kind NOT IN (0, 1) THEN 'ReplacementFailure' END AS code FROM f"""
    ),
)
def _(spark, sf_dir):
    at = "$.enriched.contexts.data"
    return _edited(
        documents(spark, sf_dir), f"{at}.[1].schema", "changed", f"{at}.[0].data.id", f"{at}.[1].schema", f"{at}.[1].data.k"
    )


@check(
    "path_filter_encoded",
    with_facts(
        """SELECT event_id, CASE WHEN kind = 0 AND has_ue THEN 'changed' END AS seen_0,
        CASE WHEN kind = 0 AND has_ue THEN CAST(uid AS VARCHAR) END AS seen_1,
        CASE WHEN NOT (kind = 0 AND has_ue) THEN 'ReplacementFailure' END AS code FROM f"""
    ),
)
def _(spark, sf_dir):
    at = "$.raw.parameters.[?(@.name=~ue_pr)].value.data"
    return _edited(documents(spark, sf_dir), f"{at}.schema", "changed", f"{at}.schema", f"{at}.data.user_id")


@check(
    "path_condition_read",
    with_facts(
        f"""SELECT event_id, CASE WHEN kind IN (2, 3) THEN aid END AS last_value,
        CASE WHEN kind = 0 THEN CAST(k AS VARCHAR) END AS in_context, CAST(NULL AS VARCHAR) AS partly_missing,
        kind = 0 AND k > 50 AS large FROM f"""
    ),
)
def _(spark, sf_dir):
    read = lambda p: F.expr(_string(paths.read("document", p)))
    return documents(spark, sf_dir).select(
        "event_id",
        read("$.querystring.[?(@.name=~a)].value").alias("last_value"),
        read("$.raw.parameters.cx.data.[?(@.schema=~com.acme/timing)].data.k").alias("in_context"),
        read("$.raw.parameters.cx.data.[?(@.schema=~com.acme)].data.k").alias("partly_missing"),
        C.size_is("$.raw.parameters.cx.data.[?(@.schema=~timing)].data.k", gt=50).alias("large"),
    )


# --- steps -------------------------------------------------------------------------


def _stepped(frame: DataFrame, **columns: str) -> DataFrame:
    return frame.select(
        "event_id", *[F.expr(sql).alias(n) for n, sql in columns.items()], F.col("err")["code"].alias("code")
    )


_V = "variant_get(document, '\\u0024.v', 'variant')"
_KIND = V.kind(_V)


@check(
    "replace_string",
    with_facts(
        """SELECT event_id, CASE event_id % 6 WHEN 0 THEN '' WHEN 3 THEN regexp_replace(et, '(i)([a-z])', '<\\2>', 'g') END AS part,
        CASE event_id % 6 WHEN 0 THEN 'all' WHEN 3 THEN 'all' END AS entire,
        CASE event_id % 6 WHEN 0 THEN '{"a":1}' WHEN 3 THEN '{"a":1}' END AS as_text FROM f"""
    ),
)
def _(spark, sf_dir):
    done = values(spark, sf_dir).withColumn("kept", F.col("document"))
    shown = F.expr(f"CASE WHEN event_id % 6 IN (0, 3) THEN CAST({_V} AS STRING) END")
    for name, value, match in (("part", "<$2>", "(i)([a-z])"), ("entire", "all", None), ("as_text", {"a": 1}, None)):
        done = T.replace(done, "$.v", value, match).withColumn(name, shown)
        done = done.drop("err").withColumn("document", F.col("kept"))
    return done.select("event_id", "part", "entire", "as_text")


@check(
    "replace_scalar",
    with_facts(
        """SELECT event_id, CASE WHEN event_id % 6 = 2 THEN 7 WHEN event_id % 6 = 4 THEN NULL END AS number,
        CASE WHEN event_id % 6 IN (1, 4, 5) THEN 'ReplacementFailure' END AS number_code,
        CASE WHEN event_id % 6 = 1 THEN true END AS flag,
        CASE WHEN event_id % 6 IN (2, 5) THEN 'ReplacementFailure' END AS flag_code FROM f"""
    ),
)
def _(spark, sf_dir):
    frame = values(spark, sf_dir).withColumn("kept", F.col("document"))
    number = (
        T.replace(frame, "$.v", 7, "[0-9]+")
        .withColumn("number", F.expr(f"CASE WHEN {_KIND} = 'd' AND err IS NULL THEN CAST({_V} AS INT) END"))
        .withColumn("number_code", F.col("err")["code"])
        .drop("err")
        .withColumn("document", F.col("kept"))
    )
    flag = T.replace(number, "$.v", True)
    return flag.select(
        "event_id",
        "number",
        "number_code",
        F.expr(f"CASE WHEN {_KIND} = 'b' AND err IS NULL THEN CAST({_V} AS BOOLEAN) END").alias("flag"),
        F.col("err")["code"].alias("flag_code"),
    )


@check(
    "replace_array",
    with_facts(
        """SELECT event_id, CASE WHEN event_id % 6 = 4 THEN CASE WHEN contains(CAST(k AS VARCHAR), '7') THEN 0 ELSE 1 END
          + CASE WHEN contains(CAST(uid AS VARCHAR), '7') THEN 0 ELSE 1 END + 1 END AS appended,
        CASE WHEN event_id % 6 = 4 THEN 2 END AS swapped, CASE WHEN event_id % 6 = 4 THEN 1 END AS single,
        CASE WHEN event_id % 6 = 4 THEN k + 0 END AS rewritten FROM f"""
    ),
)
def _(spark, sf_dir):
    frame = values(spark, sf_dir).withColumn("kept", F.col("document"))
    size = f"CASE WHEN event_id % 6 = 4 THEN size(try_cast({_V} AS ARRAY<VARIANT>)) END"

    def run(frame: DataFrame, name: str, value: object, match: str | None, sql: str) -> DataFrame:
        changed = T.replace(frame, "$.v", value, match).withColumn(name, F.expr(sql))
        return changed.drop("err").withColumn("document", F.col("kept"))

    done = run(frame, "appended", ["new"], "7", size)
    done = run(done, "swapped", ["a", "b"], None, size)
    done = run(done, "single", "x", None, size)
    first = "CASE WHEN event_id % 6 = 4 THEN CAST(variant_get(document, '\\u0024.v[0]', 'variant') AS BIGINT) END"
    done = run(done, "rewritten", "[$1]", r"^\[([0-9]+),.*$", first)
    return done.select("event_id", "appended", "swapped", "single", "rewritten")


@check(
    "replace_object",
    with_facts(
        """SELECT event_id, CASE WHEN event_id % 6 = 5 THEN k END AS k, CASE WHEN event_id % 6 = 5 THEN 'yes' END AS added,
        CASE WHEN event_id % 6 IN (1, 2) THEN 'ReplacementFailure' WHEN event_id % 6 = 5 THEN 'ok' END AS code,
        CASE WHEN event_id % 6 = 5 THEN 'InvalidJsonFormat' END AS broken FROM f"""
    ),
)
def _(spark, sf_dir):
    frame = values(spark, sf_dir).select("event_id", "document", F.col("document").alias("kept"))
    done = T.replace(frame, "$.v", '$1,"added":"yes"}', r"^(.*)\}$")
    field = lambda n, t: f"CASE WHEN event_id % 6 = 5 THEN CAST({V.get('document', 'v', n)} AS {t}) END"
    done = (
        done.withColumn("k", F.expr(field("k", "BIGINT")))
        .withColumn("added", F.expr(field("added", "STRING")))
        .withColumn("code", F.expr("CASE WHEN event_id % 6 IN (1, 2) THEN err.code WHEN event_id % 6 = 5 THEN coalesce(err.code, 'ok') END"))
        .drop("err")
        .withColumn("document", F.col("kept"))
    )
    broken = T.replace(done, "$.v", "{", r"^(.*)\}$")
    return broken.select(
        "event_id", "k", "added", "code", F.expr("CASE WHEN event_id % 6 = 5 THEN err.code END").alias("broken")
    )


@check(
    "replace_null",
    with_facts("SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'filled' END AS value FROM f"),
)
def _(spark, sf_dir):
    done = T.replace(values(spark, sf_dir), "$.v", "filled", "^$")
    return done.select("event_id", F.expr(f"CASE WHEN event_id % 6 = 0 THEN CAST({_V} AS STRING) END").alias("value"))


@check(
    "remove",
    with_facts(
        """SELECT event_id, CASE WHEN event_id % 6 IN (0, 3) THEN '' WHEN event_id % 6 = 4 THEN '[""]' END AS value,
        CASE WHEN event_id % 6 IN (1, 2) THEN 'ReplacementFailure' WHEN event_id % 6 = 5 THEN 'InvalidJsonFormat' END AS code
        FROM f"""
    ),
)
def _(spark, sf_dir):
    done = T.remove(values(spark, sf_dir), "$.v")
    return _stepped(
        done,
        value=f"CASE WHEN err IS NULL THEN CASE WHEN {_KIND} = 'a' THEN to_json({_V}) ELSE CAST({_V} AS STRING) END END",
    )


@check(
    "cast_array",
    with_facts(
        """SELECT event_id, CASE WHEN event_id % 6 <> 4 THEN 1 END AS items,
        CASE WHEN event_id % 6 = 3 THEN et END AS item, CASE WHEN event_id % 6 = 4 THEN 'CastFailure' END AS code FROM f"""
    ),
)
def _(spark, sf_dir):
    done = T.cast(values(spark, sf_dir), "$.v", "String", "Array")
    return _stepped(
        done,
        items=f"CASE WHEN err IS NULL THEN size(try_cast({_V} AS ARRAY<VARIANT>)) END",
        item=f"CASE WHEN event_id % 6 = 3 THEN CAST({V.get('document', 'v', 0)} AS STRING) END",
    )


@check(
    "cast_string",
    with_facts(
        """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'null' WHEN 1 THEN CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END
          WHEN 2 THEN CAST(CAST(val AS DECIMAL(18, 2)) AS VARCHAR) WHEN 3 THEN '"' || et || '"' WHEN 4 THEN '[' || k || ',' || uid || ']'
          ELSE '{"k":' || k || ',"t":"' || et || '"}' END AS value, CAST(NULL AS VARCHAR) AS code FROM f"""
    ),
)
def _(spark, sf_dir):
    done = T.cast(values(spark, sf_dir), "$.v", "Numeric", "String")
    shown = f"CASE WHEN event_id % 6 = 2 THEN CAST(CAST(CAST({_V} AS STRING) AS DECIMAL(18, 2)) AS STRING) ELSE CAST({_V} AS STRING) END"
    return _stepped(done, value=shown)


@check(
    "cast_boolean_numeric",
    with_facts(
        """SELECT event_id, CASE WHEN event_id % 6 = 2 THEN true END AS truth, CASE WHEN event_id % 6 = 2 THEN val <> 0 END AS by_zero,
        CASE WHEN event_id % 6 = 1 THEN CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END END AS number,
        CASE WHEN event_id % 6 <> 1 THEN 'CastFailure' END AS code FROM f"""
    ),
)
def _(spark, sf_dir):
    kept = values(spark, sf_dir).withColumn("kept", F.col("document"))
    flag = f"CASE WHEN event_id % 6 = 2 THEN CAST({_V} AS BOOLEAN) END"
    done = T.cast(kept, "$.v", "Numeric", "Boolean").withColumn("truth", F.expr(flag))
    done = done.drop("err").withColumn("document", F.col("kept"))
    done = T.cast(done, "$.v", "Numeric", "Boolean", zero_is_false=True).withColumn("by_zero", F.expr(flag))
    done = T.cast(done.drop("err").withColumn("document", F.col("kept")), "$.v", "Boolean", "Numeric")
    return done.select(
        "event_id",
        "truth",
        "by_zero",
        F.expr(f"CASE WHEN err IS NULL THEN CAST({_V} AS INT) END").alias("number"),
        F.col("err")["code"].alias("code"),
    )


@check(
    "cast_string_numeric",
    with_facts(
        """SELECT event_id, val AS number, CAST(NULL AS VARCHAR) AS code, 'CastFailure' AS bad FROM f"""
    ),
)
def _(spark, sf_dir):
    frame = X.facts(spark, sf_dir).select(
        "event_id",
        F.expr("to_variant_object(named_struct('v', CAST(val AS STRING), 't', et))").alias("document"),
    )
    done = T.cast(frame, "$.v", "String", "Numeric").withColumn("code", F.col("err")["code"]).drop("err")
    bad = T.cast(done, "$.t", "String", "Numeric")
    return bad.select(
        "event_id", F.expr(f"CAST({_V} AS DOUBLE)").alias("number"), "code", F.col("err")["code"].alias("bad")
    )


@check(
    "add",
    with_facts(
        """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'x' WHEN event_id % 6 = 3 THEN et || 'x' END AS as_text,
        CASE WHEN event_id % 6 = 2 THEN val + 2 END AS as_number, CASE WHEN event_id % 6 = 1 THEN k % 2 = 0 END AS as_flag,
        CASE WHEN event_id % 6 = 4 THEN 3 END AS as_array, CASE WHEN event_id % 6 = 5 THEN 'new' END AS as_object FROM f"""
    ),
)
def _(spark, sf_dir):
    done = values(spark, sf_dir).withColumn("kept", F.col("document"))

    def run(frame: DataFrame, name: str, value: object, sql: str) -> DataFrame:
        changed = T.add(frame, "$.v", value).withColumn(name, F.expr(sql))
        return changed.drop("err").withColumn("document", F.col("kept"))

    done = run(done, "as_text", "x", f"CASE WHEN {_KIND} = 's' THEN CAST({_V} AS STRING) END")
    done = run(done, "as_number", 2, f"CASE WHEN event_id % 6 = 2 THEN CAST({_V} AS DOUBLE) END")
    done = run(done, "as_flag", True, f"CASE WHEN event_id % 6 = 1 THEN CAST({_V} AS BOOLEAN) END")
    done = run(done, "as_array", ["x"], f"CASE WHEN event_id % 6 = 4 THEN size(try_cast({_V} AS ARRAY<VARIANT>)) END")
    done = run(
        done, "as_object", {"t": "new"}, f"CASE WHEN event_id % 6 = 5 THEN CAST({V.get('document', 'v', 't')} AS STRING) END"
    )
    return done.select("event_id", "as_text", "as_number", "as_flag", "as_array", "as_object")


@check(
    "step_chain",
    with_facts(
        """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'two' WHEN 3 THEN 'two' WHEN 4 THEN '["one"]'
          WHEN 1 THEN CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END WHEN 5 THEN '{"k":' || k || ',"t":"' || et || '"}' END AS value,
        CASE WHEN event_id % 6 IN (1, 2) THEN 'ReplacementFailure' WHEN event_id % 6 = 5 THEN 'InvalidJsonFormat'
          ELSE 'CastFailure' END AS code FROM f"""
    ),
)
def _(spark, sf_dir):
    from rowmend.plans.config import Cast, Replace

    chain = [Replace("$.v", "one"), Replace("$.v", "two", "^one$"), Cast("$.nope", "String", "Array"), Replace("$.v", "late")]
    done = T.apply_steps(values(spark, sf_dir), chain)
    return _stepped(
        done,
        value=f"CASE {_KIND} WHEN 's' THEN CAST({_V} AS STRING) WHEN 'd' THEN NULL ELSE to_json({_V}) END",
    )


@check(
    "step_validity",
    with_facts(
        f"""SELECT event_id, CASE WHEN kind IN (2, 3) AND event_id % 13 <> 0 THEN 'InvalidJsonFormat' END AS pairs,
        CASE WHEN kind IN (2, 3) AND event_id % 13 <> 0 THEN 'InvalidJsonFormat' END AS stamp,
        CASE WHEN kind IN (2, 3) AND event_id % 13 <> 0 THEN 'ok' END AS fine FROM f WHERE kind IN (2, 3)"""
    ),
)
def _(spark, sf_dir):
    from rowmend.plans.config import Add, Replace

    decoded = decode_events(lines(spark, sf_dir)).withColumn("decode_err", F.col("err")).withColumn("kept", F.col("payload"))
    decoded = decoded.filter(F.expr(schema_keys.schema_name("schema")).isin(*wire.COLLECTOR_TYPES))

    def run(frame: DataFrame, name: str, step: object) -> DataFrame:
        for row_type in wire.COLLECTOR_TYPES:
            frame = T.apply_payload_steps(frame, [step], row_type)
        ended = F.when(F.col("decode_err").isNull(), F.coalesce(F.col("err")["code"], F.lit("ok")))
        return frame.withColumn(name, ended).withColumn("err", F.col("decode_err")).withColumn("payload", F.col("kept"))

    done = run(decoded, "pairs", Add("$.querystring", [{"value": "no name"}]))
    done = run(done, "stamp", Replace("$.timestamp", "yesterday"))
    done = run(done, "fine", Replace("$.timestamp", "2024-02-03T04:05:06Z"))
    return done.select("event_id", "pairs", "stamp", "fine")


# --- recovery by row type ------------------------------------------------------------


@check(
    "recover_collector_types",
    with_outcomes(
        f"""SELECT event_id, {_ROW_TYPE_SQL} AS row_type, code, CASE WHEN code IS NULL THEN
          CASE WHEN kind = 3 THEN et WHEN et = 'click' THEN 'fixed-click' WHEN et = 'view' THEN 'All pages' ELSE et END END AS page,
        CASE WHEN code IS NULL THEN CASE WHEN kind = 3 THEN '' ELSE 'collector.example.com' END END AS hostname,
        CASE WHEN code IS NULL THEN CASE WHEN kind = 2 AND et = 'view' THEN 2 WHEN kind = 2 AND et = 'purchase' THEN 4
          ELSE 3 END END AS pairs FROM o WHERE kind IN (2, 3)"""
    ),
)
def _(spark, sf_dir):
    done = recover(decode_events(lines(spark, sf_dir)), X.check_config())
    ours = done.filter(F.expr(schema_keys.schema_name("schema")).isin(*wire.COLLECTOR_TYPES))
    ok = F.col("err").isNull()
    page = F.expr("element_at(map_from_entries(payload.pairs), 'page')")
    return ours.select(
        "event_id",
        F.expr(schema_keys.schema_name("schema")).alias("row_type"),
        F.col("err")["code"].alias("code"),
        F.when(ok, page).alias("page"),
        F.when(ok, F.col("payload.hostname")).alias("hostname"),
        F.when(ok, F.size("payload.pairs")).alias("pairs"),
    )


_DATA_SQL = "CASE WHEN has_ue AND kind = 0 AND et = 'purchase' THEN 1000 WHEN has_ue THEN k END"


@check(
    "recover_enrichment_types",
    with_outcomes(
        f"""SELECT event_id, CASE WHEN code IS NULL OR code = 'UncoerciblePayload' THEN CASE WHEN kind = 1 THEN 'https://docs.example.org/from/' || et
          ELSE 'https://example.com/' || et END END AS referer,
        CASE WHEN code IS NULL THEN CASE WHEN has_ue THEN 'iglu:com.acme/' || et || '/jsonschema/1-0-'
          || CASE WHEN kind = 0 AND et = 'click' THEN '1' ELSE '0' END END END AS schema,
        CASE WHEN code IS NULL THEN CASE WHEN kind = 1 THEN 'none' WHEN et = 'view' THEN 'true' ELSE '0' END END AS zero,
        CASE WHEN code IS NULL THEN CASE WHEN kind = 0 AND et = 'view' THEN k + 1 ELSE k END END AS timing_k,
        CASE WHEN code IS NULL THEN {_DATA_SQL} END AS k,
        CASE WHEN code = 'UncoerciblePayload' THEN NULL ELSE code END AS code FROM o WHERE kind IN (0, 1)"""
    ),
)
def _(spark, sf_dir):
    from rowmend.operators import access

    done = recover(decode_events(lines(spark, sf_dir)), X.check_config())
    ours = done.filter(F.expr(schema_keys.schema_name("schema")).isin(*wire.ENRICHMENT_TYPES))
    at = lambda p: access.read(paths.compile_path(p), "enrichment")
    coerced = "err IS NULL AND (payload.vendor = 'com.acme' OR exists(payload.pairs, p -> p.name = 'ue_pr'))"
    show = lambda p, t: F.expr(f"CASE WHEN {coerced} THEN CAST({at(p)} AS {t}) END")
    return ours.select(
        "event_id",
        F.when(F.col("err").isNull(), F.col("payload.refererUri")).alias("referer"),
        show("$.raw.parameters.ue_pr.data.schema", "STRING").alias("schema"),
        show("$.raw.parameters.cx.data.[1].data.zero", "STRING").alias("zero"),
        show("$.raw.parameters.cx.data.[1].data.k", "BIGINT").alias("timing_k"),
        show("$.raw.parameters.ue_pr.data.data.k", "BIGINT").alias("k"),
        F.col("err")["code"].alias("code"),
    )


_REPAIRED_SQL = """SELECT event_id, code, CASE WHEN code IS NULL THEN '<' || et || '>' END AS e,
  CASE WHEN code IS NULL THEN 'p|q ^r' END AS pv, CASE WHEN code IS NULL THEN '50% off' END AS k,
  CASE WHEN code IS NULL THEN aid END AS aid, CASE WHEN code IS NULL THEN vendor END AS vendor
  FROM o WHERE kind = 4 AND event_id % 16 <> 12"""


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair_format_violations(decode_events(lines(spark, sf_dir)))
    rows = rows.withColumn("twice", F.contains("line", F.lit(X.DOUBLE_MESSAGE)))
    return rows.filter(F.col("row_type") == wire.FORMAT_VIOLATION).withColumn(
        "params", F.expr("CASE WHEN err IS NULL THEN map_from_entries(payload.pairs) END")
    )


@check("repair_querystring", with_outcomes(_REPAIRED_SQL))
def _(spark, sf_dir):
    return _repaired(spark, sf_dir).filter(~F.col("twice")).select(
        "event_id",
        F.col("err")["code"].alias("code"),
        *[F.col("params")[n].alias(n) for n in ("e", "pv", "k", "aid")],
        F.when(F.col("err").isNull(), F.col("payload.vendor")).alias("vendor"),
    )


@check(
    "repair_double_base64",
    with_outcomes(
        """SELECT event_id, code, CASE WHEN code IS NULL THEN vendor END AS vendor, CASE WHEN code IS NULL THEN
          CASE WHEN event_id % 5 = 0 THEN 0 WHEN event_id % 11 = 0 THEN 1 ELSE 4 END END AS pairs,
        CASE WHEN code IS NULL AND event_id % 5 <> 0 AND event_id % 11 <> 0 THEN et END AS page
        FROM o WHERE kind = 4 AND event_id % 16 = 12"""
    ),
)
def _(spark, sf_dir):
    return _repaired(spark, sf_dir).filter("twice").select(
        "event_id",
        F.col("err")["code"].alias("code"),
        F.when(F.col("err").isNull(), F.col("payload.vendor")).alias("vendor"),
        F.when(F.col("err").isNull(), F.size("payload.pairs")).alias("pairs"),
        F.col("params")["page"].alias("page"),
    )


@check(
    "recover_recovery_error",
    with_outcomes(
        "SELECT event_id, status, code, CASE WHEN code IS NULL THEN '/' || vendor || '/v1' END AS path FROM o WHERE kind = 6"
    ),
)
def _(spark, sf_dir):
    wrapped = F.contains("line", F.lit(f"/{wire.RECOVERY_ERROR}/"))
    done = outcomes(spark, sf_dir).filter(wrapped)
    return done.select("event_id", "status", "code", F.col("request")["path"].alias("path"))


@check(
    "unrecoverable_types",
    with_facts(
        f"""SELECT {_ROW_TYPE_SQL} AS row_type, k > 50 AS matched,
        CASE WHEN k > 50 THEN 'UnrecoverableBadRowType' ELSE 'FailedToMatchConfiguration' END AS code, count(*) AS n
        FROM f WHERE kind = 5 GROUP BY ALL"""
    ),
)
def _(spark, sf_dir):
    rows = refuse_unrecoverable(C.match_flows(decode_events(lines(spark, sf_dir)), X.check_config()))
    sized = rows.filter(F.col("row_type") == wire.SIZE_VIOLATION)
    return sized.groupBy(
        "row_type", (F.size("flows") > 0).alias("matched"), F.col("err")["code"].alias("code")
    ).agg(F.count("*").alias("n"))


# --- requests -----------------------------------------------------------------------


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests rebuilt without any step."""
    return to_request(decode_events(lines(spark, sf_dir)))


@check(
    "request_from_collector",
    with_facts(
        """SELECT event_id, '/' || vendor || '/v1' AS path, 'e=pv&page=' || et || '&aid=' || aid AS querystring, 'k=' || k AS body,
        'X-K: ' || k AS header, 'text/plain' AS content_type, 'collector' AS collector, ms, uuid AS network_user_id
        FROM f WHERE kind IN (2, 3) AND event_id % 13 <> 0"""
    ),
)
def _(spark, sf_dir):
    r = F.col("request")
    return (
        _requests(spark, sf_dir)
        .filter((F.col("shape") == "collector") & F.col("err").isNull())
        .select(
            "event_id",
            r["path"].alias("path"),
            r["querystring"].alias("querystring"),
            r["body"].alias("body"),
            r["headers"][0].alias("header"),
            r["contentType"].alias("content_type"),
            r["collector"].alias("collector"),
            r["timestamp"].alias("ms"),
            r["networkUserId"].alias("network_user_id"),
        )
    )


@check(
    "request_from_enrichment",
    with_facts(
        f"""SELECT event_id, '/' || vendor || '/v1' AS path, CASE WHEN kind = 1
          THEN 'aid=' || aid || chr(10) || 'cx=' || {_CX_SQL} || chr(10) || 'e=ue' || chr(10) || 'flag=' || CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END
            || chr(10) || 'n=' || k || chr(10) || 'note=' || chr(10) || 'page=' || et || CASE WHEN has_ue THEN chr(10) || 'ue_pr=' || {_UE_PR_SQL} ELSE '' END
          ELSE 'e=ue' || chr(10) || 'page=' || et || chr(10) || 'aid=' || aid || CASE WHEN has_ue THEN chr(10) || 'ue_pr=' || {_UE_PR_SQL} ELSE '' END
            || chr(10) || 'cx=' || {_CX_SQL} END AS pairs, CAST(NULL AS VARCHAR) AS body,
        true AS bare, 'loader' AS collector, ms, uuid AS network_user_id FROM f
        WHERE kind IN (0, 1, 6) AND vendor = 'com.acme' AND {_DECODED_SQL}"""
    ),
)
def _(spark, sf_dir):
    r = F.col("request")
    # The whole querystring, decoded. Pairs that came as an object are in the order of their names.
    pairs = F.array_join(F.transform(F.split(r["querystring"], "&"), F.url_decode), "\n")
    return (
        _requests(spark, sf_dir)
        .filter((F.col("shape") == "enrichment") & F.col("err").isNull() & (F.col("payload.vendor") == "com.acme"))
        .select(
            "event_id",
            r["path"].alias("path"),
            pairs.alias("pairs"),
            r["body"].alias("body"),
            (r["headers"].isNull() & r["contentType"].isNull()).alias("bare"),
            r["collector"].alias("collector"),
            r["timestamp"].alias("ms"),
            r["networkUserId"].alias("network_user_id"),
        )
    )


def _webhook(spark: SparkSession, sf_dir: str, vendor: str, root: str) -> DataFrame:
    r = F.col("request")
    body = lambda p: F.get_json_object(r["body"], root + p)
    return (
        _requests(spark, sf_dir)
        .filter((F.col("shape") == "enrichment") & F.col("err").isNull() & (F.col("payload.vendor") == vendor))
        .select(
            "event_id",
            body(".k").cast("bigint").alias("k"),
            body(".user_id").cast("bigint").alias("uid"),
            body(".event").alias("event"),
            r["contentType"].alias("content_type"),
            F.when(F.startswith(r["querystring"], F.lit("schema=")), r["querystring"]).alias("querystring"),
        )
    )


@check(
    "request_sendgrid",
    with_facts(
        f"""SELECT event_id, k, uid, et AS event, 'application/json' AS content_type, CAST(NULL AS VARCHAR) AS querystring FROM f
        WHERE kind IN (0, 1, 6) AND et = 'purchase' AND has_ue AND {_DECODED_SQL}"""
    ),
)
def _(spark, sf_dir):
    return _webhook(spark, sf_dir, wire.SENDGRID_VENDOR, "$[0]")


@check(
    "request_iglu_webhook",
    with_facts(
        f"""SELECT event_id, k, uid, CAST(NULL AS VARCHAR) AS event, 'application/json' AS content_type,
        'schema=iglu:com.acme/' || et || '/jsonschema/1-0-0' AS querystring FROM f
        WHERE kind IN (0, 1, 6) AND et = 'signup' AND has_ue AND {_DECODED_SQL}"""
    ),
)
def _(spark, sf_dir):
    return _webhook(spark, sf_dir, wire.IGLU_WEBHOOK_VENDOR, "$")


@check(
    "request_uncoercible",
    with_facts(
        f"""SELECT event_id, vendor FROM f
        WHERE kind IN (0, 1, 6) AND et IN ('purchase', 'signup') AND NOT has_ue AND {_DECODED_SQL}"""
    ),
)
def _(spark, sf_dir):
    bad = _requests(spark, sf_dir).filter(F.col("err")["code"] == "UncoerciblePayload")
    return bad.select("event_id", F.col("payload.vendor").alias("vendor"))


@check(
    "collector_from_request",
    with_facts(
        """SELECT event_id, CASE event_id % 5 WHEN 0 THEN vendor WHEN 1 THEN vendor ELSE '' END AS vendor,
        CASE event_id % 5 WHEN 0 THEN 'v1' WHEN 2 THEN 'v1' ELSE '' END AS version,
        CASE WHEN event_id % 13 <> 0 THEN uuid END AS user, CASE WHEN event_id % 3 <> 0 THEN iso END AS stamp,
        '' AS collector, 3 AS pairs, CAST(NULL AS VARCHAR) AS code FROM f"""
    ),
)
def _(spark, sf_dir):
    path = (
        "CASE event_id % 5 WHEN 0 THEN concat('/', vendor, '/v1') WHEN 1 THEN concat('/', vendor, '/')"
        " WHEN 2 THEN '//v1' WHEN 3 THEN concat('/', vendor, '/v1/more') ELSE '/' END"
    )
    from rowmend.operators.requests import _request

    request = _request(
        path=path,
        timestamp="CASE WHEN event_id % 3 = 0 THEN 0 ELSE unix_millis(CAST(iso AS TIMESTAMP)) END",
        networkUserId="uuid",
        querystring="concat('e=', et, '&none=&', aid, '=%7B')",
    )
    done = from_request(X.facts(spark, sf_dir).withColumn("request", F.expr(request)))
    p = F.col("payload")
    return done.select(
        "event_id",
        p["vendor"].alias("vendor"),
        p["version"].alias("version"),
        p["user"].alias("user"),
        p["timestamp"].alias("stamp"),
        p["collector"].alias("collector"),
        F.size(p["pairs"]).alias("pairs"),
        F.col("err")["code"].alias("code"),
    )


@check(
    "unsupported_payload",
    with_facts(
        f"""SELECT {_ROW_TYPE_SQL} AS row_type, count(*) AS n FROM f WHERE kind IN (4, 5) OR event_id % 32 = 15 GROUP BY 1"""
    ),
)
def _(spark, sf_dir):
    refused = _requests(spark, sf_dir).filter(F.col("err")["code"] == "UncocoerciblePayload")
    return refused.groupBy("row_type").agg(F.count("*").alias("n"))


# --- outcomes ------------------------------------------------------------------------


@check("classify", with_outcomes("SELECT event_id, status FROM o"))
def _(spark, sf_dir):
    return execute(lines(spark, sf_dir), X.check_config()).select("event_id", "status")


@check(
    "three_way_split",
    with_outcomes("SELECT status AS part, count(*) AS n, sum(event_id) AS ids FROM o GROUP BY 1"),
)
def _(spark, sf_dir):
    parts = O.split_outcomes(outcomes(spark, sf_dir))
    named = [(O.RECOVERED, parts.recovered), (O.FAILED, parts.failed), (O.UNRECOVERABLE, parts.unrecoverable)]
    counted = [
        df.agg(F.count("*").alias("n"), F.sum("event_id").cast("decimal(38,0)").alias("ids")).select(
            F.lit(name).alias("part"), "n", "ids"
        )
        for name, df in named
    ]
    return counted[0].unionAll(counted[1]).unionAll(counted[2])


@check(
    "error_row",
    with_outcomes(
        f"""SELECT event_id, '{wire.RECOVERY_ERROR}' AS row_type,
        CASE WHEN kind = 6 AND code <> 'InvalidDataFormat' THEN 2 + event_id % 3 WHEN kind = 6 THEN 2 + event_id % 3 ELSE 1 END AS recoveries,
        CASE WHEN kind = 6 THEN '{wire.SCHEMA_VIOLATIONS}' ELSE {_ROW_TYPE_SQL} END AS payload_type,
        {_LEAD_SQL} AS lead FROM o WHERE code IS NOT NULL AND event_id % 16 <> 7"""
    ),
)
def _(spark, sf_dir):
    rows = outcomes(spark, sf_dir).filter((F.col("status") != O.RECOVERED) & ~F.startswith("error_row", F.lit(_VIOLATION_START)))
    at = lambda p: F.get_json_object("error_row", p)
    name = lambda p: F.regexp_extract(at(p), r"^iglu:[^/]+/([^/]+)/", 1)
    return rows.select(
        "event_id",
        name("$.schema").alias("row_type"),
        at("$.data.recoveries").cast("bigint").alias("recoveries"),
        name("$.data.payload.schema").alias("payload_type"),
        F.regexp_extract(at("$.data.failure.error"), _LEAD, 1).alias("lead"),
    )


_VIOLATION_START = f'{{"schema":"{O.VIOLATION_SCHEMA}"'


@check(
    "unparsable_row",
    with_facts("""SELECT event_id, '{"schema": "' || et AS payload, '' AS loader FROM f WHERE event_id % 16 = 7"""),
)
def _(spark, sf_dir):
    rows = outcomes(spark, sf_dir).filter(F.startswith("error_row", F.lit(_VIOLATION_START)))
    at = lambda p: F.get_json_object("error_row", p)
    return rows.select(
        "event_id", at("$.data.payload").alias("payload"), at("$.data.failure.loader").alias("loader")
    )


@check("error_codes", with_outcomes("SELECT code, count(*) AS n FROM o WHERE code IS NOT NULL GROUP BY 1"))
def _(spark, sf_dir):
    return outcomes(spark, sf_dir).filter("code IS NOT NULL").groupBy("code").agg(F.count("*").alias("n"))


_SUMMARY_SQL = with_outcomes(
    "SELECT " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in O.STATUSES) + " FROM o"
)


@check("summary", _SUMMARY_SQL)
def _(spark, sf_dir):
    return O.summary(outcomes(spark, sf_dir))


@check(
    "metrics",
    with_outcomes(
        "SELECT 'recovery' AS namespace, 'test' AS env, status AS name, count(*) AS value FROM o GROUP BY status"
    ),
)
def _(spark, sf_dir):
    rows = O.metrics_frame(O.summary(outcomes(spark, sf_dir)), "recovery", {"env": "test"})
    return rows.select("namespace", F.col("dimensions")["env"].alias("env"), "name", "value")


@check("partition_key", "SELECT doc_id, md5(text) AS key FROM documents")
def _(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select("doc_id", O.partition_key(F.col("text")).alias("key"))


# --- streaming -----------------------------------------------------------------------


def _streamed_counts(spark: SparkSession, out: str) -> DataFrame:
    recovered = spark.read.parquet(f"{out}/{O.RECOVERED}").select(F.lit(O.RECOVERED).alias("status"))
    parts = recovered
    for status in (O.FAILED, O.UNRECOVERABLE):
        parts = parts.unionAll(spark.read.text(files.error_dir(f"{out}/{status}")).select(F.lit(status)))
    return parts.groupBy("status").agg(F.count("*").alias("n"))


_COUNTS_SQL = with_outcomes("SELECT status, count(*) AS n FROM o GROUP BY 1")


@check("stream_recover", _COUNTS_SQL)
def _(spark, sf_dir):
    out = X.scratch_dir(spark)
    stream_recover(spark, text_dir(spark, sf_dir), X.check_config(), f"{out}/o", f"{out}/c").awaitTermination()
    return _streamed_counts(spark, f"{out}/o")


@check("stream_replay", _COUNTS_SQL)
def _(spark, sf_dir):
    out = X.scratch_dir(spark)
    for _attempt in range(2):
        write_batch(outcomes(spark, sf_dir).withColumn("err", F.struct("code")), 0, out)
    return _streamed_counts(spark, out)


@check("live_counters", _SUMMARY_SQL)
def _(spark, sf_dir):
    """Half of the lines, a restart, the other half and a replay of the last batch: filed and observed counts agree."""
    out = X.scratch_dir(spark)
    texts = lines(spark, sf_dir)

    def until_ended(start: dict[str, int]) -> dict[str, int]:
        counters = LiveCounters(start=start)
        spark.streams.addListener(counters)
        try:
            stream_recover(spark, f"{out}/in", X.check_config(), f"{out}/o", f"{out}/c").awaitTermination()
            counters.wait()
        finally:
            spark.streams.removeListener(counters)
        return counters.counts

    for half in (0, 1):
        texts.filter(F.col("event_id") % 2 == half).select("value").write.mode("append").text(f"{out}/in")
        seen = until_ended(durable_counters(spark, f"{out}/o").first().asDict())
    again = texts.filter(F.col("event_id") % 2 == 1).select("value")
    write_batch(execute(again, X.check_config()), 1, f"{out}/o")
    live = [F.lit(seen[s]).cast("bigint") for s in O.STATUSES]
    # a count that the two do not agree on is none
    return durable_counters(spark, f"{out}/o").select(*[F.when(F.col(s) == x, x).alias(s) for s, x in zip(O.STATUSES, live, strict=True)])
