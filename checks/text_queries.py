"""Edits that keep the rest of a document's text: whole texts, key order and digits, against SQL.

Every event gives a document whose keys are not sorted and whose numbers are written with digits that say
nothing (`1.50`, `2.0`, `1e5`); in every third one there are blanks between the tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmend import wire
from rowmend.functions import variants as V
from rowmend.functions.codecs import b64_decode, b64_encode
from rowmend.operators import conditions as C
from rowmend.operators.steps import apply_steps
from rowmend.plans.config import Add, Cast, Config, Replace, Step
from rowmend.plans.recovery import execute

from . import fixtures as X
from .fixtures import with_facts
from .queries import check

_K = "CAST(k AS STRING)"
_A = """'{"y":2.0,"b":"' || et || '"}'"""


def document(
    z: str = "CAST(val AS STRING) || '0'",
    first: str | None = None,
    n0: str = "'1.50'",
    k0: str = _K,
    a: str = _A,
    n1: str = f"{_K} || '.0'",
    k1: str = "'\"x, y\"'",
    items: str | None = None,
) -> str:
    """The document's text as SQL that both engines read, with some of its parts exchanged."""
    head = first or f"""'{{"n":' || {n0} || ',"k":' || {k0} || ',"a":' || {a} || '}}'"""
    listed = items or f"""'[' || {head} || ',{{"n":' || {n1} || ',"k":' || {k1} || ',"e":1e5}}]'"""
    return f"""'{{"z":' || {z} || ',"schema":"iglu:com.acme/' || et || '/jsonschema/1-0-0","data":' || {listed} || ',"b":null}}'"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of each event and `text`, the document with blanks in every third one."""
    blanks = f"""CASE WHEN event_id % 3 = 0 THEN replace({document()}, ',"', ' ,\\n"') ELSE {document()} END"""
    return X.facts(spark, sf_dir).withColumn("text", F.expr(blanks))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`event_id, document`: the text as a pair's base64 (cx), as a pair's JSON text (ue_pr) and as a field (contexts)."""
    pairs = f"array(named_struct('name', 'cx', 'value', {b64_encode('text')}), named_struct('name', 'ue_pr', 'value', text))"
    made = f"to_variant_object(named_struct('parameters', {pairs}, 'contexts', text))"
    return texts(spark, sf_dir).select("event_id", F.expr(made).alias("document"))


def _edited(spark: SparkSession, sf_dir: str, steps: Sequence[Step], place: str) -> DataFrame:
    """The whole text at a place after the steps."""
    done = apply_steps(documents(spark, sf_dir), steps)
    held = {
        "cx": b64_decode(V.string(V.get("document", "parameters", 0, "value"))),
        "ue_pr": V.string(V.get("document", "parameters", 1, "value")),
        "contexts": V.string(V.get("document", "contexts")),
    }
    return done.select("event_id", F.expr(held[place]).alias("whole"), F.expr("err.code").alias("code"))


def _edit(name: str, place: str, steps: Sequence[Step], whole: str) -> None:
    @check(name, with_facts(f"SELECT event_id, {whole} AS whole, CAST(NULL AS STRING) AS code FROM f"))
    def _(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _edited(spark, sf_dir, steps, place)


_edit("text_base64", "cx", [Replace("parameters.cx.data.[1].k", "new")], document(k1="""'"new"'"""))
_edit("text_json", "contexts", [Replace("contexts.data.[0].a.b", "new")], document(a="""'{"y":2.0,"b":"new"}'"""))
_edit("text_filter", "ue_pr", [Replace("parameters.[?(@.name=~ue_pr)].value.data.[?(@.k=~x)].n", 7)], document(n1="'7'"))
_edit("text_replace_string", "contexts", [Replace("contexts.schema", "iglu:org.$1", "iglu:com[.]([a-z]+)")], f"replace({document()}, 'iglu:com.acme', 'iglu:org.acme')")
_edit("text_replace_object", "contexts", [Replace("contexts.data.[0].a", '"c":9.50,"b":', '"b":')], document(a="""'{"y":2.0,"c":9.50,"b":"' || et || '"}'"""))
_edit(
    "text_replace_array",
    "cx",
    [Replace("parameters.cx.data", [{"t": 3}], '"e":1e5')],
    document(items=f"""'[{{"n":1.50,"k":' || {_K} || ',"a":' || {_A} || '}},{{"t":3}}]'"""),
)
_edit("text_cast_string", "contexts", [Cast("contexts.data.[0].a", "Array", "String")], document(a="""'"{\\"y\\":2.0,\\"b\\":\\"' || et || '\\"}"'""".replace("\\", "' || chr(92) || '")))
_edit("text_cast_array", "ue_pr", [Cast("parameters.ue_pr.z", "Numeric", "Array")], document(z="'[' || CAST(val AS STRING) || '0]'"))
_edit(
    "text_add",
    "contexts",
    [Add("contexts.data.[0]", {"k": 0, "new": []}), Add("contexts.data.[0].a.y", 1), Add("contexts.data", [True])],
    document(
        items=f"""'[{{"n":1.50,"k":0,"a":{{"y":3.0,"b":"' || et || '"}},"new":[]}},{{"n":' || {_K} || '.0,"k":"x, y","e":1e5}},true]'"""
    ),
)


@check(
    "text_chain",
    with_facts(f"SELECT event_id, {document(k1=chr(39) + chr(34) + 'n2' + chr(34) + chr(39), n0='10', a=chr(39) + chr(34) + chr(34) + chr(39))} AS whole, CAST(NULL AS STRING) AS code FROM f"),
)
def _(spark, sf_dir):
    """Three places of one base64 document, one after the other."""
    at = "parameters.cx.data"
    steps = [Replace(f"{at}.[1].k", "n2"), Replace(f"{at}.[0].n", 10), Cast(f"{at}.[0].a", "Array", "String"), Replace(f"{at}.[0].a", "", ".+")]
    return _edited(spark, sf_dir, steps, "cx")


@check(
    "text_conditions",
    with_facts(
        """SELECT event_id, true AS as_written, false AS as_sorted, true AS digits, k = 50 AS first_k, true AS through_filter, true AS in_base64,
        false AS blanks FROM f"""
    ),
)
def _(spark, sf_dir):
    """Patterns see an object's text as it was written, without blanks between its tokens."""
    return documents(spark, sf_dir).select(
        "event_id",
        C.matches("contexts.data.[0].a", '^[{]"y":2[.]0,"b":').alias("as_written"),
        C.matches("contexts.data.[0].a", '^[{]"b"').alias("as_sorted"),
        C.matches("parameters.ue_pr", '^[{]"z":[0-9.]+0,.*"e":1e5[}]\\],"b":null[}]$').alias("digits"),
        C.matches("contexts.data.[0]", '"n":1[.]50,"k":50,').alias("first_k"),
        C.matches("parameters.[?(@.name=~ue_pr)].value.data", "^\\[[{]\"n\":1[.]50").alias("through_filter"),
        C.matches("parameters.cx.data.[1]", '"k":"x, y","e":1e5').alias("in_base64"),
        C.matches("contexts", '[ \\n],').alias("blanks"),
    )


def _inner() -> str:
    """A failed event that no flow is for, with the document in its payload."""
    head = f'{{"schema":"{X.schema_of(wire.SIZE_VIOLATION, "1-0-0")}","data":{{"processor":{{"version":"1.50","artifact":"a"}},"failure":{{"z":2.0,"a":1}},"payload":'
    return f"'{head}' || {document()} || '}}}}'"


@check("text_error_row", with_facts(f"SELECT event_id, {_inner()} AS whole FROM f"))
def _(spark, sf_dir):
    """The event inside a recovery error comes out of it again as it was."""
    head = f'{{"schema":"{X.schema_of(wire.RECOVERY_ERROR, "1-0-0")}","data":{{"processor":{{"version":"1","artifact":"a"}},"failure":{{}},"recoveries":2,"payload":'
    line = F.concat(F.lit(head), F.expr(_inner()), F.lit("}}"))
    failed = execute(X.facts(spark, sf_dir).withColumn("value", line), Config(()))
    return failed.select("event_id", F.regexp_extract("error_row", r'"payload":(.*),"recoveries":3}}$', 1).alias("whole"))

