"""Fixed values of the wire formats.

Everything here is data that other programs read or write: schema URIs, vendor
ids, field names and message texts. They are fixed values: a result is only
right when it carries exactly these.
"""

from __future__ import annotations

# --- fixed values: failed-event schemas --------------------------------------
BAD_ROW_VENDOR = "com.snowplowanalytics.snowplow.badrows"

ADAPTER_FAILURES = "adapter_failures"
FORMAT_VIOLATION = "collector_payload_format_violation"
ENRICHMENT_FAILURES = "enrichment_failures"
RECOVERY_ERROR = "recovery_error"
SCHEMA_VIOLATIONS = "schema_violations"
SIZE_VIOLATION = "size_violation"
TRACKER_PROTOCOL_VIOLATIONS = "tracker_protocol_violations"

KNOWN_ROW_TYPES = (
    "adapter_failures",
    "collector_payload_format_violation",
    "enrichment_failures",
    "loader_iglu_error",
    "loader_parsing_error",
    "loader_recovery_error",
    "loader_runtime_error",
    "recovery_error",
    "relay_failure",
    "schema_violations",
    "size_violation",
    "snowflake_error",
    "tracker_protocol_violations",
)

# Row types whose payload is edited, by payload shape.
COLLECTOR_TYPES = ("adapter_failures", "tracker_protocol_violations")
ENRICHMENT_TYPES = ("enrichment_failures", "schema_violations")

# --- fixed values: request schema and webhook vendors ------------------------
REQUEST_SCHEMA = "iglu:com.snowplowanalytics.snowplow/CollectorPayload/thrift/1-0-0"
SENDGRID_VENDOR = "com.sendgrid"
IGLU_WEBHOOK_VENDOR = "com.snowplowanalytics.iglu"
SELF_DESCRIBING_PARAMETER = "ue_pr"

# --- fixed values: field names with a special encoding -----------------------
NVP_FIELDS = ("parameters", "querystring")
JSON_TEXT_FIELDS = ("co", "ue_pr", "contexts", "derived_contexts")
BASE64_FIELDS = ("cx", "ue_px")

# --- fixed values: characters a querystring value may hold unescaped ---------
QUERY_RESERVED = ":/#[]@!$&'()*+,;="
QUERY_UNRESERVED_MARKS = "-._~"

# --- fixed values: error messages --------------------------------------------
# `%s` takes, in order, the values named in the comment.
MESSAGES = {
    "InvalidJsonFormat": "Failed to parse JSON string from %s",  # text
    "InvalidDataFormat": "Failed to create object from JSON string in %s. %s",  # data, reason
    "UnexpectedFieldFormat": "Supplied data: %s in %s, does not comply expected data format (%s). Raised error: %s",
    "Base64Failure": "Failed to properly transform to/from Base64 string: %s. %s",  # data, reason
    "UrlCodecFailure": "Failed to properly transform to/from URL-encoded string: %s. %s",  # data, reason
    "FailedToMatchConfiguration": (
        "Failed to load recovery configuration for %s. No schema-configuration mapping found."  # schema
    ),
    "ReplacementFailure": "Failed to replace %s with %s in %s",  # match, value, data
    "CastFailure": "Failed to cast %s from %s to %s",  # data, from, to
}

# --- our own error messages: where the original text names classes of its runtime, which mean nothing here ---
MESSAGES |= {
    "UnrecoverableBadRowType": "Failed to recover bad row of type %s.",  # row type
    "AdditionFailure": "Failed to add %s to path %s on %s",  # value, path, data
    "UncoerciblePayload": "Unable to coerce payload to a collector request: %s. Data: %s",  # reason, data
    "UncocoerciblePayload": "Unable to read payload from a collector request: %s. Data: %s",  # reason, data
}

# --- our own identity in the rows we write -----------------------------------
PROCESSOR_ARTIFACT = "rowmend"
PROCESSOR_VERSION = "0.1.0"
