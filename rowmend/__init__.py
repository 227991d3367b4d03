"""Repair of failed events on Spark."""

from .functions.variants import configure
from .operators.conditions import all_of, equals, match_flows, matches, size_is
from .operators.decode import decode_events, decode_payloads, parse_events, unwrap_recovery_errors
from .operators.outcomes import classify, error_rows, metrics_frame, split_outcomes, summary
from .operators.paths import edit, read
from .operators.recover import recover, repair_format_violations
from .operators.requests import from_request, to_request
from .operators.steps import add, apply_flows, apply_steps, cast, edit_path, remove, replace
from .plans.config import Config, ConfigError, load_config
from .plans.recovery import execute, run_batch
from .sources.batches import message_batches
from .sources.files import (
    read_failed_events,
    stream_failed_events,
    to_stream_records,
    write_errors,
    write_recovered,
)
from .sources.runs import read_recovered
from .streaming.job import durable_counters, stream_recover

__all__ = [
    "Config",
    "ConfigError",
    "add",
    "all_of",
    "apply_flows",
    "apply_steps",
    "cast",
    "classify",
    "configure",
    "decode_events",
    "decode_payloads",
    "durable_counters",
    "edit",
    "edit_path",
    "equals",
    "error_rows",
    "execute",
    "from_request",
    "load_config",
    "match_flows",
    "matches",
    "message_batches",
    "metrics_frame",
    "parse_events",
    "read",
    "read_failed_events",
    "read_recovered",
    "recover",
    "remove",
    "repair_format_violations",
    "replace",
    "run_batch",
    "size_is",
    "split_outcomes",
    "stream_failed_events",
    "stream_recover",
    "summary",
    "to_request",
    "to_stream_records",
    "unwrap_recovery_errors",
    "write_errors",
    "write_recovered",
]
