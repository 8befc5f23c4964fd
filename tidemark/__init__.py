"""Keep a keyed table up to date from hourly drops of files, on Spark.

The building blocks are plain functions from DataFrame to DataFrame; the only
object is ``StateTable``, which publishes merged results as versions.  Every
function takes the caller's session (directly or through a DataFrame) and none
creates, configures or stops one.
"""

from tidemark.functions.draws import draw_decimal, draw_integer, draw_item
from tidemark.functions.labels import file_index, hour_start, label_time, partition_label
from tidemark.operators.calendar import (
    hour_calendar,
    hour_labels,
    hourly_row_counts,
    hours_of,
    partition_calendar,
)
from tidemark.operators.intervals import interval_report
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import carry_over, union_merge, upsert, upsert_audit
from tidemark.operators.profile import preview, schema_profile
from tidemark.operators.tables import partitioned_write, table_load, validate_row_counts
from tidemark.plans.backfill import apply_hour, backfill, backfill_hourly
from tidemark.plans.flow import TableSpec, run_flow
from tidemark.plans.generate import generate_rows
from tidemark.plans.state import CommitConflict, StateTable
from tidemark.sources.drops import EMPLOYEE_SCHEMA, available_hours, read_drops, write_drops
from tidemark.sources.export import export_csv
from tidemark.sources.typed import cast_columns, read_all_strings, read_csv, read_inferred
from tidemark.streaming.upsert import stream_drops, upsert_stream

__all__ = [
    "CommitConflict",
    "EMPLOYEE_SCHEMA",
    "StateTable",
    "TableSpec",
    "apply_hour",
    "available_hours",
    "backfill",
    "backfill_hourly",
    "carry_over",
    "cast_columns",
    "draw_decimal",
    "draw_integer",
    "draw_item",
    "export_csv",
    "file_index",
    "generate_rows",
    "hour_calendar",
    "hour_labels",
    "hour_start",
    "hourly_row_counts",
    "hours_of",
    "interval_report",
    "label_time",
    "latest_per_key",
    "partition_calendar",
    "partition_label",
    "partitioned_write",
    "preview",
    "read_all_strings",
    "read_csv",
    "read_drops",
    "read_inferred",
    "run_flow",
    "schema_profile",
    "stream_drops",
    "table_load",
    "union_merge",
    "upsert",
    "upsert_audit",
    "upsert_stream",
    "validate_row_counts",
    "write_drops",
]
