"""Bring a state up to date over a range of hours."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.functions.labels import DROP_FILE_PATTERN
from tidemark.operators.calendar import hour_labels
from tidemark.plans.state import StateTable
from tidemark.sources.drops import EMPLOYEE_SCHEMA, PARTITION, available_hours, read_drops

#: Hours that are read and written together; each is a version of its own all the same.
AT_ONCE = 24 * 31

_REPORT = T.StructType(
    [T.StructField("time_stamp", T.StringType()), T.StructField("missing", T.BooleanType())]
)


def _report(state: StateTable, wanted: list[str], present: list[str]) -> DataFrame:
    have = set(present)
    return state.spark.createDataFrame([(h, h not in have) for h in wanted], _REPORT)


def apply_hour(
    state: StateTable,
    base: str,
    hour: datetime,
    schema: T.StructType = EMPLOYEE_SCHEMA,
    pattern: str = DROP_FILE_PATTERN,
    multiline: bool | None = None,
) -> dict | None:
    """Merge the drops of one hour; returns its audit counts, or None when the hour has
    no folder and is skipped."""
    label = hour_labels(hour, hour)[0]
    if not available_hours(state.spark, base, [label]):
        return None
    drops = read_drops(state.spark, base, schema, [label], pattern, multiline)
    counts = state.apply(drops, label=label)
    if state.fold_due():
        state.fold()
    return counts


def backfill(
    state: StateTable,
    base: str,
    start: datetime | None = None,
    end: datetime | None = None,
    schema: T.StructType = EMPLOYEE_SCHEMA,
    pattern: str = DROP_FILE_PATTERN,
    multiline: bool | None = None,
) -> DataFrame:
    """All hours from ``start`` to ``end`` in one pass: one scan, one merge, one version.

    Without ``start`` and ``end``, whatever hours the base holds.  Needs a state in version
    mode, where this equals applying the hours one by one.  Returns ``time_stamp, missing``
    per hour; hours without a folder are skipped.
    """
    if state.mode != "version":
        raise ValueError("one pass over many hours needs mode='version'; use backfill_hourly")
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    wanted = None if start is None else hour_labels(start, end)
    present = available_hours(state.spark, base, wanted)
    if present:
        hours = None if wanted is None else present
        drops = read_drops(state.spark, base, schema, hours, pattern, multiline)
        state.apply(drops, label=f"{present[0]}..{present[-1]}")
    return _report(state, present if wanted is None else wanted, present)


def backfill_hourly(
    state: StateTable,
    base: str,
    start: datetime,
    end: datetime,
    schema: T.StructType = EMPLOYEE_SCHEMA,
    pattern: str = DROP_FILE_PATTERN,
    multiline: bool | None = None,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """The hours one after the other, ascending, one version each.

    This is what an hourly schedule does, and the only way to fill a state in arrival
    mode.  Returns the same report as ``backfill``.

    What an hour brings does not depend on the state, only what is published after what does.
    So the newest rows of up to ``at_once`` hours are found by one scan and one shuffle, and
    their versions published in order.  A fold that is due comes after these, as a version of
    its own.  A back-fill that died is run again from any hour up to the last published one.
    """
    wanted = hour_labels(start, end)
    present = available_hours(state.spark, base, wanted)
    for first in range(0, len(present), at_once):
        hours = present[first : first + at_once]
        drops = read_drops(state.spark, base, schema, hours, pattern, multiline)
        state.apply_each(drops, PARTITION, hours)
        if state.fold_due():
            state.fold()
    return _report(state, wanted, present)
