"""Hour labels and the file number of a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The folder label of an hour and the name of a dropped file.
LABEL_FORMAT = "yyyy-MM-dd-HH"
DROP_FILE_PATTERN = r"data_(\d+)\.csv"


def hour_start(ts: Column) -> Column:
    """The first instant of the hour of ``ts``, as ``timestamp_ntz``.

    Taken from the date and the hour of day.  ``date_trunc`` and ``date_format`` would
    first move a ``timestamp_ntz`` into the session zone, and so shift the hours which
    that zone skips.
    """
    return F.to_date(ts).cast("timestamp_ntz") + F.expr("INTERVAL '1' HOUR") * F.hour(ts)


def partition_label(ts: Column) -> Column:
    """``2026-05-01 04:30:00`` -> ``2026-05-01-04``; the label sorts like the time.

    Where rows are grouped or compared by hour, ``hour_start`` is the cheaper value to
    do it on; the label can be added to the result.
    """
    return day_hour_label(F.to_date(ts), F.hour(ts))


def day_hour_label(day: Column, hour: Column) -> Column:
    """The label of hour 0..23 of a date."""
    hours = F.array(*[F.lit(f"-{h:02d}") for h in range(24)])
    return F.concat(day.cast("string"), F.element_at(hours, hour + 1))


def label_time(label: Column) -> Column:
    """Inverse of ``partition_label``: the first instant of the hour."""
    return F.to_timestamp_ntz(label, F.lit(LABEL_FORMAT))


def file_index(name: Column, pattern: str = DROP_FILE_PATTERN) -> Column:
    """The number in a file name, NULL when the name does not match."""
    return F.regexp_extract(name, pattern, 1).try_cast("int")
