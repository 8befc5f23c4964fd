"""Hours: which there should be, which there are, how many rows each has."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import day_hour_label, hour_start, partition_label

# Fixed value: the folder label of an hour.
_LABEL = "%Y-%m-%d-%H"


def hour_labels(start: datetime, end: datetime) -> list[str]:
    """Labels of every hour from ``start`` to ``end``, both included."""
    hours = int((end - start) / timedelta(hours=1))
    return [(start + timedelta(hours=i)).strftime(_LABEL) for i in range(hours + 1)]


def hour_calendar(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """One row ``time_stamp`` per hour, both ends included."""
    first, last = (F.lit(t.strftime("%Y-%m-%d %H:%M:%S")) for t in (start, end))
    hours = F.sequence(
        first.cast("timestamp_ntz"), last.cast("timestamp_ntz"), F.expr("interval 1 hour")
    )
    return spark.range(1).select(F.explode(hours).alias("ts")).select(
        partition_label(F.col("ts")).alias("time_stamp")
    )


def hours_of(df: DataFrame, ts: str) -> DataFrame:
    """One row ``time_stamp`` per hour from the first to the last time of ``df``."""
    ends = df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
    hours = F.sequence(
        hour_start(F.col("first")), hour_start(F.col("last")), F.expr("interval 1 hour")
    )
    return ends.select(F.explode(hours).alias("ts")).select(
        partition_label(F.col("ts")).alias("time_stamp")
    )


def hourly_row_counts(df: DataFrame, ts: str) -> DataFrame:
    """``time_stamp, n_rows`` for the hours that have rows, by their time.  They are grouped
    on two small numbers, and only the groups are given labels."""
    groups = df.groupBy(F.to_date(ts).alias("day"), F.hour(ts).alias("hour"))
    return groups.agg(F.count(F.lit(1)).alias("n_rows")).select(
        day_hour_label(F.col("day"), F.col("hour")).alias("time_stamp"), "n_rows"
    )


def partition_calendar(calendar: DataFrame, counts: DataFrame) -> DataFrame:
    """Every hour of ``calendar`` with its row count and whether it is missing."""
    return calendar.join(counts, "time_stamp", "left").select(
        "time_stamp",
        F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
        F.col("n_rows").isNull().alias("missing"),
    )
