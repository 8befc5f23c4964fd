"""Fixed intervals of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_report(df: DataFrame, ts: str, width: str = "3 hours") -> DataFrame:
    """Start, end, length in seconds and row count of every interval with rows."""
    return (
        df.groupBy(F.window(ts, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            F.col("w.start").alias("interval_start"),
            F.col("w.end").alias("interval_end"),
            F.timestamp_diff("SECOND", F.col("w.start"), F.col("w.end")).alias(
                "duration_seconds"
            ),
            "n_rows",
        )
    )
