"""A first look at a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows, rows with a value.

    All columns are counted in one pass; nothing is shuffled but one row per task.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(df.schema.fields)],
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type_name"),
            F.col("n_rows"),
            F.col(f"n{i}").alias("n_values"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*[F.col(f"`{c}`") for c in order]).limit(n)
