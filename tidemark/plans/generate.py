"""Synthetic employee drops for a set of hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.draws import draw_decimal, draw_integer, draw_item, row_digest
from tidemark.sources.drops import FILE_INDEX, PARTITION

# What the drops may contain.
NAMES = [
    "Alice", "Bob", "Charlie", "Diana", "Eve", "Frank", "Grace", "Hank", "Ivy", "Jack",
]
DEPARTMENTS = ["Engineering", "Marketing", "Sales", "HR", "Finance", "Operations"]
FILES_PER_HOUR = (1, 5)
ROWS_PER_FILE = (5, 20)
AGES = (22, 60)
SALARIES = (30000, 120000)
WORKING_HOURS = (20, 60)


def generate_rows(hours: DataFrame, seed: int = 0) -> DataFrame:
    """Drops for every ``time_stamp`` of ``hours``: a few files per hour, each with ids
    1..n.  The same seed and hour give the same rows, however the hours are partitioned.
    Only the hours themselves are spread over the cores; the rows made from them stay
    where they are made, so all rows of one file lie in one task."""
    cores = hours.sparkSession.sparkContext.defaultParallelism
    stamp, number, row = F.col(PARTITION), F.col(FILE_INDEX), F.col("id")
    n_files = draw_integer(row_digest(seed, stamp), 1, 6, *FILES_PER_HOUR).cast("int")
    n_rows = draw_integer(row_digest(seed, stamp, number), 1, 6, *ROWS_PER_FILE).cast("int")
    one = F.lit(1)
    digest = F.col("digest")
    return (
        hours.select(PARTITION)
        .repartition(cores)
        .select(PARTITION, F.explode(F.sequence(one, n_files)).alias(FILE_INDEX))
        .select(PARTITION, FILE_INDEX, F.explode(F.sequence(one, n_rows)).alias("id"))
        .select(PARTITION, FILE_INDEX, "id", row_digest(seed, stamp, number, row).alias("digest"))
        .select(
            "id",
            draw_item(digest, 1, 6, NAMES).alias("name"),
            draw_integer(digest, 7, 6, *AGES).cast("int").alias("age"),
            draw_item(digest, 13, 6, DEPARTMENTS).alias("department"),
            draw_decimal(digest, 19, 8, *SALARIES, 2).alias("salary"),
            draw_decimal(digest, 27, 6, *WORKING_HOURS, 1).alias("working_hours"),
            PARTITION,
            FILE_INDEX,
        )
    )
