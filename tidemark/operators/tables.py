"""Whole-table steps: check, write by date, load."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.sources import files


def validate_row_counts(tables: Mapping[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """``table_name, n_rows, passed`` per table; no column of the tables is read."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            (F.col("n_rows") >= min_rows).alias("passed"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def partitioned_write(df: DataFrame, path: str, by: str) -> int:
    """Write Parquet with one folder per value of ``by``; returns the rows written.

    Folders that receive rows are replaced, others stay.  The rebalance groups rows of
    one value so that a small folder is one file, and under adaptive execution splits a
    value that holds much of the table over several tasks.
    """
    written = Observation()
    (
        df.hint("rebalance", F.col(f"`{by}`"))
        .observe(written, F.count(F.lit(1)).alias("n_rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )
    return written.get["n_rows"]


def table_load(df: DataFrame, table: str, path: str | None = None) -> int:
    """Replace catalog table ``table`` with the rows of ``df``; returns the rows written.

    The rows go into a new folder under ``path`` (default: one named like the table in the
    warehouse), and the table is pointed at it when they are all there: a load that fails
    leaves the table as it was, and ``df`` may read the table itself.  The folder of the load
    before stays for readers at work, older ones are deleted.
    """
    spark = df.sparkSession
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    root = (path or f"{warehouse}/{table.replace('`', '')}.loads").rstrip("/")
    loads = sorted(e.name for e in files.listing(spark, root) if e.name.startswith("load-"))
    number = int(loads[-1].split("-")[1]) + 1 if loads else 0
    target = f"{root}/load-{number:010d}-{uuid.uuid4().hex[:12]}"
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("n_rows")).write.parquet(target)
    held = spark.table(table).schema if spark.catalog.tableExists(table) else None
    if held is not None and held.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
        spark.catalog.refreshTable(table)
    elif held is None:
        spark.catalog.createTable(table, target, "parquet", df.schema)
    else:
        _swap(spark, table, target, df.schema)
    for old in loads[:-1]:
        files.delete_tree(spark, f"{root}/{old}")
    return written.get["n_rows"]


def _swap(spark, table: str, target: str, schema) -> None:
    """Other columns need another catalog entry.  It is made under a name of its own and takes
    the table's by two renames; the old one, whose files stay, goes last.  A job that dies in
    between leaves one of them under ``<table>_old`` or ``<table>_new``, with all its rows."""
    plain = table.replace("`", "")
    old, new = f"{plain}_old", f"{plain}_new"
    for left_over in (old, new):
        spark.sql(f"DROP TABLE IF EXISTS {left_over}")
    spark.catalog.createTable(new, target, "parquet", schema)
    spark.sql(f"ALTER TABLE {plain} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {plain}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {plain}")
        raise
    spark.sql(f"DROP TABLE {old}")
