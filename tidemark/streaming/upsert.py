"""The upsert as a stream of micro-batches."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.labels import DROP_FILE_PATTERN
from tidemark.plans.state import StateTable
from tidemark.sources import files
from tidemark.sources.drops import (
    EMPLOYEE_SCHEMA,
    reader_options,
    reader_schema,
    with_origin,
)


#: Longer than there have been file times, which start in 1970.
NO_AGE_LIMIT = "73000d"


def stream_drops(
    spark: SparkSession,
    base: str,
    schema: T.StructType = EMPLOYEE_SCHEMA,
    pattern: str = DROP_FILE_PATTERN,
    max_files: int = 1000,
    multiline: bool | None = None,
) -> DataFrame:
    """Drops as a stream of files, with the columns of ``read_drops`` and its ``multiline``.

    Spark leaves out files that are much older than the newest it has seen.  Late and copied
    drops may have any age, so the limit is set beyond the first day of file times.
    """
    scan = (
        spark.readStream.schema(reader_schema(schema))
        .options(**reader_options(spark, base.rstrip("/"), multiline))
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", NO_AGE_LIMIT)
        .csv(base)
    )
    return with_origin(scan, schema, pattern)


def upsert_stream(
    drops: DataFrame, state: StateTable, checkpoint: str, name: str | None = None
) -> StreamingQuery:
    """Merge everything that is available and stop; run again for what came since.

    A stream delivers files in no particular order of hours, so the state must be in
    version mode.  A micro-batch that is delivered twice is skipped: the state knows it by
    its number and the id that Spark gave to the checkpoint, so a new checkpoint, at an old
    path as well, is a new stream.  ``name`` is for the labels of the audit.
    """
    if state.mode != "version":
        raise ValueError("a stream needs a state with mode='version'")
    metadata = f"{checkpoint.rstrip('/')}/metadata"

    def merge(batch: DataFrame, number: int) -> None:
        identity = json.loads(files.read_text(state.spark, metadata))["id"]
        label = f"{name or checkpoint}#{number}"
        state.apply(batch, label=label, stream=(identity, number))
        if state.fold_due():
            state.fold()

    return (
        drops.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
