"""Hourly drops: ``<base>/time_stamp=YYYY-MM-DD-HH/data_<n>.csv``."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.labels import DROP_FILE_PATTERN, file_index
from tidemark.sources import files
from tidemark.sources.export import CSV_READ, CSV_WRITE

PARTITION = "time_stamp"
FILE_INDEX = "file_index"
CORRUPT = "_corrupt_record"
DROP_VERSION = (PARTITION, FILE_INDEX)

# The columns of an employee drop.
EMPLOYEE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("department", T.StringType()),
        T.StructField("salary", T.DoubleType()),
        T.StructField("working_hours", T.DoubleType()),
    ]
)

# A file of this name in the base says that fields of its drops hold line breaks.
_MULTILINE = "_multiline"
# Tasks move their own files to where they are renamed from, instead of the driver one by one.
_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
# How Spark names the folder of rows without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Above this many hours one listing of the base folder beats a look-up per hour.
_LOOKUPS = 64


def drop_schema(schema: T.StructType) -> T.StructType:
    """Columns of ``schema`` followed by where each row came from."""
    return T.StructType(
        list(schema.fields)
        + [
            T.StructField(PARTITION, T.StringType()),
            T.StructField(FILE_INDEX, T.IntegerType()),
        ]
    )


def reader_schema(schema: T.StructType) -> T.StructType:
    """What the CSV reader is told: data, the raw text of bad lines, the folder label."""
    return T.StructType(
        list(schema.fields)
        + [T.StructField(CORRUPT, T.StringType()), T.StructField(PARTITION, T.StringType())]
    )


def reader_options(spark: SparkSession, base: str, multiline: bool | None) -> dict[str, str]:
    if multiline is None:
        multiline = files.exists(spark, f"{base}/{_MULTILINE}")
    # With ``enforceSchema`` off each file's header is compared with the schema, instead of
    # positions being trusted.
    return CSV_READ | {
        "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def with_origin(drops: DataFrame, schema: T.StructType, pattern: str) -> DataFrame:
    """Add the file number.  Must come straight after the scan: ``_metadata`` does
    not survive a join or a shuffle."""
    number = file_index(F.col("_metadata.file_name"), pattern).alias(FILE_INDEX)
    return drops.select(*[F.col(f"`{n}`") for n in schema.names], PARTITION, number, CORRUPT)


def available_hours(
    spark: SparkSession, base: str, hours: Sequence[str] | None = None
) -> list[str]:
    """Labels that have a folder, ascending; limited to ``hours`` when given."""
    if hours is not None and len(hours) <= _LOOKUPS:
        return sorted(
            {h for h in hours if files.is_dir(spark, f"{base}/{PARTITION}={h}")}
        )
    prefix = f"{PARTITION}="
    found = {
        name.removeprefix(prefix)
        for name in files.names(spark, base)
        if name.startswith(prefix)
    }
    return sorted(found if hours is None else found.intersection(hours))


def read_drops(
    spark: SparkSession,
    base: str,
    schema: T.StructType = EMPLOYEE_SCHEMA,
    hours: Sequence[str] | None = None,
    pattern: str = DROP_FILE_PATTERN,
    multiline: bool | None = None,
) -> DataFrame:
    """All rows of the wanted hours with ``time_stamp``, ``file_index`` and
    ``_corrupt_record``.

    Only the folders of the wanted hours are listed, however many hours the base
    holds.  Hours without a folder contribute nothing.  A field that does not parse
    is NULL and its line is kept in ``_corrupt_record``; Spark parses only the columns
    a query uses, so select all of them when looking for bad lines.

    Spark splits a large file over many tasks, for which every line break must end a row.
    Where fields hold line breaks themselves, ``multiline`` has one task read a file.
    Left open, it is what ``write_drops`` has noted of the drops it wrote, else off.
    """
    base = base.rstrip("/")
    present = available_hours(spark, base, hours)
    if not present:
        empty = T.StructType(
            list(drop_schema(schema).fields) + [T.StructField(CORRUPT, T.StringType())]
        )
        return spark.createDataFrame([], empty)
    every = hours is None or (
        len(present) > _LOOKUPS and len(present) == len(available_hours(spark, base))
    )
    paths = [base] if every else [f"{base}/{PARTITION}={h}" for h in present]
    scan = (
        spark.read.schema(reader_schema(schema))
        .options(**reader_options(spark, base, multiline))
        .option("basePath", base)
        .csv(paths)
    )
    return with_origin(scan, schema, pattern)


def write_drops(rows: DataFrame, base: str) -> None:
    """Write rows with ``time_stamp`` and ``file_index`` as drops, one file
    ``time_stamp=<hour>/data_<n>.csv`` per hour and number.

    Spark's writers name files themselves.  So they write to a folder beside ``base``, and the
    files are moved to their names when all are there: a reader or a stream on ``base`` never
    finds half a file, and a job that fails leaves ``base`` as it was.  Drops may be added to
    a base; an hour and number that it holds already is an error, before anything is moved.
    The rows of a file meet in one task, which writes it.  Rows without a number go to
    ``data_.csv``, whose name gives none back.
    """
    spark, base = rows.sparkSession, base.rstrip("/")
    parent, slash, name = base.rpartition("/")
    beside = f"{parent}{slash}_{name}-{uuid.uuid4().hex}"
    texts = [F.col(f"`{f.name}`") for f in rows.schema.fields if f.dataType == T.StringType()]
    breaks = reduce(or_, [t.contains("\n") | t.contains("\r") for t in texts], F.lit(False))
    seen = Observation()
    try:
        (
            rows.observe(seen, F.max(breaks).alias("multiline"))
            .repartition(files.writers(spark), PARTITION, FILE_INDEX)
            .write.options(**CSV_WRITE, **_COMMIT, maxRecordsPerFile=0)
            .partitionBy(PARTITION, FILE_INDEX)
            .csv(beside)
        )
        moves = []
        for path in files.matching(spark, f"{beside}/{PARTITION}=*/{FILE_INDEX}=*/part-*"):
            hour, number = path.split("/")[-3:-1]
            number = number.removeprefix(f"{FILE_INDEX}=").replace(_NO_VALUE, "")
            moves.append((path, f"{hour}/data_{number}.csv"))
        hours = sorted({file.partition("/")[0] for _, file in moves})
        if new := not files.is_dir(spark, base):
            target = f"{beside}/ready"
        else:
            target = base
            held = files.matching(spark, f"{base}/{{{','.join(hours)}}}/*")
            held = {"/".join(path.split("/")[-2:]) for path in held}
            if taken := sorted(file for _, file in moves if file in held):
                raise FileExistsError(f"drops that are there already: {taken[:5]}")
        files.make_dirs(spark, [target, *[f"{target}/{hour}" for hour in hours]])
        if moves and seen.get["multiline"]:
            files.create_text(spark, f"{target}/{_MULTILINE}", "")
        files.rename_all(spark, [(path, f"{target}/{file}") for path, file in moves])
        if new:
            files.rename(spark, target, base)
    finally:
        files.delete_tree(spark, beside)
