"""Readers for data whose types are not declared at the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.export import CSV_READ


def read_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """A CSV folder with types guessed from the data.

    Guessing reads the files once more; ``sampling_ratio`` below 1 guesses from a
    part of the lines.  Meant for looking at unknown data, not for feeding a state.
    """
    return (
        spark.read.options(**{k: v for k, v in CSV_READ.items() if k != "enforceSchema"})
        .option("inferSchema", True)
        .option("samplingRatio", sampling_ratio)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV folder with declared types, as ``export_csv`` writes it: every value comes back
    as it was, line breaks, blanks and empty strings included."""
    return spark.read.schema(schema).options(**CSV_READ).csv(path)


def read_all_strings(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV folder read as text, then given the declared types."""
    text = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])
    return cast_columns(read_csv(spark, path, text), schema)


def cast_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; a value that does not fit is NULL."""
    return df.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
