"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text over lower-cased a-z, 0-9 and everything beyond ASCII, as UTF-8.

    In UTF-8 every byte of a character beyond ASCII is 0x80 or more, so the words of the
    bytes are the words of the characters, and ``bytes.lower`` touches A-Z alone.
    """
    from re import findall

    return findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower()) if text else []


def carried(kept: list[str], text_col: str) -> tuple[Column, list[Column]]:
    """Columns that travel beside the text: packed under one name, so that they clash with
    none of an operator's own, and unpacked again.  The text itself is not sent twice: column
    ``text`` is taken for it."""
    others = [F.col(f"`{name}`") for name in kept if name != text_col]
    packed = F.struct(*others) if others else F.struct(F.lit(0).alias("none"))
    back = [F.col("text" if n == text_col else f"row.`{n}`").alias(n) for n in kept]
    return packed.alias("row"), back


def drawn_texts(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of ``id`` and ``text`` that a small frame draws by id, one per row of that: where an
    id has several texts, the first by a hash of the text.  A task sends one row per draw,
    however many rows carry its id."""
    ranked = F.struct(F.xxhash64("text").alias("h"), "text")
    return (
        rows.join(F.broadcast(chosen), "id")
        .groupBy(*chosen.columns)
        .agg(F.min(ranked).alias("first"))
        .select(*chosen.columns, "first.text")
    )


#: Rows of an Arrow batch that are Python objects at one time.
SLICE_ROWS = 512


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str
) -> DataFrame:
    """Run a function over the Arrow batches of a frame, column lists in, column lists out.

    ``make`` runs once per task and returns the function, so that what it needs is loaded
    once and kept for the task's batches.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, len(batch), SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                names = enumerate(part.schema.names)
                out = work({name: part.column(i).to_pylist() for i, name in names})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[field.name], type=field.type) for field in target],
                    schema=target,
                )

    return df.mapInArrow(run, schema)
