"""The newest row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def orderable(kind: T.DataType) -> bool:
    """Whether values of a type can be compared for order."""
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    version: Sequence[str],
    tiebreak: Sequence[str] = (),
    strategy: str = "aggregate",
    tally: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest ``(version, tiebreak)``.

    A NULL version ranks below every number.  Rows that tie on version and tiebreak
    are decided by their remaining columns, so the answer never depends on the order
    in which Spark meets the rows.

    ``aggregate`` (default) is a maximum over a struct that starts with the version:
    each task reduces its input to one row per key before the shuffle, so a key that
    holds a third of the table costs one row per task.  ``window`` is ``row_number``
    with a filter, which Spark also cuts to one row per key before the shuffle, but
    it sorts on the whole version instead of the key alone.

    ``tally`` (aggregate only) adds columns counting, per key, the input rows for
    which a condition holds.  They ride along with the rows, so totals taken from
    them are exact even when tasks are run again.
    """
    leading = list(dict.fromkeys([*version, *tiebreak]))
    placed = set(keys) | set(leading)
    rest = [f for f in df.schema.fields if f.name not in placed]
    order = [n for n in leading if n not in set(keys)]
    order += [f.name for f in rest if orderable(f.dataType)]
    unordered = [f.name for f in rest if not orderable(f.dataType)]

    if strategy == "window":
        if tally:
            raise ValueError("tally needs the aggregate strategy")
        ranking = Window.partitionBy(*[_col(k) for k in keys]).orderBy(
            *[_col(n).desc_nulls_last() for n in order]
        )
        rank = "__rank"
        return (
            df.withColumn(rank, F.row_number().over(ranking))
            .filter(F.col(rank) == 1)
            .drop(rank)
        )
    if strategy != "aggregate":
        raise ValueError(f"unknown strategy {strategy!r}")

    carried = order + unordered
    counts = [F.count_if(cond).alias(name) for name, cond in (tally or {}).items()]
    grouped = df.groupBy(*[_col(k) for k in keys])
    if not carried:
        return grouped.agg(*(counts or [F.count(F.lit(1)).alias("__n")])).select(
            *[_col(n) for n in df.columns], *(tally or {})
        )
    ranked = F.struct(*[_col(n) for n in order])
    best = (
        F.max_by(F.struct(*[_col(n) for n in carried]), ranked) if unordered else F.max(ranked)
    )
    return grouped.agg(best.alias("__best"), *counts).select(
        *[
            _col(n) if n in set(keys) else F.col(f"__best.`{n}`").alias(n)
            for n in df.columns
        ],
        *(tally or {}),
    )
